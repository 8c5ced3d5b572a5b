"""Statistics queries over the risk-shaped adapter view (fx_risk)."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import functions as F

from riskspan.catalog import SCORE_BIN_EDGES
from riskspan.operators import correlation as R
from riskspan.operators import stats as S
from riskspan.functions.distributions import ppf_sql
from riskspan.operators.normality import swilk_sql
from riskspan.plans.fixtures import cte, fx, table
from riskspan.plans.q_cohorts import normal_tail_sql
from riskspan.plans.q_core import ID_RE
from riskspan.plans.q_sources import SEEDED
from riskspan.plans.registry import query

PAIRS = [("cvss", "epss_0"), ("cvss", "days_to_exploit"), ("epss_0", "days_to_exploit")]


def r6(c):
    return F.round(c, 6)


def _named_pairs(df, *more):
    names = F.element_at(F.array(*[F.lit(f"{x}~{y}") for x, y in PAIRS]), F.col("pair") + 1)
    return df.select(names.alias("pair"), F.col("n").cast("long").alias("n"), *(more or [r6(F.col("coef")).alias("coef")]))


def _pair_sql(body: str) -> str:
    parts = []
    for x, y in PAIRS:
        parts.append(body.format(x=x, y=y, pair=f"{x}~{y}"))
    return cte("fx_risk") + "\nunion all\n".join(parts)


PEARSON_SQL = _pair_sql("""
select '{pair}' as pair, count(*) as n,
  case when count(*) >= 2 and count(distinct {x}) >= 2 and count(distinct {y}) >= 2 then round(corr({x}, {y}), 6) end as coef
from fx_risk where {x} is not null and {y} is not null""")

SPEARMAN_SQL = _pair_sql("""
select '{pair}' as pair, count(*) as n,
  case when count(*) >= 2 and count(distinct x) >= 2 and count(distinct y) >= 2 then round(corr(rx, ry), 6) end as coef
from (select {x} as x, {y} as y,
        rank() over (order by {x}) + (count(*) over (partition by {x}) - 1) / 2.0 as rx,
        rank() over (order by {y}) + (count(*) over (partition by {y}) - 1) / 2.0 as ry
      from fx_risk where {x} is not null and {y} is not null)""")

KENDALL_SQL = _pair_sql("""
select '{pair}' as pair, n,
  case when n >= 2 and nx >= 2 and ny >= 2 then round(s / sqrt((n * (n - 1) / 2.0 - tx) * (n * (n - 1) / 2.0 - ty)), 6) end as coef
from (
  select (select count(*) from fx_risk where {x} is not null and {y} is not null) as n,
    (select count(distinct {x}) from fx_risk where {x} is not null and {y} is not null) as nx,
    (select count(distinct {y}) from fx_risk where {x} is not null and {y} is not null) as ny,
    (select sum(t * (t - 1) / 2.0) from (select count(*) as t from fx_risk where {x} is not null and {y} is not null group by {x})) as tx,
    (select sum(t * (t - 1) / 2.0) from (select count(*) as t from fx_risk where {x} is not null and {y} is not null group by {y})) as ty,
    (select sum(a.n * b.n * sign(a.x - b.x) * sign(a.y - b.y)) / 2.0
       from (select {x} as x, {y} as y, count(*) as n from fx_risk where {x} is not null and {y} is not null group by 1, 2) a,
            (select {x} as x, {y} as y, count(*) as n from fx_risk where {x} is not null and {y} is not null group by 1, 2) b) as s)""")


# A14
@query("pearson", PEARSON_SQL)
def q_pearson(spark, sf):
    return _named_pairs(R.pearson_pairs(fx(spark, sf, "fx_risk"), PAIRS))


# A12
@query("spearman", SPEARMAN_SQL)
def q_spearman(spark, sf):
    return _named_pairs(R.spearman_pairs(fx(spark, sf, "fx_risk"), PAIRS))


# A13
@query("kendall", KENDALL_SQL)
def q_kendall(spark, sf):
    return _named_pairs(R.kendall_pairs(fx(spark, sf, "fx_risk"), PAIRS))


# A16
@query("corr_guarded", cte("fx_risk") + """
select days_to_exploit as grp, 'cvss~days_to_exploit' as pair, count(*) as n,
  case when count(*) >= 2 and count(distinct cvss) >= 2 and count(distinct days_to_exploit) >= 2 then round(corr(cvss, days_to_exploit), 6) end as coef
from fx_risk where cvss is not null and days_to_exploit is not null group by days_to_exploit
union all
select days_to_exploit as grp, 'cvss~epss_0' as pair, count(*) as n,
  case when count(*) >= 2 and count(distinct cvss) >= 2 and count(distinct epss_0) >= 2 then round(corr(rx, ry), 6) end as coef
from (select days_to_exploit, cvss, epss_0,
        rank() over (partition by days_to_exploit order by cvss) + (count(*) over (partition by days_to_exploit, cvss) - 1) / 2.0 as rx,
        rank() over (partition by days_to_exploit order by epss_0) + (count(*) over (partition by days_to_exploit, epss_0) - 1) / 2.0 as ry
      from fx_risk where cvss is not null and epss_0 is not null) group by days_to_exploit""")
def q_corr_guarded(spark, sf):
    df = fx(spark, sf, "fx_risk").withColumnRenamed("days_to_exploit", "grp").withColumn("days_to_exploit", F.col("grp"))
    a = R.correlate(df, "cvss", "days_to_exploit", "pearson", ["grp"]).select(
        "grp", F.lit("cvss~days_to_exploit").alias("pair"), "n", r6(F.col("coef")).alias("coef"))
    b = R.correlate(df, "cvss", "epss_0", "spearman", ["grp"]).select(
        "grp", F.lit("cvss~epss_0").alias("pair"), "n", r6(F.col("coef")).alias("coef"))
    return a.unionByName(b)


# A2
@query("summary_metrics", cte("fx_risk") + """
select count(*) as row_count, round(avg(days_to_exploit), 6) as avg_time_to_exploit,
  round(avg(cvss), 6) as cvss_mean, round(stddev_samp(cvss), 6) as cvss_std,
  round(avg(case when cvss >= 7 then cvss end), 6) as cvss_geq_mean,
  round(stddev_samp(case when cvss >= 7 then cvss end), 6) as cvss_geq_std,
  round(count(*) filter (where cvss >= 7) * 100.0 / count(*), 6) as cvss_geq_pct_of_total,
  round(avg(epss_0), 6) as epss_0_mean
from fx_risk""")
def q_summary_metrics(spark, sf):
    df = S.summary_metrics(fx(spark, sf, "fx_risk"), "cvss", 7.0, days="days_to_exploit", extra_means=["epss_0"])
    return df.select(*[r6(F.col(c)).alias(c) if c != "row_count" else F.col(c) for c in df.columns])


CONDS_SQL = [
    ("all", "days_to_exploit is not null"), ("later_than_0", "days_to_exploit >= 0"),
    ("sooner_than_90", "days_to_exploit <= 90"), ("within_90", "days_to_exploit >= 0 and days_to_exploit <= 90"),
    ("negative_day", "days_to_exploit < 0"), ("high_critical_within_90", "days_to_exploit >= 0 and days_to_exploit <= 90 and cvss >= 7"),
    ("high_critical_negative_day", "days_to_exploit < 0 and cvss >= 7"),
]


def _conds():
    return {n: F.expr(c) for n, c in CONDS_SQL}


# A3 / A4
@query("avg_time_breakdown", cte("fx_risk") + "\nunion all\n".join(f"""
select '{n}' as condition, count(*) filter (where {c}) as n,
  round(count(*) filter (where {c}) * 100.0 / count(*), 6) as pct,
  round(avg(case when {c} then days_to_exploit end), 6) as avg,
  round(coalesce(avg(case when {c} then days_to_exploit end), 0), 6) as days,
  round(((coalesce(avg(case when {c} then days_to_exploit end), 0) % 1 + 1) % 1) * 24, 6) as hours,
  round(((((coalesce(avg(case when {c} then days_to_exploit end), 0) % 1 + 1) % 1) * 24 % 1 + 1) % 1) * 60, 6) as minutes,
  round(((((((coalesce(avg(case when {c} then days_to_exploit end), 0) % 1 + 1) % 1) * 24 % 1 + 1) % 1) * 60 % 1 + 1) % 1) * 60, 6) as seconds
from fx_risk""" for n, c in CONDS_SQL))
def q_avg_time_breakdown(spark, sf):
    df = S.conditional_stats(fx(spark, sf, "fx_risk"), _conds(), "days_to_exploit")
    return df.select("condition", "n", *[r6(F.col(c)).alias(c) for c in ("pct", "avg", "days", "hours", "minutes", "seconds")])


@query("condition_counts", cte("fx_risk") + "\nunion all\n".join(f"""
select '{n}' as condition, count(*) filter (where {c}) as n, round(count(*) filter (where {c}) * 100.0 / count(*), 6) as pct
from fx_risk""" for n, c in CONDS_SQL))
def q_condition_counts(spark, sf):
    df = S.conditional_stats(fx(spark, sf, "fx_risk"), _conds(), "days_to_exploit")
    return df.select("condition", "n", r6(F.col("pct")).alias("pct"))


# A5
@query("threshold_funnel", cte("fx_risk") + """
select count(*) filter (where cvss >= 7) as valid,
  round(count(*) filter (where cvss >= 7) * 100.0 / count(cvss), 6) as valid_pct,
  count(*) filter (where cvss >= 7 and epss_0 is not null) as epss_0_nonnull,
  count(*) filter (where cvss >= 7 and epss_0 >= 0.5) as epss_0_hits,
  round(count(*) filter (where cvss >= 7 and epss_0 >= 0.5) * 100.0 / count(*) filter (where cvss >= 7 and epss_0 is not null), 6) as epss_0_pct_valid,
  round(count(*) filter (where cvss >= 7 and epss_0 >= 0.5) * 100.0 / count(epss_0), 6) as epss_0_pct_total
from fx_risk""")
def q_threshold_funnel(spark, sf):
    df = S.threshold_funnel(fx(spark, sf, "fx_risk"), "cvss", 7.0, ["epss_0"], 0.5)
    return df.select(*[r6(F.col(c)).alias(c) if "pct" in c else F.col(c) for c in df.columns])


DESC_COLS = ["cvss", "epss_0", "days_to_exploit", "l_extendedprice"]


# A6
@query("describe_numeric", cte("fx_risk") + "\nunion all\n".join(f"""
select '{c}' as "column", count({c}) as count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50,
  round(quantile_cont({c}, 0.75), 6) as q75, round(max({c}), 6) as max from fx_risk""" for c in DESC_COLS))
def q_describe_numeric(spark, sf):
    df = S.describe_numeric(fx(spark, sf, "fx_risk"), DESC_COLS)
    return df.select("column", "count", *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


# A7
@query("describe_dates", """
select count(o_orderdate) as count,
  make_timestamp(cast(round(avg(epoch_us(o_orderdate))) as bigint)) as mean, min(o_orderdate) as min,
  make_timestamp(cast(round(quantile_cont(epoch_us(o_orderdate), 0.25)) as bigint)) as q25,
  make_timestamp(cast(round(quantile_cont(epoch_us(o_orderdate), 0.5)) as bigint)) as q50,
  make_timestamp(cast(round(quantile_cont(epoch_us(o_orderdate), 0.75)) as bigint)) as q75,
  max(o_orderdate) as max from orders""")
def q_describe_dates(spark, sf):
    return S.describe_dates(table(spark, sf, "orders"), "o_orderdate")


# A8
@query("null_profile", cte("fx_dirty") + "\nunion all\n".join(f"""
select '{c}' as "column", count(*) filter (where {e}) as nulls, round(count(*) filter (where {e}) * 100.0 / count(*), 6) as pct
from fx_dirty""" for c, e in [
    ("c_custkey", "c_custkey is null"),
    ("category", "category is null or category in ('', 'n/a', 'None')"),
    ("num_text", "num_text is null or num_text in ('', 'n/a', 'None')"),
    ("flag_text", "flag_text is null or flag_text in ('', 'n/a', 'None')"),
    ("score", "score is null or isnan(score)")]))
def q_null_profile(spark, sf):
    from riskspan.functions.clean import standardize_nulls
    df = S.null_profile(standardize_nulls(fx(spark, sf, "fx_dirty")))
    return df.select("column", "nulls", r6(F.col("pct")).alias("pct"))


SPARK_TYPES = "case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'VARCHAR' then 'string' when 'DATE' then 'date' when 'BOOLEAN' then 'boolean' else 'timestamp_ntz' end"
INFO_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate"]


# A9
@query("table_info", "\nunion all\n".join(f"""
select (select count(*) from lineitem) as rows, '{c}' as "column", (select {SPARK_TYPES.replace('data_type', f'typeof({c})')} from lineitem limit 1) as dtype,
  (select count({c}) from lineitem) as non_null""" for c in INFO_COLS))
def q_table_info(spark, sf):
    return S.table_info(table(spark, sf, "lineitem").select(*INFO_COLS))


# A10
@query("value_counts", cte("fx_risk") + """
select case when cvss >= 9.0 then 'CRITICAL' when cvss >= 7.0 then 'HIGH' when cvss >= 4.0 then 'MEDIUM'
  when cvss > 0.0 then 'LOW' when cvss = 0.0 then 'NONE' else 'UNKNOWN' end as cvss_severity, count(*) as count
from fx_risk where days_to_exploit >= 0 group by 1""")
def q_value_counts(spark, sf):
    from riskspan.functions.cvss import severity
    df = fx(spark, sf, "fx_risk").filter(F.col("days_to_exploit") >= 0)
    return df.groupBy(severity("cvss").alias("cvss_severity")).agg(F.count(F.lit(1)).alias("count"))


# A11
@query("binned_counts", cte("fx_risk") + """
, b as (select case when cvss > 0 and cvss <= 4 then 0 when cvss > 4 and cvss <= 7 then 1
                    when cvss > 7 and cvss <= 9 then 2 when cvss > 9 and cvss <= 10 then 3 end as bin_order from fx_risk)
select bin_order, case bin_order when 0 then '(0, 4]' when 1 then '(4, 7]' when 2 then '(7, 9]' else '(9, 10]' end as bin,
  count(*) as count, round(count(*) * 100.0 / (select count(*) from b where bin_order is not null), 6) as pct
from b where bin_order is not null group by bin_order""")
def q_binned_counts(spark, sf):
    df = S.binned_counts(fx(spark, sf, "fx_risk"), "cvss")
    return df.select("bin_order", "bin", "count", r6(F.col("pct")).alias("pct"))


# P10
@query("iqr_filter", cte("fx_risk") + """
, q as (select quantile_cont(cvss, 0.25) as q1, quantile_cont(cvss, 0.75) as q3 from fx_risk)
select l_orderkey, l_linenumber, cvss from fx_risk, q
where cvss >= q1 - 1.5 * (q3 - q1) and cvss <= q3 + 1.5 * (q3 - q1)""")
def q_iqr_filter(spark, sf):
    return S.iqr_filter(fx(spark, sf, "fx_risk"), "cvss").select("l_orderkey", "l_linenumber", "cvss")


# What the jobs remove and reject, counted in their own scans
@query("removed_counts", cte("fx_cve", "fx_risk", "fx_dirty") + f"""
, q as (select quantile_cont(cvss, 0.25) as q1, quantile_cont(cvss, 0.75) as q3 from fx_risk),
v as (select count(*) as rows, count(nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '')) as kept from fx_cve),
i as (select count(*) as rows, count(*) filter (where cvss >= q1 - 1.5 * (q3 - q1) and cvss <= q3 + 1.5 * (q3 - q1)) as kept from fx_risk, q)
select 'valid id' as step, 'rows' as what, rows as n from v union all select 'valid id', 'kept', kept from v union all select 'valid id', 'removed', rows - kept from v
union all select 'inside fences', 'rows', rows from i union all select 'inside fences', 'kept', kept from i union all select 'inside fences', 'removed', rows - kept from i
union all select 'types', 'num_text', count(*) filter (where num_text is not null and try_cast(num_text as bigint) is null) from fx_dirty
union all select 'types', 'score', 0""")
def q_removed_counts(spark, sf):
    from riskspan.functions.clean import validate_id
    from riskspan.operators import audit as A
    from riskspan.session import scratch_dir
    risk = fx(spark, sf, "fx_risk")
    jobs = {"valid id": A.counted_filter(fx(spark, sf, "fx_cve").withColumn("cve_id", validate_id("cve_id_raw")), F.col("cve_id").isNotNull()),
            "inside fences": A.counted_filter(risk, S.iqr_condition(risk, "cvss")),
            "types": A.counted_convert(fx(spark, sf, "fx_dirty"), {"integer": ["num_text"], "float": ["score"]})}
    rows = []
    for step, (df, seen) in jobs.items():
        df.write.parquet(scratch_dir(spark, "counted"))
        rows += A.counts(seen, step)
    return spark.createDataFrame(rows, "step string, what string, n long")


COHORTS_SQL = [
    ("full_dataset", "true"), ("cvss>=7", "cvss >= 7.0"), ("epss_0>=0.5", "epss_0 >= 0.5"),
    ("days<0", "days_to_exploit < 0"), ("days>=0", "days_to_exploit >= 0"),
    ("days>=0_&_<=90", "days_to_exploit >= 0 and days_to_exploit <= 90"), ("days>90", "days_to_exploit > 90"),
]


def _cohorts():
    return {n: F.expr(c) for n, c in COHORTS_SQL}


# P11
@query("cohort_membership", cte("fx_risk") + "\nunion all\n".join(
    f"select l_orderkey, l_linenumber, '{n}' as cohort from fx_risk where {c}" for n, c in COHORTS_SQL))
def q_cohort_membership(spark, sf):
    return S.cohort_membership(fx(spark, sf, "fx_risk"), _cohorts()).select("l_orderkey", "l_linenumber", "cohort")


def _cohort_sql():
    parts = []
    for n, c in COHORTS_SQL:
        parts.append(f"""
select '{n}' as cohort, count(*) as cnt, count(*) filter (where cvss >= 7) as cnt_cvss_geq_7,
  round(count(*) filter (where cvss >= 7) * 100.0 / count(*), 6) as pct_cvss_geq_7,
  round(avg(cvss), 6) as avg_cvss, round(avg(epss_0), 6) as avg_epss_0, round(avg(days_to_exploit), 6) as avg_days,
  (select case when count(*) >= 2 and count(distinct cvss) >= 2 and count(distinct epss_0) >= 2 then round(corr(cvss, epss_0), 6) end
     from fx_risk where ({c}) and cvss is not null and epss_0 is not null and days_to_exploit is not null) as pearson_cvss_epss,
  (select case when count(*) >= 2 and count(distinct x) >= 2 and count(distinct y) >= 2 then round(corr(rx, ry), 6) end
     from (select cvss as x, days_to_exploit as y,
             rank() over (order by cvss) + (count(*) over (partition by cvss) - 1) / 2.0 as rx,
             rank() over (order by days_to_exploit) + (count(*) over (partition by days_to_exploit) - 1) / 2.0 as ry
           from fx_risk where ({c}) and cvss is not null and epss_0 is not null and days_to_exploit is not null)) as spearman_cvss_days
from fx_risk where {c}""")
    return cte("fx_risk") + "\nunion all\n".join(parts)


# A21
@query("cohort_summary", _cohort_sql())
def q_cohort_summary(spark, sf):
    base = S.cohort_membership(fx(spark, sf, "fx_risk"), _cohorts())
    counts = base.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("cvss") >= 7).alias("cnt_cvss_geq_7"),
        r6(S.pct(F.count_if(F.col("cvss") >= 7), F.count(F.lit(1)))).alias("pct_cvss_geq_7"),
        r6(F.avg("cvss")).alias("avg_cvss"), r6(F.avg("epss_0")).alias("avg_epss_0"),
        r6(F.avg("days_to_exploit")).alias("avg_days"))
    corr_rows = base.dropna(subset=["cvss", "epss_0", "days_to_exploit"])
    p = R.pearson(corr_rows, "cvss", "epss_0", ["cohort"]).select("cohort", r6(F.col("coef")).alias("pearson_cvss_epss"))
    s = R.spearman(corr_rows, "cvss", "days_to_exploit", ["cohort"]).select("cohort", r6(F.col("coef")).alias("spearman_cvss_days"))
    return counts.join(p, "cohort", "left").join(s, "cohort", "left")


# A22
@query("histogram_bins", cte("fx_risk") + """
, m as (select min(cvss) as lo, max(cvss) as hi from fx_risk)
select cast(case when (hi - lo) / 10 > 0 then least(floor((cvss - lo) / ((hi - lo) / 10)), 9) else 0 end as int) as bin,
  count(*) as count, round(min(lo) + cast(case when (hi - lo) / 10 > 0 then least(floor((cvss - lo) / ((hi - lo) / 10)), 9) else 0 end as int) * min((hi - lo) / 10), 6) as lo,
  round(min(lo) + (cast(case when (hi - lo) / 10 > 0 then least(floor((cvss - lo) / ((hi - lo) / 10)), 9) else 0 end as int) + 1) * min((hi - lo) / 10), 6) as hi
from fx_risk, m where cvss is not null group by 1""")
def q_histogram_bins(spark, sf):
    df = S.histogram_bins(fx(spark, sf, "fx_risk"), "cvss", 10)
    return df.select("bin", "count", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"))


EDGES = [0, 2, 3.5, 7, 9, 10]


# Explicit edges
@query("histogram_edges", cte("fx_risk") + f""", e as (select {EDGES} as edges),
b as (select least(len(list_filter(edges, lambda x: x <= cvss)), {len(EDGES) - 1}) - 1 as bin, cvss from fx_risk, e
      where cvss >= {EDGES[0]} and cvss <= {EDGES[-1]})
select cast(bin as int) as bin, count(*) as count, cast(min(edges[bin + 1]) as double) as lo, cast(min(edges[bin + 2]) as double) as hi from b, e group by bin""")
def q_histogram_edges(spark, sf):
    return S.histogram_bins(fx(spark, sf, "fx_risk"), "cvss", edges=EDGES)


# Discrete values
@query("histogram_discrete", cte("fx_risk") + """, m as (select min(cvss) - 0.5 as lo from fx_risk)
select cast(floor(cvss - lo) as int) as bin, count(*) as count, round(min(lo) + floor(min(cvss - lo)), 6) as lo,
  round(min(lo) + floor(min(cvss - lo)) + 1, 6) as hi from fx_risk, m where cvss is not null group by 1""")
def q_histogram_discrete(spark, sf):
    df = S.histogram_bins(fx(spark, sf, "fx_risk"), "cvss", discrete=True)
    return df.select("bin", "count", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"))


# Transformed values
@query("histogram_transformed", cte("fx_risk") + """
, t as (select sqrt(case when days_to_exploit < 0 then 0 else days_to_exploit end) as x from fx_risk),
m as (select min(x) as lo, (max(x) - min(x)) / 8 as width from t), b as (select least(floor((x - lo) / width), 7) as bin, lo, width from t, m)
select cast(bin as int) as bin, count(*) as count, round(min(lo) + bin * min(width), 6) as lo, round(min(lo) + (bin + 1) * min(width), 6) as hi
from b group by bin""")
def q_histogram_transformed(spark, sf):
    df = S.histogram_bins(fx(spark, sf, "fx_risk"), "days_to_exploit", 8, transform="sqrt")
    return df.select("bin", "count", r6(F.col("lo")).alias("lo"), r6(F.col("hi")).alias("hi"))


SCORED = ["cvss", "epss_0", "epss_30", "epss_60", "change_0_to_30"]


# Null map
@query("null_map", cte("fx_scored") + """, p as (
  select *, cast(floor((row_number() over (order by l_orderkey, l_linenumber, cvss, epss_0, epss_30, epss_60, exploit_count) - 1) * 40 / count(*) over ()) as int) as tile from fx_scored)
""" + "\nunion all\n".join(f"""select tile, '{c}' as "column", count(*) as rows, count(*) filter (where {c} is null) as nulls from p group by tile""" for c in SCORED))
def q_null_map(spark, sf):
    key = ["l_orderkey", "l_linenumber", "cvss", "epss_0", "epss_30", "epss_60", "exploit_count"]
    out = S.null_map(fx(spark, sf, "fx_scored").select(*key, "change_0_to_30"), key, 40)
    return out.where(F.col("column").isin(SCORED))


PROBS = ["epss_0", "epss_30", "epss_60"]
CHANGES = ["change_0_to_30", "change_30_to_60", "change_0_to_60"]
NUMBERS = ["cvss", *PROBS, "days_to_poc_exploit", "exploit_count"]


def _report_sql() -> str:
    rows = [("summary", "row_count", "count(*)"), ("summary", "avg_time_to_exploit", "avg(days_to_poc_exploit)"),
            ("summary", "cvss_mean", "avg(cvss)"), ("summary", "cvss_std", "stddev_samp(cvss)"),
            ("summary", "cvss_geq_mean", "avg(cvss) filter (where cvss >= 7)"), ("summary", "cvss_geq_std", "stddev_samp(cvss) filter (where cvss >= 7)"),
            ("summary", "cvss_geq_pct_of_total", "count(*) filter (where cvss >= 7) * 100.0 / count(*)")]
    rows += [("summary", f"{c}_mean", f"avg({c})") for c in PROBS + CHANGES]
    rows += [("summary", f"{c}_geq_pct", f"count(*) filter (where {c} >= 0.5) * 100.0 / count(*)") for c in PROBS]
    rows += [("summary", f"{c}_std", f"stddev_samp({c})") for c in CHANGES]
    rows += [("funnel", "valid", "count(*) filter (where cvss >= 7)"), ("funnel", "valid_pct", "count(*) filter (where cvss >= 7) * 100.0 / count(cvss)")]
    for c in PROBS:
        has, hit = f"count(*) filter (where cvss >= 7 and {c} is not null)", f"count(*) filter (where cvss >= 7 and {c} >= 0.5)"
        rows += [("funnel", f"{c}_nonnull", has), ("funnel", f"{c}_hits", hit), ("funnel", f"{c}_pct_valid", f"{hit} * 100.0 / {has}"),
                 ("funnel", f"{c}_pct_total", f"{hit} * 100.0 / count({c})")]
    rows += [("nulls", c, f"count(*) filter (where {c} is null)") for c in NUMBERS + CHANGES]
    for c in NUMBERS:
        rows += [("describe", f"{c}_{n}", f"{f}({c})") for n, f in (("count", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))]
    rows += [("bins", f"cvss_({lo}, {hi}]", f"count(*) filter (where cvss > {lo} and cvss <= {hi})") for lo, hi in zip(SCORE_BIN_EDGES, SCORE_BIN_EDGES[1:])]
    return cte("fx_scored") + ", w as (select " + ", ".join(f"{e} as v{i}" for i, (_, _, e) in enumerate(rows)) + " from fx_scored)" + "\nunion all\n".join(
        f"select '{a}' as section, '{b}' as metric, round(cast(v{i} as double), 6) as value from w" for i, (a, b, _) in enumerate(rows))


def report_sections() -> dict:
    c = F.col
    return {"summary": S.summary_aggregates("cvss", 7.0, "days_to_poc_exploit", PROBS, probs=PROBS, changes=CHANGES),
            "funnel": S.funnel_aggregates("cvss", 7.0, PROBS),
            "nulls": {n: F.count_if(c(n).isNull()) for n in NUMBERS + CHANGES},
            "describe": {f"{n}_{k}": f(n) for n in NUMBERS for k, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))},
            "bins": {f"cvss_({lo}, {hi}]": F.count_if((c("cvss") > lo) & (c("cvss") <= hi)) for lo, hi in zip(SCORE_BIN_EDGES, SCORE_BIN_EDGES[1:])}}


# Q17 / Q18 / A2: the whole report from one scan
@query("risk_report", _report_sql())
def q_risk_report(spark, sf):
    out = S.one_pass_report(fx(spark, sf, "fx_scored"), report_sections())
    return out.withColumn("value", r6(F.col("value")))


# A24
@query("linear_fit", cte("fx_risk") + """
select regr_count(epss_0, cvss) as n, round(regr_slope(epss_0, cvss), 6) as slope,
  round(regr_intercept(epss_0, cvss), 6) as intercept, round(regr_r2(epss_0, cvss), 6) as r2 from fx_risk""")
def q_linear_fit(spark, sf):
    df = S.linear_fit(fx(spark, sf, "fx_risk"), "cvss", "epss_0")
    return df.select(F.col("n").cast("long").alias("n"), *[r6(F.col(c)).alias(c) for c in ("slope", "intercept", "r2")])


@query("scatter_bins", cte("fx_risk") + """
, b as (select * from fx_risk where cvss is not null and days_to_exploit is not null),
m as (select min(cvss) as xl, max(cvss) as xh, min(days_to_exploit) as yl, max(days_to_exploit) as yh from b)
select cast(case when (xh - xl) / 10 > 0 then least(floor((cvss - xl) / ((xh - xl) / 10)), 9) else 0 end as int) as x_bin,
  cast(case when (yh - yl) / 10 > 0 then least(floor((days_to_exploit - yl) / ((yh - yl) / 10.0)), 9) else 0 end as int) as y_bin,
  count(*) as count from b, m group by 1, 2""")
def q_scatter_bins(spark, sf):
    return S.scatter_bins(fx(spark, sf, "fx_risk"), "cvss", "days_to_exploit", 10)


# A25
@query("box_stats", """
with q as (select l_returnflag, count(*) as n, quantile_cont(l_extendedprice, 0.25) as q1,
             quantile_cont(l_extendedprice, 0.5) as median, quantile_cont(l_extendedprice, 0.75) as q3
           from lineitem group by l_returnflag)
select q.l_returnflag, q.n, round(q.q1, 6) as q1, round(q.median, 6) as median, round(q.q3, 6) as q3,
  round(min(case when l.l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then l.l_extendedprice end), 6) as whisker_lo,
  round(max(case when l.l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then l.l_extendedprice end), 6) as whisker_hi,
  count(*) filter (where not (l.l_extendedprice between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as outliers
from lineitem l join q on q.l_returnflag = l.l_returnflag group by all""")
def q_box_stats(spark, sf):
    df = S.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return df.select("l_returnflag", "n", *[r6(F.col(c)).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "outliers")


BOOTSTRAP_PAIRS = [("cvss", "epss_0"), ("cvss", "days_to_poc_exploit"), ("epss_0", "days_to_poc_exploit"), ("cvss", "exploit_count"), ("epss_0", "exploit_count")]


# A17 at its defaults (rows-only: resampling)
@query("bootstrap_corr")
def q_bootstrap_corr(spark, sf):
    from riskspan.operators.bootstrap import bootstrap_correlation
    df = fx(spark, sf, "fx_scored").dropna(subset=["cvss", "epss_0", "days_to_poc_exploit", "exploit_count"])
    return bootstrap_correlation(df, BOOTSTRAP_PAIRS)


def _values_sql(c: str) -> str:
    """Distinct values of a column, ascending, with their rank spans."""
    return (f"select '{c}' as variable, cast({c} as double) as x, count(*) as t, sum(count(*)) over (order by {c}) - count(*) as b, "
            f"sum(count(*)) over () as n from fx_risk where {c} is not null group by {c}")


VARIABLES = ["cvss", "epss_0", "days_to_exploit"]
VALUES_SQL = cte("fx_risk") + ", v as (" + " union all ".join(f"select * from ({_values_sql(c)})" for c in VARIABLES) + ")"
# the normal distribution function by Simpson's rule
CDF_SQL = f"(case when z < 0 then {normal_tail_sql('z')} / 2 else 1 - {normal_tail_sql('z')} / 2 end)"
SF_SQL = f"(case when z < 0 then 1 - {normal_tail_sql('z')} / 2 else {normal_tail_sql('z')} / 2 end)"


# A18
@query("anderson_darling", VALUES_SQL + f""",
m as (select variable, sum(t * x) / sum(t) as mean, sqrt((sum(t * x * x) - sum(t * x) * sum(t * x) / sum(t)) / (sum(t) - 1)) as sd from v group by variable),
s as (select v.*, (x - mean) / sd as z from v join m using (variable)),
l as (select *, ln({CDF_SQL}) as below, ln({SF_SQL}) as above from s),
a as (select variable, max(n) as n, -max(n) - sum(t * (2 * b + t) * below + t * (2.0 * n - 2 * b - t) * above) / max(n) as a2 from l group by variable)
select variable, cast(n as bigint) as n, round(a2, 1) as statistic, round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 3) as critical_value, 5.0 as significance,
  a2 > round(0.787 / (1 + 4.0 / n - 25.0 / (n * n)), 3) as reject_normal from a""")
def q_anderson_darling(spark, sf):
    from riskspan.operators.normality import anderson_darling
    df = fx(spark, sf, "fx_risk")
    return reduce(lambda a, b: a.unionByName(b), [anderson_darling(df, c).select(F.lit(c).alias("variable"), "*") for c in VARIABLES]) \
        .withColumn("statistic", F.round("statistic", 1))


# A19
@query("ks_normal", VALUES_SQL + f""", s as (select *, x as z from v), c as (select *, {CDF_SQL} as f from s),
d as (select variable, max(n) as n, max(greatest((b + t) / n - f, f - b / n)) as d from c group by variable),
p as (select *, sqrt(n) * d as lam from d)
select variable, cast(n as bigint) as n, round(d, 5) as statistic, round(case when lam < 0.2 then 1 else least(1, greatest(0,
  2 * list_sum(list_transform(range(1, 101), lambda k: pow(-1, k - 1) * exp(-2 * k * k * lam * lam))))) end, 5) as p_value from p""")
def q_ks_normal(spark, sf):
    from riskspan.operators.normality import ks_standard_normal
    df = fx(spark, sf, "fx_risk")
    return reduce(lambda a, b: a.unionByName(b), [ks_standard_normal(df, c).select(F.lit(c).alias("variable"), "*") for c in VARIABLES]) \
        .withColumns({c: F.round(c, 5) for c in ("statistic", "p_value")})


# tells the rows of an order apart
ROW_KEY = ("concat(cast(l_orderkey as varchar(20)), " + ", ".join(
    f"'-', cast(cast(round({c} * 100) as bigint) as varchar(20))" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + ")")


def _shapiro_sql() -> str:
    sql = swilk_sql()
    cols = "l_linenumber, variable"
    return cte("fx_risk") + ", long as (" + " union all ".join(
        f"select {ROW_KEY} as row_key, l_linenumber, '{c}' as variable, cast({c} as double) as x from fx_risk where {c} is not null"
        for c in VARIABLES) + f"""),
s as (select *, row_number() over (partition by {cols} order by {SEEDED.format("row_key")}, row_key) as nth from long),
o as (select *, row_number() over (partition by {cols} order by x) as i, cast(count(*) over (partition by {cols}) as double) as n,
      avg(x) over (partition by {cols}) as mean from s where nth <= 5000),
m as (select *, {ppf_sql("((i - 0.375) / (n + 0.25))")} as m from o),
g as (select {cols}, n, sum(m * m) as mm, sum(m * x) as mx, max(case when i = n then m end) as ml, max(case when i = n - 1 then m end) as mk,
  max(case when i = 1 then x end) as x1, max(case when i = 2 then x end) as x2, max(case when i = n - 1 then x end) as xk, max(case when i = n then x end) as xl,
  sum((x - mean) * (x - mean)) as ss from m group by {cols}, n),
w as (select *, case when xl > x1 then {sql['w']} end as w from g), z as (select *, {sql['z']} as z from w)
select {cols}, cast(n as bigint) as n, round(w, 5) as statistic,
  round(case when w is null then null when z < 0 then 1 - {normal_tail_sql('z')} / 2 else {normal_tail_sql('z')} / 2 end, 5) as p_value from z"""


# At most 5000 values of each group and variable, the sampling step before the test
@query("shapiro_wilk", _shapiro_sql())
def q_shapiro_wilk(spark, sf):
    from riskspan.operators.filters import hash_sample_n
    from riskspan.operators.normality import shapiro_wilk
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in VARIABLES])).alias("v")
    long = fx(spark, sf, "fx_risk").select(F.expr(ROW_KEY).alias("row_key"), "l_linenumber", values) \
        .select("row_key", "l_linenumber", "v.*").where("value is not null")
    out = shapiro_wilk(hash_sample_n(long, "row_key", 5000, group_cols=["l_linenumber", "variable"]), "value", ["l_linenumber", "variable"])
    return out.withColumns({c: F.round(c, 5) for c in ("statistic", "p_value")})


QQ_POINTS = 100


# A23
@query("qq_table", cte("fx_risk") + f""", q as (
  select unnest(range(1, {QQ_POINTS + 1})) as k, unnest({[round(NormalDist().inv_cdf((k - 0.5) / QQ_POINTS), 12) for k in range(1, QQ_POINTS + 1)]}) as theoretical,
    unnest((select quantile_cont(epss_0, {[(k - 0.5) / QQ_POINTS for k in range(1, QQ_POINTS + 1)]}) from fx_risk)) as sample),
m as (select avg(epss_0) as mean, stddev_samp(epss_0) as sd from fx_risk)
select cast(k as int) as k, round(theoretical, 6) as theoretical, round(sample, 6) as sample, round(mean + sd * theoretical, 6) as fitted from q, m""")
def q_qq_table(spark, sf):
    from riskspan.operators.normality import qq_table
    out = qq_table(fx(spark, sf, "fx_risk"), "epss_0", QQ_POINTS)
    return out.select("k", *[r6(F.col(c)).alias(c) for c in ("theoretical", "sample", "fitted")])
