"""Cohort matrix (A21, P11, Q19) and correlation p-values (A15) with oracles
that rank, count and integrate in plain SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.catalog import URGENCY_LEVELS
from riskspan.operators import correlation as R
from riskspan.operators.cohorts import METHODS, cohort_mask, cohort_matrix
from riskspan.plans.fixtures import cte, fx
from riskspan.plans.registry import query

# FIXED VALUES: the cohorts of the analysis, name and condition (the same text on both engines)
COHORTS = {
    "full_dataset": "true",
    "cvss>=7": "cvss_score >= 7.0",
    "exploitability>=5": "exploitability_score >= 5",
    "high_patch_urgency": "patch_urgency = 'High'",
    "patch_available": "patch_availability = 'Patch Available'",
    "operation_impact>=7": "operational_impact_score >= 7",
    "scada_relevant": "relevant_to_scada = 1",
    "days_to_exp_code<0": "days_to_exploit_code < 0",
    "days_to_exp_code>=0": "days_to_exploit_code >= 0",
    "days_to_exp_code>=0_&_<=90": "days_to_exploit_code >= 0 and days_to_exploit_code <= 90",
    "days_to_exp_code>90": "days_to_exploit_code > 90",
    "time_to_patch<0": "time_to_patch < 0",
    "time_to_patch>=0": "time_to_patch >= 0",
    "time_to_patch>=0_&_<=90": "time_to_patch >= 0 and time_to_patch <= 90",
    "time_to_patch>90": "time_to_patch > 90",
    "high_risk": "high_risk = 1",
}
# FIXED VALUES: conditions that are counted in each cohort
COUNTS = {
    "cvss_geq_7": "cvss_score >= 7",
    "exploitability_geq_5": "exploitability_score >= 5",
    "high_patch_urgency": "patch_urgency = 'High'",
    "patch_availability": "patch_availability = 'Patch Available'",
    "operational_impact_geq_7": "operational_impact_score >= 7",
}


def _coded(c: str, codes: dict[str, int]) -> str:
    return f"(case {c} " + " ".join(f"when '{k}' then {v}" for k, v in codes.items()) + " end)"


# FIXED VALUES: codes of answers, and values that are averaged
YES_NO = {"Yes": 1, "No": 2}
MEANS = {
    "days_to_publish": "days_to_publish",
    "cvss": "cvss_score",
    "exploitability": "exploitability_score",
    "patch_availability": _coded("patch_availability", {"Patch Available": 1, "No Patch": 0}),
    "scada_relevance": "relevant_to_scada",
    "epss_on_exploit_date": "epss_on_exploit_date",
    "operational_impact": "operational_impact_score",
    "reg_mandate": _coded("regulatory_mandate", YES_NO),
    "device_criticality": "device_criticality",
    "time_to_patch": "time_to_patch",
    "patch_success": _coded("patch_deployment_success", YES_NO),
    "exploit_success": "exploit_success_rate",
    "exploit_attempts": "known_exploit_attempts",
    "state_involvement": _coded("nation_state_involvement", YES_NO),
    "insider_access_req": _coded("insider_access_required", YES_NO),
    "supply_chain_vuln": _coded("supply_chain_vulnerability", YES_NO),
    "risk_level": "risk_level",
    "threat_actor_attribution": "threat_actor_attribution",
    "securegrid_score": "securegrid_score",
}
# FIXED VALUES: columns that are correlated, and with what
COLUMNS = {
    "cvss": "cvss_score",
    "exploitability_score": "exploitability_score",
    "epss": "epss_on_exploit_date",
    "exploit_attempts": "known_exploit_attempts",
    "exploit_success": "exploit_success_rate",
    "time2patch": "time_to_patch",
    "patch_urgency": _coded("patch_urgency", URGENCY_LEVELS),
    "risk": "risk_level",
    "secgrid": "securegrid_score",
}
WITH = ["exploitability_score", "exploit_attempts", "exploit_success", "time2patch", "risk", "epss", "patch_urgency"]
PAIRS = [("cvss", c) for c in WITH] + [("cvss", "secgrid")] + [("secgrid", c) for c in WITH]


# -- SQL ----------------------------------------------------------------------
def _simpson(f: str, start: str, length: str, steps: int = 800) -> str:
    """Integral of ``f`` (over t) by Simpson's rule, as a scalar expression."""
    h = f"(({length}) / {steps})"
    total = (f"list_sum(list_transform(range(0, {steps + 1}), lambda k: (case when k in (0, {steps}) then 1 when k % 2 = 1 then 4 else 2 end) * "
             + f.replace("t_", f"(({start}) + k * {h})") + "))")
    return f"({total} * {h} / 3)"


def t_tail_sql(r: str, n: str) -> str:
    """Two-sided p-value of a correlation: with sin(a) = |r| the share of the
    integral of cos^(n - 3) from a on."""
    f = f"pow(cos(least(t_, pi() / 2)), {n} - 3)"
    reach = f"(12 / sqrt({n} - 2))"
    a = f"asin(least(abs({r}), 1))"
    return (f"(case when abs({r}) >= 1 then 0.0 when {n} > 2 then "
            f"{_simpson(f, a, f'least(pi() / 2 - {a}, {reach})')} / {_simpson(f, '0', f'least(pi() / 2, {reach})')} end)")


def normal_tail_sql(z: str) -> str:
    return f"(2 * {_simpson('exp(-t_ * t_ / 2)', f'abs({z})', '10')} / sqrt(2 * pi()))"


# from p (cohort, pair, x, y without nulls): assoc (cohort, pair, method, n, coef, p)
ASSOC_SQL = f"""
cells as (select cohort, pair, x, y, count(*) as n from p group by all),
mx as (select cohort, pair, x, sum(n) as t, sum(sum(n)) over (partition by cohort, pair order by x) - (sum(n) - 1) / 2.0 as r
       from cells group by cohort, pair, x),
my as (select cohort, pair, y, sum(n) as t, sum(sum(n)) over (partition by cohort, pair order by y) - (sum(n) - 1) / 2.0 as r
       from cells group by cohort, pair, y),
size as (select cohort, pair, cast(sum(n) as double) as n, min(x) < max(x) and min(y) < max(y) as varied from cells group by all),
ranked as (
  select c.cohort, c.pair, sum(c.n * (mx.r - (s.n + 1) / 2) * (my.r - (s.n + 1) / 2)) as xy,
    sum(c.n * (mx.r - (s.n + 1) / 2) ** 2) as xx, sum(c.n * (my.r - (s.n + 1) / 2) ** 2) as yy
  from cells c join mx using (cohort, pair, x) join my using (cohort, pair, y) join size s using (cohort, pair) group by all),
grid as (select mx.cohort, mx.pair, mx.x, my.y, coalesce(c.n, 0) as n from mx join my using (cohort, pair)
         left join cells c on c.cohort = mx.cohort and c.pair = mx.pair and c.x = mx.x and c.y = my.y),
lower_x as (select *, coalesce(sum(n) over (partition by cohort, pair, y order by x rows between unbounded preceding and 1 preceding), 0) as l from grid),
lower as (select *, coalesce(sum(l) over (partition by cohort, pair, x order by y rows between unbounded preceding and 1 preceding), 0) as b from lower_x),
votes as (select cohort, pair, sum(cast(n as double) * b) as concordant, sum(n * (n - 1) / 2.0) as both_tied from lower group by all),
tx as (select cohort, pair, sum(t * (t - 1) / 2.0) as a, sum(t * (t - 1.0) * (2 * t + 5)) as v, sum(t * (t - 1.0)) as v1, sum(t * (t - 1.0) * (t - 2)) as v2 from mx group by all),
ty as (select cohort, pair, sum(t * (t - 1) / 2.0) as a, sum(t * (t - 1.0) * (2 * t + 5)) as v, sum(t * (t - 1.0)) as v1, sum(t * (t - 1.0) * (t - 2)) as v2 from my group by all),
taus as (
  select s.cohort, s.pair, s.n, s.varied, 2 * concordant - s.n * (s.n - 1) / 2 + tx.a + ty.a - both_tied as s,
    (s.n * (s.n - 1) / 2 - tx.a) * (s.n * (s.n - 1) / 2 - ty.a) as d,
    (s.n * (s.n - 1) * (2 * s.n + 5) - tx.v - ty.v) / 18 + tx.v1 * ty.v1 / (2 * s.n * (s.n - 1))
      + tx.v2 * ty.v2 / (9 * s.n * (s.n - 1) * (s.n - 2)) as var
  from size s join votes using (cohort, pair) join tx using (cohort, pair) join ty using (cohort, pair)),
coefs as (
  select cohort, pair, 'pearson' as method, s.n, case when varied then corr(x, y) end as coef, null as z from p join size s using (cohort, pair) group by cohort, pair, s.n, varied
  union all select cohort, pair, 'spearman', s.n, case when varied then xy / sqrt(xx * yy) end, null from ranked join size s using (cohort, pair)
  union all select cohort, pair, 'kendall', n, case when varied then s / sqrt(d) end, case when varied then s / sqrt(var) end from taus),
assoc as (select *, case when coef is null then null when method = 'kendall' then {normal_tail_sql('z')} else {t_tail_sql('coef', 'n')} end as p from coefs)"""


def _matrix_sql() -> str:
    member = "list_filter([" + ", ".join(f"case when {c} then {i} end" for i, c in enumerate(COHORTS.values())) + "], lambda v: v is not null)"
    facts = ["count(*) as cnt"]
    for name, cond in COUNTS.items():
        facts += [f"count(*) filter (where {cond}) as cnt_{name}", f"round(count(*) filter (where {cond}) * 100.0 / count(*), 6) as pct_{name}"]
    facts += [f"round(avg({c}), 6) as avg_{name}" for name, c in MEANS.items()]
    names = list(COLUMNS)
    pairs = ", ".join(f"{{'pair': {i}, 'x': x{names.index(a)}, 'y': x{names.index(b)}}}" for i, (a, b) in enumerate(PAIRS))
    columns = ", ".join(f"cast({c} as double) as x{i}" for i, c in enumerate(COLUMNS.values()))
    wide = [f"round(max(case when method = '{m}' and pair = {i} then {c} end), {digits}) as {prefix}{m}_{a}_vs_{b}"
            for i, (a, b) in enumerate(PAIRS) for m in METHODS for c, prefix, digits in (("coef", "", 6), ("p", "p_", 3))]
    labels = ", ".join(f"({i}, '{name}')" for i, name in enumerate(COHORTS))
    return cte("fx_synth") + f""", members as (select unnest({member}) as cohort, * from fx_synth),
facts as (select cohort, {", ".join(facts)} from members group by cohort),
whole as (select * from (select cohort, {columns} from members) where {" and ".join(f"x{i} is not null" for i in range(len(COLUMNS)))}),
p as (select cohort, e.pair as pair, e.x as x, e.y as y from (select cohort, unnest([{pairs}]) as e from whole)), {ASSOC_SQL},
wide as (select cohort, {", ".join(wide)} from assoc group by cohort),
labels(cohort, name) as (values {labels})
select l.name as cohort, coalesce(f.cnt, 0) as cnt, f.* exclude (cohort, cnt), w.* exclude (cohort)
from labels l left join facts f using (cohort) left join wide w using (cohort)"""


def _exprs(texts: dict[str, str]) -> dict:
    return {k: F.expr(v) for k, v in texts.items()}


# A21 / P11 / Q19
@query("cohort_matrix", _matrix_sql())
def q_cohort_matrix(spark, sf):
    out = cohort_matrix(fx(spark, sf, "fx_synth"), _exprs(COHORTS), _exprs(COUNTS), _exprs(MEANS), _exprs(COLUMNS), PAIRS)
    return out.select("cohort", *[c if c.startswith("cnt") else F.round(c, 3 if c.startswith("p_") else 6).alias(c) for c in out.columns[1:]])


# All cohorts of a row as one number
@query("cohort_masks", cte("fx_synth") + "select l_orderkey, l_linenumber, cast("
       + " + ".join(f"case when {c} then {1 << i} else 0 end" for i, c in enumerate(COHORTS.values())) + " as bigint) as mask from fx_synth")
def q_cohort_masks(spark, sf):
    return fx(spark, sf, "fx_synth").select("l_orderkey", "l_linenumber", cohort_mask(_exprs(COHORTS)).alias("mask"))


RISK_PAIRS = [("cvss", "epss_0"), ("cvss", "days_to_exploit"), ("epss_0", "days_to_exploit")]


# A15
@query("corr_pvalues", cte("fx_risk") + ", p as (" + " union all ".join(
    f"select 0 as cohort, {i} as pair, cast({x} as double) as x, cast({y} as double) as y from fx_risk where {x} is not null and {y} is not null"
    for i, (x, y) in enumerate(RISK_PAIRS)) + "), " + ASSOC_SQL + f"""
select {[f"{x}~{y}" for x, y in RISK_PAIRS]}[pair + 1] as pair, method, cast(n as bigint) as n, round(coef, 3) as coef, round(p, 3) as p_value from assoc""")
def q_corr_pvalues(spark, sf):
    df = fx(spark, sf, "fx_risk")
    names = F.element_at(F.array(*[F.lit(f"{x}~{y}") for x, y in RISK_PAIRS]), F.col("pair") + 1)
    parts = [R.with_pvalues_pairs(df, RISK_PAIRS, m).select(names.alias("pair"), F.lit(m).alias("method"), F.col("n").cast("long").alias("n"),
                                                            F.round("coef", 3).alias("coef"), F.round("p_value", 3).alias("p_value"))
             for m in METHODS]
    return reduce(DataFrame.unionByName, parts)
