"""Descriptive statistics, thresholds, bins and chart tables (A2-A11,
A22-A26, P10, P11, A21).  Every result is one grouped aggregate or a small
number of them; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspan.catalog import SCORE_BIN_EDGES
from riskspan.operators.ranks import part_of, row_positions, value_ranks


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double")) * 100.0


# Exact quantiles -------------------------------------------------------------
def exact_quantiles(df: DataFrame, col, probs, group_cols=(), names=None) -> DataFrame:
    """Per group, the ``probs`` quantiles of ``col`` (nulls dropped) with
    linear interpolation between order statistics: position h = p (n - 1),
    value = x[floor h] + (h - floor h) (x[floor h + 1] - x[floor h]).

    The built-in exact ``percentile`` merges a group's value counts in one
    task, which does not hold for a hot group of continuous values.  Here the
    order statistics come from ``value_ranks`` (one row per distinct value
    with its rank span, computed with bounded tasks); each position is read
    from the single distinct value whose span covers it, in one grouped
    aggregate.  Returns the group columns, ``n`` (non-null values) and one
    double column per prob.
    """
    g = list(group_cols)
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    src = df.select(*g, _c(col).alias("_qv"))
    r = value_ranks(src, "_qv", g, value_name="_qv")
    v = F.col("_qv").cast("double")
    aggs, finals = [F.max("total").alias("_n")], []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("total") - 1)
        lo = F.floor(h)
        hi = F.least(lo + 1, F.col("total") - 1)

        def covers(idx):
            return (F.col("before") <= idx) & (idx < F.col("before") + F.col("n"))
        aggs += [F.max(F.when(covers(lo), v)).alias(f"_lo{i}"), F.max(F.when(covers(hi), v)).alias(f"_hi{i}")]
        hh = F.lit(float(p)) * (F.col("_n") - 1)
        finals.append((F.col(f"_lo{i}") + (hh - F.floor(hh)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(names[i]))
    out = r.groupBy(*g).agg(*aggs) if g else r.agg(*aggs)
    return out.select(*g, F.coalesce(F.col("_n"), F.lit(0)).alias("n"), *finals)


def quantile_rows(df: DataFrame, col, probs, group_cols=()) -> DataFrame:
    """Long form of ``exact_quantiles`` for many probabilities: one row
    (group, ``k`` = 1-based index of the prob, ``value``) per quantile.

    Each distinct value's rank row emits only the quantile positions its span
    covers (an array filter over the probs), so the work is one small grouped
    aggregate per quantile instead of two conditional aggregates per prob.
    """
    g = list(group_cols)
    src = df.select(*g, _c(col).alias("_qv"))
    r = value_ranks(src, "_qv", g, value_name="_qv")
    last = F.col("total") - 1
    cand = F.transform(F.array(*[F.lit(float(p)) for p in probs]),
                       lambda p, i: F.struct((i + 1).alias("k"), F.floor(p * last).alias("lo"),
                                             F.least(F.floor(p * last) + 1, last).alias("hi"),
                                             (p * last - F.floor(p * last)).alias("frac")))

    def covers(idx):
        return (F.col("before") <= idx) & (idx < F.col("before") + F.col("n"))
    hits = F.filter(cand, lambda c: covers(c["lo"]) | covers(c["hi"]))
    e = r.select(*g, F.col("_qv").cast("double").alias("_v"), "before", "n", F.explode(hits).alias("_c"))
    agg = e.groupBy(*g, F.col("_c.k").alias("k")).agg(
        F.max(F.when(covers(F.col("_c.lo")), F.col("_v"))).alias("_lo"),
        F.max(F.when(covers(F.col("_c.hi")), F.col("_v"))).alias("_hi"),
        F.max("_c.frac").alias("_f"))
    return agg.select(*g, "k", (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias("value"))


# A2 -------------------------------------------------------------------------
def summary_metrics(df: DataFrame, value: str, threshold: float, days: str | None = None,
                    extra_means: list[str] = (), prefix: str | None = None, probs: list[str] = (), prob_min: float = 0.5,
                    changes: list[str] = ()) -> DataFrame:
    """One row: count, mean/std of ``value``, mean/std of rows at or above
    ``threshold`` and their share, means of ``extra_means``; for each of
    ``probs`` the share of rows at or above ``prob_min``; means, then standard
    deviations of ``changes`` (empty input -> nulls)."""
    aggs = summary_aggregates(value, threshold, days, extra_means, prefix, probs, prob_min, changes)
    return df.agg(*[a.alias(name) for name, a in aggs.items()])


def summary_aggregates(value: str, threshold: float, days: str | None = None, extra_means: list[str] = (), prefix: str | None = None,
                       probs: list[str] = (), prob_min: float = 0.5, changes: list[str] = ()) -> dict[str, Column]:
    p = prefix or value
    v, rows = F.col(value), F.count(F.lit(1))
    hi = v >= threshold
    aggs = {"row_count": rows} | ({"avg_time_to_exploit": F.avg(days)} if days else {})
    aggs |= {f"{p}_mean": F.avg(v), f"{p}_std": F.stddev_samp(v), f"{p}_geq_mean": F.avg(F.when(hi, v)),
             f"{p}_geq_std": F.stddev_samp(F.when(hi, v)), f"{p}_geq_pct_of_total": pct(F.count_if(hi), rows)}
    aggs |= {f"{c}_mean": F.avg(c) for c in extra_means}
    aggs |= {f"{c}_geq_pct": pct(F.count_if(F.col(c) >= prob_min), rows) for c in probs}
    return aggs | {f"{c}_mean": F.avg(c) for c in changes} | {f"{c}_std": F.stddev_samp(c) for c in changes}


# Q17 / Q18 ------------------------------------------------------------------
def one_pass_report(df: DataFrame, sections: dict[str, dict[str, Column]]) -> DataFrame:
    """(section, metric, value) of many aggregates from one pass over the
    rows: one wide aggregate, unpivoted."""
    cells = [(section, metric, a) for section, aggs in sections.items() for metric, a in aggs.items()]
    wide = df.agg(*[a.cast("double").alias(f"v{i}") for i, (_, _, a) in enumerate(cells)])
    rows = [F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), F.col(f"v{i}").alias("value"))
            for i, (section, metric, _) in enumerate(cells)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# A3 / A4 ----------------------------------------------------------------------
def time_breakdown(avg_days: Column) -> list[Column]:
    """(days, hours, minutes, seconds) with Python's modulo sign rule; null
    average -> zeros."""
    d = F.coalesce(avg_days, F.lit(0.0))
    hrs = F.pmod(d, F.lit(1.0)) * 24
    mins = F.pmod(hrs, F.lit(1.0)) * 60
    secs = F.pmod(mins, F.lit(1.0)) * 60
    return [d.alias("days"), hrs.alias("hours"), mins.alias("minutes"), secs.alias("seconds")]


def conditional_stats(df: DataFrame, conditions: dict, value: str) -> DataFrame:
    """One aggregate pass over all named conditions, then unpivoted to one
    row per condition: count, % of rows, mean of ``value`` and its
    (days, hours, minutes, seconds) breakdown."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, (_, cond) in enumerate(conditions.items()):
        aggs += [F.count_if(cond).alias(f"_n{i}"), F.avg(F.when(cond, F.col(value))).alias(f"_a{i}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("condition"), F.col(f"_n{i}").alias("n"),
                                        F.col(f"_a{i}").alias("avg"))
                               for i, name in enumerate(conditions)])).alias("r")
    long = wide.select("_total", rows).select("_total", "r.*")
    return long.select("condition", "n", pct(F.col("n"), F.col("_total")).alias("pct"),
                       "avg", *time_breakdown(F.col("avg")))


# A5 ---------------------------------------------------------------------------
def threshold_funnel(df: DataFrame, score: str, score_min: float, probs: list[str],
                     prob_min: float = 0.5) -> DataFrame:
    """Of rows with score >= score_min: how many have each probability, how
    many reach prob_min, as % of those with the probability and of all
    non-null probabilities."""
    return df.agg(*[a.alias(name) for name, a in funnel_aggregates(score, score_min, probs, prob_min).items()])


def funnel_aggregates(score: str, score_min: float, probs: list[str], prob_min: float = 0.5) -> dict[str, Column]:
    valid = F.col(score) >= score_min
    aggs = {"valid": F.count_if(valid), "valid_pct": pct(F.count_if(valid), F.count(score))}
    for p in probs:
        has = valid & F.col(p).isNotNull()
        hit = has & (F.col(p) >= prob_min)
        aggs |= {f"{p}_nonnull": F.count_if(has), f"{p}_hits": F.count_if(hit), f"{p}_pct_valid": pct(F.count_if(hit), F.count_if(has)),
                 f"{p}_pct_total": pct(F.count_if(hit), F.count(p))}
    return aggs


# A6 / A7 --------------------------------------------------------------------
def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (exact, linear interpolation), max
    per column; one aggregate pass, unpivoted to one row per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    # quartiles of all columns from one long (column, value) table, grouped
    # by column name: one rank pipeline instead of one per column
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_x"))
                                         for i, c in enumerate(cols)])).alias("_r")).select("_r.*")
    q = exact_quantiles(long, "_x", (0.25, 0.5, 0.75), ["_i"], ["q25", "q50", "q75"])
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(c).alias("column"), F.col(f"c{i}").alias("count"),
                                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                               for i, c in enumerate(cols)]))
    base = wide.select(rows.alias("r")).select("r.*")
    # both sides have one row per column (a bounded size)
    return (base.join(F.broadcast(q), "_i", "left")
                .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"))


def describe_dates(df: DataFrame, col: str) -> DataFrame:
    """Date describe over epoch microseconds, cast back to timestamps."""
    us = F.unix_micros(F.col(col).cast("timestamp"))
    back = lambda e: F.timestamp_micros(F.round(e).cast("long")).cast("timestamp_ntz")
    q = exact_quantiles(df, us, (0.25, 0.5, 0.75), names=["_q0", "_q1", "_q2"])
    a = df.agg(F.count(us).alias("count"), back(F.avg(us)).alias("mean"), back(F.min(us)).alias("min"),
               back(F.max(us)).alias("max"))
    # q is one row: its columns enter as scalar subqueries
    return a.select("count", "mean", "min", *[back(q.select(f"_q{i}").scalar()).alias(n)
                                              for i, n in enumerate(("q25", "q50", "q75"))], "max")


# A8 -------------------------------------------------------------------------
def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column (NaN counts as null for floats)."""
    aggs = []
    for f in df.schema.fields:
        aggs.append(F.count_if(_is_null(f)).alias(f.name))
    wide = df.agg(*aggs, F.count(F.lit(1)).alias("__rows"))
    rows = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("nulls"))
                               for f in df.schema.fields]))
    return wide.select("__rows", rows.alias("r")).select("r.column", "r.nulls",
                                                          pct(F.col("r.nulls"), F.col("__rows")).alias("pct"))


def _is_null(f) -> Column:
    c = F.col(f"`{f.name}`")
    return c.isNull() | F.isnan(c) if f.dataType.typeName() in ("double", "float") else c.isNull()


def null_map(df: DataFrame, order_by: list[str], tiles: int = 100) -> DataFrame:
    """(tile, column, rows, nulls): the rows in the order of ``order_by`` cut
    into ``tiles`` runs of the same length (one more row in some), and the
    nulls of each column in each."""
    flags = [_is_null(f) for f in df.schema.fields]
    placed = row_positions(df.select(*[F.col(f"`{c}`") for c in order_by], F.array(*flags).alias("_flags")), order_by, "_at")
    tile = F.floor(F.col("_at") * tiles / F.col("_at_total")).cast("int")
    named = F.array(*[F.struct(F.lit(c).alias("column"), F.get("_flags", i).alias("gone")) for i, c in enumerate(df.columns)])
    # counts by tile and column fold on the map side
    return placed.select(tile.alias("tile"), F.explode(named).alias("f")).groupBy("tile", F.col("f.column").alias("column")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("f.gone").alias("nulls"))


# A9 -------------------------------------------------------------------------
def table_info(df: DataFrame) -> DataFrame:
    """Per column: type and non-null count, plus the row count."""
    aggs = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns] + [F.count(F.lit(1)).alias("__rows")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                                        F.col(f"`{c}`").alias("non_null")) for c, t in df.dtypes]))
    return wide.select(F.col("__rows").alias("rows"), rows.alias("r")).select("rows", "r.*")


# A11 ------------------------------------------------------------------------
def binned_counts(df: DataFrame, col: str, edges=SCORE_BIN_EDGES) -> DataFrame:
    """Right-closed bins (e0, e1], (e1, e2] ...; values outside -> dropped."""
    x = F.col(col)
    b = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x > lo) & (x <= hi)
        lab = F.lit(f"({lo}, {hi}]")
        b = F.when(cond, F.struct(F.lit(i).alias("bin_order"), lab.alias("bin"))) if b is None else \
            b.when(cond, F.struct(F.lit(i).alias("bin_order"), lab.alias("bin")))
    binned = df.select(b.alias("_b")).filter(F.col("_b").isNotNull())
    counts = binned.groupBy("_b.bin_order", "_b.bin").agg(F.count(F.lit(1)).alias("count"))
    total = binned.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", pct(F.col("count"), total))


# P10 ------------------------------------------------------------------------
def iqr_bounds(df: DataFrame, col: str, k: float = 1.5) -> Column:
    """Tukey fences as one scalar subquery: struct(lo, hi)."""
    q = exact_quantiles(df, col, (0.25, 0.75), names=["q1", "q3"])
    reach = k * (F.col("q3") - F.col("q1"))
    return q.select(F.struct((F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))).scalar()


def iqr_condition(df: DataFrame, col: str, k: float = 1.5) -> Column:
    fences = iqr_bounds(df, col, k)
    return F.col(col).between(fences["lo"], fences["hi"])


def iqr_filter(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows of ``col`` inside the fences (nulls removed as in the reference's
    comparison mask)."""
    return df.filter(iqr_condition(df, col, k))


# P11 / A21 ------------------------------------------------------------------
def cohort_membership(df: DataFrame, cohorts: dict, name: str = "cohort") -> DataFrame:
    """Explode each row into the named cohorts whose predicate it meets."""
    arr = F.filter(F.array(*[F.when(cond, F.lit(n)) for n, cond in cohorts.items()]), lambda v: v.isNotNull())
    return df.withColumn(name, F.explode(arr))


# A22 ------------------------------------------------------------------------
def _range(base: DataFrame, col: str) -> Column:
    """struct(lo, hi) of a column as one scalar subquery."""
    x = F.col(col).cast("double")
    return base.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).select(F.struct("lo", "hi")).scalar()


def histogram_bins(df: DataFrame, col: str, bins: int = 10, edges: list[float] | None = None, discrete: bool = False,
                   transform: str | None = None) -> DataFrame:
    """bin, lo, hi, count of the non-null values, after ``transform``.

    Equal-width bins between min and max by default; with ``edges`` (ascending)
    the bins between them, values outside left out; ``discrete``: bins of
    width one centred on the smallest value and its successors.  A bin holds
    its lower end but not its upper, the last one both.  Bins without values
    have no row.
    """
    from riskspan.functions.numeric import transform_numeric
    x = transform_numeric(F.col(col), transform) if transform else F.col(col)
    base = df.select(x.cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    if edges is not None:
        if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
            raise ValueError("edges must ascend")
        cuts = F.array(*[F.lit(float(e)) for e in edges])
        inside = base.where(F.col("x").between(float(edges[0]), float(edges[-1]))).withColumn("cuts", cuts)
        idx = F.least(part_of("x", "cuts") - 1, F.lit(len(edges) - 2))
        counts = inside.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        return counts.select("bin", "count", F.get(cuts, F.col("bin")).alias("lo"), F.get(cuts, F.col("bin") + 1).alias("hi"))
    ends = _range(base, "x")
    if discrete:
        lo, width = ends["lo"] - 0.5, F.lit(1.0)
        idx = F.floor(F.col("x") - lo)
    else:
        lo, width = ends["lo"], (ends["hi"] - ends["lo"]) / bins
        idx = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = base.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumns({"lo": lo + F.col("bin") * width, "hi": lo + (F.col("bin") + 1) * width})


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    base = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = []
    for c in (x, y):
        ends = _range(base, c)
        w = (ends["hi"] - ends["lo"]) / bins
        out.append(F.when(w > 0, F.least(F.floor((F.col(c) - ends["lo"]) / w), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int"))
    return base.groupBy(out[0].alias("x_bin"), out[1].alias("y_bin")).agg(F.count(F.lit(1)).alias("count"))


# A24 ------------------------------------------------------------------------
def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
                  F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


# A25 ------------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, group: str | None = None, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest data within 1.5 IQR of the box) and
    outlier counts per group: two grouped aggregates joined on the group (a
    box plot has a few groups, so their boxes are broadcast)."""
    g = [group] if group else []
    base = df.filter(F.col(col).isNotNull())
    q = exact_quantiles(base, col, (0.25, 0.5, 0.75), g, ["q1", "median", "q3"])
    q = q.withColumns({"lo_fence": F.col("q1") - k * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + k * (F.col("q3") - F.col("q1"))})
    j = base.join(F.broadcast(q), on=g) if g else base.withColumns(
        {c: q.select(c).scalar() for c in ("n", "q1", "median", "q3", "lo_fence", "hi_fence")})
    inside = (F.col(col) >= F.col("lo_fence")) & (F.col(col) <= F.col("hi_fence"))
    return j.groupBy(*g, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"), F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"))


# A26 ------------------------------------------------------------------------
def stats_by_offset(df: DataFrame, prefix: str = "epss_", offsets=(0, 30, 60)) -> DataFrame:
    cols = [f"{prefix}{k}" for k in offsets]
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("offset"), F.col(c).cast("double").alias("score"))
                            for k, c in zip(offsets, cols)])).alias("r")).select("r.*")
    return long.groupBy("offset").agg(F.count("score").alias("n"), F.avg("score").alias("mean"),
                                      F.stddev_samp("score").alias("std"))
