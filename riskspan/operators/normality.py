"""Normality tests and Q-Q data.

Anderson-Darling and Kolmogorov-Smirnov only need, per distinct value, its
multiplicity and the number of smaller values, which ``value_ranks`` gives
without a global sort into one task; each statistic is then one grouped sum
or max.  Shapiro-Wilk needs the ordered values themselves and is defined for
at most 5000; larger groups get no statistic, and the caller samples first
(``hash_sample_n``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspan.catalog import AD_CRITICAL_BASE, AD_SIGNIFICANCE
from riskspan.functions.distributions import log_norm_sf, norm_cdf, norm_ppf, norm_sf, ppf_sql
from riskspan.operators.ranks import value_ranks


def _moments(df: DataFrame, col: str, g: list[str]) -> DataFrame:
    x = F.col(col).cast("double")
    aggs = [F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd")]
    return df.filter(x.isNotNull()).groupBy(*g).agg(*aggs)


# A18 ------------------------------------------------------------------------
def anderson_darling(df: DataFrame, col: str, group_cols=(), significance: float = 5.0) -> DataFrame:
    """A^2 against a normal with estimated mean and sample sd; critical value
    for ``significance`` (one of 15, 10, 5, 2.5, 1) with the small-sample
    factor 1 / (1 + 4/n - 25/n^2); reject when A^2 exceeds it."""
    if significance not in AD_SIGNIFICANCE:
        raise ValueError(f"significance must be one of {AD_SIGNIFICANCE}")
    base = AD_CRITICAL_BASE[AD_SIGNIFICANCE.index(significance)]
    g = list(group_cols)
    vr = value_ranks(df, col, g)
    m = _moments(df, col, g)
    j = vr.join(m, on=g) if g else vr.withColumns({"_mean": m.select("_mean").scalar(), "_sd": m.select("_sd").scalar()})
    z = (F.col("value").cast("double") - F.col("_mean")) / F.col("_sd")
    t, b, n = F.col("n").cast("double"), F.col("before").cast("double"), F.col("total").cast("double")
    term = t * (2 * b + t) * log_norm_sf(-z) + t * (2 * n - 2 * b - t) * log_norm_sf(z)
    s = j.groupBy(*g).agg(F.first("total").alias("n"), F.sum(term).alias("_s"))
    nn = F.col("n").cast("double")
    a2 = -nn - F.col("_s") / nn
    crit = F.round(F.lit(base) / (1.0 + 4.0 / nn - 25.0 / (nn * nn)), 3)
    return s.select(*g, "n", F.when(nn >= 8, a2).alias("statistic"), crit.alias("critical_value"),
                    F.lit(significance).alias("significance"),
                    F.when(nn >= 8, a2 > crit).alias("reject_normal"))


# A19 ------------------------------------------------------------------------
def ks_standard_normal(df: DataFrame, col: str, group_cols=()) -> DataFrame:
    """Two-sided KS statistic against N(0, 1) (data not standardized) and the
    asymptotic p-value."""
    g = list(group_cols)
    vr = value_ranks(df, col, g)
    cdf = norm_cdf(F.col("value").cast("double"))
    n = F.col("total").cast("double")
    d = F.greatest((F.col("before") + F.col("n")) / n - cdf, cdf - F.col("before") / n)
    s = vr.groupBy(*g).agg(F.first("total").alias("n"), F.max(d).alias("statistic"))
    lam = F.sqrt(F.col("n").cast("double")) * F.col("statistic")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series))
    return s.select(*g, "n", "statistic", F.when(lam < 0.2, F.lit(1.0)).otherwise(p).alias("p_value"))


# A20 ------------------------------------------------------------------------
# FIXED VALUES: Royston's polynomials (AS R94): the two end weights in 1/sqrt(n), and the
# normalizing transformation of W for up to 11 values (in n) and beyond (in ln n)
LAST_WEIGHT = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
NEXT_WEIGHT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
FEW_GAMMA, FEW_MEAN, FEW_LOG_SD = [-2.273, 0.459], [0.544, -0.39978, 0.025054, -0.0006714], [1.3822, -0.77857, 0.062767, -0.0020322]
MANY_MEAN, MANY_LOG_SD = [-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302]


def poly_sql(coefs: list[float], x: str) -> str:
    out = repr(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {c!r})"
    return out


def swilk_sql() -> dict[str, str]:
    """W, and the normal score of its p-value, from sums over the ordered
    values of a group: n, mm = sum of squared expected order statistics m, mx
    = sum of m * x, ml and mk the largest two m, x1, x2, xk, xl the first and
    last two values, ss the sum of squares about the mean."""
    u = "(1 / sqrt(n))"
    last = f"(case when n = 3 then sqrt(0.5) else ml / sqrt(mm) + {poly_sql(LAST_WEIGHT, u)} end)"
    after = f"(mk / sqrt(mm) + {poly_sql(NEXT_WEIGHT, u)})"
    # of the inner weights m / sqrt(phi) the outer places are taken out
    one = f"(mm - 2 * ml * ml) / (1 - 2 * {last} * {last})"
    two = f"(mm - 2 * ml * ml - 2 * mk * mk) / (1 - 2 * {last} * {last} - 2 * {after} * {after})"
    slope = (f"(case when n = 3 then {last} * (xl - x1) when n <= 5 then (mx - ml * (xl - x1)) / sqrt({one}) + {last} * (xl - x1) "
             f"else (mx - ml * (xl - x1) - mk * (xk - x2)) / sqrt({two}) + {last} * (xl - x1) + {after} * (xk - x2) end)")
    few = f"(-ln({poly_sql(FEW_GAMMA, 'n')} - ln(1 - w)) - ({poly_sql(FEW_MEAN, 'n')})) / exp({poly_sql(FEW_LOG_SD, 'n')})"
    many = f"(ln(1 - w) - ({poly_sql(MANY_MEAN, 'ln(n)')})) / exp({poly_sql(MANY_LOG_SD, 'ln(n)')})"
    return {"w": f"least(1.0, {slope} * {slope} / ss)", "z": f"(case when n <= 11 then {few} else {many} end)"}


def shapiro_wilk(df: DataFrame, col: str, group_cols=(), max_n: int = 5000) -> DataFrame:
    """Per group: n, W and p (Royston's approximation).  Null W and p where a
    group has more than ``max_n`` values (the approximation ends there), fewer
    than three, or equal values only; only groups within the limit are ordered.

    The weights of the statistic follow from a value's place, so W is one
    grouped aggregate over (place, value).
    """
    g = list(group_cols)
    gnames = g if g else ["_g"]
    base = df if g else df.withColumn("_g", F.lit(0))
    base = base.select(*gnames, F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    sizes = base.groupBy(*gnames).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    small = base.join(sizes.where(F.col("n").between(3, max_n)), gnames)
    placed = small.withColumn("i", F.row_number().over(Window.partitionBy(*gnames).orderBy("x"))) \
        .withColumn("m", F.expr(ppf_sql("(i - 0.375D) / (n + 0.25D)")))

    def at(place, name):
        return F.max(F.when(F.col("i") == place, F.col(name)))

    n = F.col("n")
    sums = placed.groupBy(*gnames, "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(F.col("m") * F.col("x")).alias("mx"), at(n, "m").alias("ml"), at(n - 1, "m").alias("mk"),
        at(F.lit(1), "x").alias("x1"), at(F.lit(2), "x").alias("x2"), at(n - 1, "x").alias("xk"), at(n, "x").alias("xl"),
        F.sum((F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean"))).alias("ss"))
    sql = swilk_sql()
    tested = sums.where("xl > x1").withColumn("w", F.expr(sql["w"])).withColumn("z", F.when(F.col("w") < 1, F.expr(sql["z"])))
    exact = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75))))
    p = F.when(n == 3, exact).when(F.col("z").isNotNull(), norm_sf(F.col("z"))).otherwise(F.lit(1.0))
    return sizes.select(*gnames, "n").join(tested.select(*gnames, F.col("w").alias("statistic"), p.alias("p_value")), gnames, "left") \
        .select(*g, "n", "statistic", "p_value")


# A23 ------------------------------------------------------------------------
def qq_table(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """(theoretical normal quantile, sample quantile, fitted line) at
    ``points`` plotting positions; sample quantiles are exact (linear
    interpolation), computed from distributed value ranks."""
    probs = [(k - 0.5) / points for k in range(1, points + 1)]
    theo = [norm_ppf(p) for p in probs]
    from riskspan.operators.stats import quantile_rows
    x = F.col(col).cast("double")
    q = quantile_rows(df, x, probs)
    ms = df.agg(F.avg(x).alias("_m"), F.stddev_samp(x).alias("_s"))
    theo_of_k = F.element_at(F.array(*[F.lit(t) for t in theo]), F.col("k"))
    # mean and std (one row) enter as scalar subqueries
    r = q.select("k", theo_of_k.alias("theoretical"), F.col("value").alias("sample"),
                 ms.select("_m").scalar().alias("_m"), ms.select("_s").scalar().alias("_s"))
    return r.select("k", "theoretical", "sample",
                    (F.col("_m") + F.col("_s") * F.col("theoretical")).alias("fitted"))
