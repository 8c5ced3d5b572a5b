"""Correlation coefficients (A12-A16) as distributed aggregates.

* Pearson: built-in covariance and deviations (single pass, mergeable).
* Spearman: Pearson of average ranks.  Rows are first folded into
  (x, y, count) cells, ranks come from ``value_ranks`` (no global window),
  and the weighted, rank-centred sums give the coefficient.
* Kendall tau-b: exact, from the weighted dominance counts of the cells
  (``dominance``): blocks of bounded size on both axes, whatever values are
  hot, and no pairs.

All pairs of columns that a call asks for run in one plan: every row becomes
one (pair, x, y) entry for each pair whose two values it has, and entries fold
into cells on the map side.  Building a plan starts no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspan.operators.dominance import dominance_sums
from riskspan.operators.ranks import value_ranks


def _value(c: str) -> Column:
    # "+ 0.0" turns -0.0 into 0.0, so equal values compare and group alike
    return F.nanvl(F.col(c).cast("double") + 0.0, F.lit(None).cast("double"))


def pair_cells(df: DataFrame, pairs: list[tuple[str, str]], g: list[str], weight: str | None = None) -> DataFrame:
    """(g, pair, x, y, n): rows for each combination of values of each pair
    (its place in ``pairs``), rows without one of the two left out."""
    columns = list(dict.fromkeys(c for p in pairs for c in p))
    place = {c: f"_c{i}" for i, c in enumerate(columns)}
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    base = df.select(*g, w.alias("_w"), *[_value(c).alias(place[c]) for c in columns])
    entries = F.explode(F.array(*[F.struct(F.lit(i).alias("pair"), F.col(place[x]).alias("x"), F.col(place[y]).alias("y"))
                                  for i, (x, y) in enumerate(pairs)])).alias("e")
    long = base.select(*g, "_w", entries).select(*g, "e.*", "_w").where("x is not null and y is not null")
    return long.groupBy(*g, "pair", "x", "y").agg(F.sum("_w").alias("n"))


def _two_values(c) -> Column:
    """2 when the column has at least two distinct values in the group, else
    1: the guard only needs that, and min < max says it without the extra
    shuffle of a distinct count."""
    return F.when(F.min(c) < F.max(c), F.lit(2)).otherwise(F.lit(1))


def _guard(n, nx, ny, value):
    """Fewer than two rows or fewer than two distinct values -> null."""
    return F.when((n >= 2) & (nx >= 2) & (ny >= 2), value)


# A14 -----------------------------------------------------------------------
def pearson_pairs(df: DataFrame, pairs: list[tuple[str, str]], group_cols=()) -> DataFrame:
    """(g, pair, n, coef) of all pairs from one aggregate over the rows; each
    pair uses the rows that have both of its values."""
    g = list(group_cols)
    aggs, rows = [], []
    for i, (x, y) in enumerate(pairs):
        x, y = _value(x), _value(y)
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        # covariance / (sd * sd): the built-in corr divides by zero (an error
        # under ANSI) on constant groups, which the guard must turn into null
        aggs += [F.count(x).alias(f"n{i}"), _two_values(x).alias(f"a{i}"), _two_values(y).alias(f"b{i}"),
                 F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"r{i}")]
        coef = _guard(F.col(f"n{i}"), F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"r{i}"))
        rows.append(F.struct(F.lit(i).alias("pair"), F.col(f"n{i}").alias("n"), coef.alias("coef")))
    wide = df.groupBy(*g).agg(*aggs)
    return wide.select(*g, F.explode(F.array(*rows)).alias("e")).select(*g, "e.*")


def pearson(df: DataFrame, x: str, y: str, group_cols=()) -> DataFrame:
    return pearson_pairs(df, [(x, y)], group_cols).drop("pair")


# A12 -----------------------------------------------------------------------
def spearman_pairs(df: DataFrame, pairs: list[tuple[str, str]], group_cols=(), weight: str | None = None) -> DataFrame:
    """(g, pair, n, coef) for every pair that has rows."""
    key = [*group_cols, "pair"]
    cells = pair_cells(df, pairs, list(group_cols), weight)
    # both rank tables come from the cell counts: the base rows are scanned once
    both = [value_ranks(cells, c, key, value_name=c, weight="n").select(*key, c, F.col("rank").alias(f"r{c}"), F.col("total").alias(f"t{c}"))
            for c in ("x", "y")]
    c = cells.join(both[0], [*key, "x"]).join(both[1].drop("ty"), [*key, "y"])
    m = (F.col("tx") + 1) / 2.0
    dx, dy = F.col("rx") - m, F.col("ry") - m
    out = c.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * dx * dy).alias("_sxy"), F.sum(F.col("n") * dx * dx).alias("_sxx"),
        F.sum(F.col("n") * dy * dy).alias("_syy"), _two_values("x").alias("_nx"), _two_values("y").alias("_ny"))
    r = F.try_divide(F.col("_sxy"), F.sqrt(F.col("_sxx") * F.col("_syy")))
    return out.select(*key, "n", _guard(F.col("n"), F.col("_nx"), F.col("_ny"), r).alias("coef"))


def spearman(df: DataFrame, x: str, y: str, group_cols=(), weight: str | None = None) -> DataFrame:
    return spearman_pairs(df, [(x, y)], group_cols, weight).drop("pair")


# A13 -----------------------------------------------------------------------
def tau_b(sums: DataFrame, keys: list[str]) -> DataFrame:
    """tau-b from dominance sums: of n(n-1)/2 pairs those tied in x or y are
    no votes, concordant ones count for, the others against.  Keeps S and the
    tie sums that its variance needs."""
    n = F.col("n")
    pairs = n * (n - 1) / 2
    s = 2 * F.col("concordant") - pairs + F.col("x_t2") + F.col("y_t2") - F.col("both_t2")
    tau = F.try_divide(s, F.sqrt((pairs - F.col("x_t2")) * (pairs - F.col("y_t2"))))
    # one distinct value: every pair is tied
    known = (n >= 2) & (F.col("x_t2") < pairs) & (F.col("y_t2") < pairs)
    return sums.select(*keys, n.cast("long").alias("n"), F.when(known, tau).alias("coef"), s.alias("s_stat"),
                       *[f"{axis}_{t}" for axis in "xy" for t in ("t2", "v", "v1", "v2")])


def kendall_pairs(df: DataFrame, pairs: list[tuple[str, str]], group_cols=(), target_cells: int = 50_000,
                  weight: str | None = None) -> DataFrame:
    """Exact Kendall tau-b (ties handled as in tau-b) for every pair that has
    rows; blocks hold about ``target_cells`` different combinations."""
    key = [*group_cols, "pair"]
    return tau_b(dominance_sums(pair_cells(df, pairs, list(group_cols), weight), key, target_cells), key)


def kendall(df: DataFrame, x: str, y: str, group_cols=(), target_cells: int = 50_000, weight: str | None = None) -> DataFrame:
    return kendall_pairs(df, [(x, y)], group_cols, target_cells, weight).drop("pair")


def correlate_pairs(df: DataFrame, pairs: list[tuple[str, str]], method: str, group_cols=(), weight: str | None = None) -> DataFrame:
    """A16 entry point: 'pearson' | 'spearman' | 'kendall'; others raise."""
    if method == "pearson":
        return pearson_pairs(df, pairs, group_cols)
    if method == "spearman":
        return spearman_pairs(df, pairs, group_cols, weight)
    if method == "kendall":
        return kendall_pairs(df, pairs, group_cols, weight=weight)
    raise ValueError(f"Unknown correlation method: {method.title()}")


def correlate(df: DataFrame, x: str, y: str, method: str, group_cols=(), weight: str | None = None) -> DataFrame:
    return correlate_pairs(df, [(x, y)], method, group_cols, weight).drop("pair")


# A15 -----------------------------------------------------------------------
def kendall_pvalue(k: DataFrame) -> "Column":
    """Asymptotic two-sided p-value of tau-b with the tie-corrected
    variance of S (columns produced by ``kendall``)."""
    from riskspan.functions.distributions import erfc
    n = F.col("n").cast("double")
    v0 = n * (n - 1) * (2 * n + 5)
    var = ((v0 - F.col("x_v") - F.col("y_v")) / 18.0
           + F.try_divide(F.col("x_v1") * F.col("y_v1"), 2 * n * (n - 1))
           + F.try_divide(F.col("x_v2") * F.col("y_v2"), 9 * n * (n - 1) * (n - 2)))
    z = F.try_divide(F.col("s_stat").cast("double"), F.sqrt(var))
    return F.when(F.col("coef").isNotNull(), erfc(F.abs(z) / 2 ** 0.5))


def with_pvalues_pairs(df: DataFrame, pairs: list[tuple[str, str]], method: str, group_cols=(), weight: str | None = None) -> DataFrame:
    """Coefficients plus p-values: t test (Pearson, Spearman) or normal
    approximation with ties (Kendall)."""
    from riskspan.functions.distributions import corr_t_pvalue
    r = correlate_pairs(df, pairs, method, group_cols, weight)
    p = kendall_pvalue(r) if method == "kendall" else corr_t_pvalue(F.col("coef"), F.col("n"))
    return r.select(*group_cols, "pair", "n", "coef", p.alias("p_value"))


def with_pvalues(df: DataFrame, x: str, y: str, method: str, group_cols=(), weight: str | None = None) -> DataFrame:
    return with_pvalues_pairs(df, [(x, y)], method, group_cols, weight).drop("pair")
