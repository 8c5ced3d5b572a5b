"""Bootstrap confidence for rank correlations.

Resampling with replacement is expressed as Poisson multiplicities (the
standard distributed bootstrap).  Rows are first folded into (x, y, n) cells;
n independent rows together draw Poisson(n), so one draw per cell and
replicate stands for all its rows, and no row is replicated.  Draws come from
a counter-based generator keyed by the cell and a block of replicates, so a
recomputed task draws the same.

Pairs of columns with up to ``WHOLE`` different combinations are handled a
block of replicates at a time: a task holds the cells once, and the weights of
its replicates are vectors that share all sorting.  Pairs with more go through
the distributed coefficients, with a group for each replicate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.functions.distributions import normal_two_sided_p, t_two_sided_p
from riskspan.operators.correlation import pair_cells, with_pvalues_pairs
from riskspan.operators.dominance import concordant, tie_sums

BLOCK = 500       # replicates drawn with one generator
WHOLE = 100_000   # cells that one task may hold
ROOM = 1 << 21    # weights that are in memory at the same time


def draws(key: int, block: int, n: int, replicates: int) -> np.ndarray:
    """Poisson(n) weights of one cell in the replicates of a block."""
    width = min(BLOCK, replicates - block * BLOCK)
    rng = np.random.Generator(np.random.Philox(key=[key & ((1 << 64) - 1), block]))
    return rng.poisson(n, width)


def _keyed(cells: DataFrame, seed: int) -> DataFrame:
    return cells.withColumn("key", F.xxhash64("x", "y", F.lit(seed)))


def _weighted_rows(replicates: int) -> Callable:
    def run(batches):
        for batch in batches:
            xs, ys, ns, keys, pairs = (batch[c].to_numpy(zero_copy_only=False) for c in ("x", "y", "n", "key", "pair"))
            for i in range(batch.num_rows):
                for block in range(-(-replicates // BLOCK)):
                    weight = draws(int(keys[i]), block, ns[i], replicates)
                    held = np.flatnonzero(weight)
                    k = len(held)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, pairs[i]), pa.int32()), pa.array(held + block * BLOCK), pa.array(np.full(k, xs[i])),
                         pa.array(np.full(k, ys[i])), pa.array(weight[held].astype(np.int64))],
                        names=["pair", "replicate", "x", "y", "weight"])

    return run


def replicate_cells(df: DataFrame, x: str, y: str, replicates: int, seed: int = 1945) -> DataFrame:
    """(replicate, x, y, weight) with the Poisson weight of every cell that a
    replicate holds."""
    return _long(_keyed(pair_cells(df, [(x, y)], []), seed), replicates).drop("pair")


def _long(cells: DataFrame, replicates: int) -> DataFrame:
    return cells.select("pair", "x", "y", "n", "key").mapInArrow(
        _weighted_rows(replicates), "pair int, replicate long, x double, y double, weight long")


def _deviations(values: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Average rank of every cell's value in each replicate, less the middle."""
    _, place = np.unique(values, return_inverse=True)
    order = np.argsort(place, kind="stable")
    start = np.flatnonzero(np.append(True, np.diff(place[order]) > 0))
    t = np.add.reduceat(w[order], start, axis=0)
    rank = np.cumsum(t, axis=0) - t + (t + 1) / 2 - (n + 1) / 2
    return rank[place], t


def coefficients(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Spearman and Kendall (coefficient, p-value) for every column of weights;
    NaN where a column of weights leaves a variable constant."""
    n = w.sum(axis=0)
    dx, tx = _deviations(x, w, n)
    dy, ty = _deviations(y, w, n)
    with np.errstate(divide="ignore", invalid="ignore"):
        rho = (w * dx * dy).sum(axis=0) / np.sqrt((w * dx * dx).sum(axis=0) * (w * dy * dy).sum(axis=0))
        order = np.lexsort((-y, x))
        (x2, xv, xv1, xv2), (y2, yv, yv1, yv2) = tie_sums(tx), tie_sums(ty)
        pairs = n * (n - 1) / 2
        s = 2 * concordant(y[order], w[order]) - pairs + x2 + y2 - (w * (w - 1) / 2).sum(axis=0)
        tau = s / np.sqrt((pairs - x2) * (pairs - y2))
        var = (n * (n - 1) * (2 * n + 5) - xv - yv) / 18 + xv1 * yv1 / (2 * n * (n - 1)) + xv2 * yv2 / (9 * n * (n - 1) * (n - 2))
        t = rho * np.sqrt((n - 2) / (1 - rho * rho))
        p_rho = np.where(np.abs(rho) >= 1, 0.0, t_two_sided_p(t, n - 2))
        return {"spearman": (rho, p_rho), "kendall": (tau, normal_two_sided_p(s / np.sqrt(var)))}


def _block_results(replicates: int) -> Callable:
    def run(t: pa.Table) -> pa.Table:
        pair, block = t["pair"][0].as_py(), t["block"][0].as_py()
        order = np.lexsort((t["y"].to_numpy(), t["x"].to_numpy()))
        x, y, n, keys = (t[c].to_numpy()[order] for c in ("x", "y", "n", "key"))
        width = min(BLOCK, replicates - block * BLOCK)
        w = np.stack([draws(int(k), block, c, replicates) for k, c in zip(keys, n)]).astype(np.float32 if len(x) > 4096 else np.float64)
        rows = {"method": [], "replicate": [], "coef": [], "p_value": []}
        step = max(1, ROOM // len(x))
        for lo in range(0, width, step):
            for method, (coef, p) in coefficients(x, y, w[:, lo:lo + step].astype(np.float64)).items():
                rows["method"] += [method] * len(coef)
                rows["replicate"] += range(block * BLOCK + lo, block * BLOCK + lo + len(coef))
                rows["coef"] += [None if np.isnan(c) else float(c) for c in coef]
                rows["p_value"] += [None if np.isnan(c) else float(c) for c in p]
        return pa.table({"pair": pa.array([pair] * len(rows["coef"]), pa.int32()), "method": rows["method"],
                         "replicate": pa.array(rows["replicate"], pa.int64()), "coef": pa.array(rows["coef"], pa.float64()),
                         "p_value": pa.array(rows["p_value"], pa.float64())})

    return run


def replicate_coefficients(df: DataFrame, pairs: list[tuple[str, str]], replicates: int, seed: int = 1945, whole: int = WHOLE) -> DataFrame:
    """(pair, method, replicate, coef, p_value) for every pair, replicate and
    both coefficients."""
    cells = _keyed(pair_cells(df, pairs, []), seed)
    sizes = cells.groupBy("pair").agg(F.count(F.lit(1)).alias("m"))
    small = cells.join(sizes.where(F.col("m") <= whole).select("pair"), "pair", "left_semi")
    blocks = F.sequence(F.lit(0), F.lit(-(-replicates // BLOCK) - 1))
    done = small.withColumn("block", F.explode(blocks)).groupBy("pair", "block").applyInArrow(
        _block_results(replicates), "pair int, method string, replicate long, coef double, p_value double")
    large = _long(cells.join(sizes.where(F.col("m") > whole).select("pair"), "pair", "left_semi"), replicates)
    parts = [with_pvalues_pairs(large.withColumnRenamed("pair", "of"), [("x", "y")], m, ["of", "replicate"], weight="weight")
             .select(F.col("of").alias("pair"), F.lit(m).alias("method"), "replicate", "coef", "p_value") for m in ("spearman", "kendall")]
    return reduce(DataFrame.unionByName, parts, done)


def bootstrap_correlation(df: DataFrame, pairs: list[tuple[str, str]], replicates: int = 10000,
                          alpha: float = 0.05, seed: int = 1945) -> DataFrame:
    """Per pair and method: mean and population sd of the coefficient over
    the replicates, and the % of replicates significant at ``alpha``."""
    names = F.element_at(F.array(*[F.lit(f"{x}~{y}") for x, y in pairs]), F.col("pair") + 1)
    return replicate_coefficients(df, pairs, replicates, seed).groupBy(names.alias("pair"), "method").agg(
        F.avg("coef").alias("mean"), F.stddev_pop("coef").alias("std"),
        (F.avg((F.col("p_value") < alpha).cast("double")) * 100).alias("pct_significant"), F.count(F.lit(1)).alias("replicates"))
