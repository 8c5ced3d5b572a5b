"""Weighted dominance counts: the core of exact Kendall coefficients.

For cells (x, y) with weights, the pairs of cells with x_a < x_b and
y_a < y_b are counted, weight times weight, without listing pairs.  Order the
cells by (x, then y from high to low): a pair counts if and only if the first
has the smaller y.  The order can be cut anywhere, also within one x value,
so every block holds a bounded number of cells whatever values are hot; the
same holds for the order by (y, then x from high to low).  A pair is then

* in one x block: counted in the block's task;
* in different x blocks and one y block: counted in the y block's task;
* in different blocks on both axes: from a table of block totals.

A cell's weight may be a vector (one weight for each cohort, or for each
bootstrap replicate); all of them share the sorting.  Sums are doubles: a
count of n rows has an absolute error of some n**2 / 10**16.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspan.operators.ranks import cut_points, part_of

# cells that are compared with each other directly
NEAR = 32

# what a row of block results holds
CONCORDANT, GRID, BOTH_TIES = 0, 1, 2
X_TIES, Y_TIES = 3, 4          # sums over values that lie in one block
X_EDGE, Y_EDGE = 5, 6          # weight of a block's first and last value
TIES = ("t2", "v", "v1", "v2")  # t(t-1)/2, t(t-1)(2t+5), t(t-1), t(t-1)(t-2)


def concordant(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of w[a] * w[b] over a < b with y[a] < y[b], for every column of
    ``w``: blocks of NEAR rows directly, then merges of ever longer blocks."""
    n, width = w.shape
    m = -(-max(n, 1) // NEAR) * NEAR
    rank = np.zeros(m, np.int64)
    rank[:n] = np.unique(y, return_inverse=True)[1].reshape(-1)
    weight = np.zeros((m, width))
    weight[:n] = w
    total = np.zeros(width)
    ahead = np.triu(np.ones((NEAR, NEAR), bool), 1)
    for lo in range(0, m, NEAR * 512):
        r = rank[lo:lo + NEAR * 512].reshape(-1, NEAR)
        v = weight[lo:lo + NEAR * 512].reshape(-1, NEAR, width)
        smaller = ((r[:, :, None] < r[:, None, :]) & ahead).astype(np.float64)
        total += (np.matmul(smaller.transpose(0, 2, 1), v) * v).sum(axis=(0, 1))
    span = int(rank.max(initial=0)) + 1
    place, size = np.arange(m), NEAR
    while size < n:
        late = place // size % 2
        # of equal values the later half comes first, so it sees smaller ones only
        order = np.argsort((place // (2 * size) * span + rank) * 2 + 1 - late, kind="stable")
        v, late = weight[order], late[order].astype(bool)
        seen = np.cumsum(np.where(late[:, None], 0.0, v), axis=0)
        first = place // (2 * size) * (2 * size)
        base = np.where(first[:, None] > 0, seen[first - 1], 0.0)
        total += (v[late] * (seen - base)[late]).sum(axis=0)
        size *= 2
    return total


def tie_sums(t: np.ndarray) -> np.ndarray:
    """(4, width): the sums named in TIES over the rows of ``t``."""
    two = t * (t - 1)
    return np.stack([two.sum(axis=0) / 2, (two * (2 * t + 5)).sum(axis=0), two.sum(axis=0), (two * (t - 2)).sum(axis=0)])


def _value_weights(values: np.ndarray, w: np.ndarray):
    """Different values, ascending, and the weight of each."""
    order = np.argsort(values, kind="stable")
    v = values[order]
    start = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    return v[start], np.add.reduceat(w[order], start, axis=0)


def _block_rows(x: np.ndarray, y: np.ndarray, kx: np.ndarray, ky: np.ndarray, w: np.ndarray, side: int, alone: bool):
    """Results of one block: (kind, a, b, value, vector)."""
    if side == 0:
        order = np.lexsort((-y, x))
        yield CONCORDANT, 0, 0, 0.0, concordant(y[order], w[order])
        sx, sy = x[order], y[order]
        cell = np.flatnonzero(np.append(True, (sx[1:] != sx[:-1]) | (sy[1:] != sy[:-1])))
        both = np.add.reduceat(w[order], cell, axis=0)
        yield BOTH_TIES, 0, 0, 0.0, (both * (both - 1) / 2).sum(axis=0)
        columns, total = _value_weights(ky, w)
        for k, v in zip(columns.tolist(), total):
            yield GRID, int(kx[0]), k, 0.0, v
    elif not alone:
        order = np.lexsort((-y, kx))
        yield CONCORDANT, 0, 0, 0.0, concordant(y[order], w[order])
    values, total = _value_weights(x if side == 0 else y, w)
    inner = slice(None) if alone else slice(1, -1)
    yield (X_TIES, Y_TIES)[side], 0, 0, 0.0, tie_sums(total[inner]).reshape(-1)
    if not alone:
        for i in sorted({0, len(values) - 1}):
            yield (X_EDGE, Y_EDGE)[side], 0, 0, float(values[i]), total[i]


def _finished(rows: list[tuple], width: int) -> dict[str, np.ndarray]:
    """Sums of one group from the results of all its blocks."""
    def total(kind, size=width):
        found = [v for k, _, _, _, v in rows if k == kind]
        return np.sum(found, axis=0) if found else np.zeros(size)

    out = {}
    same = total(CONCORDANT)
    grid = [(a, b, v) for k, a, b, _, v in rows if k == GRID]
    side_a, side_b = (max(g[i] for g in grid) + 1 for i in (0, 1))
    table = np.zeros((side_a, side_b, width))
    for a, b, v in grid:
        table[a, b] += v
    below = np.zeros_like(table)
    below[1:, 1:] = np.cumsum(np.cumsum(table, axis=0), axis=1)[:-1, :-1]
    out["concordant"] = same + (table * below).sum(axis=(0, 1))
    out["n"] = table.sum(axis=(0, 1))
    out["both_t2"] = total(BOTH_TIES)
    for axis, ties, edge in (("x", X_TIES, X_EDGE), ("y", Y_TIES, Y_EDGE)):
        sums = total(ties, 4 * width).reshape(4, width)
        edges = [(value, v) for k, _, _, value, v in rows if k == edge]
        if edges:
            values = np.array([e[0] for e in edges])
            sums = sums + tie_sums(_value_weights(values, np.stack([e[1] for e in edges]))[1])
        out |= {f"{axis}_{name}": s for name, s in zip(TIES, sums)}
    return out


def cell_weights(table: pa.Table) -> np.ndarray:
    """One weight for each cell: its count ``n``."""
    return table["n"].to_numpy().astype(np.float64)[:, None]


def dominance_sums(cells: DataFrame, g: list[str], part: int, weights: Callable[[pa.Table], np.ndarray] = cell_weights) -> DataFrame:
    """Per group and weight (``lane`` = its place in the vector): n, the
    concordant weight, and the tie sums that tau-b and its variance need.

    ``cells`` holds the group columns, x, y (doubles) and what ``weights``
    reads; cells of the same x and y are added up.
    """
    points = cells.select(*g, F.struct("x", (-F.col("y")).alias("y")).alias("px"), F.struct("y", (-F.col("x")).alias("x")).alias("py"))
    cuts = cut_points(points, g, part, ["px", "py"])
    base = cells.join(F.broadcast(cuts), g, "left").withColumns({
        "px": F.struct("x", (-F.col("y")).alias("y")), "py": F.struct("y", (-F.col("x")).alias("x"))})
    base = base.select(*cells.columns, part_of("px", "cuts_px").alias("kx"), part_of("py", "cuts_py").alias("ky"),
                       F.col("cuts_px").isNull().alias("alone"))
    sides = base.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("block", F.when(F.col("side") == 0, F.col("kx")).otherwise(F.col("ky")))
    fields = [base.schema[c] for c in g]
    schema = T.StructType(fields + [T.StructField("kind", T.IntegerType()), T.StructField("a", T.IntegerType()),
                                    T.StructField("b", T.IntegerType()), T.StructField("value", T.DoubleType()),
                                    T.StructField("v", T.ArrayType(T.DoubleType()))])

    def of_block(t: pa.Table) -> pa.Table:
        x, y, kx, ky = (t[c].to_numpy() for c in ("x", "y", "kx", "ky"))
        rows = list(_block_rows(x, y, kx, ky, weights(t), t["side"][0].as_py(), t["alone"][0].as_py()))
        keys = {c: t[c].slice(0, 1).combine_chunks().take(pa.array([0] * len(rows))) for c in g}
        kind, a, b, value, v = zip(*rows)
        return pa.table(keys | {"kind": pa.array(kind, pa.int32()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
                                "value": pa.array(value, pa.float64()), "v": pa.array(v, pa.list_(pa.float64()))})

    names = ["n", "concordant", "both_t2"] + [f"{axis}_{t}" for axis in "xy" for t in TIES]
    result = T.StructType(fields + [T.StructField("lane", T.IntegerType())] + [T.StructField(n, T.DoubleType()) for n in names])

    def of_group(t: pa.Table) -> pa.Table:
        rows = [(k, a, b, value, np.array(v)) for k, a, b, value, v in
                zip(*(t[c].to_pylist() for c in ("kind", "a", "b", "value", "v")))]
        width = next(len(v) for k, _, _, _, v in rows if k == GRID)
        sums = _finished(rows, width)
        keys = {c: t[c].slice(0, 1).combine_chunks().take(pa.array([0] * width)) for c in g}
        return pa.table(keys | {"lane": pa.array(range(width), pa.int32())} | {n: pa.array(sums[n]) for n in names})

    return sides.groupBy(*g, "side", "block").applyInArrow(of_block, schema).groupBy(*g).applyInArrow(of_group, result)
