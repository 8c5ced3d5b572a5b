"""Exact top-k by inner product with multi-resolution segment statistics.

For a segment of m components with means u, v and deviations s, t the squared
distance is at least m((u-v)^2 + (s-t)^2).  With the two norms this bounds the
inner product from above by the sum over segments of m(uv + st).  Per block of
queries and candidates the bound is taken with 1, 2, 4, ... segments; a pair
whose bound falls below the query's k-th best exact score so far is dropped,
and the survivors' exact products decide.  Bounds only drop pairs that can't
be among the best, so the result is exact.

Queries and candidates are dealt into blocks of bounded size by a hash of the
id; each pair of blocks is one unit of work, and only its best k rows of each
query go on.

Products are exact whatever the size of the components: in doubles where every
sum stays below 2**52, in longs below 2**62, in whole numbers of any size
beyond.  A score that a long cannot hold is an error if it would be returned.

Defined cases: null vectors, vectors with null or non-finite components and
rows without id take no part; a finite component that is not finite any more
after scaling is an error; vectors meet only vectors of the same length; a
row with the query's own id is not its candidate; ties go to the smaller id;
repeated rows are returned as often as they occur; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 8192
CANDIDATE_BLOCK = 4096
AT_ONCE = 64  # queries whose bounds are held as one matrix
# components from here on take no part in bounds (their squares could overflow)
HUGE = 2.0 ** 400
_LONG = (1 << 63) - 1


def _segments(v: np.ndarray, count: int) -> np.ndarray:
    """Rows (sqrt(m) * mean, sqrt(m) * deviation) of ``count`` segments."""
    edges = np.linspace(0, v.shape[1], count + 1).astype(int)
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = v[:, lo:hi]
        out += [part.mean(axis=1) * np.sqrt(hi - lo), part.std(axis=1) * np.sqrt(hi - lo)]
    return np.stack(out, axis=1)


def exact_products(q: np.ndarray, c: np.ndarray, most: np.ndarray):
    """Inner products of the rows of ``q`` and ``c`` (whole numbers as doubles)
    as longs, and whether each fits; ``most``: bounds on their sizes."""
    out, fits = np.zeros(len(q), np.int64), np.ones(len(q), bool)
    near, far = most < 2.0 ** 52, most >= 2.0 ** 62
    out[near] = np.rint(np.einsum("ij,ij->i", q[near], c[near])).astype(np.int64)
    mid = ~near & ~far
    out[mid] = np.einsum("ij,ij->i", q[mid].astype(np.int64), c[mid].astype(np.int64))
    for k in np.flatnonzero(far).tolist():
        value = sum(int(x) * int(y) for x, y in zip(q[k].tolist(), c[k].tolist()))
        fits[k] = -_LONG <= value <= _LONG
        out[k] = max(-_LONG, min(_LONG, value))
    return out, fits


def best_of_block(q_ids, q, c_ids, c, k: int):
    """(query row, candidate row, score, whether it fits a long) of each
    query's best k candidates."""
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    q_most, c_most = np.abs(qf).max(axis=1, initial=0), np.abs(cf).max(axis=1, initial=0)
    exact_floats = q_most.max(initial=0) * c_most.max(initial=0) * q.shape[1] < 2.0 ** 52
    q_huge, c_huge = q_most >= HUGE, c_most >= HUGE
    levels, count = [], 1
    while count <= max(1, q.shape[1] // 4):
        levels.append((_segments(np.where(q_huge[:, None], 0.0, qf), count), _segments(np.where(c_huge[:, None], 0.0, cf), count)))
        count *= 2

    def products(rows, cols):
        if exact_floats:
            return np.rint(np.einsum("ij,ij->i", qf[rows], cf[cols])).astype(np.int64), np.ones(len(rows), bool)
        with np.errstate(over="ignore"):
            return exact_products(qf[rows], cf[cols], q_most[rows] * c_most[cols] * q.shape[1])

    order = np.argsort(c_ids, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    found = []
    for at in range(0, len(q_ids), AT_ONCE):
        rows = np.arange(at, min(at + AT_ONCE, len(q_ids)))
        other = q_ids[rows][:, None] != c_ids[None, :]
        coarse_q, coarse_c = levels[0]
        open_ = q_huge[rows][:, None] | c_huge[None, :]
        bound = np.where(other, np.where(open_, np.inf, coarse_q[rows] @ coarse_c.T), -np.inf)
        # exact scores of the most promising k give each query a first limit
        few = min(k, bound.shape[1])
        top = np.argpartition(-bound, few - 1, axis=1)[:, :few]
        seed = products(np.repeat(rows, few), top.reshape(-1))[0].reshape(len(rows), few).astype(np.float64)
        seed[~np.take_along_axis(other, top, axis=1)] = -np.inf
        limit = seed.min(axis=1) if few == k else np.full(len(rows), -np.inf)
        slack = 1e-9 * (1.0 + np.abs(bound, where=np.isfinite(bound), out=np.zeros_like(bound)).max(axis=1, initial=0))
        alive = other & (bound >= (limit - slack - 1e-6)[:, None])
        for level_q, level_c in levels[1:]:
            if alive.mean() > 0.05:
                alive &= open_ | (level_q[rows] @ level_c.T >= (limit - slack - 1e-6)[:, None])
            else:
                i, j = np.nonzero(alive & ~open_)
                low = np.einsum("ij,ij->i", level_q[rows[i]], level_c[j]) < (limit - slack - 1e-6)[i]
                alive[i[low], j[low]] = False
        if alive.mean() > 0.2 and exact_floats:
            score = np.rint(qf[rows] @ cf.T)
            i, j = np.nonzero(alive & (score >= limit[:, None]))
            s, fits = score[i, j].astype(np.int64), np.ones(len(i), bool)
        else:
            i, j = np.nonzero(alive)
            s, fits = products(rows[i], j)
            keep = s.astype(np.float64) >= limit[i]  # rounded alike, so none that is as good is lost
            i, j, s, fits = i[keep], j[keep], s[keep], fits[keep]
        sort = np.lexsort((place[j], -s, i))
        i, j, s, fits = i[sort], j[sort], s[sort], fits[sort]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        keep = nth < k
        found.append((rows[i[keep]], j[keep], s[keep], fits[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


_PAIR = "query_id long, vec_id long, score long, fits boolean"


def _search(k: int):
    def run(batches):
        for batch in batches:
            cols = [batch[n].to_pylist() for n in ("q_ids", "q_data", "c_ids", "c_data")]
            for a, b, c, d in zip(*cols):
                q_ids, c_ids = np.frombuffer(a, np.int64), np.frombuffer(c, np.int64)
                q = np.frombuffer(b, np.float64).reshape(len(q_ids), -1)
                v = np.frombuffer(d, np.float64).reshape(len(c_ids), -1)
                i, j, s, fits = best_of_block(q_ids, q, c_ids, v, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(s), pa.array(fits)],
                                                 names=["query_id", "vec_id", "score", "fits"])

    return run


def _block(table: pa.Table) -> pa.Table:
    ids = table["id"].to_numpy().astype(np.int64)
    values = table["v"].combine_chunks()
    data = values.flatten().to_numpy().astype(np.float64)
    return pa.table({"block": table["block"][:1], "size": table["size"][:1], "ids": [ids.tobytes()],
                     "data": [data.tobytes()]},
                    schema=pa.schema([("block", pa.int64()), ("size", pa.int32()), ("ids", pa.binary()),
                                      ("data", pa.binary())]))


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count))) \
        .groupBy("block", "size").applyInArrow(_block, "block long, size int, ids binary, data binary")


def whole_vectors(table: DataFrame, scale: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (floor(scale * x) of every component, whole numbers as doubles),
    size of usable rows."""
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("x", lambda x: F.when(F.abs(x * float(scale)) < float("inf"), _floor(x * float(scale)))
                        .otherwise(F.raise_error(F.lit("a component is too large to be scaled")).cast("double")))
    return table.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")) \
        .where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).where(finite) \
        .select("id", whole.alias("v"), F.size("x").alias("size"))


def _floor(x: Column) -> Column:
    """floor as a double; from 2**52 on doubles are whole."""
    return F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``vectors``: id, v, size (see ``whole_vectors``); ``is_query``: a
    condition on id.  Returns query_id, rank, vec_id, score."""
    n, queries = vectors.agg(F.count(F.lit(1)), F.sum(F.when(is_query, 1).otherwise(0))).first()
    q_count, c_count = max(1, -(-(queries or 0) // QUERY_BLOCK)), max(1, -(-n // CANDIDATE_BLOCK))
    q = _blocks(vectors.where(is_query), q_count).select(
        F.col("block").alias("q_block"), "size", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.explode(F.expr(f"sequence(0L, {c_count - 1}L)")).alias("c_block"))
    c = _blocks(vectors, c_count).select(
        F.col("block").alias("c_block"), "size", F.col("ids").alias("c_ids"), F.col("data").alias("c_data"),
        F.explode(F.expr(f"sequence(0L, {q_count - 1}L)")).alias("q_block"))
    units = q.join(c, ["q_block", "c_block", "size"]).repartition(q_count * c_count, "q_block", "c_block")
    found = units.select("q_ids", "q_data", "c_ids", "c_data").mapInArrow(_search(k), _PAIR)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    score = F.when(F.col("fits"), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", score.alias("score"))
