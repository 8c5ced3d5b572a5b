"""Search over components of any finite size."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskspan.llm.vector_search import top_inner_products, whole_vectors

SCHEMA = "vec_id long, embedding array<double>"


def search(spark, rows, k=3, every=20):
    df = spark.createDataFrame(rows, SCHEMA)
    out = top_inner_products(whole_vectors(df, 64), F.col("id") % every == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def expected(rows, k=3, every=20):
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in whole if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q and len(whole[c]) == len(whole[q]))
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return out


def test_large_components_take_part(spark):
    rows = [(20, [1.0, 0.0]), (1, [4e7, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [float("inf"), 0.0]), (5, [None, 1.0])]
    assert search(spark, rows) == expected(rows) == [(20, 1, 1, 163840000000), (20, 2, 2, 4096)]


def test_products_of_all_sizes(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-1, size) for _ in range(6)])
            for size in (1, 5, 7, 8) for i in range(100 * size, 100 * size + 40)]
    assert search(spark, rows, k=5) == expected(rows, k=5)


def test_sums_that_cancel(spark):
    rows = [(20, [1e12, 1e12, 1.0]), (1, [1e12, -1e12, 5.0]), (2, [3.0, -3.0, 7.0])]
    assert search(spark, rows) == expected(rows)


def test_scores_beyond_a_long_fail(spark):
    rows = [(20, [2.0 ** 24] * 16), (1, [2.0 ** 24] * 16), (2, [1.0] * 16)]
    with pytest.raises(Exception, match="does not fit a long"):
        search(spark, rows)
    # one that is not returned does no harm
    low = [(20, [2.0 ** 40] * 2), (1, [-2.0 ** 40] * 2), (2, [1.0] * 2), (3, [2.0] * 2)]
    assert [r[2] for r in search(spark, low, k=2)] == [3, 2]
    huge = [(20, [0.0, 1.0]), (1, [1e305, 2.0]), (2, [-1e305, 3.0])]
    assert search(spark, huge) == expected(huge)
