"""Cohort matrix against pandas, bootstrap blocks against single replicates,
counts taken in the scan."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspan.operators import audit as A
from riskspan.operators import bootstrap as B
from riskspan.operators import stats as S
from riskspan.operators.cohorts import cohort_matrix
from riskspan.operators.ranks import row_positions


def tau_b(x, y):
    x, y = np.asarray(x, float), np.asarray(y, float)
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return (sx * sy).sum() / np.sqrt((sx ** 2).sum() * (sy ** 2).sum())


@pytest.mark.parametrize("part", [50_000, 25])
def test_matrix_against_pandas(spark, part):
    rng = np.random.default_rng(12)
    n = 600
    pdf = pd.DataFrame({"a": rng.integers(0, 12, n).astype(float), "b": rng.normal(size=n).round(2), "c": rng.integers(0, 2, n).astype(float)})
    pdf["b"] += pdf["a"] / 4
    pdf.loc[::17, "b"] = None
    cohorts = {"all": "true", "low": "a < 4", "high": "a >= 4", "missing": "b > 3 or b is null", "none": "a > 100", "one": "a = 5"}
    pairs = [("a", "b"), ("b", "c"), ("a", "c")]
    df = spark.createDataFrame(pdf).select("a", F.nanvl("b", F.lit(None)).alias("b"), "c")
    out = cohort_matrix(df, {k: F.expr(v) for k, v in cohorts.items()}, {"c1": F.col("c") == 1}, {"b": F.col("b")},
                        {c: F.col(c) for c in "abc"}, pairs, part=part)
    rows = {r.cohort: r for r in out.collect()}
    assert list(rows) and set(rows) == set(cohorts)
    masks = {"all": pdf.a >= 0, "low": pdf.a < 4, "high": pdf.a >= 4, "missing": (pdf.b > 3) | pdf.b.isna(), "none": pdf.a > 100, "one": pdf.a == 5}
    for name, mask in masks.items():
        own, r = pdf[mask], rows[name]
        assert r.cnt == len(own) and r.cnt_c1 == (own.c == 1).sum()
        assert r.avg_b == (pytest.approx(own.b.mean()) if len(own) else None)
        whole = own.dropna()
        for x, y in pairs:
            got = [r[f"{m}_{x}_vs_{y}"] for m in ("pearson", "spearman", "kendall")]
            if len(whole) < 2 or whole[x].nunique() < 2 or whole[y].nunique() < 2:
                assert got == [None] * 3 and r[f"p_kendall_{x}_vs_{y}"] is None
            else:
                want = [whole[x].corr(whole[y]), whole[x].rank().corr(whole[y].rank()), tau_b(whole[x], whole[y])]
                assert got == pytest.approx(want, abs=1e-9)
                assert all(0 <= r[f"p_{m}_{x}_vs_{y}"] <= 1 for m in ("pearson", "spearman", "kendall"))


def test_blocks_of_replicates_against_single_ones(spark):
    """The vector path and the distributed path draw and compute alike."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, 200)
    df = spark.createDataFrame([(float(a), float(a + b), float(b)) for a, b in zip(x, rng.integers(0, 4, 200))], "x double, y double, z double")
    pairs = [("x", "y"), ("y", "z")]
    rows = {(r.pair, r.method, r.replicate): (r.coef, r.p_value) for r in B.replicate_coefficients(df, pairs, 12).collect()}
    apart = {(r.pair, r.method, r.replicate): (r.coef, r.p_value) for r in B.replicate_coefficients(df, pairs, 12, whole=3).collect()}
    assert len(rows) == 2 * 2 * 12 and set(rows) == set(apart)
    for k, (coef, p) in rows.items():
        assert apart[k] == (pytest.approx(coef, abs=1e-9), pytest.approx(p, abs=1e-6))
    # one replicate by hand
    weights = B.replicate_cells(df, "x", "y", 12).where("replicate = 3").toPandas()
    full = weights.loc[weights.index.repeat(weights.weight)]
    assert rows[0, "kendall", 3][0] == pytest.approx(tau_b(full.x, full.y), abs=1e-9)
    assert rows[0, "spearman", 3][0] == pytest.approx(full.x.rank().corr(full.y.rank()), abs=1e-9)


def test_counts_of_a_filter_and_a_conversion(spark, tmp_path):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (None, None), (4, "7")], "a int, b string")
    kept, seen = A.counted_filter(df, F.col("a") > 1)
    kept.write.parquet(f"{tmp_path}/kept")
    assert A.counts(seen, "step") == [("step", "kept", 2), ("step", "removed", 2), ("step", "rows", 4)]
    changed, failed = A.counted_convert(df, {"integer": ["b"], "float": ["missing"]})
    changed.write.parquet(f"{tmp_path}/changed")
    assert A.counts(failed, "types") == [("types", "b", 1)]
    assert [r.b for r in spark.read.parquet(f"{tmp_path}/changed").orderBy("b").collect()] == [None, None, 5, 7]


def test_row_positions_and_null_map(spark):
    rows = [(i, None if i < 30 else 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    got = row_positions(df, ["k"], part=9).collect()
    assert sorted((r.k, r.position, r.position_total) for r in got) == [(i, i, 100) for i in range(100)]
    tiles = {(r.tile, r.column): (r.rows, r.nulls) for r in S.null_map(df, ["k"], 10).collect()}
    assert len(tiles) == 20 and all(tiles[t, "v"] == (10, 10 if t < 3 else 0) and tiles[t, "k"] == (10, 0) for t in range(10))


def test_histogram_modes(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.4, 1.0, 2.0, 2.0, 9.0, None, float("nan")]], "v double")
    bins = lambda **k: sorted((r.bin, r["count"], r.lo, r.hi) for r in S.histogram_bins(df, "v", **k).collect())
    assert bins(edges=[0, 1, 2, 4]) == [(0, 2, 0.0, 1.0), (1, 1, 1.0, 2.0), (2, 2, 2.0, 4.0)]
    assert bins(edges=[0, 2]) == [(0, 5, 0.0, 2.0)]
    assert bins(discrete=True) == [(0, 1, -1.5, -0.5), (1, 2, -0.5, 0.5), (2, 1, 0.5, 1.5), (3, 2, 1.5, 2.5), (10, 1, 8.5, 9.5)]
    assert bins(bins=2) == [(0, 6, -1.0, 4.0), (1, 1, 4.0, 9.0)]
    assert bins(bins=3, transform="sqrt")[-1] == (2, 1, 2.0, 3.0)
    with pytest.raises(ValueError):
        S.histogram_bins(df, "v", edges=[1, 1])


def test_cells_are_counted_once(spark):
    df = spark.createDataFrame([(i % 5, (i * 7) % 11) for i in range(60)], "a int, b int")
    out = cohort_matrix(df, {"all": F.lit(True)}, {}, {}, {"a": F.col("a"), "b": F.col("b")}, [("a", "b")], ("spearman", "kendall"))
    assert out.first().cnt == 60
    # the plan that is left reads the rows for the facts only
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [a#") == 1
