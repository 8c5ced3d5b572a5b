import numpy as np
import pandas as pd
import pytest

from riskspan.operators import correlation as R
from riskspan.operators import stats as S
from riskspan.operators.normality import anderson_darling, shapiro_wilk
from riskspan.operators.ranks import value_ranks


def _brute_tau_b(x, y):
    x, y = np.asarray(x, float), np.asarray(y, float)
    n = len(x)
    s = 0.0
    for i in range(n):
        s += np.sum(np.sign(x[i] - x[i + 1:]) * np.sign(y[i] - y[i + 1:]))
    tx = pd.Series(x).value_counts().to_numpy(float)
    ty = pd.Series(y).value_counts().to_numpy(float)
    n0 = n * (n - 1) / 2
    return s / np.sqrt((n0 - np.sum(tx * (tx - 1) / 2)) * (n0 - np.sum(ty * (ty - 1) / 2)))


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(7)
    n = 400
    g = rng.integers(0, 3, n)
    x = rng.integers(0, 15, n).astype(float)          # heavy ties
    y = np.round(x * 0.3 + rng.normal(0, 2, n), 1)
    pdf = pd.DataFrame({"g": g, "x": x, "y": y})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("target_cells", [20000, 3])  # one block, and many blocks
def test_kendall_matches_brute_force(spark, pairs, target_cells):
    pdf, df = pairs
    got = R.kendall(df, "x", "y", target_cells=target_cells).first().coef
    assert got == pytest.approx(_brute_tau_b(pdf.x, pdf.y), abs=1e-12)
    grouped = {r.g: r.coef for r in R.kendall(df, "x", "y", ["g"], target_cells=target_cells).collect()}
    for k, part in pdf.groupby("g"):
        assert grouped[k] == pytest.approx(_brute_tau_b(part.x, part.y), abs=1e-12)


def test_spearman_and_pearson(spark, pairs):
    pdf, df = pairs
    want = pdf.x.rank().corr(pdf.y.rank())
    assert R.spearman(df, "x", "y").first().coef == pytest.approx(want, abs=1e-12)
    assert R.pearson(df, "x", "y").first().coef == pytest.approx(pdf.x.corr(pdf.y), abs=1e-12)


def test_perfect_and_constant(spark):
    df = spark.createDataFrame([(float(i), float(i), 1.0) for i in range(10)], "x double, y double, c double")
    assert R.kendall(df, "x", "y").first().coef == pytest.approx(1.0)
    assert R.spearman(df, "x", "y").first().coef == pytest.approx(1.0)
    assert R.spearman(df, "x", "c").first().coef is None   # guard: constant column
    assert R.kendall(df, "x", "c").first().coef is None
    with pytest.raises(ValueError):
        R.correlate(df, "x", "y", "foo")


def test_partition_independence(spark, pairs):
    _, df = pairs
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append((R.kendall(df, "x", "y").first().coef, R.spearman(df, "x", "y").first().coef))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(r == pytest.approx(results[0], abs=1e-12) for r in results)


def test_value_ranks_average(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 3, 2, 3]], "v int")
    got = {r.value: (r.n, r.before, r.rank) for r in value_ranks(df, "v").collect()}
    assert got == {1: (1, 0, 1.0), 2: (1, 1, 2.0), 3: (3, 2, 4.0)}


def test_binned_counts_edges(spark):
    df = spark.createDataFrame([(0.0,), (4.0,), (4.1,), (9.0,), (10.0,), (None,)], "c double")
    got = {r.bin: r["count"] for r in S.binned_counts(df, "c").collect()}
    assert got == {"(0, 4]": 1, "(4, 7]": 1, "(7, 9]": 1, "(9, 10]": 1}


def test_iqr_filter(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "c double")
    assert sorted(r.c for r in S.iqr_filter(df, "c").collect()) == [1, 2, 3, 4]


def test_normality_direction(spark):
    rng = np.random.default_rng(3)
    normal = rng.normal(0, 1, 2000)
    skewed = rng.exponential(1, 2000)
    df = spark.createDataFrame(pd.DataFrame({"g": [0] * 2000 + [1] * 2000, "v": np.r_[normal, skewed]}))
    ad = {r.g: r for r in anderson_darling(df, "v", ["g"]).collect()}
    assert not ad[0].reject_normal and ad[1].reject_normal
    sw = {r.g: r for r in shapiro_wilk(df, "v", ["g"]).collect()}
    assert sw[0].p_value > 0.01 and sw[1].p_value < 1e-6
    small = spark.createDataFrame([(float(v),) for v in range(5)], "v double")
    assert anderson_darling(small, "v").first().statistic is None  # n < 8
    with pytest.raises(ValueError):
        anderson_darling(df, "v", significance=3.0)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from riskspan.operators.stats import exact_quantiles
    rng = np.random.default_rng(7)
    # group 0 is hot (most rows, many ties); group 2 has one value; nulls dropped
    rows = [(0, float(v)) for v in rng.integers(0, 50, 3000)]
    rows += [(1, float(v)) for v in rng.normal(0, 1, 97)]
    rows += [(2, 4.5), (2, None), (1, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.g: r for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    for g in (0, 1, 2):
        vals = np.array([x for k, x in rows if k == g and x is not None])
        assert got[g]["n"] == len(vals)
        for i, p in enumerate(probs):
            assert abs(got[g][f"q{i}"] - np.percentile(vals, p * 100)) < 1e-9
    one = exact_quantiles(df, "x", (0.5,), names=["med"]).collect()[0]
    allv = np.array([x for _, x in rows if x is not None])
    assert abs(one["med"] - np.median(allv)) < 1e-9 and one["n"] == len(allv)


def test_quantile_rows_match_numpy(spark):
    import numpy as np
    from riskspan.operators.stats import quantile_rows
    rng = np.random.default_rng(11)
    rows = [(0, float(v)) for v in rng.integers(0, 20, 2000)] + [(1, float(v)) for v in rng.normal(0, 1, 53)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [(k - 0.5) / 40 for k in range(1, 41)]
    got = {(r.g, r.k): r.value for r in quantile_rows(df, "x", probs, ["g"]).collect()}
    assert len(got) == 2 * len(probs)
    for g in (0, 1):
        vals = np.array([x for k, x in rows if k == g])
        for i, p in enumerate(probs):
            assert abs(got[(g, i + 1)] - np.percentile(vals, p * 100)) < 1e-9


def test_value_ranks_with_outlier_and_groups(spark):
    # one far outlier: equal-width buckets would put every other value into
    # bucket 0; ranks must stay exact whatever the bucket layout
    rng = np.random.default_rng(3)
    vals = [float(x) for x in rng.integers(0, 300, 2000)] + [1e12, -5.0]
    rows = [(i % 2, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r.g, r.value): (r.before, r.rank) for r in value_ranks(df, "v", ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    pdf["rank"] = pdf.groupby("g")["v"].rank(method="average")
    pdf["before"] = pdf.groupby("g")["v"].rank(method="min") - 1
    for r in pdf.drop_duplicates(["g", "v"]).itertuples():
        assert got[(r.g, r.v)] == (r.before, r.rank)


def test_parts_are_monotone_and_bounded(spark):
    """Values crowded anywhere (near zero, far from it, in a narrow range)
    spread over parts of about the same size."""
    from pyspark.sql import functions as F
    from riskspan.operators.ranks import cut_points, part_of
    rng = np.random.default_rng(3)
    groups = {0: np.arange(20000) * 1e-9, 1: 1.7e15 + np.arange(20000), 2: np.append(rng.normal(0, 1, 20000), [1e300, -1e300, np.inf, -np.inf]),
              3: np.arange(50.0), 4: np.append(np.arange(20000.0), np.nan)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g int, v double")
    cuts = cut_points(df.withColumnRenamed("v", "p"), ["g"], part=1000)
    rows = df.join(cuts, "g", "left").select("g", "v", part_of("v", "cuts_p").alias("b")).orderBy("g", "v").collect()
    for g, vs in groups.items():
        parts = [r.b for r in rows if r.g == g]
        assert parts == sorted(parts)
        assert len(set(parts)) == (1 if g == 3 else -(-len(vs) // 1000))
        assert max(np.bincount(parts)) < 2000


def test_value_ranks_in_parts(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 3000), "v": np.append(1.6e15 + rng.integers(0, 900, 2999), 0.0)})
    got = {(r.g, r.value): (r.before, r.rank, r.total) for r in value_ranks(spark.createDataFrame(pdf), "v", ["g"], part=40).collect()}
    pdf["rank"] = pdf.groupby("g")["v"].rank(method="average")
    pdf["before"] = pdf.groupby("g")["v"].rank(method="min") - 1
    pdf["total"] = pdf.groupby("g")["v"].transform("size")
    for r in pdf.drop_duplicates(["g", "v"]).itertuples():
        assert got[(r.g, r.v)] == (r.before, r.rank, r.total)


def test_dominance_with_hot_values(spark):
    """Two x values against very many y values: blocks stay bounded, results
    exact; vector weights share the sorting."""
    from riskspan.operators import dominance as D
    rng = np.random.default_rng(4)
    y = np.append(rng.permutation(3000) * 1.0, np.zeros(500))
    x = np.append(rng.integers(0, 2, 3000), rng.integers(0, 40, 500)) * 1.0
    cells = pd.DataFrame({"pair": 0, "x": x, "y": y}).groupby(["pair", "x", "y"]).size().rename("n").reset_index()
    sizes = []

    def weights(t):
        sizes.append(t.num_rows)
        n = t["n"].to_numpy().astype(float)
        return np.stack([n, 2 * n], axis=1)

    df = spark.createDataFrame(cells)
    got = {r.lane: r for r in D.dominance_sums(df, ["pair"], 100, weights).collect()}
    c, q = cells[["x", "y", "n"]].to_numpy(dtype=float), 0.0
    for i in range(len(c)):
        q += c[i, 2] * c[(c[:, 0] < c[i, 0]) & (c[:, 1] < c[i, 1]), 2].sum()
    assert got[0].concordant == q and got[1].concordant == 4 * q and got[0].n == 3500
    for axis in "xy":
        t = cells.groupby(axis)["n"].sum()
        assert got[0][f"{axis}_t2"] == (t * (t - 1) / 2).sum() and got[0][f"{axis}_v2"] == (t * (t - 1) * (t - 2)).sum()
    # the tasks themselves: no block beyond a few times its share
    from pyspark.sql import functions as F
    from riskspan.operators.ranks import cut_points, part_of
    point = F.struct("x", (-F.col("y")).alias("y"))
    cuts = cut_points(df.select("pair", point.alias("p")), ["pair"], 100)
    largest = df.join(cuts, "pair").withColumn("p", point).groupBy(part_of("p", "cuts_p").alias("b")).count().agg(F.max("count")).first()[0]
    assert largest < 400


def test_concordant_pairs_by_brute_force():
    from riskspan.operators.dominance import concordant
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 32, 33, 64, 100, 1000):
        y, w = rng.integers(0, max(1, n // 3), n) * 0.5, rng.integers(0, 5, (n, 3)) * 1.0
        want = np.zeros(3)
        for b in range(n):
            want += w[b] * w[:b][y[:b] < y[b]].sum(axis=0)
        assert concordant(y, w).tolist() == want.tolist()


def test_bootstrap_of_tied_rows(spark):
    import numpy as np
    from riskspan.operators.bootstrap import bootstrap_correlation, replicate_cells
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, 300)
    y = x + rng.integers(0, 4, 300)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    total = replicate_cells(df, "x", "y", 400).groupBy("replicate").agg(F.sum("weight").alias("n")).toPandas()["n"]
    assert abs(total.mean() - 300) < 4 and 13 < total.std() < 22
    got = {r.method: r for r in bootstrap_correlation(df, [("x", "y")], 400).collect()}

    def rank(v):
        order = np.unique(v, return_inverse=True, return_counts=True)
        return (np.cumsum(order[2]) - (order[2] - 1) / 2)[order[1]]

    own = []
    for _ in range(2000):
        i = rng.integers(0, 300, 300)
        own.append(np.corrcoef(rank(x[i]), rank(y[i]))[0, 1])
    assert abs(got["spearman"].std / np.std(own) - 1) < 0.12 and abs(got["spearman"].mean - np.mean(own)) < 0.01


def test_anderson_darling_far_tail(spark):
    import math
    from riskspan.functions.distributions import log_norm_sf
    from pyspark.sql import functions as F
    zs = [-60.0, -5.0, 0.0, 3.0, 8.0, 38.0, 60.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(log_norm_sf(F.col("z"))).collect()]
    for z, v in zip(zs, got):
        want = math.log(0.5 * math.erfc(z / math.sqrt(2))) if z < 30 else -z * z / 2 - math.log(z * math.sqrt(2 * math.pi)) + math.log1p(-1 / z ** 2)
        assert abs(v - want) < 1e-5 * max(1, abs(want))


def test_shapiro_needs_a_sample_above_its_limit(spark):
    df = spark.range(0, 6000).selectExpr("id % 2 as g", "cast(id as double) as v")
    assert [r.statistic for r in shapiro_wilk(df, "v", ["g"], max_n=100).collect()] == [None, None]


def test_samples_are_thinned_before_they_are_ordered(spark, monkeypatch):
    from pyspark.sql import functions as F
    from riskspan.operators import ranks as R
    monkeypatch.setattr(R, "MOST_PARTS", 8)
    monkeypatch.setattr(R, "SAMPLED", 8)
    df = spark.range(20000).select((F.col("id") % 2).alias("g"), F.col("id").alias("p"))
    sizes = R._large_groups(df, ["g"], 1000, ["p"])
    assert R._sampled(df, sizes, ["g"], ["p"]).count() < 2 * 4 * 64
    cuts = {r.g: r.cuts_p for r in R.cut_points(df, ["g"], 1000).collect()}
    smallest = df.where("g = 1").orderBy(F.xxhash64("p")).limit(64).collect()
    own = sorted(r.p for r in smallest)
    assert cuts[1] == [own[i * 64 // 8] for i in range(1, 8)] and len(cuts[0]) == 7


def test_hash_sample_orders_low_hashes_only(spark, monkeypatch):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from riskspan.operators import filters as P
    monkeypatch.setattr(P, "LARGE_GROUP", 100)
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 500 > 0, F.col("id")).alias("k"),
                                  (F.col("id") % 7).alias("v")).union(spark.createDataFrame([(9, i, 0) for i in range(50)], "g long, k long, v long"))
    near = P._low_hashes(df, "k", 40, 1945, ["g"])
    assert near.where("g is null").count() < 120 and near.where("g = 9").count() == 50
    nth = F.row_number().over(Window.partitionBy("g").orderBy(P._seeded("k", 1945), "k", F.xxhash64("g", "k", "v")))
    want = df.withColumn("nth", nth).where("nth <= 40").drop("nth")
    got = P.hash_sample_n(df, "k", 40, group_cols=["g"])
    assert got.count() == 160 and got.exceptAll(want).count() == 0


def test_boxes_are_broadcast_to_the_rows(spark):
    from riskspan.operators.stats import box_stats
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = box_stats(spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 1.0)], "g string, v double"), "v", "g")
        assert {r.g: (r.n, r.whisker_hi) for r in out.collect()} == {"a": (10, 9.0), "b": (1, 1.0)}
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "rightHint=(strategy=broadcast)" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
