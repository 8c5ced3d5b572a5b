"""Cohort matrix (A21, P11, Q19): counts, shares, averages and all pairwise
correlations of many overlapping cohorts at the same time.

A row's cohorts are bits of one number, its *mask*; no row is copied for a
cohort.  Everything is first folded by mask:

* counts, sums, means and covariances by mask (at most as many groups as
  masks occur), merged to cohorts by the parallel formula;
* ranks: how often each mask has each value of a column, turned into one
  vector of counts (an entry for each cohort) and running sums over the
  values, so one table serves the ranks of all cohorts;
* Kendall: dominance counts whose weights are vectors over the cohorts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspan.operators.correlation import kendall_pvalue, tau_b
from riskspan.operators.dominance import dominance_sums
from riskspan.operators.ranks import PART, cut_points, part_of
from riskspan.operators.stats import pct
from riskspan.session import cut_lineage

METHODS = ("pearson", "spearman", "kendall")


def cohort_mask(cohorts: Mapping[str, Column]) -> Column:
    """The cohorts of a row as bits of a long (an unknown condition is no)."""
    if len(cohorts) > 62:
        raise ValueError("a mask holds at most 62 cohorts")
    bits = [F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, cond in enumerate(cohorts.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out + b
    return out


def _bits(df: DataFrame, count: int) -> DataFrame:
    """A row for each cohort (its number) of a small table by mask."""
    return df.withColumn("cohort", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).where(F.expr("shiftright(mask, cohort) & 1 = 1"))


def _facts(base: DataFrame, counts: list[str], means: list[str], count: int) -> DataFrame:
    by_mask = base.groupBy("mask").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"k{i}")).alias(f"k{i}") for i in range(len(counts))],
        *[F.sum(f"m{i}").alias(f"s{i}") for i in range(len(means))], *[F.count(f"m{i}").alias(f"c{i}") for i in range(len(means))])
    out = _bits(by_mask, count).groupBy("cohort").agg(
        F.sum("n").alias("n"), *[F.sum(f"k{i}").alias(f"k{i}") for i in range(len(counts))],
        *[F.try_divide(F.sum(f"s{i}"), F.sum(f"c{i}").cast("double")).alias(f"avg{i}") for i in range(len(means))])
    return out.select("cohort", F.col("n").alias("cnt"),
                      *[c for i, name in enumerate(counts)
                        for c in (F.col(f"k{i}").alias(f"cnt_{name}"), pct(F.col(f"k{i}"), F.col("n")).alias(f"pct_{name}"))],
                      *[F.col(f"avg{i}").alias(f"avg_{name}") for i, name in enumerate(means)])


def _pearson(whole: DataFrame, columns: list[str], pairs: list[tuple[int, int]], count: int) -> DataFrame:
    """(cohort, pair, n, coef): means and covariances by mask are merged as
    weighted covariances within plus covariances of the means."""
    both = pairs + [(i, i) for i in range(len(columns))]
    by_mask = whole.groupBy("mask").agg(
        F.count(F.lit(1)).alias("n"), *[f(f"x{i}").alias(f"{name}{i}") for i in range(len(columns))
                                        for name, f in (("a", F.avg), ("lo", F.min), ("hi", F.max))],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}_{j}") for i, j in both])
    rows = _bits(by_mask, count)
    cohort = Window.partitionBy("cohort")
    rows = rows.withColumns({f"m{i}": F.sum(F.col("n") * F.col(f"a{i}")).over(cohort) / F.sum("n").over(cohort) for i in range(len(columns))})
    sums = rows.groupBy("cohort").agg(
        F.sum("n").alias("n"), *[f(f"{name}{i}").alias(f"{name}{i}") for i in range(len(columns)) for name, f in (("lo", F.min), ("hi", F.max))],
        *[F.sum(F.col("n") * (F.col(f"v{i}_{j}") + (F.col(f"a{i}") - F.col(f"m{i}")) * (F.col(f"a{j}") - F.col(f"m{j}")))).alias(f"v{i}_{j}")
          for i, j in both])
    varied = {i: F.col(f"lo{i}") < F.col(f"hi{i}") for i in range(len(columns))}
    coef = [F.struct(F.lit(p).alias("pair"), F.when(varied[i] & varied[j], F.try_divide(
        F.col(f"v{i}_{j}"), F.sqrt(F.col(f"v{i}_{i}") * F.col(f"v{j}_{j}")))).alias("coef")) for p, (i, j) in enumerate(pairs)]
    return sums.select("cohort", "n", F.explode(F.array(*coef)).alias("e")).select("cohort", "n", "e.*")


def rank_vectors(values: DataFrame, count: int, part: int = PART) -> DataFrame:
    """(col, value, dev): for each cohort the average rank of a value among
    the cohort's rows, less the middle rank.  ``values``: col, value, mask, n."""
    lanes = range(count)
    lane = [F.sum(F.when(F.expr(f"shiftright(mask, {i}) & 1 = 1"), F.col("n")).otherwise(F.lit(0))).alias(f"n{i}") for i in lanes]
    vc = values.groupBy("col", "value").agg(*lane)
    cuts = cut_points(vc.select("col", F.col("value").alias("p")), ["col"], part).drop("parts")
    vb = vc.join(F.broadcast(cuts), "col", "left").withColumn("b", part_of("value", "cuts_p")).drop("cuts_p")
    whole = Window.partitionBy("col")
    before = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = vb.groupBy("col", "b").agg(*[F.sum(f"n{i}").alias(f"p{i}") for i in lanes]).select(
        "col", "b", *[F.coalesce(F.sum(f"p{i}").over(before), F.lit(0)).alias(f"o{i}") for i in lanes],
        *[F.sum(f"p{i}").over(whole).alias(f"t{i}") for i in lanes])
    inside = Window.partitionBy("col", "b").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = vb.select("col", "b", "value", *[F.col(f"n{i}") for i in lanes],
                       *[F.coalesce(F.sum(f"n{i}").over(inside), F.lit(0)).alias(f"i{i}") for i in lanes]).join(offsets, ["col", "b"])
    dev = F.array(*[F.col(f"o{i}") + F.col(f"i{i}") + (F.col(f"n{i}") - F.col(f"t{i}")) / 2.0 for i in lanes])
    return ranked.select("col", "value", dev.alias("dev"))


def _lanes(t, count: int) -> np.ndarray:
    """Weight of each cell in each cohort."""
    mask, n = (np.asarray(t[c]) for c in ("mask", "n"))
    return n[:, None].astype(np.float64) * ((mask[:, None] >> np.arange(count)) & 1)


def _spearman(cells: DataFrame, ranks: DataFrame, count: int) -> DataFrame:
    """(cohort, pair, n, coef) from the cells of each pair and the rank vectors."""
    for side in "xy":
        cells = cells.join(ranks.select(F.col("col").alias(f"c{side}"), F.col("value").alias(side), F.col("dev").alias(f"d{side}")), [f"c{side}", side])

    def sums(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            pair = batch["pair"].to_numpy(zero_copy_only=False)
            w = _lanes(batch, count)
            dx, dy = (batch[c].flatten().to_numpy(zero_copy_only=False).reshape(-1, count) for c in ("dx", "dy"))
            stacked = np.stack([w, w * dx * dy, w * dx * dx, w * dy * dy])
            for p in np.unique(pair):
                held[int(p)] = held.get(int(p), 0) + stacked[:, pair == p].sum(axis=1)
        rows = [(p, c, *s[:, c]) for p, s in held.items() for c in range(count)]
        yield pa.RecordBatch.from_pylist([dict(zip(("pair", "cohort", "n", "xy", "xx", "yy"), r)) for r in rows], schema=pa.schema(
            [("pair", pa.int32()), ("cohort", pa.int32()), *[(c, pa.float64()) for c in ("n", "xy", "xx", "yy")]]))

    parts = cells.select("pair", "mask", "n", "dx", "dy").mapInArrow(sums, "pair int, cohort int, n double, xy double, xx double, yy double")
    total = parts.groupBy("cohort", "pair").agg(*[F.sum(c).alias(c) for c in ("n", "xy", "xx", "yy")])
    known = (F.col("xx") > 0) & (F.col("yy") > 0)
    return total.select("cohort", "pair", F.col("n").cast("long").alias("n"),
                        F.when(known, F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("coef"))


def cohort_matrix(df: DataFrame, cohorts: Mapping[str, Column], counts: Mapping[str, Column], means: Mapping[str, Column],
                  columns: Mapping[str, Column], pairs: list[tuple[str, str]], methods: tuple[str, ...] = METHODS,
                  part: int = PART) -> DataFrame:
    """One row for each cohort: ``cnt``; ``cnt_<name>`` and ``pct_<name>`` (of
    the cohort's rows) for each condition in ``counts``; ``avg_<name>`` for
    each value in ``means``; ``<method>_<x>_vs_<y>`` and ``p_<method>_<x>_vs_<y>``
    for each of the ``methods`` and pair of ``columns``.

    Correlations use the rows that have all ``columns``; they are null with
    fewer than two rows or a constant column.  An empty cohort has counts of
    zero and nulls.
    """
    from riskspan.functions.distributions import corr_t_pvalue
    names = list(columns)
    places = [(names.index(x), names.index(y)) for x, y in pairs]
    value = {i: F.nanvl(c.cast("double") + 0.0, F.lit(None).cast("double")) for i, c in enumerate(columns.values())}
    base = df.select(cohort_mask(cohorts).alias("mask"), *[c.alias(f"k{i}") for i, c in enumerate(counts.values())],
                     *[c.cast("double").alias(f"m{i}") for i, c in enumerate(means.values())],
                     *[c.alias(f"x{i}") for i, c in value.items()]).where("mask <> 0")
    whole = base.select("mask", *[f"x{i}" for i in value]).dropna()
    count = len(cohorts)
    entry = F.explode(F.array(*[F.struct(F.lit(p).alias("pair"), F.lit(i).alias("cx"), F.lit(j).alias("cy"), F.col(f"x{i}").alias("x"),
                                         F.col(f"x{j}").alias("y")) for p, (i, j) in enumerate(places)])).alias("e")
    cells = whole.select("mask", entry).select("mask", "e.*").groupBy("pair", "cx", "cy", "x", "y", "mask").agg(F.count(F.lit(1)).alias("n"))
    # ranks, Spearman and Kendall read the cells several times: they are counted once
    cells = cut_lineage(cells)
    # a column's values, from the first pair that has it
    first = {c: next((p, side) for p, ij in enumerate(places) for side, k in zip("xy", ij) if k == c) for c in sorted({k for ij in places for k in ij})}
    taken = [F.struct(F.lit(c).alias("col"), F.col(side).alias("value")) for c, (p, side) in first.items()]
    wanted = [F.col("pair") == p for p, _ in first.values()]
    held = F.filter(F.array(*[F.when(w, t) for w, t in zip(wanted, taken)]), lambda v: v.isNotNull())
    values = cells.select("mask", "n", F.explode(held).alias("v")).select("v.*", "mask", "n") \
        .groupBy("col", "value", "mask").agg(F.sum("n").alias("n"))
    known = ["cohort", "pair", "n", "coef"]
    parts = {}
    if "pearson" in methods:
        r = _pearson(whole, names, places, count)
        parts["pearson"] = r.select(*known, corr_t_pvalue(F.col("coef"), F.col("n")).alias("p"))
    if "spearman" in methods:
        r = _spearman(cells, rank_vectors(values, count, part), count)
        parts["spearman"] = r.select(*known, corr_t_pvalue(F.col("coef"), F.col("n")).alias("p"))
    if "kendall" in methods:
        r = tau_b(dominance_sums(cells.select("pair", "x", "y", "mask", "n"), ["pair"], part, lambda t: _lanes(t, count)), ["pair", "lane"])
        parts["kendall"] = r.withColumnRenamed("lane", "cohort").select(*known, kendall_pvalue(r).alias("p"))
    long = reduce(DataFrame.unionByName, [r.withColumn("method", F.lit(m)) for m, r in parts.items()])
    wide = long.groupBy("cohort").agg(*[F.max(F.when((F.col("method") == m) & (F.col("pair") == p), F.col(c))).alias(f"{prefix}{m}_{x}_vs_{y}")
                                        for p, (x, y) in enumerate(pairs) for m in parts for c, prefix in (("coef", ""), ("p", "p_"))])
    facts = _facts(base, list(counts), list(means), count)
    labels = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cohorts])).alias("_i", "name"))
    out = labels.join(facts, F.col("_i") == facts["cohort"], "left").drop("cohort").join(wide, F.col("_i") == wide["cohort"], "left").drop("cohort")
    zero = ["cnt", *[f"cnt_{c}" for c in counts]]
    return out.withColumnRenamed("name", "cohort").drop("_i").fillna(0, zero)
