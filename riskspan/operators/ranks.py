"""Distributed value ranks (average rank for ties) without a global window.

A window with no ``partitionBy`` moves every row into one task.  Instead:

1. count rows per distinct value (map-side partial aggregation, so a hot
   value costs one row per map task);
2. groups of more than ``PART`` distinct values are cut into parts of about
   that many at points taken from a hash sample of their own values, so
   values crowded anywhere and far outliers alike spread evenly; smaller
   groups stay whole;
3. part totals -> offsets with a window over the parts of a group (at most
   ``MOST_PARTS``);
4. inside a part, a running sum over the distinct values of that part.

Result per (group, value): ``n`` rows, ``before`` rows with a smaller value,
``rank`` = before + (n + 1) / 2 (the average rank used by Spearman), and
``total`` rows in the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct points that a part holds, at most so many parts, and sampled
# points for each part: with 32 a part stays below twice its share.
PART = 50_000
MOST_PARTS = 512
SAMPLED = 32


def _sampled(points: DataFrame, sizes: DataFrame, g: list[str], names: list[str]) -> DataFrame:
    """The different points of the groups in ``sizes`` whose hash is below the
    group's ``_top``."""
    near = points.join(sizes.select(*g, "_top"), g).where(F.col("_top").isNull() | (F.xxhash64(*names) <= F.col("_top")))
    return near.select(*g, *names).distinct()


def _large_groups(points: DataFrame, g: list[str], part: int, names: list[str]) -> DataFrame:
    """(g, parts, _top): at most a row for every ``part`` points; ``_top``: the
    hash below which twice the sample's share of the points lies, null where
    that is more than half of them."""
    sizes = points.groupBy(*g).agg(F.count(F.lit(1)).alias("_m"), F.approx_count_distinct(F.xxhash64(*names)).alias("_d")).where(F.col("_m") > part)
    share = 2.0 * MOST_PARTS * SAMPLED / F.col("_d")
    return sizes.select(*g, F.least(F.lit(MOST_PARTS), F.ceil(F.col("_m") / part)).cast("int").alias("parts"),
                        F.when(share < 0.5, (share * 2.0 ** 64 - 2.0 ** 63).cast("long")).alias("_top"))


def cut_points(points: DataFrame, g: list[str], part: int = PART, names: list[str] = ("p",)) -> DataFrame:
    """(g, parts, cuts_<name>...): for every group with more than ``part`` rows the
    ascending points that cut it into parts of about ``part`` rows, for each
    of the (orderable, row-wise different) columns ``names``.

    The sample are the different points with the smallest hashes.  Points
    whose hash is beyond about twice the sample's share are left out where they
    are read, so no task gets more of a group than some samples' worth.
    """
    sizes = F.broadcast(_large_groups(points, g, part, names))
    turn = Window.partitionBy(*g).orderBy(F.xxhash64(*names), *names)
    sample = _sampled(points, sizes, g, names).withColumn("_nth", F.row_number().over(turn)).where(F.col("_nth") <= MOST_PARTS * SAMPLED)
    lists = sample.groupBy(*g).agg(*[F.sort_array(F.collect_list(c)).alias(f"_{c}") for c in names])

    def cuts(c):
        return F.expr(f"transform(sequence(1, parts - 1), i -> get(`_{c}`, cast(i * size(`_{c}`) / parts as int)))").alias(f"cuts_{c}")

    return lists.join(sizes, g).select(*g, "parts", *[cuts(c) for c in names])


def part_of(point: str, cuts: str) -> Column:
    """How many of the ascending ``cuts`` (an array column; null: none) are
    not above ``point``: a binary search."""
    step = (f"if(s.lo < s.hi, if(get({cuts}, cast((s.lo + s.hi) div 2 as int)) <= {point}, "
            "named_struct('lo', cast((s.lo + s.hi) div 2 + 1 as int), 'hi', s.hi), "
            "named_struct('lo', s.lo, 'hi', cast((s.lo + s.hi) div 2 as int))), s)")
    rounds = MOST_PARTS.bit_length()
    return F.expr(f"if({cuts} is null, 0, aggregate(sequence(1, {rounds}), named_struct('lo', 0, 'hi', size({cuts})), "
                  f"(s, i) -> {step}, s -> s.lo))")


def value_ranks(df: DataFrame, col: str, group_cols: list[str] | tuple = (), value_name: str = "value",
                weight: str | None = None, part: int | None = None) -> DataFrame:
    """Ranks of ``col`` per group; with ``weight`` each input row stands for
    that many rows (an already aggregated table of counts)."""
    g0 = list(group_cols)
    g = g0 if g0 else ["_g"]  # ungrouped input runs as one constant group
    src = df if g0 else df.withColumn("_g", F.lit(0))
    vc = (src.filter(F.col(col).isNotNull())
             .groupBy(*g, F.col(col).alias(value_name))
             .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n")))
    cuts = cut_points(vc.select(*g, F.col(value_name).alias("p")), g, part or PART).drop("parts")
    vb = vc.join(F.broadcast(cuts), g, "left").withColumn("_b", part_of(f"`{value_name}`", "cuts_p")).drop("cuts_p")
    bt = vb.groupBy(*g, "_b").agg(F.sum("n").alias("_bn"))
    whole = Window.partitionBy(*g)
    w_off = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumns({"_off": F.coalesce(F.sum("_bn").over(w_off), F.lit(0)),
                         "total": F.sum("_bn").over(whole)}).drop("_bn")
    w_in = Window.partitionBy(*g, "_b").orderBy(value_name).rowsBetween(Window.unboundedPreceding, -1)
    out = (vb.join(bt, on=g + ["_b"], how="inner")
             .withColumn("before", F.col("_off") + F.coalesce(F.sum("n").over(w_in), F.lit(0))))
    return out.select(*g0, value_name, "n", "before",
                      (F.col("before") + (F.col("n") + 1) / 2.0).alias("rank"), "total")


def row_positions(df: DataFrame, order_by: list[str], name: str = "position", part: int = PART) -> DataFrame:
    """``df`` with the 0-based place of every row in the order of ``order_by``
    (a key; rows with equal keys keep an arbitrary order among them) and
    ``<name>_total``, the number of rows."""
    key = F.struct(*[F.col(f"`{c}`") for c in order_by])
    base = df.withColumns({"_g": F.lit(0), "_key": key})
    cuts = cut_points(base.select("_g", F.col("_key").alias("p")), ["_g"], part).drop("parts")
    placed = base.join(F.broadcast(cuts), "_g", "left").withColumn("_b", part_of("_key", "cuts_p")).drop("cuts_p")
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), F.sum("_n").over(whole).alias(f"{name}_total"))
    inside = Window.partitionBy("_b").orderBy("_key")
    ranked = placed.withColumn("_nth", F.row_number().over(inside)).join(F.broadcast(offsets), "_b")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_nth") - 1).alias(name), f"{name}_total")
