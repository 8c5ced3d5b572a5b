"""Line dedup over sequences of line ids.

A line's id is a 128-bit fingerprint of its text.  Prefix doubling names the
runs that start at each line: the name of 2k lines is made from the names of
the k lines here and the k lines further on (the last step overlaps, so that
``min_lines`` need not be a power of two).  Sorting suffixes by these names
puts runs with a common prefix of at least ``min_lines`` lines side by side:
each class of equal names is a longest-common-prefix interval.  The earliest
start of a class, by (order column, place), keeps its lines; every other start
is a later copy, and the lines it covers are deleted.  Overlapping starts
join to the maximal repeated runs.  Where ``lone_bytes`` is given, a line of at
least so many bytes is a run of its own as well: its later copies go whatever
lines stand around them.  The first occurrence of every different line always
stays.

Only names travel between tasks: starts are pre-aggregated by name before the
shuffle, and the join back is one that Spark splits where a name is frequent.

Defined cases: a null text has no lines and stays null, an empty one has one
empty line; rows alike in order column and text are one document here (none
is later than the other); null order values come first; extra columns are
passed on; an input column named like a result column is replaced; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.llm.common import carried, uncarried, with_text


def _names(lines: str, count: int) -> tuple[str, str]:
    """SQL for the two halves of the names of runs of ``count`` lines."""
    def level(seed: int) -> str:
        sql, have = f"transform({lines}, x -> xxhash64({seed}, x))", 1
        while have < count:
            step = min(have, count - have)
            sql = (f"transform(array({sql}), v -> transform(sequence(0, greatest(size(v) - {step + 1}, 0)), "
                   f"i -> xxhash64({seed}, v[i], get(v, i + {step}))))[0]")
            have += step
        return sql
    return level(1), level(2)


def _later_starts(base: DataFrame, min_lines: int, lone_bytes: int | None) -> DataFrame:
    """(key1, key2, starts): twice the places in each document where a later
    copy of a run of ``min_lines`` lines begins, one more for a lone line."""
    first, second = _names("lines", min_lines)
    names = (f"if(size(lines) >= {min_lines}, transform(arrays_zip({first}, {second}), "
             "(x, i) -> struct(2 * i as start, x.`0` as a, x.`1` as b)), array())")
    if lone_bytes is not None:
        # seeds of their own: a lone line is never equal to a run
        lone = (f"filter(transform(lines, (x, i) -> if(octet_length(x) >= {lone_bytes}, "
                "struct(2 * i + 1 as start, xxhash64(5, x) as a, xxhash64(6, x) as b), null)), x -> x is not null)")
        names = f"concat({names}, {lone})"
    runs = base.where("lines is not null").select("key1", "key2", "place", F.explode(F.expr(names)).alias("name")) \
        .select("key1", "key2", "place", "name.start", "name.a", "name.b")
    head = F.min(F.struct("place", "key1", "key2", "start"))
    classes = runs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), head.alias("head")).where("n > 1") \
        .select("a", "b", "head")
    return runs.join(classes, ["a", "b"]) \
        .where(F.struct("place", "key1", "key2", "start") > F.col("head")) \
        .groupBy("key1", "key2").agg(F.collect_set("start").alias("starts"))


def _deduped(docs: DataFrame, min_lines: int, order: str, text: str, lone_bytes: int | None) -> DataFrame:
    """row, text, kept, n_lines, n_removed."""
    base = carried(docs, text).withColumn("place", F.col("row").getField(order))
    base = base.withColumn("key1", F.xxhash64("place", "text")) \
        .withColumn("key2", F.xxhash64(F.lit(3), "text", "place")) \
        .withColumn("lines", F.split("text", "\n", -1))
    starts = _later_starts(base, min_lines, lone_bytes)
    covered = F.expr(f"array_distinct(flatten(transform(starts, s -> "
                     f"sequence(cast(s div 2 as int), cast(s div 2 as int) + if(s % 2 = 1, 0, {min_lines - 1})))))")
    kept = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), covered), i -> lines[i]), '\n')")
    return base.drop("lines").join(starts, ["key1", "key2"], "left") \
        .withColumn("lines", F.split("text", "\n", -1)).withColumn("covered", covered) \
        .select("row", "text", F.when(F.col("covered").isNull(), F.col("text")).otherwise(kept).alias("kept"),
                F.greatest(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                F.greatest(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"))


def remove_repeated_lines(docs: DataFrame, min_lines: int = 2, order: str = "doc_id", text: str = "text",
                          lone_bytes: int | None = None) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_removed``."""
    out = _deduped(docs, min_lines, order, text, lone_bytes)
    return uncarried(out, docs, text, kept_text=F.col("kept"), n_lines=F.col("n_lines"), n_removed=F.col("n_removed"))


def line_stage(docs: DataFrame, min_lines: int = 2, order: str = "doc_id", text: str = "text",
               lone_bytes: int | None = None) -> DataFrame:
    """``docs`` without later copies of line runs; documents that lose every
    line go."""
    out = _deduped(docs, min_lines, order, text, lone_bytes)
    out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return with_text(docs, out, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")), text)
