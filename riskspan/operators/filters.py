"""Row filters: keyword match (P9), deterministic samples (P13), rule
checks (P14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspan.catalog import CASE_INSENSITIVE_KEYWORDS, CASE_SENSITIVE_KEYWORDS

# A word boundary written with explicit classes (letters, digits, '_'), the
# same on the JVM and in RE2, instead of engine-dependent \b.
_NOT_WORD = "[^\\pL\\pN_]"


def keyword_pattern(keywords: list[str], ignore_case: bool) -> str:
    """One alternation, list order kept (at the same position the earlier
    keyword wins), keywords quoted literally."""
    alts = "|".join(f"\\Q{k}\\E" for k in keywords)
    return ("(?i)" if ignore_case else "") + f"(^|{_NOT_WORD})({alts})({_NOT_WORD}|$)"


def matched_keyword(text, sensitive=CASE_SENSITIVE_KEYWORDS,
                    insensitive=CASE_INSENSITIVE_KEYWORDS) -> Column:
    """First whole-word case-sensitive hit, else first case-insensitive hit
    (leftmost position first); non-matching or null text -> null."""
    t = F.col(text) if isinstance(text, str) else text
    cs = F.nullif(F.regexp_extract(t, keyword_pattern(sensitive, False), 2), F.lit(""))
    ci = F.nullif(F.regexp_extract(t, keyword_pattern(insensitive, True), 2), F.lit(""))
    return F.coalesce(cs, ci)


def keyword_filter(df: DataFrame, field: str, sensitive=CASE_SENSITIVE_KEYWORDS,
                   insensitive=CASE_INSENSITIVE_KEYWORDS) -> DataFrame:
    """Rows whose ``field`` has a keyword hit, with ``matched_keyword``.

    A plain ``filter(matched.isNotNull())`` is pushed below the projection
    and the regex scan runs twice per text; emitting the 0-or-1 hit through
    ``explode`` keeps it to one evaluation.  The regex is CPU-bound: a caller
    whose input has fewer partitions than cores deals it out first.
    """
    if field not in df.columns:
        raise ValueError(f'Column "{field}" not found in DataFrame.')
    hit = F.array_compact(F.array(matched_keyword(field, sensitive, insensitive)))
    return df.select("*", F.explode(hit).alias("matched_keyword"))


# P13 -------------------------------------------------------------------------
# Parts of the hash range whose rows are counted, and the rows of a group that
# is worth it.
HASH_PARTS = 4096
LARGE_GROUP = 10_000


def _seeded(key: str, seed: int) -> Column:
    """First 32 bits of the MD5 of the key's text and the seed, a hash that
    other engines have too."""
    text = F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 1945) -> DataFrame:
    """Deterministic fraction sample: keeps a row when the seeded 32-bit hash
    of its key falls in the lowest ``fraction`` of the hash range.  The same
    key always gets the same decision, on any cluster and after retries."""
    return df.filter(_seeded(key, seed) < fraction * (1 << 32))


def hash_sample_n(df: DataFrame, key: str, n: int, seed: int = 1945, group_cols: list[str] | tuple = ()) -> DataFrame:
    """Fixed-size sample: the n rows with the smallest seeded hash, of every
    group where ``group_cols`` are given.  Rows of one key are told apart by
    their whole content, so the cut is the same in every run.

    Of a large group only rows whose hash is in the lowest of ``HASH_PARTS``
    parts of the hash range, as many parts as hold n rows, are shuffled and
    ordered: a first pass counts the rows of each part."""
    order = [_seeded(key, seed), F.col(key), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    if not group_cols:
        return df.orderBy(*order).limit(n)
    nth = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order))
    return _low_hashes(df, key, n, seed, group_cols).withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def _low_hashes(df: DataFrame, key: str, n: int, seed: int, group_cols: list[str] | tuple) -> DataFrame:
    """``df`` without rows that cannot be among the n of their group with the
    smallest seeded hash."""
    group = Window.partitionBy(*group_cols)
    rows = df.withColumn("_part", F.coalesce(F.floor(_seeded(key, seed) / ((1 << 32) // HASH_PARTS)), F.lit(-1)))
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = rows.groupBy(*group_cols, "_part").agg(F.count(F.lit(1)).alias("_n")) \
        .select("*", before.alias("_before"), F.sum("_n").over(group).alias("_all"))
    # at most a row for every LARGE_GROUP rows
    large = counted.where((F.col("_all") > max(n, LARGE_GROUP)) & (F.col("_before") < n)).groupBy(*group_cols).agg(F.max("_part").alias("_last")) \
        .select(*[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(group_cols)], "_last")
    same = [rows[f"`{c}`"].eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group_cols)]
    near = rows.join(F.broadcast(large), same, "left").where(F.col("_last").isNull() | (F.col("_part") <= F.col("_last")))
    return near.select(*[F.col(f"`{c}`") for c in df.columns])


# P14 -------------------------------------------------------------------------
def rule_violations(df: DataFrame, rules: dict) -> DataFrame:
    """One aggregate pass: per named rule, the rows that break it."""
    wide = df.agg(*[F.count_if(cond).alias(f"_r{i}") for i, cond in enumerate(rules.values())])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations"))
                               for i, name in enumerate(rules)]))
    return wide.select(rows.alias("r")).select("r.*")
