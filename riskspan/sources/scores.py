"""Point-in-time score lookups (S13/S14) and the score cleaning job (Q7).

The reference asked a web service for one score per (CVE, day).  Here the
score history is a table and the lookups become one equi-join on
``(cve_id, day)``: the wanted keys are exploded to one row per offset, joined,
and folded back with conditional aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.catalog import SCORE_ERA_START, SCORE_OFFSETS
from riskspan.functions.clean import (convert_types, standardize_nulls,
                                      trim_strings, validate_id)
from riskspan.functions.dates import percent_change


# P8 -------------------------------------------------------------------------
def filter_score_era(df: DataFrame, date_col: str = "earliest_date",
                     start: str = SCORE_ERA_START) -> DataFrame:
    """Rows with a date on or after the first day scores exist.

    A literal comparison, so Parquet scans receive it as a pushed filter.
    """
    return df.filter(F.col(date_col).isNotNull() & (F.col(date_col).cast("timestamp_ntz") >= F.lit(start).cast("timestamp_ntz")))


def _wanted(wanted: DataFrame, key: str, date_col: str, offsets: list[int]) -> DataFrame:
    return (wanted.select(F.col(key), F.col(date_col).cast("timestamp_ntz").alias("epss_date"))
                  .withColumn("offset", F.explode(F.array(*[F.lit(k) for k in offsets])))
                  .withColumn("query_date", F.col("epss_date") + F.make_dt_interval(F.col("offset")))
                  .withColumn("score_date", F.to_date("query_date")))


# S13 / J4 -------------------------------------------------------------------
def score_at_offsets(wanted: DataFrame, history: DataFrame, key: str = "cve_id",
                     date_col: str = "earliest_date", offsets: list[int] = SCORE_OFFSETS,
                     score_cols=("epss", "percentile"),
                     history_date: str = "score_date") -> DataFrame:
    """One row per wanted key: ``epss_date`` plus ``epss_date_k``, ``epss_k``,
    ``percentile_k`` for every offset k (null when the day has no score)."""
    w = _wanted(wanted, key, date_col, offsets)
    h = history.select(F.col(key), F.col(history_date).cast("date").alias("score_date"),
                       *[F.col(c) for c in score_cols])
    j = w.join(h, on=[key, "score_date"], how="left")
    aggs = []
    for k in offsets:
        hit = F.col("offset") == k
        aggs.append(F.max(F.when(hit, F.col("query_date"))).alias(f"epss_date_{k}"))
        for c in score_cols:
            aggs.append(F.max(F.when(hit, F.col(c))).alias(f"{c}_{k}"))
    return j.groupBy(key, "epss_date").agg(*aggs)


# S14 / J5 -------------------------------------------------------------------
def score_missing(wanted: DataFrame, history: DataFrame, key: str = "cve_id",
                  date_col: str = "earliest_date", offsets: list[int] = SCORE_OFFSETS,
                  history_date: str = "score_date") -> DataFrame:
    """(key, day, reason) for every wanted lookup with no history row."""
    w = _wanted(wanted, key, date_col, offsets)
    h = history.select(F.col(key), F.col(history_date).cast("date").alias("score_date"))
    miss = w.join(h, on=[key, "score_date"], how="left_anti")
    return miss.select(F.col(key), F.date_format("score_date", "yyyy-MM-dd").alias("date"),
                       F.lit("No records available.").alias("reason"))


# Q7 -------------------------------------------------------------------------
EPSS_TYPES = {
    "string": ["cve_id"],
    "date": ["epss_date_0", "epss_date_30", "epss_date_60"],
    "float": ["epss_0", "epss_30", "epss_60", "percentile_0", "percentile_30",
              "percentile_60", "change_0_to_30", "change_30_to_60", "change_total"],
}


def epss_clean(df: DataFrame) -> DataFrame:
    """Trim, validate IDs, numbers from text, change rates 0->30, 30->60,
    0->60 (``change_total``), nulls, duplicates, types; drops ``epss_date``."""
    df = trim_strings(df).withColumn("cve_id", validate_id("cve_id"))
    num = [c for c in df.columns if c.startswith(("epss_", "percentile_")) and not c.startswith("epss_date")]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in num})
    offs = sorted(int(c.split("_")[1]) for c in num if c.startswith("epss_"))
    if len(offs) >= 3:
        a, b, c = offs[:3]
        df = df.withColumns({
            f"change_{a}_to_{b}": percent_change(f"epss_{a}", f"epss_{b}"),
            f"change_{b}_to_{c}": percent_change(f"epss_{b}", f"epss_{c}"),
            "change_total": percent_change(f"epss_{a}", f"epss_{c}"),
        })
    df = standardize_nulls(df).dropDuplicates()
    types = dict(EPSS_TYPES)
    types["date"] = [f"epss_date_{k}" for k in offs]
    types["float"] = [c for c in df.columns if c.startswith(("epss_", "percentile_", "change_"))
                      and not c.startswith("epss_date")]
    return convert_types(df, types).drop("epss_date")
