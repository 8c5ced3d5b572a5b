"""Joins with match-status columns and the exploit backbone.

Join strategy is left to Catalyst/AQE: with adaptive execution the planner
turns a sort-merge join into a broadcast join only when the measured shuffle
output of one side is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
-- a runtime size check, with sort-merge as the path beyond it.  No side is
force-broadcast here because every input grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspan.functions.clean import booleanize
from riskspan.functions.dates import earliest_date


def _flagged(df: DataFrame, flag: str) -> DataFrame:
    return df.withColumn(flag, F.lit(True))


# J1 -------------------------------------------------------------------------
def left_join_indicator(left: DataFrame, right: DataFrame, on: str | list[str],
                        indicator: str = "_merge") -> DataFrame:
    """Left equi-join plus a status column 'both' / 'left_only'.

    Null keys never match (standard SQL).
    """
    flag = f"__in_{indicator}"
    j = left.join(_flagged(right, flag), on=on, how="left")
    return (j.withColumn(indicator, F.when(F.col(flag), F.lit("both")).otherwise(F.lit("left_only")))
             .drop(flag))


# J2 -------------------------------------------------------------------------
def outer_join_origin(left: DataFrame, right: DataFrame, key: str,
                      suffixes=("_x", "_y"), labels=("left_only", "right_only", "both"),
                      indicator: str = "_merge") -> DataFrame:
    """Full outer equi-join; clashing columns get suffixes; status labelled
    with ``labels`` = (left-only, right-only, both)."""
    lf, rf = "__l_in", "__r_in"
    clash = (set(left.columns) & set(right.columns)) - {key}
    l2 = left.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in left.columns]).withColumn(lf, F.lit(True))
    r2 = right.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in right.columns]).withColumn(rf, F.lit(True))
    j = l2.join(r2, on=key, how="full")
    status = (F.when(F.col(lf) & F.col(rf), F.lit(labels[2]))
               .when(F.col(lf), F.lit(labels[0])).otherwise(F.lit(labels[1])))
    return j.withColumn(indicator, status).drop(lf, rf)


# J6 -------------------------------------------------------------------------
def resolve_origin(m1, m2) -> Column:
    """Origin from the two merge statuses (right-only rows of the second
    merge have no first status, so they are plain 'kev')."""
    m1 = F.col(m1) if isinstance(m1, str) else m1
    m2 = F.col(m2) if isinstance(m2, str) else m2
    return (F.when(m2 == "kev", F.lit("kev"))
             .when(m2 == "poc_xdb_kev", F.lit("poc_xdb_kev"))
             .otherwise(m1))


# A1 -------------------------------------------------------------------------
def exploit_rollup(df: DataFrame, key: str = "cve_id", count_col: str = "exploit_count",
                   date_col: str = "earliest_date") -> DataFrame:
    """Per key: summed counts, earliest date, and for every other column the
    value of the earliest row (total order: date, then the value itself),
    i.e. a deterministic "first non-null".  Null keys are dropped.

    A partial aggregate runs map-side before the shuffle, so a hot key costs
    one row per map task.
    """
    rest = [c for c in df.columns if c not in (key, count_col, date_col)]
    aggs = [F.sum(F.coalesce(F.col(count_col), F.lit(0))).alias(count_col),
            F.min(date_col).alias(date_col)]
    for c in rest:
        # rows whose value is null get a null ordering and are skipped
        order = F.when(F.col(c).isNotNull(),
                       F.struct(F.col(date_col).isNull(), F.col(date_col), F.col(c)))
        aggs.append(F.min_by(F.col(c), order).alias(c))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


# Q14 ------------------------------------------------------------------------
def exploit_backbone(poc: DataFrame, xdb: DataFrame, kev: DataFrame,
                     key: str = "cve_id") -> DataFrame:
    """Merge PoC and ExploitDB summaries, then the KEV list, with origins.

    Each source is first rolled up to one row per key (A1) so the outer joins
    are one-to-one; the roll-up leaves the data hash-partitioned by key, which
    the following joins reuse.
    """
    poc = exploit_rollup(poc, key)
    xdb = exploit_rollup(xdb, key)
    m1 = outer_join_origin(poc, xdb, key, suffixes=("_poc", "_xdb"),
                           labels=("poc", "xdb", "poc_xdb"), indicator="_merge1")
    m1 = (m1.withColumn("exploit_count", F.coalesce(F.col("exploit_count_poc"), F.lit(0))
                        + F.coalesce(F.col("exploit_count_xdb"), F.lit(0)))
            .withColumn("earliest_date", earliest_date("earliest_date_poc", "earliest_date_xdb")))
    m1 = m1.drop(*[c for c in m1.columns if c.endswith(("_poc", "_xdb"))])
    kev_cols = [c for c in kev.columns if c != key]
    m2 = outer_join_origin(m1, kev, key, suffixes=("_og", "_kev"),
                           labels=("poc_xdb", "kev", "poc_xdb_kev"), indicator="_merge2")
    date_k = "kev_date_published" if "kev_date_published" in m2.columns else None
    out = m2
    if date_k:
        out = out.withColumn("earliest_date", earliest_date("earliest_date", date_k))
    out = out.withColumn("exploit_count", F.when(F.col("_merge2") == "kev", F.lit(1))
                         .otherwise(F.col("exploit_count")))
    if "poc_code" in out.columns:
        out = out.withColumn("poc_code", booleanize("poc_code"))
    out = out.withColumn("origin", resolve_origin("_merge1", "_merge2"))
    drop = [c for c in out.columns if c.startswith("_")] + [c for c in kev_cols if c in out.columns]
    return out.drop(*drop)
