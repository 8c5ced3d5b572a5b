"""Exploit listings -> one summary row per CVE (S15) and the sample job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def earliest_exploit(rows: DataFrame, cves: DataFrame | None = None,
                     key: str = "cve_id", date_col: str = "date_published") -> DataFrame:
    """Count, earliest date and the earliest exploit's attributes per CVE.

    ``rows``: key, date_published, exploit_type, platform, port, verified
    (0/1/other).  Ties on the date are broken by the attribute values, so the
    pick is deterministic.  With ``cves`` given, every listed CVE appears and
    CVEs without exploits get count 0 and ``poc_code = 'NO'``.
    """
    first = F.struct(
        F.upper("exploit_type").alias("t"), F.upper("platform").alias("p"),
        F.col("port").cast("string").alias("port"),
        F.when(F.col("verified") == 0, F.lit(False)).when(F.col("verified") == 1, F.lit(True)).alias("v"))
    order = F.struct(F.col(date_col), F.col("exploit_type"), F.col("platform"),
                     F.col("port"), F.col("verified"))
    agg = (rows.filter(F.col(key).isNotNull())
               .groupBy(key)
               .agg(F.count(F.lit(1)).alias("exploit_count"),
                    F.min(date_col).alias("earliest_date"),
                    F.min_by(first, order).alias("_f"))
               .select(key, "earliest_date", "exploit_count", F.lit("YES").alias("poc_code"),
                       F.col("_f.t").alias("first_poc_type"), F.col("_f.p").alias("first_poc_platform"),
                       F.col("_f.port").alias("first_poc_port"), F.col("_f.v").alias("verified")))
    if cves is None:
        return agg
    out = cves.select(key).distinct().join(agg, on=key, how="left")
    return out.withColumns({"exploit_count": F.coalesce("exploit_count", F.lit(0)),
                            "poc_code": F.coalesce("poc_code", F.lit("NO"))})
