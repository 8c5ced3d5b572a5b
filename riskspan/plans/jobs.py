"""Composite jobs: one lazy plan per job, DataFrame in -> DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspan.catalog import (COMPILED_COLUMNS, CVE_CATEGORY_MAP, CVE_FIRST_ITEM, CVE_SUBTABLES, CVE_TYPES, CVSS_COMPILE_MAP,
                              ICS_RENAMES, KEV_RENAMES, KEV_TYPES, NVD_TYPES, NVD_VERSION_LABELS, POC_TYPES)
from riskspan.functions import clean as C
from riskspan.functions import cvss as V
from riskspan.functions.dates import add_days, days_between, earliest_date
from riskspan.operators.joins import left_join_indicator
from riskspan.sources import files as FS
from riskspan.sources import nested as N

CVE_SUBTABLE_COLS = [c for cols in CVE_SUBTABLES.values() for c in cols]


def _is_array(df: DataFrame, c: str) -> bool:
    return c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType)


def _public_date(df: DataFrame, cols: list[str]):
    return earliest_date(*[F.col(c) if isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))
                           else C.to_timestamp_any(F.col(c).cast("string")) for c in cols])


# Q2 -------------------------------------------------------------------------
def _published(df: DataFrame, key_for_report: str | None = None) -> DataFrame:
    """Published records with single values where lists hold one item at most;
    the lists of the subtables stay, CWE descriptions are the English texts."""
    for s, v in (("cvss_v3_1", "cvss_v3_1_vector"), ("cvss_v4", "cvss_v4_vector")):
        if _is_array(df, s) and _is_array(df, v):
            df = df.withColumn("_top", V.max_pair(s, v)) \
                .withColumns({s: F.col("_top.score"), v: F.col("_top.vector")}).drop("_top")
    df = df.withColumns({c: C.first_item(c) for c in CVE_FIRST_ITEM if _is_array(df, c)})
    lists = [c for c in df.columns if _is_array(df, c) and c not in CVE_SUBTABLE_COLS
             and c not in ("is_kev", "solution", "cwe_desc")]
    if lists:
        df, _ = C.flatten_singletons(df, lists, key=key_for_report)
    df = df.filter(F.col("cve_state") == "PUBLISHED")
    if "cwe_desc" in df.columns:
        df = df.withColumn("cwe_desc", C.english_desc("cwe_desc"))
    return df


VECTOR_VERSIONS = {"cvss_v2_vector": "v2", "cvss_v3_vector": "v3", "cvss_v4_vector": "v4"}
CVE_METRICS = [c for version in VECTOR_VERSIONS.values() for c in V.metric_columns(version)]
# unified columns of scores and severities, and those of what the vectors say
CVE_SCORES = {t: cols for t, cols in CVSS_COMPILE_MAP.items() if not set(cols) & set(CVE_METRICS)}
CVE_VECTORS = {t: cols for t, cols in CVSS_COMPILE_MAP.items() if t not in CVE_SCORES}


def _cleaned(df: DataFrame) -> DataFrame:
    """One cleaned row per published record, without the subtables' lists.

    Equal rows are dropped before the vectors are decoded: metrics follow from
    the vectors, which are columns of the result (a vector that counts as null
    has no metrics), so rows are equal with them if they are without.  Thus the
    one exchange carries no metrics; they are decoded where the rows are.
    """
    if "cvss_v3_1" in df.columns:
        df = df.withColumn("cvss_v3", V.coalesce_priority("cvss_v3_1", "cvss_v3"))
    if "cvss_v3_1_vector" in df.columns:
        df = df.withColumn("cvss_v3_vector", V.coalesce_priority("cvss_v3_1_vector", "cvss_v3_vector"))
    before = df.columns
    df = V.add_severities(df, ["cvss_v2", "cvss_v3", "cvss_v4"])
    if _is_array(df, "solution"):
        df = df.withColumn("solution", C.concat_list("solution", " "))
    df = df.withColumn("cve_id", C.validate_id("cve_id"))
    df = C.standardize_categories(df, CVE_CATEGORY_MAP)
    df = V.compile_versions(df, CVE_SCORES)
    df = df.withColumn("kev", C.array_flag("is_kev") if _is_array(df, "is_kev") else F.lit(False))
    pub = [c for c in ("mitre_cve_publish_date", "mitre_cve_public_date") if c in df.columns]
    df = df.withColumn("public_date", _public_date(df, pub))
    drop = ["cve_state", "cwe_desc", "mitre_cve_publish_date", "mitre_cve_public_date",
            "cvss_v3_1", "cvss_v3_1_vector", "is_kev"] + CVE_SUBTABLE_COLS
    df = C.standardize_nulls(df.drop(*[c for c in drop if c in df.columns])).dropDuplicates()
    for vec, ver in VECTOR_VERSIONS.items():
        df = V.cvss_metrics(df, vec, ver, distinct_first=False)
    df = C.standardize_nulls(V.compile_versions(df, CVE_VECTORS))
    made = CVE_METRICS + [c for t in CVSS_COMPILE_MAP for c in (t, f"{t}_src")] + ["kev", "public_date"]
    df = df.select(*[c for c in dict.fromkeys(before + made) if c in df.columns])
    return C.convert_types(df, CVE_TYPES)


def cve_clean(df: DataFrame, key_for_report: str | None = None) -> DataFrame:
    """CVE records (extracted fields) -> one cleaned row per published CVE.

    Works on list-wrapped extractions and on already-flat rows: list steps
    run only for list columns.  Metric columns always exist (fixed schema).
    """
    return _cleaned(_published(df, key_for_report))


def cve_tables(df: DataFrame, key_for_report: str | None = None) -> dict[str, DataFrame]:
    """The cleaned table ``cve`` and its subtables (F13): one row per
    published record with its lists, under the same validated id."""
    records = _published(df, key_for_report)
    tables = {"cve": _cleaned(records)}
    for name, cols in CVE_SUBTABLES.items():
        present = [c for c in cols if c in records.columns]
        tables[name] = records.select(C.validate_id("cve_id").alias("cve_id"), *present)
    return tables


def cve_record_tables(documents: DataFrame, folder: str, json_col: str = "doc") -> dict[str, DataFrame]:
    """Documents -> the tables of ``cve_tables``, saved under ``folder``.

    Every document is parsed once: the extracted fields are a table of their
    own, from which the others are made.  A subtable's id that the parent
    table lacks is an error.
    """
    extracted = FS.save_tables({"extracted": N.extract_cve_fields(documents, json_col)}, folder)["extracted"]
    return FS.save_tables(cve_tables(extracted), folder, parent="cve", key="cve_id")


def cve_scores(df: DataFrame) -> DataFrame:
    """What the compile job needs of the CVE records, by the rules of
    ``cve_clean``: cve_id, public_date, cvss, cvss_src of published records,
    distinct.  Vectors are neither decoded nor shuffled."""
    def single(c: str):
        return C.first_item(c) if _is_array(df, c) else F.col(c)

    def score(c: str):
        return V.max_pair(c, f"{c}_vector")["score"] if _is_array(df, c) and c in ("cvss_v3_1", "cvss_v4") else single(c)

    scores = [c for c in ("cvss_v2", "cvss_v3", "cvss_v3_1", "cvss_v4") if c in df.columns]
    dates = [c for c in ("mitre_cve_publish_date", "mitre_cve_public_date") if c in df.columns]
    out = df.where(single("cve_state") == "PUBLISHED").select(
        C.validate_id(single("cve_id")).alias("cve_id"), *[score(c).alias(c) for c in scores],
        *[single(c).alias(c) for c in dates])
    if "cvss_v3_1" in scores:
        out = out.withColumn("cvss_v3", V.coalesce_priority("cvss_v3_1", "cvss_v3")).drop("cvss_v3_1")
    out = V.compile_versions(out, {"cvss": CVSS_COMPILE_MAP["cvss"]})
    return out.select("cve_id", _public_date(out, dates).alias("public_date"), F.col("cvss").cast("double").alias("cvss"),
                      "cvss_src").distinct()


# Q12 ------------------------------------------------------------------------
def nvd_clean(df: DataFrame) -> DataFrame:
    df = (df.withColumn("cvss_version", C.replace_values("cvss_version", NVD_VERSION_LABELS))
            .withColumnRenamed("cvss_version", "cvss_src")
            .withColumn("cve_id", C.validate_id("cve_id")))
    df = C.standardize_nulls(C.trim_strings(df)).dropDuplicates()
    return C.convert_types(df, NVD_TYPES)


# Q10 ------------------------------------------------------------------------
def kev_clean(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed({k: v for k, v in KEV_RENAMES.items() if k in df.columns})
    df = C.convert_types(df, KEV_TYPES)
    if "cwe_id" in df.columns:
        df = df.withColumn("cwe_id", C.split_to_array(C.strip(F.col("cwe_id").cast("string"))))
    return C.standardize_nulls(df)


# Q9 -------------------------------------------------------------------------
def poc_clean(df: DataFrame) -> DataFrame:
    """Validate IDs (topics list as backup), keep valid rows, drop listing
    detail columns, dedupe, trim, types."""
    backup = "poc_topics" if "poc_topics" in df.columns else None
    df = df.withColumn("cve_id", C.validate_id("cve_id", backup)).filter(F.col("cve_id").isNotNull())
    df = C.standardize_nulls(df)
    df = df.drop(*[c for c in ("poc_creation", "poc_uploaded", "poc_forks", "poc_topics",
                               "poc_visibility") if c in df.columns])
    df = C.trim_strings(df.dropDuplicates())
    return C.convert_types(df, POC_TYPES)


# Q16 ------------------------------------------------------------------------
def compiled_dataset(exploits: DataFrame, cves: DataFrame, epss: DataFrame,
                     nvd: DataFrame) -> DataFrame:
    """Backbone LEFT JOIN CVE LEFT JOIN scores LEFT JOIN NVD -> 25 ordered
    columns with floored days-to-exploit, coalesced scores and severities.

    Only the columns the output needs are taken from each side, so Parquet
    scans prune the rest; all three joins are on ``cve_id`` and AQE picks
    broadcast or sort-merge per join from measured sizes.
    """
    cves = cves.select("cve_id", "public_date", F.col("cvss").alias("cvss_x"),
                       F.col("cvss_src").alias("cvss_src_x"))
    epss_cols = [c for c in epss.columns if c.startswith(("epss_", "percentile_", "change_"))
                 and not c.startswith("epss_date")]
    epss = epss.select("cve_id", *epss_cols)
    nvd = nvd.select("cve_id", F.col("cvss").alias("cvss_y"), F.col("cvss_src").alias("cvss_src_y"),
                     "date_published")
    df = left_join_indicator(exploits, cves, "cve_id", "_merge")
    df = left_join_indicator(df, epss, "cve_id", "epss_merge")
    df = left_join_indicator(df, nvd, "cve_id", "nvd_merge")
    df = df.withColumn("date_public", earliest_date("public_date", "date_published"))
    df = df.withColumnsRenamed({"earliest_date": "exploitation_date_0", "change_total": "change_0_to_60"})
    df = C.trim_strings(df)
    df = df.withColumns({
        "days_to_poc_exploit": days_between("date_public", "exploitation_date_0").cast("double"),
        "cvss": V.coalesce_priority("cvss_x", "cvss_y"),
        "cvss_src": V.coalesce_priority("cvss_src_x", "cvss_src_y"),
    })
    df = df.withColumns({
        "cvss_severity": V.severity("cvss"),
        "exploitation_date_30": add_days("exploitation_date_0", 30),
        "exploitation_date_60": add_days("exploitation_date_0", 60),
    })
    for c in COMPILED_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None))
    return df.select(*COMPILED_COLUMNS)


# Q13 ------------------------------------------------------------------------
def ics_clean(df: DataFrame) -> DataFrame:
    df = C.drop_by_pattern(df, prefixes=("cvss_",), suffixes=("Impact", "Priv", "Required", "updated"),
                           names=("accessVector", "complexity"))
    df = df.withColumn("cve_id", C.validate_id("cve_id")).withColumnsRenamed(
        {k: v for k, v in ICS_RENAMES.items() if k in df.columns})
    df = C.standardize_nulls(C.trim_strings(df.dropDuplicates()))
    types = {"string": [c for c in df.columns if c not in ("advisory_date", "product_type")],
             "date": ["advisory_date"], "category": ["product_type"]}
    return C.convert_types(df, types)
