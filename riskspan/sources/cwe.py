"""CWE catalogue: XML scan (S10/S11) and cleaning jobs (Q4/Q5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspan.catalog import CWE_PLATFORM_SOURCE, CWE_SUBTABLE_TYPES
from riskspan.functions import clean as C

_ATTRS = "struct<_Name:string,_Class:string,_Prevalence:string>"

# Explicit schema: inference would turn repeated children into scalars or
# arrays depending on the data and read IDs as numbers.
WEAKNESS_SCHEMA = (
    "_ID string, _Name string, Description string, Extended_Description string, "
    "Related_Weaknesses struct<Related_Weakness: array<struct<_CWE_ID:string,_Nature:string>>>, "
    "Background_Details array<struct<Background_Detail: array<string>>>, "
    "Modes_Of_Introduction struct<Introduction: array<struct<Phase: array<string>>>>, "
    "Likelihood_Of_Exploit string, "
    "Common_Consequences struct<Consequence: array<struct<Scope: array<string>, Impact: array<string>, Note: array<string>>>>, "
    "Detection_Methods struct<Detection_Method: array<struct<Method: array<string>, Description: array<string>, "
    "Effectiveness: array<string>, Effectiveness_Notes: array<string>>>>, "
    "Potential_Mitigations struct<Mitigation: array<struct<Phase: array<string>, Description: array<string>, "
    "Effectiveness: array<string>, Effectiveness_Notes: array<string>>>>, "
    f"Applicable_Platforms struct<Language: array<{_ATTRS}>, Architecture: array<{_ATTRS}>, "
    f"Operating_System: array<{_ATTRS}>, Technology: array<{_ATTRS}>>"
)


def lead_text(c) -> Column:
    """Text before the first child tag, trimmed; missing -> ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(F.regexp_extract(c, "^[^<]*", 0)), F.lit(""))


def read_weaknesses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "Weakness").schema(WEAKNESS_SCHEMA).load(path)


def _firsts(arr: Column, field: str) -> Column:
    """First ``field`` child of every element, as lead text."""
    return F.transform(F.coalesce(arr, F.array()), lambda e: lead_text(F.get(e[field], 0)))


def extract_weaknesses(w: DataFrame, *more: Column) -> DataFrame:
    """5 scalar + 15 list fields per weakness (and ``more`` columns)."""
    cons = F.col("Common_Consequences.Consequence")
    det = F.col("Detection_Methods.Detection_Method")
    mit = F.col("Potential_Mitigations.Mitigation")
    rel = F.coalesce(F.col("Related_Weaknesses.Related_Weakness"), F.array())
    return w.select(
        F.coalesce(F.trim("_ID"), F.lit("")).alias("cwe_id"),
        F.coalesce(F.trim("_Name"), F.lit("")).alias("cwe_name"),
        lead_text("Description").alias("cwe_desc"),
        lead_text("Extended_Description").alias("cwe_desc_extended"),
        F.transform(rel, lambda r: F.coalesce(r["_CWE_ID"], F.lit(""))).alias("cwe_related_id"),
        F.transform(rel, lambda r: F.coalesce(r["_Nature"], F.lit(""))).alias("cwe_nature_of_rel"),
        F.transform(F.coalesce("Background_Details", F.array()),
                    lambda b: lead_text(F.get(b["Background_Detail"], 0))).alias("cwe_bg_details"),
        _firsts(F.col("Modes_Of_Introduction.Introduction"), "Phase").alias("cwe_introduction"),
        lead_text("Likelihood_Of_Exploit").alias("cwe_exploit_likelihood"),
        _firsts(cons, "Scope").alias("cwe_consequence_scope"),
        _firsts(cons, "Impact").alias("cwe_consequence_impact"),
        _firsts(cons, "Note").alias("cwe_consequence_note"),
        _firsts(det, "Method").alias("cwe_detect_method"),
        _firsts(det, "Description").alias("cwe_detect_desc"),
        _firsts(det, "Effectiveness").alias("cwe_detect_effectiveness"),
        _firsts(det, "Effectiveness_Notes").alias("cwe_detect_effect_notes"),
        _firsts(mit, "Phase").alias("cwe_miti_phase"),
        _firsts(mit, "Description").alias("cwe_miti_desc"),
        _firsts(mit, "Effectiveness").alias("cwe_miti_effect"),
        _firsts(mit, "Effectiveness_Notes").alias("cwe_miti_effect_notes"), *more,
    )


def _platforms(w: DataFrame) -> Column:
    from riskspan.sources.nested import PLATFORM_TYPES
    return F.concat(*[F.transform(F.coalesce(w[f"Applicable_Platforms.{t}"], F.array().cast(f"array<{_ATTRS}>")), _tagger(t))
                      for t in PLATFORM_TYPES])


def extract_platforms(w: DataFrame) -> DataFrame:
    """One row per platform element (cwe_id, type, name, class,
    prevalence)."""
    return w.select(F.trim("_ID").alias("cwe_id"), F.explode(_platforms(w)).alias("p")).select("cwe_id", "p.*")


def _tagger(t: str):
    def f(e):
        return F.struct(F.lit(t).alias("type"), e["_Name"].alias("name"), e["_Class"].alias("class"),
                        e["_Prevalence"].alias("prevalence"))
    return f


# Q4 ---------------------------------------------------------------------------
SUBTABLES = {
    "related cwe table": ["cwe_related_id", "cwe_nature_of_rel"],
    "cwe consequence table": ["cwe_consequence_scope", "cwe_consequence_impact", "cwe_consequence_note"],
    "cwe detection table": ["cwe_detect_method", "cwe_detect_desc", "cwe_detect_effectiveness",
                            "cwe_detect_effect_notes"],
    "cwe mitigation table": ["cwe_miti_phase", "cwe_miti_desc", "cwe_miti_effect", "cwe_miti_effect_notes"],
}


def cwe_subtables(df: DataFrame) -> dict:
    """The four exploded subtables keyed by name (ids already prefixed)."""
    df = df.withColumn("cwe_id", C.prefix_id("cwe_id"))
    return {name: C.subtable_explode(df, "cwe_id", cols, name) for name, cols in SUBTABLES.items()}


def cwe_clean(df: DataFrame) -> DataFrame:
    """Main CWE table: prefixed IDs, combined description (description,
    extended description and joined background details), singleton lists
    flattened, duplicates dropped, trimmed, nulls standardized."""
    df = C.convert_types(df, {"string": ["cwe_id", "cwe_name", "cwe_exploit_likelihood"]})
    df = df.withColumn("cwe_id", F.when(F.col("cwe_id").isNotNull(), C.prefix_id("cwe_id")))
    df = df.withColumn("cwe_bg_details", F.nullif(C.concat_list("cwe_bg_details", " "), F.lit("")))
    df = df.withColumn("cwe_desc_combined", C.combine_text("cwe_desc", "cwe_desc_extended", "cwe_bg_details"))
    drop = [c for cols in SUBTABLES.values() for c in cols] + ["cwe_desc", "cwe_desc_extended", "cwe_bg_details"]
    df = df.drop(*drop)
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    df, _ = C.flatten_singletons(df, lists, key="cwe_id")
    df = C.trim_strings(df.dropDuplicates())
    return C.standardize_nulls(df)


# Q5 ---------------------------------------------------------------------------
def subtable_clean(df: DataFrame, types: dict) -> DataFrame:
    """Shared cleaner of the subtables: types (names absent from the frame
    are ignored), nulls, duplicates, trimming."""
    df = C.convert_types(df, types)
    df = C.standardize_nulls(df).dropDuplicates()
    return C.trim_strings(df)


def platform_clean(platforms: DataFrame) -> DataFrame:
    """Platform rows with prefixed ids and their label, cleaned as subtables are."""
    df = platforms.withColumns({"cwe_id": C.prefix_id("cwe_id"), "source_table": F.lit(CWE_PLATFORM_SOURCE)})
    return subtable_clean(df, CWE_SUBTABLE_TYPES["cwe platform table"])


# Q3 + Q4 + Q5 -----------------------------------------------------------------
def cwe_record_tables(weaknesses: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Weakness elements -> the cleaned table ``cwe`` and its five cleaned
    subtables, saved under ``folder``.

    The catalogue is parsed once: the extracted fields and platforms are
    tables of their own, from which the others are made.  A subtable's id that
    the main table lacks is an error.
    """
    from riskspan.sources.files import save_tables
    raw = save_tables({"extracted": extract_weaknesses(weaknesses, _platforms(weaknesses).alias("platforms"))}, folder)["extracted"]
    tables = {"cwe": cwe_clean(raw.drop("platforms"))}
    for name, sub in cwe_subtables(raw).items():
        tables[name.replace(" ", "_")] = subtable_clean(sub, CWE_SUBTABLE_TYPES[name])
    rows = raw.select("cwe_id", F.explode("platforms").alias("p")).select("cwe_id", "p.*")
    tables["cwe_platform_table"] = platform_clean(rows)
    return save_tables(tables, folder, parent="cwe", key="cwe_id")


# fixture: weakness records shaped like the extraction output --------------
def weakness_records(cwe: DataFrame) -> DataFrame:
    """Extraction-shaped CWE rows from conversations (aligned lists)."""
    n = F.size("roles")
    return cwe.select(
        F.col("conv_id").cast("string").alias("cwe_id"),
        F.get("roles", 0).alias("cwe_name"),
        F.get("texts", 0).alias("cwe_desc"),
        F.get("texts", 1).alias("cwe_desc_extended"),
        F.transform("roles", lambda r, i: (F.col("conv_id") * 100 + i).cast("string")).alias("cwe_related_id"),
        F.col("roles").alias("cwe_nature_of_rel"),
        F.slice("texts", -1, 1).alias("cwe_bg_details"),
        F.array(F.lit("Implementation")).alias("cwe_introduction"),
        F.when(n > 3, F.lit(" High ")).otherwise(F.lit("n/a")).alias("cwe_exploit_likelihood"),
        F.col("roles").alias("cwe_consequence_scope"),
        F.transform("roles", lambda r: F.concat(F.lit("Read "), r)).alias("cwe_consequence_impact"),
        F.transform("roles", lambda r: F.lit("")).alias("cwe_consequence_note"),
        F.slice("roles", 1, 1).alias("cwe_detect_method"),
        F.slice("texts", 1, 1).alias("cwe_detect_desc"),
        F.array(F.lit("High")).alias("cwe_detect_effectiveness"),
        F.array(F.lit("None")).alias("cwe_detect_effect_notes"),
        F.slice("roles", 1, 2).alias("cwe_miti_phase"),
        F.slice("texts", 1, 2).alias("cwe_miti_desc"),
        F.slice(F.array(F.lit("Moderate"), F.lit("Limited")), 1, 2).alias("cwe_miti_effect"),
        F.array(F.lit("")).alias("cwe_miti_effect_notes"),
    )


def _xml_escape(c: Column) -> Column:
    """Escape markup characters and drop code points XML 1.0 cannot hold."""
    c = F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def weakness_xml(cwe: DataFrame) -> DataFrame:
    """CWE-catalogue XML text per conversation (one <Weakness> per line)."""
    turns = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    rel = F.array_join(F.transform(turns, lambda t, i: F.concat(
        F.lit('<Related_Weakness Nature="'), t["role"], F.lit('" CWE_ID="'), (F.col("conv_id") * 100 + i).cast("string"),
        F.lit('"/>'))), "")
    cons = F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("<Consequence><Scope>"), t["role"], F.lit("</Scope><Scope>Other</Scope><Impact>Read "), t["role"],
        F.lit("</Impact></Consequence>"))), "")
    detect = F.array_join(F.transform(turns, lambda t, i: F.concat(
        F.lit("<Detection_Method><Method>"), t["role"], F.lit("</Method><Description>Check "), i.cast("string"),
        F.lit("</Description><Effectiveness>High</Effectiveness>"),
        F.when(i % 2 == 0, F.lit("<Effectiveness_Notes>None</Effectiveness_Notes>")).otherwise(F.lit("")), F.lit("</Detection_Method>"))), "")
    mitigate = F.array_join(F.transform(F.slice(turns, 1, 2), lambda t, i: F.concat(
        F.lit("<Mitigation><Phase>"), t["role"], F.lit("</Phase><Phase>Other</Phase><Description> Fix "), i.cast("string"),
        F.lit("<p>later</p></Description></Mitigation>"))), "")
    xml = F.concat(
        F.lit('<Weakness ID="'), F.col("conv_id").cast("string"), F.lit('" Name="'), F.get("roles", 0), F.lit('">'),
        F.lit("<Description>"), _xml_escape(F.get("texts", 0)), F.lit("</Description>"),
        F.lit("<Extended_Description>"), F.coalesce(_xml_escape(F.get("texts", 1)), F.lit("")),
        F.lit("<p>details</p>tail</Extended_Description>"),
        F.lit("<Related_Weaknesses>"), rel, F.lit("</Related_Weaknesses>"),
        F.lit("<Common_Consequences>"), cons, F.lit("</Common_Consequences>"),
        F.lit("<Background_Details><Background_Detail>Known since "), (F.col("conv_id") % 30 + 1990).cast("string"),
        F.lit("</Background_Detail></Background_Details><Modes_Of_Introduction><Introduction><Phase>Implementation</Phase>"
              "</Introduction></Modes_Of_Introduction>"),
        F.when(F.size("roles") > 3, F.lit("<Likelihood_Of_Exploit> High </Likelihood_Of_Exploit>")).otherwise(F.lit("")),
        F.lit("<Detection_Methods>"), detect, F.lit("</Detection_Methods><Potential_Mitigations>"), mitigate, F.lit("</Potential_Mitigations>"),
        F.lit('<Applicable_Platforms><Language Name="'), F.get("roles", 0),
        F.lit('" Class="Not Language-Specific" Prevalence="Undetermined"/><Technology Class="Web Based" '
              'Prevalence="Often"/></Applicable_Platforms>'),
        F.lit("</Weakness>"))
    return cwe.select("conv_id", xml.alias("value"))


def write_weakness_catalog(xml_rows: DataFrame, key: str, path: str, per_file: int = 1000) -> None:
    """Write <Weakness> fragments as rooted catalogue documents, at most
    ``per_file`` weaknesses per file (bounded groups), one document per file
    (the XML reader needs the rooted form)."""
    bucket = F.floor(F.col(key) / per_file).cast("long")
    docs = (xml_rows.groupBy(bucket.alias("_part"))
                    .agg(F.concat(F.lit("<Weaknesses>"), F.array_join(F.array_sort(F.collect_list("value")), "\n"),
                                  F.lit("</Weaknesses>")).alias("value")))
    docs.write.mode("overwrite").partitionBy("_part").text(path)
