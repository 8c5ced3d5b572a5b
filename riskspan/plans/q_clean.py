"""Cleaning-function queries (F1-F13, F24-F29, P2/P6/P7/P12, A27/A28,
per-source cleaning jobs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspan.functions import clean as C
from riskspan.functions.numeric import transform_numeric
from riskspan.plans.fixtures import cte, cve_id_sql, fx, table
from riskspan.plans.jobs import kev_clean, nvd_clean, poc_clean
from riskspan.plans.q_core import ID_RE, NVD_SQL
from riskspan.plans.registry import query

WS = "[ \\t\\n\\r\\f\\x0B]"
TRIM_SQL = "regexp_replace({c}, '^" + WS + "+|" + WS + "+$', '', 'g')"


def dtrim(c: str) -> str:
    return TRIM_SQL.format(c=c)


def nulls_sql(c: str) -> str:
    return f"case when {c} in ('', 'n/a', 'None') then null else {c} end"


# F1
@query("standardize_nulls", cte("fx_dirty") + f"""
select c_custkey, {nulls_sql('category')} as category, {nulls_sql('num_text')} as num_text,
  {nulls_sql('flag_text')} as flag_text, case when isnan(score) then null else score end as score
from fx_dirty""")
def q_standardize_nulls(spark, sf):
    return C.standardize_nulls(fx(spark, sf, "fx_dirty"))


SEGMENT_MAP = {"automobile": "Automobile", "building": "Building", "furniture": "Furniture",
               "Household": "HOUSEHOLD"}


# F2
@query("standardize_categories", cte("fx_dirty") + """
select c_custkey, coalesce(case lower(category) when 'automobile' then 'Automobile'
  when 'building' then 'Building' when 'furniture' then 'Furniture' end, category) as category
from fx_dirty""")
def q_standardize_categories(spark, sf):
    df = C.standardize_categories(fx(spark, sf, "fx_dirty"), {"category": SEGMENT_MAP})
    return df.select("c_custkey", "category")


# F3
@query("trim_strings", cte("fx_dirty") + f"""
select c_custkey, {dtrim('category')} as category, {dtrim('num_text')} as num_text,
  {dtrim('flag_text')} as flag_text, score from fx_dirty""")
def q_trim_strings(spark, sf):
    return C.trim_strings(fx(spark, sf, "fx_dirty"))


# F4 / F32
@query("convert_types", cte("fx_dirty") + f"""
select c_custkey, {dtrim('category')} as category, try_cast(num_text as bigint) as num_text,
  flag_text, try_cast(score as double) as score from fx_dirty""")
def q_convert_types(spark, sf):
    return C.convert_types(fx(spark, sf, "fx_dirty"),
                           {"string": ["category"], "integer": ["num_text"], "float": ["score"]})


# F5
@query("validate_id", cte("fx_cve") + f"""
select k, coalesce(upper(nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '')),
  'CVE-' || regexp_extract(list_filter([regexp_extract(trim('none'), '{ID_RE}', 0),
                                        regexp_extract(trim('see ' || cve_id), '{ID_RE}', 0)], lambda x: x <> '')[1], '{ID_RE}', 1)
  || '-' || regexp_extract(list_filter([regexp_extract(trim('none'), '{ID_RE}', 0),
                                        regexp_extract(trim('see ' || cve_id), '{ID_RE}', 0)], lambda x: x <> '')[1], '{ID_RE}', 2)) as cve_id
from fx_cve""")
def q_validate_id(spark, sf):
    df = fx(spark, sf, "fx_cve")
    backup = F.array(F.lit("none"), F.concat(F.lit("see "), F.col("cve_id")))
    return df.select("k", C.validate_id("cve_id_raw", backup).alias("cve_id"))


# F6
@query("concat_list", cte("fx_cwe") + """
select conv_id, coalesce(array_to_string(list_filter(texts, lambda x: x is not null and x <> ''), ' '), '') as text
from fx_cwe""")
def q_concat_list(spark, sf):
    return fx(spark, sf, "fx_cwe").select("conv_id", C.concat_list("texts", " ").alias("text"))


# F7
@query("combine_text", """
select doc_id, nullif(trim(concat_ws(' ', case when doc_id % 3 = 0 then null else source end, lang, text)), '') as description
from documents""")
def q_combine_text(spark, sf):
    d = table(spark, sf, "documents")
    src = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("source"))
    return d.select("doc_id", C.combine_text(src, "lang", "text").alias("description"))


# F8
@query("prefix_id", "select c_custkey, 'CWE-' || cast(c_custkey as varchar) as cwe_id from customer")
def q_prefix_id(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", C.prefix_id("c_custkey").alias("cwe_id"))


# F9
@query("split_to_array", """
select doc_id, array_to_string(list_transform(string_split(text, ','), lambda x: trim(x)), '|') as items,
  len(string_split(text, ',')) as n_items
from documents""")
def q_split_to_array(spark, sf):
    arr = C.split_to_array("text", ",")
    return table(spark, sf, "documents").select("doc_id", F.array_join(arr, "|").alias("items"),
                                                  F.size(arr).alias("n_items"))


# F10
@query("first_item", cte("fx_cwe") + "select conv_id, roles[1] as first_role, texts[1] as first_text from fx_cwe")
def q_first_item(spark, sf):
    return fx(spark, sf, "fx_cwe").select("conv_id", C.first_item("roles").alias("first_role"),
                                          C.first_item("texts").alias("first_text"))


# F11
@query("flatten_singletons", cte("fx_cwe") + """
select conv_id, roles[1] as single, array_to_string(texts, '|') as multi from fx_cwe""")
def q_flatten_singletons(spark, sf):
    df = fx(spark, sf, "fx_cwe").select("conv_id", F.slice("roles", 1, 1).alias("single"),
                                        F.col("texts").alias("multi"))
    out, _report = C.flatten_singletons(df, ["single", "multi"], key="conv_id")
    multi = out["multi"]
    if "array" in dict(out.dtypes)["multi"]:
        multi = F.array_join("multi", "|")
    return out.select("conv_id", "single", multi.alias("multi"))


# F12
@query("pad_arrays", cte("fx_cwe") + """
select conv_id, greatest(len(roles), len(texts[1:2])) as n_roles,
  greatest(len(roles), len(texts[1:2])) as n_texts,
  greatest(len(roles), len(texts[1:2])) - len(texts[1:2]) as n_padding
from fx_cwe""")
def q_pad_arrays(spark, sf):
    df = fx(spark, sf, "fx_cwe").select("conv_id", "roles", F.slice("texts", 1, 2).alias("texts"))
    p = C.pad_arrays(df, ["roles", "texts"])
    return p.select("conv_id", F.size("roles").alias("n_roles"), F.size("texts").alias("n_texts"),
                    F.size(F.filter("texts", lambda x: x.isNull())).alias("n_padding"))


# F13
@query("subtable_explode", cte("fx_cwe") + """
select conv_id, unnest(roles) as roles, unnest(texts[1:2]) as texts, 'related_cwe_table' as source_table
from fx_cwe""")
def q_subtable_explode(spark, sf):
    df = fx(spark, sf, "fx_cwe").select("conv_id", "roles", F.slice("texts", 1, 2).alias("texts"))
    return C.subtable_explode(df, "conv_id", ["roles", "texts"], "related_cwe_table")


# F24
@query("array_flag", cte("fx_cwe") + """
select conv_id, coalesce(list_contains(roles, 'system'), false) as has_system from fx_cwe""")
def q_array_flag(spark, sf):
    return fx(spark, sf, "fx_cwe").select("conv_id", C.array_flag("roles", "system").alias("has_system"))


# F25 / S6
@query("english_desc", """
select doc_id, array_to_string(list_transform(list_filter(
  [{'lang': lang, 'description': text}, {'lang': 'English', 'description': source}, {'lang': 'fr', 'description': 'x' || source}],
  lambda x: lower(trim(x.lang)) in ('en', 'eng', 'english')), lambda x: x.description), ' | ') as english
from documents""")
def q_english_desc(spark, sf):
    d = table(spark, sf, "documents")
    items = F.array(F.struct(F.col("lang").alias("lang"), F.col("text").alias("description")),
                    F.struct(F.lit("English").alias("lang"), F.col("source").alias("description")),
                    F.struct(F.lit("fr").alias("lang"), F.concat(F.lit("x"), F.col("source")).alias("description")))
    return d.select("doc_id", F.array_join(C.english_desc(items), " | ").alias("english"))


# F26
@query("booleanize", cte("fx_dirty") + """
select c_custkey, case when lower(flag_text) = 'yes' then true when lower(flag_text) = 'no' then false end as flag
from fx_dirty""")
def q_booleanize(spark, sf):
    return fx(spark, sf, "fx_dirty").select("c_custkey", C.booleanize("flag_text").alias("flag"))


# F27
@query("replace_values", cte("fx_nvd") + """
select cve_id, case cvss_version when '2.0' then 'V2' when '3.0' then 'V3' when '3.1' then 'V3.1'
  when '4.0' then 'V4' else cvss_version end as cvss_src from fx_nvd""")
def q_replace_values(spark, sf):
    from riskspan.catalog import NVD_VERSION_LABELS
    return fx(spark, sf, "fx_nvd").select("cve_id", C.replace_values("cvss_version", NVD_VERSION_LABELS).alias("cvss_src"))


# F28
@query("encode_ordinal", cte("fx_dirty") + """
select c_custkey, case flag_text when 'Yes' then 1 when 'No' then 2 end as flag_code from fx_dirty""")
def q_encode_ordinal(spark, sf):
    return fx(spark, sf, "fx_dirty").select("c_custkey", C.encode_ordinal("flag_text", {"Yes": 1, "No": 2}).alias("flag_code"))


# F29
@query("transform_numeric", cte("fx_risk") + """
select l_orderkey, l_linenumber,
  round(case when cvss > 0 then ln(1 + cvss) when cvss is not null then 0 end, 6) as cvss_log1p,
  round(case when days_to_exploit < 0 then 0 else sqrt(days_to_exploit) end, 6) as days_sqrt,
  round(exp(epss_0), 6) as epss_exp
from fx_risk""")
def q_transform_numeric(spark, sf):
    df = fx(spark, sf, "fx_risk")
    return df.select("l_orderkey", "l_linenumber",
                     F.round(transform_numeric("cvss", "log1p"), 6).alias("cvss_log1p"),
                     F.round(transform_numeric("days_to_exploit", "sqrt"), 6).alias("days_sqrt"),
                     F.round(transform_numeric("epss_0", "exp"), 6).alias("epss_exp"))


# P2
@query("drop_by_pattern", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus
from lineitem""")
def q_drop_by_pattern(spark, sf):
    return C.drop_by_pattern(table(spark, sf, "lineitem"), prefixes=("l_ship",), suffixes=("flag",),
                             names=("l_comment",))


# P6
@query("filter_state", cte("fx_cve") + "select k, cve_id from fx_cve where cve_state = 'PUBLISHED'")
def q_filter_state(spark, sf):
    return fx(spark, sf, "fx_cve").filter(F.col("cve_state") == "PUBLISHED").select("k", "cve_id")


# P7
@query("filter_valid_id", cte("fx_cve") + f"""
select k, upper(nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '')) as cve_id from fx_cve
where nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '') is not null""")
def q_filter_valid_id(spark, sf):
    df = fx(spark, sf, "fx_cve").select("k", C.validate_id("cve_id_raw").alias("cve_id"))
    return df.filter(F.col("cve_id").isNotNull())


# P12
@query("dropna_subset", cte("fx_dirty") + "select * from fx_dirty where score is not null")
def q_dropna_subset(spark, sf):
    return fx(spark, sf, "fx_dirty").dropna(subset=["score"])


# A27
@query("dedupe_rows", cte("fx_nvd") + "select distinct cvss, cvss_version from fx_nvd")
def q_dedupe_rows(spark, sf):
    return fx(spark, sf, "fx_nvd").select("cvss", "cvss_version").dropDuplicates()


# A28
@query("dedupe_nested", cte("fx_cwe") + """
select array_to_string(roles, ',') as roles, n from (select distinct roles, len(roles) as n from fx_cwe)""")
def q_dedupe_nested(spark, sf):
    df = fx(spark, sf, "fx_cwe").select("roles", F.size("roles").alias("n")).dropDuplicates()
    return df.select(F.array_join("roles", ",").alias("roles"), "n")


# Q12
@query("nvd_clean", cte("fx_nvd") + "," + NVD_SQL + " select * from nvd")
def q_nvd_clean(spark, sf):
    return nvd_clean(fx(spark, sf, "fx_nvd"))


POC_RAW = """
select case when exploit_count % 4 = 0 then 'exploit-tool' else lower(cve_id) || '-poc' end as cve_id,
  case when exploit_count % 8 = 0 then ['poc', cve_id] else ['poc'] end as poc_topics,
  exploit_count, earliest_date from fx_poc"""


# Q9
@query("poc_clean", cte("fx_poc") + f", raw as ({POC_RAW}) " + f"""
select distinct coalesce(upper(nullif(regexp_extract(cve_id, '{ID_RE}', 0), '')),
    case when exploit_count % 8 = 0 then 'CVE-' || regexp_extract(poc_topics[2], '{ID_RE}', 1) || '-' || regexp_extract(poc_topics[2], '{ID_RE}', 2) end) as cve_id,
  exploit_count, earliest_date from raw
where coalesce(upper(nullif(regexp_extract(cve_id, '{ID_RE}', 0), '')),
    case when exploit_count % 8 = 0 then 'CVE-' || regexp_extract(poc_topics[2], '{ID_RE}', 1) end) is not null""")
def q_poc_clean(spark, sf):
    p = fx(spark, sf, "fx_poc")
    raw = p.select(
        F.when(F.col("exploit_count") % 4 == 0, F.lit("exploit-tool"))
         .otherwise(F.concat(F.lower("cve_id"), F.lit("-poc"))).alias("cve_id"),
        F.when(F.col("exploit_count") % 8 == 0, F.array(F.lit("poc"), F.col("cve_id")))
         .otherwise(F.array(F.lit("poc"))).alias("poc_topics"),
        "exploit_count", "earliest_date")
    return poc_clean(raw)


KEV_RAW = f"""
select {cve_id_sql("o_orderkey", "o_orderkey % 25")} as cveID,
  concat(' vendor ', cast(o_custkey % 50 as varchar(10))) as vendorProject,
  concat('product ', cast(o_custkey % 7 as varchar(10))) as product,
  o_orderpriority as vulnerabilityName,
  cast(cast(o_orderdate as date) as varchar(10)) as dateAdded,
  case when o_orderkey % 9 = 0 then '' else 'short description' end as shortDescription,
  'apply updates' as requiredAction,
  cast(cast(o_orderdate + interval '21' day as date) as varchar(10)) as dueDate,
  case when o_custkey % 3 = 0 then 'Known' else 'Unknown' end as knownRansomwareCampaignUse,
  case when o_orderkey % 4 = 0 then 'n/a' else 'see advisory' end as notes,
  case when o_orderkey % 10 = 0 then null else concat('CWE-', cast(o_custkey % 100 as varchar(10)), ', CWE-', cast(o_orderkey % 7 as varchar(10))) end as cwes
from orders where o_orderstatus = 'P'"""


# Q10
@query("kev_clean", "with raw as (" + KEV_RAW + f""")
select cveID as cve_id, {nulls_sql(dtrim('vendorProject'))} as vendor, {dtrim('product')} as product,
  {dtrim('vulnerabilityName')} as cve_name, cast(cast(dateAdded as date) as timestamp) as kev_date_published,
  {nulls_sql(dtrim('shortDescription'))} as cve_short_desc, {dtrim('requiredAction')} as required_action,
  cast(cast(dueDate as date) as timestamp) as due_date, knownRansomwareCampaignUse as known_use,
  {nulls_sql(dtrim('notes'))} as notes,
  coalesce(array_to_string(list_transform(string_split({dtrim('cwes')}, ','), lambda x: trim(x)), '|'), '') as cwe_id
from raw""")
def q_kev_clean(spark, sf):
    from riskspan.plans.fixtures import register_tables
    register_tables(spark, sf)
    out = kev_clean(spark.sql(KEV_RAW))
    return out.withColumn("cwe_id", F.array_join("cwe_id", "|"))
