"""File-source/sink queries, CWE and ICS jobs, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspan.catalog import CVE_FIELD_PATHS, CVE_SUBTABLES, CWE_PLATFORM_SOURCE
from riskspan.functions import clean as C
from riskspan.functions.numeric import impute_scores
from riskspan.plans.fixtures import cte, cve_id_sql, fx, register_tables, table
from riskspan.plans.q_core import EPSS_SQL, ID_RE, epss_table
from riskspan.plans.q_cvss import cve_clean_sql
from riskspan.plans.registry import query
from riskspan.session import scratch_dir
from riskspan.sources import cwe as W
from riskspan.sources import files as FS
from riskspan.sources import nested as N

WS = "[ \\t\\n\\r\\f\\x0B]"


def dtrim(c: str) -> str:
    return "regexp_replace(" + c + ", '^" + WS + "+|" + WS + "+$', '', 'g')"


def nulls(c: str) -> str:
    return f"case when {c} in ('', 'n/a', 'None') then null else {c} end"


# S2 (written to the shared scratch folder and read back; CSV does not tell an
# empty text from a missing one)
@query("csv_roundtrip", cte("fx_dirty") + "select * replace (nullif(category, '') as category) from fx_dirty")
def q_csv_roundtrip(spark, sf):
    df = fx(spark, sf, "fx_dirty")
    path = scratch_dir(spark, "csv")
    FS.save_table(df, path, "CSV")
    return FS.read_csv(spark, path, schema=df.schema)


# S20
@query("sink_roundtrip", cte("fx_risk") + "select * from fx_risk")
def q_sink_roundtrip(spark, sf):
    df = fx(spark, sf, "fx_risk")
    path = scratch_dir(spark, "parquet")
    FS.save_table(df, path, "parquet", partition_by=["l_linenumber"])
    return spark.read.parquet(path)


# S21 (rows-only)
@query("file_audit")
def q_file_audit(spark, sf):
    return N.file_audit(spark, sf)


PACKED_DOCUMENTS = 20_000


def _scan_records(spark, sf, view="fx_cve"):
    """Good and rejected documents of a written folder of records, some of
    them broken."""
    docs = N.cve_documents(fx(spark, sf, view)).select("doc")
    bad = table(spark, sf, "orders").filter(F.col("o_orderkey") % 997 == 0).select(
        F.concat(F.lit("{broken "), F.col("o_orderkey").cast("string")).alias("doc"))
    path = scratch_dir(spark, "cvejson")
    # packed files can't be split for reading, so each holds a bounded number of documents
    docs.unionByName(bad).write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", PACKED_DOCUMENTS).text(path)
    return N.scan_json_documents(spark, path, schema=None, glob="*.txt.gz", one_per_file=False)


# S3
@query("json_doc_scan", cte("fx_cve") + "select cve_id_raw as cve_id, cve_state as state from fx_cve")
def q_json_doc_scan(spark, sf):
    schema = "cveMetadata struct<cveId:string, state:string, datePublished:string>"
    good = _scan_records(spark, sf)[0].withColumn("rec", F.from_json("doc", schema))
    return good.select(F.col("rec.cveMetadata.cveId").alias("cve_id"), F.col("rec.cveMetadata.state").alias("state"))


# S3: what the scan rejects
@query("json_doc_rejects", """
select 'invalid JSON' as reason, count(*) as documents from orders where o_orderkey % 997 = 0 having count(*) > 0""")
def q_json_doc_rejects(spark, sf):
    return _scan_records(spark, sf)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


def _record_tables(spark, sf):
    """Q1 + Q2: scan, extract, clean, save: the CVE table and its subtables."""
    from riskspan.plans.jobs import cve_record_tables
    good, _ = _scan_records(spark, sf, "fx_cve_rec")
    return cve_record_tables(good, scratch_dir(spark, "cves"))


# Q1 + Q2, all columns
@query("cve_pipeline", cve_clean_sql("fx_cve_rec", {
    "cve_desc": "description", "mitre_cve_res_date": "cast(reserved as timestamp)",
    "solution": "case when n_solutions > 0 then list_aggregate(list_transform(range(1, n_solutions + 1), lambda i: concat('Update to release ', i)), 'string_agg', ' ') end",
    "cve_discovery": "case discovery when 'External' then 'EXTERNAL' when 'internal' then 'INTERNAL' else discovery end",
    "ssvc_exploitation": "case when k % 5 = 0 then 'POC' end", "ssvc_automatable": "case when k % 5 = 0 then 'YES' end",
    "ssvc_tech_impact": "case when k % 5 = 0 then 'PARTIAL' end"}, kev="k % 25 = 0"))
def q_cve_pipeline(spark, sf):
    return _record_tables(spark, sf)["cve"]


RELEASED = "list_filter(range(1, n_aff + 1), lambda i: (k + i) % 3 <> 0)"
CVE_LISTS = {
    "cwe_id": "list_transform(list_filter(range(1, n_cwe + 1), lambda i: (k + i) % 5 <> 0), lambda i: concat('CWE-', (k * 7 + i) % 900)) "
              "|| case when k % 6 = 0 then ['CWE-20'] else [] end",
    "vendor": "list_transform(range(1, n_aff + 1), lambda i: concat('vendor ', k % 50 + i))",
    "product": "list_transform(range(1, n_aff + 1), lambda i: concat('product ', k, '.', i))",
    "prod_status": f"flatten(list_transform({RELEASED}, lambda i: [case when k % 2 = 1 then 'affected' else 'unaffected' end, "
                   "case when k % 2 = 0 then 'affected' else 'unaffected' end]))",
    "prod_defaultStatus": "list_transform(range(1, n_aff + 1), lambda i: case when (k + i) % 2 = 0 then 'affected' else 'unknown' end)",
    "prod_version": f"flatten(list_transform({RELEASED}, lambda i: [concat(i, '.1'), concat(i, '.2')]))",
    "prod_version_type": "case when k % 4 = 0 then ['semver'] else [] end",
    "prod_lessThan": "case when k % 4 = 0 then [concat('2.', k % 9)] else [] end",
    "prod_lessThanOrEqual": "case when k % 8 = 0 then [concat('3.', k % 9)] else [] end",
    "cpe": "case when k % 4 = 0 then list_transform(range(1, k % 3 + 1), lambda i: concat('cpe:2.3:a:vendor', k % 50, ':p', i)) else [] end",
}
ENGLISH = "list_filter(range(1, n_cwe + 1), lambda i: (k + i) % 4 <> 2)"
WEAKNESS = "list_transform({}, lambda i: concat('Weakness ', i, ' of ', k))"
SOLUTIONS = "list_transform(range(1, n_solutions + 1), lambda i: concat('Update to release ', i))"
PUBLISHED = f"(select *, upper(nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '')) as id from fx_cve_rec where cve_state = 'PUBLISHED')"


def or_null(items: str) -> str:
    return f"(case when len({items}) > 0 then {items} else [null] end)"


# Weaknesses of each record, one row for each place in the lists
@query("cve_cwe_connection", cte("fx_cve_rec") + f"""
select id as cve_id, unnest({or_null(CVE_LISTS['cwe_id'])}) as cwe_id, unnest({WEAKNESS.format(ENGLISH)}) as cwe_desc,
  'cve-cwe connection' as source_table from {PUBLISHED}""")
def q_cve_cwe_connection(spark, sf):
    sub = _record_tables(spark, sf)["cve_cwe_connection"]
    return C.subtable_explode(sub, "cve_id", CVE_SUBTABLES["cve_cwe_connection"], "cve-cwe connection")


# Products of each record
@query("cve_product_table", cte("fx_cve_rec") + "select id as cve_id, " + ", ".join(
    f'unnest({or_null(CVE_LISTS[c])}) as "{c}"' for c in CVE_SUBTABLES["cve_product"]) + f", 'cve product table' as source_table from {PUBLISHED}")
def q_cve_product_table(spark, sf):
    sub = _record_tables(spark, sf)["cve_product"]
    return C.subtable_explode(sub, "cve_id", CVE_SUBTABLES["cve_product"], "cve product table")


CVE_FIELDS_SQL = {c: f"array_to_string({items}, '|')" for c, items in (CVE_LISTS | {
    "cwe_desc": WEAKNESS.format("range(1, n_cwe + 1)"), "solution": SOLUTIONS}).items()} | {
    "cve_id": "cve_id_raw", "cve_desc": "description", "cve_state": "cve_state", "mitre_cve_res_date": "strftime(reserved, '%Y-%m-%dT%H:%M:%S')",
    "mitre_cve_publish_date": "strftime(publish_date, '%Y-%m-%dT%H:%M:%S')", "mitre_cve_public_date": "strftime(public_date, '%Y-%m-%dT%H:%M:%S')",
    "cve_discovery": "discovery", "cvss_v2": "cast(cvss_v2 as varchar)", "cvss_v2_vector": "cvss_v2_vector", "cvss_v3": "null",
    "cvss_v3_vector": "null", "cvss_v3_1": "cast(cvss_v3 as varchar)", "cvss_v3_1_vector": "cvss_v3_vector", "cvss_v4": "cast(cvss_v4 as varchar)",
    "cvss_v4_vector": "cvss_v4_vector", "ssvc_exploitation": "case when k % 5 = 0 then 'PoC' end",
    "ssvc_automatable": "case when k % 5 = 0 then 'yes' end", "ssvc_tech_impact": "case when k % 5 = 0 then 'Partial' end",
    "is_kev": "concat_ws('|', case when k % 5 = 0 then 'ssvc' end, case when k % 25 = 0 then 'kev' end)"}


# All fields of the catalogue, the items of each joined
@query("cve_field_extract", cte("fx_cve_rec") + "select " + ", ".join(
    f'coalesce({CVE_FIELDS_SQL[c]}, \'\') as "{c}"' for c in CVE_FIELD_PATHS) + " from fx_cve_rec")
def q_cve_field_extract(spark, sf):
    df = N.extract_cve_fields(N.cve_documents(fx(spark, sf, "fx_cve_rec")), "doc")
    texts = df.withColumn("cwe_desc", F.transform("cwe_desc", lambda x: x["description"]))
    return texts.select(*[F.array_join(F.col(f"`{c}`").cast("array<string>"), "|").alias(c) for c in CVE_FIELD_PATHS])


# S4 on full records: a key at any depth, an alternative, a list that is opened
@query("cve_deep_search", cte("fx_cve_rec") + f"""
select k, coalesce(array_to_string({CVE_LISTS['cwe_id']}, '|'), '') as cwe, coalesce(array_to_string({CVE_LISTS['prod_status']}, '|'), '') as status,
  coalesce(array_to_string({CVE_LISTS['cpe']}, '|'), '') as cpe from fx_cve_rec""")
def q_cve_deep_search(spark, sf):
    found = {"cwe": ["containers.cweId"], "status": ["containers.nothing", "affected.versions.status"], "cpe": ["adp.cpes"]}
    # the test tables are single row groups: deal the documents out for the search
    docs = N.cve_documents(fx(spark, sf, "fx_cve_rec")).repartition(spark.sparkContext.defaultParallelism)
    return docs.select("k", *[F.array_join(v, "|").alias(c) for c, v in zip(found, N.deep_searches("doc", found))])


def _weaknesses(spark, sf):
    """Weakness elements of a written catalogue of XML files."""
    path = scratch_dir(spark, "cwexml")
    W.write_weakness_catalog(W.weakness_xml(fx(spark, sf, "fx_cwe")), "conv_id", path)
    return W.read_weaknesses(spark, path)


def _lead(c: str) -> str:
    return f"coalesce(trim(regexp_extract({c}, '^[^<]*')), '')"


def _over_turns(item: str, rows: str = "range(1, len(roles) + 1)") -> str:
    return f"list_transform({rows}, lambda i: {item})"


FIRST_TWO = "range(1, least(len(roles), 2) + 1)"
CWE_LISTS = {
    "cwe_related_id": _over_turns("cast(conv_id * 100 + i - 1 as varchar)"), "cwe_nature_of_rel": "roles",
    "cwe_consequence_scope": "roles", "cwe_consequence_impact": _over_turns("concat('Read ', roles[i])"), "cwe_consequence_note": _over_turns("''"),
    "cwe_detect_method": "roles", "cwe_detect_desc": _over_turns("concat('Check ', i - 1)"), "cwe_detect_effectiveness": _over_turns("'High'"),
    "cwe_detect_effect_notes": _over_turns("case when i % 2 = 1 then 'None' else '' end"),
    "cwe_miti_phase": _over_turns("roles[i]", FIRST_TWO), "cwe_miti_desc": _over_turns("concat('Fix ', i - 1)", FIRST_TWO),
    "cwe_miti_effect": _over_turns("''", FIRST_TWO), "cwe_miti_effect_notes": _over_turns("''", FIRST_TWO)}
CWE_SCALARS = {"cwe_id": "cast(conv_id as varchar)", "cwe_name": "roles[1]", "cwe_desc": _lead("texts[1]"), "cwe_desc_extended": _lead("texts[2]"),
               "cwe_bg_details": "concat('Known since ', conv_id % 30 + 1990)", "cwe_introduction": "'Implementation'",
               "cwe_exploit_likelihood": "case when len(roles) > 3 then 'High' else '' end"}


# All fields, lists joined
@query("cwe_xml_scan", cte("fx_cwe") + "select " + ", ".join([f"{e} as {c}" for c, e in CWE_SCALARS.items()] + [
    f"array_to_string({e}, '|') as {c}" for c, e in CWE_LISTS.items()]) + " from fx_cwe")
def q_cwe_xml_scan(spark, sf):
    df = W.extract_weaknesses(_weaknesses(spark, sf))
    return df.select(*[F.array_join(f.name, "|").alias(f.name) if f.dataType.typeName() == "array" else f.name for f in df.schema.fields])


PLATFORM_SQL = """
select {} as cwe_id, 'Language' as type, roles[1] as name, 'Not Language-Specific' as class, 'Undetermined' as prevalence {} from fx_cwe
union all select {}, 'Technology', null, 'Web Based', 'Often' {} from fx_cwe"""


# S11 from XML
@query("cwe_platform_scan", cte("fx_cwe") + PLATFORM_SQL.format("cast(conv_id as varchar)", "", "cast(conv_id as varchar)", ""))
def q_cwe_platform_scan(spark, sf):
    return W.extract_platforms(_weaknesses(spark, sf))


def _cwe_tables(spark, sf):
    """Q3 + Q4 + Q5: scan, extract, clean, save."""
    return W.cwe_record_tables(_weaknesses(spark, sf), scratch_dir(spark, "cwe"))


# Q3 + Q4
@query("cwe_pipeline", cte("fx_cwe") + f"""
select distinct concat('CWE-', conv_id) as cwe_id, {nulls(dtrim('roles[1]'))} as cwe_name, 'Implementation' as cwe_introduction,
  case when len(roles) > 3 then 'High' end as cwe_exploit_likelihood,
  {nulls(dtrim(f"trim(concat_ws(' ', {CWE_SCALARS['cwe_desc']}, {CWE_SCALARS['cwe_desc_extended']}, {CWE_SCALARS['cwe_bg_details']}))"))} as cwe_desc_combined
from fx_cwe""")
def q_cwe_pipeline(spark, sf):
    return _cwe_tables(spark, sf)["cwe"]


def _cwe_sub_sql(name: str) -> str:
    cols = W.SUBTABLES[name]
    return (cte("fx_cwe") + "select distinct cwe_id, " + ", ".join(f"{dtrim(nulls(c))} as {c}" for c in cols) + f", '{name}' as source_table from (select "
            "concat('CWE-', conv_id) as cwe_id, " + ", ".join(f"unnest({CWE_LISTS[c]}) as {c}" for c in cols) + " from fx_cwe)")


# Q3 + Q5: the cleaned subtables
@query("cwe_related_table", _cwe_sub_sql("related cwe table"))
def q_cwe_related_table(spark, sf):
    return _cwe_tables(spark, sf)["related_cwe_table"]


@query("cwe_consequence_table", _cwe_sub_sql("cwe consequence table"))
def q_cwe_consequence_table(spark, sf):
    return _cwe_tables(spark, sf)["cwe_consequence_table"]


@query("cwe_detection_table", _cwe_sub_sql("cwe detection table"))
def q_cwe_detection_table(spark, sf):
    return _cwe_tables(spark, sf)["cwe_detection_table"]


@query("cwe_mitigation_table", _cwe_sub_sql("cwe mitigation table"))
def q_cwe_mitigation_table(spark, sf):
    return _cwe_tables(spark, sf)["cwe_mitigation_table"]


@query("cwe_platform_table", cte("fx_cwe") + PLATFORM_SQL.format(
    "concat('CWE-', conv_id)", f", '{CWE_PLATFORM_SOURCE}' as source_table", "concat('CWE-', conv_id)", f", '{CWE_PLATFORM_SOURCE}'"))
def q_cwe_platform_table(spark, sf):
    return _cwe_tables(spark, sf)["cwe_platform_table"]


# Q4
@query("cwe_clean", cte("fx_cwe") + f"""
select distinct {nulls(dtrim("'CWE-' || trim(cast(conv_id as varchar))"))} as cwe_id,
  {nulls(dtrim('roles[1]'))} as cwe_name,
  {nulls(dtrim("'Implementation'"))} as cwe_introduction,
  {nulls(dtrim(dtrim("case when len(roles) > 3 then ' High ' else 'n/a' end")))} as cwe_exploit_likelihood,
  {nulls(dtrim("nullif(trim(concat_ws(' ', texts[1], texts[2], texts[len(texts)])), '')"))} as cwe_desc_combined
from fx_cwe""")
def q_cwe_clean(spark, sf):
    return W.cwe_clean(W.weakness_records(fx(spark, sf, "fx_cwe")))


# Q5
@query("subtable_clean", cte("fx_cwe") + f"""
select distinct {dtrim('cwe_id')} as cwe_id, {dtrim('cwe_consequence_scope')} as cwe_consequence_scope,
  {dtrim('cwe_consequence_impact')} as cwe_consequence_impact,
  {dtrim(nulls('cwe_consequence_note'))} as cwe_consequence_note, 'cwe consequence table' as source_table
from (select 'CWE-' || cast(conv_id as varchar) as cwe_id, unnest(roles) as cwe_consequence_scope,
        unnest(list_transform(roles, lambda r: 'Read ' || r)) as cwe_consequence_impact,
        unnest(list_transform(roles, lambda r: '')) as cwe_consequence_note from fx_cwe)""")
def q_subtable_clean(spark, sf):
    sub = W.cwe_subtables(W.weakness_records(fx(spark, sf, "fx_cwe")))["cwe consequence table"]
    return W.subtable_clean(sub, {"string": ["cwe_id", "cwe_consequence_scope", "cwe_consequence_impact",
                                             "cwe_consequence_note"], "integer": ["rel_cwe_id"]})


ICS_RAW = f"""
select case when c_custkey % 7 = 0 then concat(' ', lower({cve_id_sql("c_custkey", "19", 5, 2)}), ' ')
            else {cve_id_sql("c_custkey", "20", 5, 2)} end as cve_id,
  c_name as cve_description, '2021-03-0' || cast(c_custkey % 9 + 1 as varchar(1)) as u_sys_created,
  cast(c_nationkey as varchar(10)) as u_sfp_cluster, c_mktsegment as u_old_cat,
  case when c_custkey % 4 = 0 then 'n/a' else lower(c_mktsegment) end as u_new_cat, '' as u_other_cat,
  concat(' ', c_mktsegment, ' ') as u_product_type, c_acctbal as cvss_score, 'High' as confidentialityImpact,
  'Low' as userPriv, 'None' as userInteractionRequired, '2022' as sys_updated, 'NETWORK' as accessVector,
  'LOW' as complexity
from customer"""


# Q13
@query("ics_clean", "with raw as (" + ICS_RAW + f""")
select distinct {nulls(dtrim(f"upper(nullif(regexp_extract(cve_id, '{ID_RE}', 0), ''))"))} as cve_id,
  {nulls(dtrim('cve_description'))} as cve_desc, cast(cast(u_sys_created as date) as timestamp) as advisory_date,
  {nulls(dtrim('u_sfp_cluster'))} as sfp_id, {nulls(dtrim('u_old_cat'))} as cwe_name,
  {nulls(dtrim('u_new_cat'))} as new_cwe_cat, {nulls(dtrim('u_other_cat'))} as impossible_to_cat_cwes,
  {nulls(dtrim('u_product_type'))} as product_type
from raw""")
def q_ics_clean(spark, sf):
    from riskspan.plans.jobs import ics_clean
    register_tables(spark, sf)
    return ics_clean(spark.sql(ICS_RAW))


def _impute_sql():
    return cte("fx_first_exploit", "fx_epss_hist") + ", " + EPSS_SQL + """
select cve_id,
  case when epss_0 is null and epss_30 is not null and epss_60 is not null then least(1.0, greatest(0.0, (epss_30 + epss_60) / 2.0)) else epss_0 end as epss_0,
  case when epss_30 is null and epss_0 is not null and epss_60 is not null then least(1.0, greatest(0.0, (epss_0 + epss_60) / 2.0)) else epss_30 end as epss_30,
  case when epss_60 is null and epss_0 is not null and epss_30 is not null then least(1.0, greatest(0.0, (epss_0 + epss_30) / 2.0)) else epss_60 end as epss_60,
  case when epss_0 is null and epss_30 is not null and epss_60 is not null then 'epss_0:mean'
       when epss_30 is null and epss_0 is not null and epss_60 is not null then 'epss_30:mean'
       when epss_60 is null and epss_0 is not null and epss_30 is not null then 'epss_60:mean' end as imputation
from epss"""


# F33
@query("impute_scores", _impute_sql())
def q_impute_scores(spark, sf):
    return impute_scores(epss_table(spark, sf)).select("cve_id", "epss_0", "epss_30", "epss_60", "imputation")
