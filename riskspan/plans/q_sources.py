"""Source, nested-document, filter and synthetic-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspan.catalog import CASE_INSENSITIVE_KEYWORDS, CASE_SENSITIVE_KEYWORDS
from riskspan.operators import filters as P
from riskspan.plans.fixtures import USER_CVE, cte, fx, register_tables, table
from riskspan.plans.q_core import XDB_SQL
from riskspan.plans.registry import query
from riskspan.sources import nested as N
from riskspan.sources.exploitdb import earliest_exploit
from riskspan.sources import synth as Y


def _q(s: str) -> str:
    return s.replace("'", "''")


# P9
@query("keyword_filter", cte("fx_desc") + f"""
, m as (select doc_id, coalesce(nullif(regexp_extract(description, '{_q(P.keyword_pattern(CASE_SENSITIVE_KEYWORDS, False))}', 2), ''),
                                nullif(regexp_extract(description, '{_q(P.keyword_pattern(CASE_INSENSITIVE_KEYWORDS, True))}', 2), '')) as matched_keyword
        from fx_desc)
select doc_id, matched_keyword from m where matched_keyword is not null""")
def q_keyword_filter(spark, sf):
    # the test tables are single row groups: deal the texts out for the regex
    texts = fx(spark, sf, "fx_desc").repartition(spark.sparkContext.defaultParallelism)
    return P.keyword_filter(texts, "description").select("doc_id", "matched_keyword")


SEEDED = "cast('0x' || substr(md5({} || '#1945'), 1, 8) as bigint)"


# A fixed number of rows
@query("hash_sample_n", f"""
select o_orderkey from orders order by {SEEDED.format("cast(o_orderkey as varchar)")}, o_orderkey limit 500""")
def q_hash_sample_n(spark, sf):
    return P.hash_sample_n(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 500)


# P13
@query("hash_sample", cte("fx_cve") + f"select k, cve_id from fx_cve where {SEEDED.format('cve_id')} < 0.2 * 4294967296")
def q_hash_sample(spark, sf):
    return P.hash_sample(fx(spark, sf, "fx_cve"), "cve_id", 0.2).select("k", "cve_id")


# Q15: a sample of the CVEs, each with its earliest exploit or none
@query("exploit_sample_summary", cte("fx_cve", "fx_xdb_rows") + ", " + XDB_SQL + f""",
picked as (select distinct cve_id from fx_cve where {SEEDED.format('cve_id')} < 0.2 * 4294967296)
select p.cve_id, x.earliest_date, coalesce(x.exploit_count, 0) as exploit_count, coalesce(x.poc_code, 'NO') as poc_code,
  x.first_poc_type, x.first_poc_platform, x.first_poc_port, x.verified from picked p left join xdb x using (cve_id)""")
def q_exploit_sample_summary(spark, sf):
    picked = P.hash_sample(fx(spark, sf, "fx_cve").select("cve_id"), "cve_id", 0.2)
    return earliest_exploit(fx(spark, sf, "fx_xdb_rows"), picked)


# P14
@query("consistency_checks", cte("fx_cve", "fx_first_exploit", "fx_epss_hist") + """
, e as (select f.cve_id, h.epss, case when day(f.earliest_date) % 5 = 0 then null else h.percentile end as percentile
        from fx_first_exploit f left join fx_epss_hist h on h.cve_id = f.cve_id and h.score_date = f.earliest_date)
select 'score_without_percentile' as rule, count(*) filter (where epss is not null and percentile is null) as violations from e
union all select 'null_publish_date' as rule, count(*) filter (where publish_date is null) as violations from fx_cve
union all select 'rejected_state' as rule, count(*) filter (where cve_state <> 'PUBLISHED') as violations from fx_cve""")
def q_consistency_checks(spark, sf):
    f = fx(spark, sf, "fx_first_exploit")
    h = fx(spark, sf, "fx_epss_hist")
    e = (f.join(h.withColumnRenamed("score_date", "earliest_date"), ["cve_id", "earliest_date"], "left")
          .withColumn("percentile", F.when(F.day("earliest_date") % 5 == 0, F.lit(None)).otherwise(F.col("percentile"))))
    a = P.rule_violations(e, {"score_without_percentile": F.col("epss").isNotNull() & F.col("percentile").isNull()})
    c = P.rule_violations(fx(spark, sf, "fx_cve"), {"null_publish_date": F.col("publish_date").isNull(),
                                                    "rejected_state": F.col("cve_state") != "PUBLISHED"})
    return a.unionByName(c)


# S4 (typed path)
@query("json_path_extract", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def q_json_path_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# S4 (any depth): all roles below the first path; the texts by the second alternative
@query("json_deep_search", cte("fx_cwe") + """
select conv_id, array_to_string(roles, '|') as roles, array_to_string(texts, '|') as texts, '' as nothing from fx_cwe""")
def q_json_deep_search(spark, sf):
    docs = N.conversation_documents(fx(spark, sf, "fx_cwe")).repartition(spark.sparkContext.defaultParallelism)
    found = {"roles": ["meta.role", "thread.text"], "texts": ["role.turns", "thread.text"], "nothing": ["text.meta"]}
    return docs.select("conv_id", *[F.array_join(v, "|").alias(c) for c, v in zip(found, N.deep_searches("doc", found))])


# S8 / S9
@query("poc_file_summary", f"""
select {USER_CVE} as cve_id, count(*) as exploit_count,
  min(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as earliest_date
from events group by user_id""")
def q_poc_file_summary(spark, sf):
    listings = N.poc_listings(table(spark, sf, "events"), F.expr(USER_CVE))
    return N.poc_file_summary(listings, "listing").select("cve_id", "exploit_count", "earliest_date")


# user's listings; the id is in the name, for every third user in the topics of even ones
POC_NAME = f"case when user_id % 3 = 0 then concat('exploit ', cast(user_id as varchar(10))) else concat('poc for ', {USER_CVE}, ' (', event_type, ')') end"
POC_BACKUP = f"case when user_id % 2 = 0 then lower({USER_CVE}) end"


# Q8: fields found by search, one row per listing
@query("poc_extract", f"""
with e as (select *, strftime(ts, '%Y-%m-%dT%H:%M:%S') as created, strftime(ts + interval 1 day, '%Y-%m-%dT%H:%M:%S') as pushed,
    {POC_NAME} as name, {POC_BACKUP} as backup from events),
o as (select *, row_number() over (partition by user_id, date_trunc('hour', ts) order by name, created, pushed, event_id % 7, event_id % 2 desc, event_type) as nth from e)
select count(*) as exploit_count, min(created) as earliest_date, min(name) as cve_id, min(case when nth = 1 then created end) as poc_creation,
  min(case when nth = 1 then pushed end) as poc_uploaded, min(case when nth = 1 then event_id % 7 end) as poc_forks,
  min(case when nth = 1 then case event_id % 2 when 0 then 'public' else 'private' end end) as poc_visibility,
  string_agg(concat_ws(',', event_type, backup), ',' order by nth) as poc_topics
from o group by user_id, date_trunc('hour', ts)""")
def q_poc_extract(spark, sf):
    listings = N.poc_listings(table(spark, sf, "events"), F.expr(POC_NAME), F.expr(POC_BACKUP))
    out = N.poc_extract(listings, "listing")
    return out.withColumns({"poc_topics": F.array_join("poc_topics", ","), "poc_forks": F.col("poc_forks").try_cast("long")})


# Q8 + Q9: listings to cleaned rows, ids from names or topics
@query("poc_pipeline", f"""
select distinct {USER_CVE} as cve_id, count(*) as exploit_count, min(cast(date_trunc('second', ts) as timestamp)) as earliest_date
from events where user_id % 3 <> 0 or user_id % 2 = 0 group by user_id, date_trunc('hour', ts)""")
def q_poc_pipeline(spark, sf):
    from riskspan.plans.jobs import poc_clean
    listings = N.poc_listings(table(spark, sf, "events"), F.expr(POC_NAME), F.expr(POC_BACKUP))
    return poc_clean(N.poc_extract(listings, "listing"))


# S11
@query("platform_unpivot", """
select p_partkey as cwe_id, 'Language' as type, p_brand as name, 'Often' as class, p_type as prevalence from part
union all select p_partkey, 'Architecture', 'x86', 'Sometimes', p_type from part where p_size % 2 = 0
union all select p_partkey, 'Operating_System', 'Linux', 'Rarely', p_type from part where p_size % 3 = 0
union all select p_partkey, 'Technology', p_name, 'Undetermined', p_type from part where p_size % 5 = 0""")
def q_platform_unpivot(spark, sf):
    return N.platform_unpivot(N.platform_records(table(spark, sf, "part")), "cwe_id")


# S12
@query("nvd_best_metric", cte("fx_nvd") + """
select cve_id, date_published as published,
  case when cvss_version = '2.0' then 9.9 else cvss end as cvss,
  case when cvss_version = '2.0' then '2.0' else cvss_version end as cvss_version,
  case when cvss_version = '2.0' then 'AV:N/AC:L/Au:N/C:C/I:C/A:C' else concat('CVSS:', cvss_version, '/AV:N') end as cvss_vector
from fx_nvd""")
def q_nvd_best_metric(spark, sf):
    pages = N.nvd_pages(fx(spark, sf, "fx_nvd"))
    return N.nvd_best_metric(pages)


# S19
@query("nested_flatten", cte("fx_cwe") + """
select conv_id as search_id, 'conversations' as search_source, r.turn as turn, r.role as title, r.text as description
from (select conv_id, unnest(list_zip(range(1, len(roles) + 1), roles, texts)) as r0 from fx_cwe),
  lateral (select r0[1] as turn, r0[2] as role, r0[3] as text) r""")
def q_nested_flatten(spark, sf):
    searches = N.search_records(fx(spark, sf, "fx_cwe"))
    return N.nested_flatten(searches)


# S17
@query("weighted_risk_score", """
with c as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 5 as cvss,
  least(5, greatest(1, cast(trunc((l_linenumber % 5 + 1) * cast(0.7 as double) + (l_quantity / 5) / 10 * 5 * cast(0.3 as double)) as int))) as dca
  from lineitem)
select l_orderkey, l_linenumber,
  round(10 * dca + 7 * least(5, greatest(0, cast(trunc(dca * cast(0.6 as double) + cvss / 10 * 5 * cast(0.4 as double)) as int)))
      + 5 * cast(l_partkey % 4 as int) + 4 * cast(l_suppkey % 5 + 1 as int) + 3 * cast(l_orderkey % 5 as int)
      + 3 * cast(l_partkey % 5 + 1 as int) + 2 * cast(l_suppkey % 4 as int) + cast(0.5 as double) * cvss, 2) as securegrid_score
from c""")
def q_weighted_risk_score(spark, sf):
    li = table(spark, sf, "lineitem")
    return Y.weighted_risk_score(Y.risk_components(li)).select("l_orderkey", "l_linenumber", "securegrid_score")


# S18
@query("exploit_window_flags", cte("fx_risk") + """
select l_orderkey, l_linenumber,
  cast(days_to_exploit >= 0 and days_to_exploit <= 30 as int) as within_30,
  cast(days_to_exploit >= 0 and days_to_exploit <= 60 as int) as within_60,
  cast(days_to_exploit >= 0 and days_to_exploit <= 90 as int) as within_90,
  cast(days_to_exploit < 0 as int) as zero_day, cast(cvss >= 7 as int) as high_cvss
from fx_risk""")
def q_exploit_window_flags(spark, sf):
    return Y.exploit_window_flags(fx(spark, sf, "fx_risk"), "days_to_exploit", "cvss").select(
        "l_orderkey", "l_linenumber", "within_30", "within_60", "within_90", "zero_day", "high_cvss")


# S16 (rows-only: seeded generator, distribution not value equality)
@query("synth_generate")
def q_synth_generate(spark, sf):
    return Y.synth_generate(table(spark, sf, "customer"), "c_custkey", seed=1945)


# P15
@query("type_profile", """
select case when props is null then 'null' when not json_valid(props) then 'not json'
  when json_type(props) = 'OBJECT' then 'OBJECT<' || list_aggregate(list_transform(json_keys(props), lambda k: k || ': ' ||
    case json_type(props, '$.' || k) when 'UBIGINT' then 'BIGINT' when 'VARCHAR' then 'STRING' else json_type(props, '$.' || k) end), 'string_agg', ', ') || '>'
  else json_type(props) end as value_type, count(*) as count from events group by 1""")
def q_type_profile(spark, sf):
    return N.type_profile(table(spark, sf, "events"), "props")
