"""Flagship job and the exploit/score joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspan.plans.fixtures import cte, fx
from riskspan.plans.jobs import compiled_dataset, cve_clean, cve_scores, nvd_clean
from riskspan.plans.registry import query
from riskspan.operators.joins import (exploit_backbone, exploit_rollup,
                                      left_join_indicator, outer_join_origin)
from riskspan.sources.exploitdb import earliest_exploit
from riskspan.sources.scores import (epss_clean, filter_score_era,
                                     score_at_offsets, score_missing)

ID_RE = "(?i)CVE-(1999|20[0-9]{2})-([0-9]{4,7})"


def cve_input(spark, sf):
    """fx_cve shaped like extracted CVE fields."""
    return fx(spark, sf, "fx_cve").select(
        F.col("cve_id_raw").alias("cve_id"), "cve_state", "cvss_v2", "cvss_v3", "cvss_v4",
        "cvss_v2_vector", "cvss_v3_vector", "cvss_v4_vector",
        F.col("publish_date").alias("mitre_cve_publish_date"),
        F.col("public_date").alias("mitre_cve_public_date"))


def backbone(spark, sf):
    xdb = earliest_exploit(fx(spark, sf, "fx_xdb_rows"))
    return exploit_backbone(fx(spark, sf, "fx_poc"), xdb, fx(spark, sf, "fx_kev"))


def epss_table(spark, sf, offsets=(0, 30, 60)):
    wanted = filter_score_era(fx(spark, sf, "fx_first_exploit"))
    return epss_clean(score_at_offsets(wanted, fx(spark, sf, "fx_epss_hist"), offsets=list(offsets)))


# ---- DuckDB texts ---------------------------------------------------------
def least2(a: str, b: str) -> str:
    return f"(case when {a} is null then {b} when {b} is null then {a} else least({a}, {b}) end)"


XDB_SQL = """
xdb_ranked as (
  select *, row_number() over (partition by cve_id order by date_published, exploit_type, platform, port, verified) as rn
  from fx_xdb_rows),
xdb as (
  select a.cve_id, a.earliest_date, a.exploit_count, 'YES' as poc_code,
    upper(r.exploit_type) as first_poc_type, upper(r.platform) as first_poc_platform,
    cast(r.port as varchar) as first_poc_port,
    case when r.verified = 0 then false when r.verified = 1 then true end as verified
  from (select cve_id, min(date_published) as earliest_date, count(*) as exploit_count from fx_xdb_rows group by cve_id) a
  join xdb_ranked r on r.cve_id = a.cve_id and r.rn = 1)"""

BACKBONE_SQL = XDB_SQL + f""",
poc as (select cve_id, cast(sum(exploit_count) as bigint) as exploit_count, min(earliest_date) as earliest_date
        from fx_poc where cve_id is not null group by cve_id),
m1 as (
  select coalesce(p.cve_id, x.cve_id) as cve_id,
    cast(coalesce(p.exploit_count, 0) + coalesce(x.exploit_count, 0) as bigint) as exploit_count,
    {least2('p.earliest_date', 'x.earliest_date')} as earliest_date,
    x.poc_code, x.first_poc_type, x.first_poc_platform, x.first_poc_port, x.verified,
    case when p.cve_id is not null and x.cve_id is not null then 'poc_xdb'
         when p.cve_id is not null then 'poc' else 'xdb' end as m1
  from poc p full outer join xdb x on p.cve_id = x.cve_id),
backbone as (
  select coalesce(m.cve_id, k.cve_id) as cve_id,
    cast(case when m.cve_id is null then 1 else m.exploit_count end as bigint) as exploit_count,
    {least2('m.earliest_date', 'k.kev_date_published')} as earliest_date,
    case when lower(m.poc_code) = 'yes' then true when lower(m.poc_code) = 'no' then false end as poc_code,
    m.first_poc_type, m.first_poc_platform, m.first_poc_port, m.verified,
    case when m.cve_id is null then 'kev' when k.cve_id is not null then 'poc_xdb_kev' else m.m1 end as origin
  from m1 m full outer join fx_kev k on m.cve_id = k.cve_id)"""

EPSS_SQL = """
wanted as (
  select cve_id, cast(earliest_date as timestamp) as epss_date, o.off,
         cast(earliest_date as timestamp) + to_days(o.off) as query_date
  from fx_first_exploit, (values (0), (30), (60)) o(off)
  where earliest_date is not null and cast(earliest_date as timestamp) >= timestamp '2021-04-14'),
looked as (
  select w.*, h.epss, h.percentile from wanted w
  left join fx_epss_hist h on h.cve_id = w.cve_id and h.score_date = cast(w.query_date as date)),
offs as (
  select cve_id, epss_date,
    max(case when off = 0 then query_date end) as epss_date_0,
    max(case when off = 0 then epss end) as epss_0, max(case when off = 0 then percentile end) as percentile_0,
    max(case when off = 30 then query_date end) as epss_date_30,
    max(case when off = 30 then epss end) as epss_30, max(case when off = 30 then percentile end) as percentile_30,
    max(case when off = 60 then query_date end) as epss_date_60,
    max(case when off = 60 then epss end) as epss_60, max(case when off = 60 then percentile end) as percentile_60
  from looked group by cve_id, epss_date),
epss as (
  select distinct upper(nullif(regexp_extract(cve_id, '(?i)CVE-(1999|20[0-9]{2})-([0-9]{4,7})', 0), '')) as cve_id,
    epss_date_0, epss_0, percentile_0, epss_date_30, epss_30, percentile_30, epss_date_60, epss_60, percentile_60,
    (epss_30 - epss_0) / nullif(epss_0, 0) * 100.0 as change_0_to_30,
    (epss_60 - epss_30) / nullif(epss_30, 0) * 100.0 as change_30_to_60,
    (epss_60 - epss_0) / nullif(epss_0, 0) * 100.0 as change_total
  from offs)"""

CVES_SQL = f"""
cves as (
  select distinct upper(nullif(regexp_extract(cve_id_raw, '{ID_RE}', 0), '')) as cve_id,
    {least2('publish_date', 'public_date')} as public_date,
    coalesce(cvss_v4, cvss_v3, cvss_v2) as cvss,
    case when cvss_v4 is not null then 'V4' when cvss_v3 is not null then 'V3' when cvss_v2 is not null then 'V2' end as cvss_src
  from fx_cve where cve_state = 'PUBLISHED')"""

NVD_SQL = """
nvd as (
  select distinct cve_id, cvss,
    case cvss_version when '2.0' then 'V2' when '3.0' then 'V3' when '3.1' then 'V3.1' when '4.0' then 'V4' else cvss_version end as cvss_src,
    date_published
  from fx_nvd)"""


def severity_sql(x: str) -> str:
    return (f"case when {x} >= 9.0 then 'CRITICAL' when {x} >= 7.0 then 'HIGH' when {x} >= 4.0 then 'MEDIUM' "
            f"when {x} > 0.0 then 'LOW' when {x} = 0.0 then 'NONE' else 'UNKNOWN' end")


COMPILED_SQL = cte("fx_poc", "fx_xdb_rows", "fx_kev", "fx_cve", "fx_nvd", "fx_epss_hist", "fx_first_exploit") \
    + ", " + BACKBONE_SQL + ", " + EPSS_SQL + ", " + CVES_SQL + ", " + NVD_SQL + f""",
j as (
  select b.*, c.public_date, c.cvss as cvss_x, c.cvss_src as cvss_src_x,
    e.epss_0, e.percentile_0, e.epss_30, e.percentile_30, e.epss_60, e.percentile_60,
    e.change_0_to_30, e.change_30_to_60, e.change_total,
    n.cvss as cvss_y, n.cvss_src as cvss_src_y, n.date_published
  from backbone b left join cves c on c.cve_id = b.cve_id
  left join epss e on e.cve_id = b.cve_id
  left join nvd n on n.cve_id = b.cve_id),
k as (select *, {least2('public_date', 'date_published')} as date_public,
        coalesce(cvss_x, cvss_y) as cvss, coalesce(cvss_src_x, cvss_src_y) as cvss_src from j)
select cve_id, date_public, origin, cvss, {severity_sql('cvss')} as cvss_severity, cvss_src,
  poc_code, verified, exploit_count,
  cast(floor(date_diff('microsecond', date_public, earliest_date) / 86400000000.0) as double) as days_to_poc_exploit,
  first_poc_type, first_poc_platform, first_poc_port,
  earliest_date as exploitation_date_0, epss_0, percentile_0,
  earliest_date + interval 30 day as exploitation_date_30, epss_30, percentile_30,
  earliest_date + interval 60 day as exploitation_date_60, epss_60, percentile_60,
  change_0_to_30, change_30_to_60, change_total as change_0_to_60
from k"""


@query("compiled_dataset", COMPILED_SQL)
def q_compiled_dataset(spark, sf):
    cves = cve_scores(cve_input(spark, sf))
    nvd = nvd_clean(fx(spark, sf, "fx_nvd"))
    return compiled_dataset(backbone(spark, sf), cves, epss_table(spark, sf), nvd)
