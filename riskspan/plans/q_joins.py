"""Join, backbone, score-lookup and date-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspan.functions import dates as D
from riskspan.operators.joins import (exploit_backbone, exploit_rollup,
                                      left_join_indicator, outer_join_origin)
from riskspan.plans.fixtures import cte, fx
from riskspan.plans.q_core import (BACKBONE_SQL, EPSS_SQL, XDB_SQL, backbone,
                                   epss_table, least2)
from riskspan.plans.registry import query
from riskspan.sources.exploitdb import earliest_exploit
from riskspan.sources.scores import (filter_score_era, score_at_offsets,
                                     score_missing)


# Q14
@query("exploit_backbone", cte("fx_poc", "fx_xdb_rows", "fx_kev") + ", " + BACKBONE_SQL + " select * from backbone")
def q_exploit_backbone(spark, sf):
    return backbone(spark, sf)


# J1
@query("left_join_indicator", cte("fx_kev", "fx_nvd") + """
select k.cve_id, k.kev_date_published, n.cvss, n.cvss_version, n.date_published,
  case when n.cve_id is not null then 'both' else 'left_only' end as _merge
from fx_kev k left join fx_nvd n on n.cve_id = k.cve_id""")
def q_left_join_indicator(spark, sf):
    return left_join_indicator(fx(spark, sf, "fx_kev"), fx(spark, sf, "fx_nvd"), "cve_id")


# J2 / J6 / F30
@query("outer_join_origin", cte("fx_poc", "fx_xdb") + """
select coalesce(p.cve_id, x.cve_id) as cve_id, p.exploit_count as exploit_count_poc, p.earliest_date as earliest_date_poc,
  x.exploit_count as exploit_count_xdb, x.earliest_date as earliest_date_xdb,
  case when p.cve_id is not null and x.cve_id is not null then 'poc_xdb' when p.cve_id is not null then 'poc' else 'xdb' end as _merge1
from fx_poc p full outer join fx_xdb x on p.cve_id = x.cve_id""")
def q_outer_join_origin(spark, sf):
    return outer_join_origin(fx(spark, sf, "fx_poc"), fx(spark, sf, "fx_xdb"), "cve_id",
                             suffixes=("_poc", "_xdb"), labels=("poc", "xdb", "poc_xdb"), indicator="_merge1")


# A1 / F31
@query("exploit_rollup", cte("fx_poc", "fx_xdb") + """
, u as (select cve_id, exploit_count, earliest_date, 'poc' as src from fx_poc
        union all select cve_id, exploit_count, earliest_date, 'xdb' as src from fx_xdb),
r as (select *, row_number() over (partition by cve_id order by earliest_date is null, earliest_date, src) as rn from u)
select cve_id, cast(sum(coalesce(exploit_count, 0)) as bigint) as exploit_count, min(earliest_date) as earliest_date,
  min(case when rn = 1 then src end) as src
from r where cve_id is not null group by cve_id""")
def q_exploit_rollup(spark, sf):
    u = (fx(spark, sf, "fx_poc").withColumn("src", F.lit("poc"))
         .unionByName(fx(spark, sf, "fx_xdb").withColumn("src", F.lit("xdb"))))
    return exploit_rollup(u)


# S15
@query("earliest_exploit", cte("fx_xdb_rows", "fx_cve") + ", " + XDB_SQL + """
select c.cve_id, x.earliest_date, coalesce(x.exploit_count, 0) as exploit_count, coalesce(x.poc_code, 'NO') as poc_code,
  x.first_poc_type, x.first_poc_platform, x.first_poc_port, x.verified
from (select distinct cve_id from fx_cve) c left join xdb x on x.cve_id = c.cve_id""")
def q_earliest_exploit(spark, sf):
    return earliest_exploit(fx(spark, sf, "fx_xdb_rows"), cves=fx(spark, sf, "fx_cve"))


OFFSETS = [0, 30, 60]


# S13 / J4
@query("score_at_offsets", cte("fx_first_exploit", "fx_epss_hist") + """
, wanted as (
  select cve_id, cast(earliest_date as timestamp) as epss_date, o.off,
         cast(earliest_date as timestamp) + to_days(o.off) as query_date
  from fx_first_exploit, (values (0), (30), (60)) o(off)
  where earliest_date is not null and cast(earliest_date as timestamp) >= timestamp '2021-04-14'),
looked as (select w.*, h.epss, h.percentile from wanted w
  left join fx_epss_hist h on h.cve_id = w.cve_id and h.score_date = cast(w.query_date as date))
select cve_id, epss_date,
  max(case when off = 0 then query_date end) as epss_date_0, max(case when off = 0 then epss end) as epss_0,
  max(case when off = 0 then percentile end) as percentile_0,
  max(case when off = 30 then query_date end) as epss_date_30, max(case when off = 30 then epss end) as epss_30,
  max(case when off = 30 then percentile end) as percentile_30,
  max(case when off = 60 then query_date end) as epss_date_60, max(case when off = 60 then epss end) as epss_60,
  max(case when off = 60 then percentile end) as percentile_60
from looked group by cve_id, epss_date""")
def q_score_at_offsets(spark, sf):
    wanted = filter_score_era(fx(spark, sf, "fx_first_exploit"))
    return score_at_offsets(wanted, fx(spark, sf, "fx_epss_hist"), offsets=OFFSETS)


# S14 / J5
@query("score_missing", cte("fx_first_exploit", "fx_epss_hist") + """
, wanted as (
  select cve_id, cast(cast(earliest_date as timestamp) + to_days(o.off) as date) as d
  from fx_first_exploit, (values (0), (30), (60)) o(off)
  where earliest_date is not null and cast(earliest_date as timestamp) >= timestamp '2021-04-14')
select w.cve_id, strftime(w.d, '%Y-%m-%d') as date, 'No records available.' as reason
from wanted w where not exists (select 1 from fx_epss_hist h where h.cve_id = w.cve_id and h.score_date = w.d)""")
def q_score_missing(spark, sf):
    wanted = filter_score_era(fx(spark, sf, "fx_first_exploit"))
    return score_missing(wanted, fx(spark, sf, "fx_epss_hist"), offsets=OFFSETS)


# P8
@query("filter_score_era", """
select l_orderkey, l_shipdate from lineitem where l_shipdate is not null and l_shipdate >= timestamp '1998-04-14'""")
def q_filter_score_era(spark, sf):
    from riskspan.plans.fixtures import table
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    return filter_score_era(li, "l_shipdate", start="1998-04-14")


# Q7
@query("epss_clean", cte("fx_first_exploit", "fx_epss_hist") + ", " + EPSS_SQL + " select * from epss")
def q_epss_clean(spark, sf):
    return epss_table(spark, sf)


# A26
@query("score_by_offset_stats", cte("fx_first_exploit", "fx_epss_hist") + ", " + EPSS_SQL + """
select o.off as "offset", count(v) as n, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std
from epss, (values (0), (30), (60)) o(off),
  lateral (select case o.off when 0 then epss_0 when 30 then epss_30 else epss_60 end as v)
group by o.off""")
def q_score_by_offset_stats(spark, sf):
    from riskspan.operators.stats import stats_by_offset
    df = stats_by_offset(epss_table(spark, sf))
    return df.select("offset", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


# F20
@query("percent_change", cte("fx_epss_hist") + """
select cve_id, score_date, round((percentile - epss) / nullif(epss, 0) * 100.0, 6) as change from fx_epss_hist""")
def q_percent_change(spark, sf):
    h = fx(spark, sf, "fx_epss_hist")
    return h.select("cve_id", "score_date", F.round(D.percent_change("epss", "percentile"), 6).alias("change"))


# F21
@query("earliest_date", cte("fx_cve") + f"select k, {least2('publish_date', 'public_date')} as earliest from fx_cve")
def q_earliest_date(spark, sf):
    return fx(spark, sf, "fx_cve").select("k", D.earliest_date("publish_date", "public_date").alias("earliest"))


# F22
@query("days_between", cte("fx_cve") + """
select k, floor(date_diff('microsecond', public_date, publish_date + interval 7 hour) / 86400000000.0) as days_to_poc_exploit
from fx_cve""")
def q_days_between(spark, sf):
    c = fx(spark, sf, "fx_cve")
    end = F.col("publish_date") + F.expr("INTERVAL 7 HOURS")
    return c.select("k", D.days_between("public_date", end).alias("days_to_poc_exploit"))


# F23
@query("date_offsets", cte("fx_poc") + """
select cve_id, earliest_date + interval 30 day as date_30, earliest_date + interval 60 day as date_60 from fx_poc""")
def q_date_offsets(spark, sf):
    p = fx(spark, sf, "fx_poc")
    return p.select("cve_id", D.add_days("earliest_date", 30).alias("date_30"), D.add_days("earliest_date", 60).alias("date_60"))
