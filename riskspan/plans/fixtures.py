"""Adapter views that shape the driver tables into the reference's inputs.

The same SQL text runs on Spark (as temp views) and on DuckDB (as CTEs in the
oracle), so both engines start from identical rows.  An ID holds the last
seven digits of its key; the digits above move the year on, so that keys below
10**9 have different IDs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def cve_id_sql(key: str, year: str, digits: int = 7, step: int = 1) -> str:
    """CVE-20yy-nnnnnnn of an integer key.  ``year`` (0-99) may depend on the
    last digits of the key only; ``step`` years lie between keys that differ
    by ten million."""
    low = f"cast({key} % 10000000 as varchar(10))"
    above = f"cast(({key} - {key} % 10000000) / 10000000 as bigint)"
    return (f"concat('CVE-20', lpad(cast(({year} + {step} * {above}) % 100 as varchar(4)), 2, '0'), '-', "
            f"lpad({low}, cast(greatest({digits}, length({low})) as int), '0'))")


def _cve(key: str) -> str:
    return cve_id_sql(key, f"{key} % 25")


def _scores(days: int, score: str) -> str:
    """Scores of a third of the exploited CVEs, some days after each exploit
    and moved into the score era; some dates have none."""
    return (f"select {_cve('l_orderkey')} as cve_id, "
            f"cast(l_shipdate + interval '26' year + interval '{days}' day as date) as score_date, {score} as score "
            f"from lineitem where l_returnflag in ('A', 'R') and l_orderkey % 3 = 0 and (l_orderkey + {days}) % 7 <> 1")


USER_CVE = cve_id_sql("user_id", "24")


FX = {
    "fx_cve": f"""
select k, cve_id,
  case when k % 17 = 0 then concat(' ', lower(cve_id), ' ')
       when k % 19 = 0 then 'n/a' when k % 23 = 0 then '' else cve_id end as cve_id_raw,
  case when k % 20 = 0 then 'REJECTED' else 'PUBLISHED' end as cve_state,
  case when k % 3 = 0 then round(cast(k % 101 as double) / 10, 1) end as cvss_v2,
  case when k % 5 <> 0 then round(cast(k % 97 as double) / 10, 1) end as cvss_v3,
  case when k % 11 = 0 then round(cast(k % 89 as double) / 10, 1) end as cvss_v4,
  case when k % 3 = 0 then concat('AV:', substr('NAL', cast(k % 3 as int) + 1, 1), '/AC:', substr('LMH', cast((k % 7) % 3 as int) + 1, 1),
       '/Au:', substr('NSM', cast((k % 5) % 3 as int) + 1, 1), '/C:', substr('NPC', cast((k % 7) % 3 as int) + 1, 1), '/I:', substr('NPC', cast((k % 11) % 3 as int) + 1, 1),
       '/A:', substr('NPC', cast((k % 13) % 3 as int) + 1, 1), case when k % 12 = 0 then '/CDP:LM' else '' end) end as cvss_v2_vector,
  case when k % 5 <> 0 then concat('CVSS:3.1/AV:', substr('NALP', cast(k % 4 as int) + 1, 1), '/AC:', substr('LH', cast((k % 7) % 2 as int) + 1, 1),
       '/PR:', substr('NLHZ', cast((k % 11) % 4 as int) + 1, 1), '/UI:', substr('NR', cast((k % 3) % 2 as int) + 1, 1), '/S:', substr('UC', cast((k % 13) % 2 as int) + 1, 1),
       '/C:', substr('NLH', cast(k % 3 as int) + 1, 1), '/I:', substr('NLH', cast((k % 7) % 3 as int) + 1, 1), '/A:', substr('NLH', cast((k % 11) % 3 as int) + 1, 1),
       case when k % 10 = 1 then '/AV:P' else '' end) end as cvss_v3_vector,
  case when k % 11 = 0 then concat('CVSS:4.0/AV:', substr('NALP', cast(k % 4 as int) + 1, 1), '/AC:', substr('LH', cast(k % 2 as int) + 1, 1), '/AT:', substr('NP', cast(k % 2 as int) + 1, 1),
       '/PR:', substr('NLH', cast(k % 3 as int) + 1, 1), '/UI:', substr('NPA', cast(k % 3 as int) + 1, 1), '/VC:', substr('HLN', cast(k % 3 as int) + 1, 1), '/VI:', substr('HLN', cast((k % 5) % 3 as int) + 1, 1),
       '/VA:', substr('HLN', cast((k % 7) % 3 as int) + 1, 1), '/SC:N/SI:L/SA:H/S:', substr('XPN', cast(k % 3 as int) + 1, 1), '/AU:', substr('NY', cast(k % 2 as int) + 1, 1)) end as cvss_v4_vector,
  case when k % 13 = 0 then null else o_orderdate end as publish_date,
  case when k % 7 = 0 then null when k % 2 = 0 then o_orderdate - interval '3' day
       else o_orderdate + interval '3' day end as public_date
from (select o_orderkey as k, o_orderdate,
             {_cve('o_orderkey')} as cve_id from orders) o""",
    "fx_poc": f"""
select {_cve('l_orderkey')} as cve_id,
  count(*) as exploit_count, min(l_shipdate) as earliest_date
from lineitem where l_returnflag = 'R' group by l_orderkey""",
    "fx_xdb": f"""
select {_cve('l_orderkey')} as cve_id,
  count(*) as exploit_count, min(l_shipdate) as earliest_date
from lineitem where l_returnflag = 'A' group by l_orderkey""",
    "fx_kev": f"""
select {_cve('o_orderkey')} as cve_id,
  o_orderdate as kev_date_published from orders where o_orderstatus = 'P'""",
    "fx_nvd": f"""
select {_cve('o_orderkey')} as cve_id,
  case when o_orderkey % 5 = 0 then null else round(cast(o_orderkey % 100 as double) / 10, 1) end as cvss,
  case o_orderkey % 4 when 0 then '2.0' when 1 then '3.0' when 2 then '3.1' else '4.0' end as cvss_version,
  o_orderdate + interval '1' day as date_published
from orders where o_orderkey % 3 <> 1""",
    "fx_epss_hist": f"""
select cve_id, score_date, round(max(score), 5) as epss, round(min(score) / 2, 5) as percentile
from (""" + "\n  union all ".join(_scores(*x) for x in ((0, "0.01 + l_discount * 5"), (30, "0.01 + l_discount * 4"),
                                                        (60, "0.02 + l_tax * 6"))) + """)
group by cve_id, score_date""",
    "fx_first_exploit": f"""
select {_cve('l_orderkey')} as cve_id, cast(min(l_shipdate) + interval '26' year as date) as earliest_date
from lineitem where l_returnflag in ('A', 'R') and l_orderkey % 3 = 0 group by l_orderkey""",
    "fx_dirty": """
select c_custkey, case when c_custkey % 11 = 0 then 'n/a' when c_custkey % 13 = 0 then '' when c_custkey % 17 = 0 then 'None'
  when c_custkey % 5 = 0 then concat('  ', lower(c_mktsegment), ' ') else c_mktsegment end as category,
  case when c_custkey % 6 = 0 then 'bad' else cast(c_custkey as varchar(10)) end as num_text,
  case c_custkey % 3 when 0 then 'Yes' when 1 then 'no' else 'maybe' end as flag_text,
  case when c_custkey % 4 = 0 then null else c_acctbal end as score
from customer""",
    "fx_risk": """
select l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice,
  case when l_orderkey % 9 = 0 then null else l_quantity / 5 end as cvss,
  case when l_orderkey % 8 = 0 then null else round(l_discount * 10, 2) end as epss_0,
  cast(l_linenumber * 40 as bigint) - 100 as days_to_exploit
from lineitem""",
    # ExploitDB-shaped exploit rows: one row per listed exploit
    "fx_xdb_rows": f"""
select {_cve('l_orderkey')} as cve_id, l_shipdate as date_published,
  case l_linestatus when 'O' then 'remote' else 'webapps' end as exploit_type,
  case l_partkey % 4 when 0 then 'windows' when 1 then 'linux' when 2 then 'php' else 'multiple' end as platform,
  case when l_suppkey % 5 = 0 then 0 else l_suppkey % 1000 + 1 end as port,
  cast(l_linenumber % 3 as int) as verified
from lineitem where l_returnflag = 'A'""",
}

# CVE rows with what their full records hold besides scores: numbers of weakness
# entries, products, solutions; texts follow from k and a place in the list
FX["fx_cve_rec"] = f"""
select c.*, k % 4 as n_cwe, k % 3 as n_aff, k % 3 as n_solutions,
  case k % 4 when 0 then 'External' when 1 then 'internal' when 2 then 'upstream' end as discovery,
  public_date - interval '10' day as reserved, concat('Issue in ', cve_id) as description
from ({FX["fx_cve"]}) c"""

# rows of the compiled dataset's numeric columns
FX["fx_scored"] = """
select *, (epss_30 - epss_0) / nullif(epss_0, 0) * 100.0 as change_0_to_30, (epss_60 - epss_30) / nullif(epss_30, 0) * 100.0 as change_30_to_60,
  (epss_60 - epss_0) / nullif(epss_0, 0) * 100.0 as change_0_to_60
from (select l_orderkey, l_linenumber, case when l_orderkey % 9 = 0 then null else round(l_quantity / 5, 1) end as cvss,
    case when l_orderkey % 8 = 0 then null else round(l_discount * 9, 3) end as epss_0,
    case when l_orderkey % 7 = 0 then null else round(l_discount * 8 + l_tax, 3) end as epss_30,
    case when l_orderkey % 5 = 0 then null else round(l_discount * 7 + l_tax * 2, 3) end as epss_60,
    cast(l_linenumber * 40 - 100 as double) as days_to_poc_exploit, cast(l_partkey % 30 + 1 as bigint) as exploit_count from lineitem) r"""

# rows shaped like the synthetic vulnerability table of the cohort analysis
FX["fx_synth"] = """
select l_orderkey, l_linenumber,
  case when l_orderkey % 9 = 0 then null else round(l_quantity / 5, 1) end as cvss_score,
  cast(l_partkey % 21 as double) / 2 as exploitability_score,
  case when l_orderkey % 8 = 0 then null else round(l_discount * 9, 3) end as epss_on_exploit_date,
  cast(l_suppkey % 13 + l_linenumber as double) as known_exploit_attempts,
  case when l_partkey % 31 = 0 then null else round(l_tax * 10 + l_discount, 2) end as exploit_success_rate,
  cast((l_partkey + l_orderkey) % 200 - 40 as double) as time_to_patch,
  case l_returnflag when 'R' then 'High' when 'A' then 'Medium' else 'Low' end as patch_urgency,
  case l_linestatus when 'O' then 'Patch Available' else 'No Patch' end as patch_availability,
  cast(l_suppkey % 2 as double) as relevant_to_scada,
  cast(l_partkey % 11 as double) as operational_impact_score,
  case when l_suppkey % 6 = 5 then null else cast(l_suppkey % 6 as double) end as device_criticality,
  cast(l_orderkey % 90 as double) as days_to_publish,
  case l_orderkey % 5 when 0 then 'Yes' when 1 then 'unknown' else 'No' end as regulatory_mandate,
  case l_partkey % 3 when 0 then 'Yes' else 'No' end as patch_deployment_success,
  case l_partkey % 7 when 0 then 'Yes' else 'No' end as nation_state_involvement,
  case l_suppkey % 4 when 0 then 'Yes' else 'No' end as insider_access_required,
  case (l_suppkey + l_linenumber) % 3 when 0 then 'Yes' else 'No' end as supply_chain_vulnerability,
  cast((l_linenumber + l_orderkey) % 4 as double) as risk_level,
  case when l_quantity >= 46 and l_linenumber = 1 then 1 else 0 end as high_risk,
  cast(l_suppkey % 3 as double) as threat_actor_attribution,
  round(l_quantity / 8 + l_discount * 10 + cast(l_partkey % 7 as double) / 4, 1) as securegrid_score,
  cast(l_linenumber * 40 - 100 as double) as days_to_exploit_code
from lineitem"""

FX["fx_desc"] = """
select doc_id, case doc_id % 9
    when 0 then concat('Siemens PLC firmware issue. ', text)
    when 1 then concat(text, ' Affects the OPC UA server of the smart grid.')
    when 2 then concat(text, ' Found in Supervisory Control and Data Acquisition (scada) gateways.')
    when 3 then concat('GE digital energy relay; ', text, ' ICS vendors notified.')
    when 4 then concat(text, ' IEC 60870-5-104 and T&D networks; see Modbus notes.')
    when 5 then concat(text, ' EMSx and PLCs are not affected.')
    else text end as description
from documents"""

# fx_cwe needs one text per engine (ordered list aggregation)
FX_CWE_SPARK = """
select conv_id, transform(array_sort(collect_list(struct(turn, role))), x -> x.role) as roles,
       transform(array_sort(collect_list(struct(turn, text))), x -> x.text) as texts
from conversations group by conv_id"""
FX_CWE_DUCKDB = """
select conv_id, list(role order by turn) as roles, list(text order by turn) as texts
from conversations group by conv_id"""


_REGISTERED: dict = {}


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Expose the driver parquet tables as temp views of the same names
    (once per session and folder)."""
    key = id(spark)
    if _REGISTERED.get(key) == sf_dir and spark.catalog.tableExists("lineitem"):
        return
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    _REGISTERED[key] = sf_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter view as a Spark DataFrame."""
    register_tables(spark, sf_dir)
    if name == "fx_cwe":
        return spark.sql(FX_CWE_SPARK)
    return spark.sql(FX[name])


def cte(*names: str) -> str:
    """``WITH`` clause holding the DuckDB text of the named adapter views."""
    parts = []
    for n in names:
        body = FX_CWE_DUCKDB if n == "fx_cwe" else FX[n]
        parts.append(f"{n} as ({body}\n)")
    return "with " + ",\n".join(parts) + "\n"
