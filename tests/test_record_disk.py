"""What the record jobs write and shuffle: packed documents, one exchange without metrics."""

import glob
import gzip
import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from riskspan.catalog import CVSS_METRICS, CVSS_TRANSLATIONS
from riskspan.functions import cvss as V
from riskspan.plans import q_files
from riskspan.plans.fixtures import FX
from riskspan.plans.jobs import cve_clean, cve_record_tables
from riskspan.sources.files import save_table

VECTORS = [None, "", "n/a", "None", "/", ":", "AV:N", "AV:N/AV:L", "AV:L/AV:Q", "AV: N /AC:H", "AV:N/x:y:z/AC:L", "AV:N//AC:L/E",
           "x:y:z/AV:N", "CVSS:3.1/AV:P/AC:H/PR:N/UI:R/S:C/C:H/I:L/A:N/E:P/RL:W/RC:C", "AV:N/AC:L/Au:N/C:P/I:P/A:C/CDP:LM", "av:N", ":AV/AV:",
           "CVSS:4.0/AV:A/AC:L/AT:P/PR:H/UI:A/VC:N/VI:L/VA:H/SC:N/SI:L/SA:H/S:P/AU:Y/R:I/V:C/RE:M/U:Red/MAV:N"]


def decoded(vector, version):
    found = {}
    for token in (vector or "").split("/"):
        if token.count(":") > 1:
            break
        if ":" in token:
            key, value = token.split(":")
            found[key.strip(" ")] = value.strip(" ")
    return [CVSS_TRANSLATIONS[version][key].get(found.get(key)) for key in CVSS_METRICS[version]]


def test_metrics_against_brute_force(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VECTORS)], "i int, v string")
    for version in ("v2", "v3", "v4"):
        for first in (True, False):
            rows = V.cvss_metrics(df, "v", version, first).orderBy("i").collect()
            for r, v in zip(rows, VECTORS, strict=True):
                assert [r[c] for c in V.metric_columns(version)] == decoded(v, version), (v, version, first)


def test_equal_rows_are_dropped_before_vectors_are_decoded(spark):
    schema = ("cve_id string, cve_state string, cvss_v2 double, cvss_v3 double, cvss_v4 double, cvss_v2_vector string, cvss_v3_vector string, "
              "cvss_v4_vector string, mitre_cve_publish_date timestamp_ntz, mitre_cve_public_date timestamp_ntz")
    one = ("CVE-2020-1000", "PUBLISHED", 5.0, 9.8, None, "AV:N/AC:L/Au:N/C:P/I:P/A:C", "CVSS:3.1/AV:P/AC:H/C:N", None, None, None)
    rows = [one, one, one[:5] + ("n/a",) + one[6:], one[:5] + ("",) + one[6:], one[:5] + (None,) + one[6:],
            one[:3] + (3.95,) + one[4:], one[:3] + (0.0,) + one[4:], one[:4] + (0.0,) + one[5:], ("none",) + one[1:], (None,) + one[1:],
            one[:1] + ("REJECTED",) + one[2:]]
    df = cve_clean(spark.createDataFrame(rows, schema))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # before: three joins of whole rows
    aggregate = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "cvss_v2_vector" in aggregate and "privileges" not in aggregate and "attack_vector" not in aggregate
    got = sorted((r.cve_id or "", r.cvss, r.cvss_src, r.cvss_severity, r.cvss_severity_src, r.cvss_v2_vector or "", r.attack_vector_src or "",
                  r.authentication or "") for r in df.collect())
    v2, none = one[5], CVSS_TRANSLATIONS["v2"]["Au"]["N"]
    null = None if none in ("", "n/a", "None") else none
    kept = [("CVE-2020-1000", 9.8, "V3", "Critical", "V3"), ("CVE-2020-1000", 3.95, "V3", "MEDIUM", "V2"),
            ("CVE-2020-1000", 0.0, "V3", None, "V3"), ("CVE-2020-1000", 0.0, "V4", None, "V4"), ("", 9.8, "V3", "Critical", "V3")]
    shown = {(g[0], g[1], g[2], g[4], g[5]) for g in got}
    assert len(got) == 6 and all(g[7] == ((null or "") if g[5] else "") and g[6] == "V3" for g in got)
    assert shown == {(k[0], k[1], k[2], k[4], v2) for k in kept} | {("CVE-2020-1000", 9.8, "V3", "V3", "")}


def test_documents_are_written_packed(spark, monkeypatch):
    orders = spark.range(0, 2500, numPartitions=2).select(
        F.col("id").alias("o_orderkey"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 900 as int))").alias("o_orderdate"))
    orders.createOrReplaceTempView("record_orders")
    monkeypatch.setattr(q_files, "fx", lambda s, sf, name: s.sql(FX[name].replace("from orders)", "from record_orders)")))
    monkeypatch.setattr(q_files, "table", lambda s, sf, name: orders)
    monkeypatch.setattr(q_files, "PACKED_DOCUMENTS", 400)
    good, bad = q_files._scan_records(spark, "", "fx_cve_rec")
    assert good.count() == 2500 and bad.count() == 3
    files = [f.removeprefix("file://").removeprefix("file:") for f in good.inputFiles()]
    assert files and all(f.endswith(".txt.gz") for f in files)
    texts = [gzip.open(f).read() for f in files]
    # before: plain text
    assert sum(map(os.path.getsize, files)) * 5 < sum(map(len, texts)) and max(t.count(b"\n") for t in texts) <= 400
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tables = cve_record_tables(good, folder)
    published = 2500 - 125
    assert [tables[t].count() for t in ("cve", "cve_product", "cve_cwe_connection")] == [published] * 3
    saved = [f for t in ("extracted", *tables) for f in glob.glob(f"{folder}/{t}/*.parquet")]
    assert saved and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in saved if pq.ParquetFile(f).metadata.num_rows)


def test_sink_is_compressed(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    save_table(spark.range(100), f"{folder}/t", "parquet")
    found = glob.glob(f"{folder}/t/*.parquet")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in found} == {"ZSTD"}
    assert spark.read.parquet(f"{folder}/t").count() == 100
