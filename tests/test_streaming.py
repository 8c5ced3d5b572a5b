import json
import os
import tempfile

from pyspark.sql import functions as F

from riskspan.streaming import start_cve_ingest


def _clean(docs):
    rec = F.from_json("doc", "cveMetadata struct<cveId:string, state:string>")
    return docs.select(rec["cveMetadata"]["cveId"].alias("cve_id"), rec["cveMetadata"]["state"].alias("state"))


def test_incremental_ingest_resumes(spark):
    src = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/out"
    ck = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for i in range(3):
        json.dump({"cveMetadata": {"cveId": f"CVE-2024-{1000 + i}", "state": "PUBLISHED"}},
                  open(os.path.join(src, f"CVE-2024-{1000 + i}.json"), "w"))
    open(os.path.join(src, "CVE-2024-9999.json"), "w").write("{broken")
    q = start_cve_ingest(spark, src, out, _clean, checkpoint=ck)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 3
    assert [r.doc for r in spark.read.parquet(out + "-rejects").collect()] == ["{broken"]
    json.dump({"cveMetadata": {"cveId": "CVE-2024-2000", "state": "PUBLISHED"}},
              open(os.path.join(src, "CVE-2024-2000.json"), "w"))
    q = start_cve_ingest(spark, src, out, _clean, checkpoint=ck)   # resumes from the checkpoint
    q.awaitTermination(120)
    ids = sorted(r.cve_id for r in spark.read.parquet(out).collect())
    assert ids == ["CVE-2024-1000", "CVE-2024-1001", "CVE-2024-1002", "CVE-2024-2000"]
