import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from riskspan.operators.filters import keyword_filter
from riskspan.sources import cwe as W
from riskspan.sources import nested as N


def found(spark, doc, paths):
    text = json.dumps(doc)
    return spark.createDataFrame([(text,)], "doc string").select(N.deep_search("doc", paths)).first()[0]


def test_deep_search_semantics(spark):
    doc = {"a": {"x": {"b": {"c": 1}}, "c": 9}, "other": [{"a": {"c": [2, 3]}}]}
    assert found(spark, doc, ["a.c"]) == ["9", "2", "3"]
    assert found(spark, doc, ["a.b.c"]) == ["1"]
    assert found(spark, doc, ["nope.c"]) == [None]
    assert found(spark, doc, ["nope", "a.c"]) == ["9", "2", "3"]
    # a non-final hit descends and the dict's values are searched again: duplicates
    assert found(spark, {"a": {"a": {"c": 1}}}, ["a.c"]) == ["1", "1"]


def test_json_scan_rejects_broken_file(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{d}/2024/1xxx")
    json.dump({"cveMetadata": {"cveId": "CVE-2024-1000"}}, open(f"{d}/2024/1xxx/CVE-2024-1000.json", "w"))
    open(f"{d}/2024/1xxx/CVE-2024-1001.json", "w").write("{not json")
    json.dump({"meta": 1}, open(f"{d}/delta.json", "w"))      # metadata file: not matched by the glob
    good, bad = N.scan_json_documents(spark, d, schema="cveMetadata struct<cveId:string>")
    assert [r.rec.cveMetadata.cveId for r in good.collect()] == ["CVE-2024-1000"]
    assert [r.file_path.rsplit("/", 1)[1] for r in bad.collect()] == ["CVE-2024-1001.json"]


def test_poc_listing_missing_created_at(spark):
    listing = json.dumps([{"name": "CVE-2020-0001-poc", "created_at": "2020-02-01T00:00:00"},
                          {"name": "other", "topics": ["x"]}])
    df = spark.createDataFrame([(listing,)], "listing string")
    r = N.poc_file_summary(df, "listing").first()
    assert (r.cve_id, r.exploit_count, r.earliest_date) == ("CVE-2020-0001-poc", 2, "2020-02-01T00:00:00")


def test_keyword_filter_golden(spark):
    rows = [(1, "Firmware of the modbus gateway and the PLC"),   # case-sensitive hit wins
            (2, "An OPC UA server"),                             # OPC precedes OPC UA
            (3, "PLCs and EMSx are not whole words"),
            (4, "smart GRID operators"),
            (5, None)]
    df = spark.createDataFrame(rows, "id int, d string")
    got = {r.id: r.matched_keyword for r in keyword_filter(df, "d").collect()}
    assert got == {1: "PLC", 2: "OPC", 4: "smart GRID"}


def test_cwe_xml_children(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    open(f"{d}/cwe.xml", "w").write(
        '<Weakness_Catalog><Weaknesses>'
        '<Weakness ID="79" Name=" XSS "><Description>lead<b>x</b>tail</Description>'
        '<Common_Consequences><Consequence><Scope>A</Scope><Scope>B</Scope><Impact>I</Impact></Consequence>'
        '<Consequence><Scope>C</Scope></Consequence></Common_Consequences>'
        '<Applicable_Platforms><Language Name="C" Prevalence="Often"/><Technology Class="Web"/></Applicable_Platforms>'
        '</Weakness><Weakness ID="80" Name="Y"/></Weaknesses></Weakness_Catalog>')
    w = W.read_weaknesses(spark, d)
    e = {r.cwe_id: r for r in W.extract_weaknesses(w).collect()}
    assert e["79"].cwe_name == "XSS" and e["79"].cwe_desc == "lead"
    assert e["79"].cwe_consequence_scope == ["A", "C"] and e["79"].cwe_consequence_impact == ["I", ""]
    assert e["80"].cwe_desc == "" and e["80"].cwe_consequence_scope == []
    plats = sorted((r.cwe_id, r.type, r.name) for r in W.extract_platforms(w).collect())
    assert plats == [("79", "Language", "C"), ("79", "Technology", None)]


def test_search_order_and_list_ends(spark):
    # a match that goes deeper comes before the other members; members keep their order
    assert found(spark, {"x": {"a": {"b": 1}}, "a": {"b": 2}}, ["a.b"]) == ["2", "1"]
    assert found(spark, {"z": {"b": 1}, "c": {"b": 2}, "a": {"b": 3}}, ["b"]) == ["1", "2", "3"]
    # of a list only the last item decides whether the next path is tried
    doc = {"l": [{"a": 1}, {"z": 0}], "b": 5}
    assert found(spark, doc, ["l.a", "b"]) == ["1", "5"]
    assert found(spark, {"l": [{"z": 0}, {"a": 1}], "b": 5}, ["l.a", "b"]) == ["1"]
    assert found(spark, {"a": {"a": 3}}, ["a"]) == ['{"a":3}']
    assert found(spark, [], ["a"]) == [None]


def plain_search(doc, keys, again):
    """Nested recursion over parsed values, hits in match order."""
    if isinstance(doc, list):
        return [h for item in doc for h in plain_search(item, keys, again)]
    if not isinstance(doc, dict):
        return []
    if keys[0] in doc and len(keys) == 1:
        return [doc[keys[0]]]
    deeper = plain_search(doc[keys[0]], keys[1:], again) if keys[0] in doc else []
    beside = [h for v in doc.values() for h in plain_search(v, keys, again)] if again or keys[0] not in doc else []
    return deeper + beside


def test_search_of_random_documents(spark):
    rng = random.Random(8)

    def value(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.25:
            return rng.choice([1, 2.5, "t", "{x", "[", "", None, True, "a\"b"])
        if kind < 0.45:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("abcd"): value(depth - 1) for _ in range(rng.randint(0, 3))}

    def text(v):
        return v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"), sort_keys=True)

    docs = [value(6) for _ in range(150)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(-1, "{broken"), (-2, None)], "i int, doc string")
    for path in ("a", "a.b", "c.a.d"):
        rows = df.select("i", N.path_hits("doc", path)["items"].alias("every"), N.first_or_flat("doc", path).alias("first")).collect()
        for r in rows:
            if r.i < 0:
                assert r.every is None and r.first is None
                continue
            hits = plain_search(docs[r.i], path.split("."), True)
            assert [x for h in r.every for x in h] == [text(x) for h in hits for x in (h if isinstance(h, list) else [h])]
            own = plain_search(docs[r.i], path.split("."), False)
            flat = [text(x) for h in own for x in (h if isinstance(h, list) else [h])]
            assert r.first == (flat if any(isinstance(h, list) for h in own) else flat[:1] or None)


def test_deep_documents(spark):
    doc = '{"a":' * 60 + '{"end": [1, 2]}' + "}" * 60
    df = spark.createDataFrame([(doc,), (" \n" + doc,)], "doc string")
    assert [r[0] for r in df.select(N.first_or_flat("doc", "a.end")).collect()] == [["1", "2"]] * 2


def test_poc_fields_and_backup_ids(spark):
    from riskspan.plans.jobs import poc_clean
    listings = [[{"name": "x CVE-2021-1234 y", "created_at": "2021-03-01T00:00:00Z", "forks_count": 3, "topics": ["poc"]},
                 {"name": "z", "created_at": "2021-02-01T00:00:00Z", "owner": {"visibility": "public"}, "topics": ["a", "b"]}],
                [{"name": "no id", "created_at": "2022-01-01T00:00:00Z", "topics": ["exploit", " cve-2020-99 ", "cve-2020-7777"]}],
                [{"name": "none", "created_at": "2022-01-01T00:00:00Z", "topics": []}]]
    df = spark.createDataFrame([(json.dumps(x),) for x in listings], "listing string")
    rows = N.poc_extract(df, "listing").collect()
    assert [(r.exploit_count, r.earliest_date, r.cve_id, r.poc_forks, r.poc_visibility, r.poc_topics) for r in rows] == [
        (2, "2021-02-01T00:00:00Z", "x CVE-2021-1234 y", "3", "public", ["poc", "a", "b"]),
        (1, "2022-01-01T00:00:00Z", "no id", None, None, ["exploit", " cve-2020-99 ", "cve-2020-7777"]),
        (1, "2022-01-01T00:00:00Z", "none", None, None, [])]
    cleaned = poc_clean(N.poc_extract(df, "listing"))
    assert cleaned.columns == ["exploit_count", "earliest_date", "cve_id"]
    assert sorted(r.cve_id for r in cleaned.collect()) == ["CVE-2020-7777", "CVE-2021-1234"]


def test_record_tables(spark):
    from riskspan.plans.jobs import cve_record_tables
    from riskspan.sources.files import save_tables
    doc = {"cveMetadata": {"cveId": " cve-2024-1000 ", "state": "PUBLISHED"}, "containers": {"cna": {
        "descriptions": [{"lang": "en", "value": "one"}], "affected": [{"vendor": "v", "product": "p"}, {"vendor": "w"}],
        "problemTypes": [{"descriptions": [{"lang": "EN", "description": "d", "cweId": "CWE-1"}, {"lang": "fr", "description": "e"}]}]}}}
    rejected = {"cveMetadata": {"cveId": "CVE-2024-1001", "state": "REJECTED"}}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(rejected),)], "doc string")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tables = cve_record_tables(df, folder)
    assert sorted(os.listdir(folder)) == ["cve", "cve_cwe_connection", "cve_product", "extracted"]
    assert [r.cve_id for r in tables["cve"].collect()] == ["CVE-2024-1000"]
    assert [(r.cve_id, r.cwe_id, r.cwe_desc) for r in tables["cve_cwe_connection"].collect()] == [("CVE-2024-1000", ["CWE-1"], ["d"])]
    assert [(r.vendor, r["product"]) for r in tables["cve_product"].collect()] == [(["v", "w"], ["p"])]
    child = spark.createDataFrame([("CVE-2024-1000",), ("CVE-1999-0001",), (None,)], "cve_id string")
    with pytest.raises(ValueError, match="CVE-1999-0001"):
        save_tables({"cve": tables["cve"], "child": child}, tempfile.mkdtemp(prefix="run-", dir="/tmp"), parent="cve", key="cve_id")


def test_typed_fields_of_a_record(spark):
    score = lambda s, v: {"baseScore": s, "vectorString": v}
    doc = {"cveMetadata": {"cveId": "CVE-2024-1000", "state": "PUBLISHED"},
           "containers": {"cna": {"descriptions": [{"lang": "en", "value": "one"}, {"lang": "de", "value": "zwei"}],
                                  "problemTypes": [{"descriptions": [{"lang": "en", "description": "d", "cweId": "CWE-1"}]}],
                                  "metrics": [{"cvssV3_1": score(9.8, "a")}, {"cvssV3_1": score(10.0, "b")}],
                                  "source": {"discovery": "EXTERNAL"}},
                          "adp": [{"problemTypes": [{"descriptions": [{"cweId": "CWE-2"}]}],
                                   "metrics": [{"other": {"type": "kev"}},
                                               {"other": {"type": "ssvc", "content": {"options": [
                                                   {"Exploitation": "active"}, {"Technical Impact": "total"}]}}}]}]}}
    df = spark.createDataFrame([(json.dumps(doc),), ("{broken",)], "doc string")
    good, bad = N.extract_cve_fields(df, "doc").collect()
    assert good.cve_id == ["CVE-2024-1000"] and good.cve_desc == ["one", "zwei"]
    assert good.cvss_v3_1 == [9.8, 10.0] and good.cvss_v3_1_vector == ["a", "b"] and good.cvss_v2 == [None]
    assert good.cwe_id == ["CWE-1", "CWE-2"] and good.cwe_desc[0].description == "d"
    assert good.is_kev == ["kev", "ssvc"] and good.ssvc_exploitation == ["active"] and good.ssvc_tech_impact == ["total"]
    assert good.cve_discovery == ["EXTERNAL"] and all(v == [None] for v in bad)


def test_extract_then_clean(spark):
    from riskspan.plans.jobs import cve_clean
    score = lambda s, v: {"baseScore": s, "vectorString": v}
    doc = {"cveMetadata": {"cveId": " cve-2024-1000 ", "state": "PUBLISHED", "datePublished": "2024-02-01T00:00:00"},
           "containers": {"cna": {"descriptions": [{"lang": "en", "value": "one"}],
                                  "metrics": [{"cvssV3_1": score(9.8, "CVSS:3.1/AV:N")}, {"cvssV3_1": score(10.0, "CVSS:3.1/AV:L")}]},
                          "adp": [{"metrics": [{"other": {"type": "kev"}}]}]}}
    rejected = {"cveMetadata": {"cveId": "CVE-2024-1001", "state": "REJECTED"}}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(rejected),)], "doc string")
    rows = cve_clean(N.extract_cve_fields(df, "doc")).collect()
    assert [(r.cve_id, r.cvss, r.kev, r.cve_desc) for r in rows] == [("CVE-2024-1000", 10.0, True, "one")]


def test_weakness_tables(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    open(f"{d}/cwe.xml", "w").write(
        '<Weakness_Catalog><Weaknesses><Weakness ID="79" Name=" XSS "><Description>lead</Description>'
        '<Related_Weaknesses><Related_Weakness Nature="ChildOf" CWE_ID="74"/></Related_Weaknesses>'
        '<Detection_Methods><Detection_Method><Method>Fuzzing</Method><Effectiveness>High</Effectiveness>'
        '<Effectiveness_Notes>None</Effectiveness_Notes></Detection_Method></Detection_Methods>'
        '<Potential_Mitigations><Mitigation><Phase>Build</Phase><Phase>Test</Phase><Description> Do<b>x</b></Description></Mitigation>'
        '</Potential_Mitigations><Applicable_Platforms><Language Name="C" Prevalence="Often"/></Applicable_Platforms>'
        '</Weakness><Weakness ID="80" Name="Y"/></Weaknesses></Weakness_Catalog>')
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    tables = W.cwe_record_tables(W.read_weaknesses(spark, d), folder)
    assert sorted(os.listdir(folder)) == ["cwe", "cwe_consequence_table", "cwe_detection_table", "cwe_mitigation_table", "cwe_platform_table",
                                          "extracted", "related_cwe_table"]
    assert sorted(r.cwe_id for r in tables["cwe"].collect()) == ["CWE-79", "CWE-80"]
    related = {(r.cwe_id, r.cwe_related_id, r.cwe_nature_of_rel) for r in tables["related_cwe_table"].collect()}
    assert related == {("CWE-79", "74", "ChildOf"), ("CWE-80", None, None)}
    found = tables["cwe_detection_table"].where("cwe_id = 'CWE-79'").first()
    assert (found.cwe_detect_method, found.cwe_detect_effectiveness, found.cwe_detect_effect_notes) == ("Fuzzing", "High", None)
    fix = tables["cwe_mitigation_table"].where("cwe_id = 'CWE-79'").first()
    assert (fix.cwe_miti_phase, fix.cwe_miti_desc) == ("Build", "Do")
    assert [tuple(r) for r in tables["cwe_platform_table"].collect()] == [("CWE-79", "Language", "C", None, "Often", "related_cwe_table")]


def test_sample_with_its_summary(spark):
    import datetime as dt
    from riskspan.sources.exploitdb import earliest_exploit
    day = dt.date(2020, 1, 2)
    rows = spark.createDataFrame([("CVE-1", day, "remote", "linux", 0, 1), ("CVE-1", dt.date(2019, 5, 1), "local", "php", 80, 0)],
                                 "cve_id string, date_published date, exploit_type string, platform string, port int, verified int")
    cves = spark.createDataFrame([("CVE-1",), ("CVE-2",), ("CVE-2",)], "cve_id string")
    got = {r.cve_id: (r.exploit_count, r.poc_code, r.first_poc_type, r.verified) for r in earliest_exploit(rows, cves).collect()}
    assert got == {"CVE-1": (2, "YES", "LOCAL", False), "CVE-2": (0, "NO", None, None)}


def test_keys_of_a_parent_are_not_broadcast(spark):
    from riskspan.sources.files import _unknown
    known = spark.createDataFrame([("a", "x" * 50), ("b", "y")], "k string, more string").select("k")
    lost = _unknown(spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "k string"), known, "k")
    assert [r.k for r in lost.collect()] == ["c"]
    assert "Broadcast" not in lost._jdf.queryExecution().executedPlan().toString()


def test_a_document_is_read_once_for_all_fields(spark):
    doc = '{"a": {"n": 1.50}, "b": [{"n": 1e5}, {"n": -0}, {"n": 123456789012345678901234567890}], "c": {"n": {"z": [1, 2.0], "y": "\\u00e9"}}}'
    df = spark.createDataFrame([(doc,), ("{broken",), ('{"a": 1, "a": 2}',)], "doc string")
    out = df.select(*N.deep_searches("doc", {"one": ["a.n"], "more": ["b.nothing", "b.n"], "none": ["x"], "object": ["c.n"]}))
    rows = out.collect()
    assert rows[0].one == ["1.5"] and rows[0].none == [None]
    assert rows[0].more == ["100000.0", "0", "123456789012345678901234567890"]
    assert rows[0].object == ['{"y":"\u00e9","z":[1,2]}']
    assert all(v is None for r in rows[1:] for v in r)
    # one call in one Python stage
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [search(") == 1 and plan.split("ArrowEvalPython [")[1].split("\n")[0].count("search(") == 1
