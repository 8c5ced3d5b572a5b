import pytest
from pyspark.sql import functions as F

from riskspan.functions import clean as C


def test_standardize_nulls_golden(spark):
    df = spark.createDataFrame(
        [("", 1.0, ["", "x"]), ("n/a", float("nan"), ["None", "y"]), ("None", 2.0, None), ("none", None, ["n/a"])],
        "s string, d double, a array<string>")
    rows = C.standardize_nulls(df).collect()
    assert [r.s for r in rows] == [None, None, None, "none"]
    assert [r.d for r in rows] == [1.0, None, 2.0, None]
    assert [r.a for r in rows] == [[None, "x"], [None, "y"], None, [None]]


def test_standardize_nulls_idempotent(spark):
    df = spark.createDataFrame([("", "a"), ("n/a", "None")], "a string, b string")
    once = C.standardize_nulls(df)
    assert once.collect() == C.standardize_nulls(once).collect()


@pytest.mark.parametrize("raw,backup,repair,want", [
    ("cve-2021-1234", None, False, "CVE-2021-1234"),
    ("see CVE-2019-12345 for details", None, False, "CVE-2019-12345"),
    ("CVE-2020-12345678", None, False, "CVE-2020-1234567"),
    ("2021-1234", None, False, None),
    ("2021-1234", None, True, "CVE-2021-1234"),
    ("CVE-1998-1234", None, False, None),
    (None, ["junk", "cve-2022-0042"], False, "CVE-2022-0042"),
    ("n/a", ["nothing here"], False, None),
])
def test_validate_id(spark, raw, backup, repair, want):
    df = spark.createDataFrame([(raw, backup)], "p string, b array<string>")
    got = df.select(C.validate_id("p", "b" if backup is not None else None, repair=repair).alias("v")).first().v
    assert got == want


def test_flatten_singletons(spark):
    df = spark.createDataFrame([(1, ["a"], ["x", "y"], []), (2, ["b"], ["z"], ["q"])],
                               "k int, one array<string>, many array<string>, e array<string>")
    out, report = C.flatten_singletons(df, ["one", "many", "e"], key="k")
    assert dict(out.dtypes)["one"] == "string"
    assert dict(out.dtypes)["many"].startswith("array")
    assert report["many"] == (1, [1])
    assert [r.e for r in out.orderBy("k").collect()] == [None, "q"]
    with pytest.raises(ValueError):
        C.flatten_singletons(df, ["many"], on_multi="error")


def test_subtable_explode_pads_and_keeps_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"]), (2, [], [])], "id int, p array<string>, q array<string>")
    rows = C.subtable_explode(df, "id", ["p", "q"], "t").orderBy("id", "p").collect()
    assert [(r.id, r.p, r.q, r.source_table) for r in rows] == [
        (1, "a", "x", "t"), (1, "b", None, "t"), (2, None, None, "t")]
    with pytest.raises(KeyError):
        C.subtable_explode(df, "id", ["nope"], "t")


def test_trim_and_convert(spark):
    df = spark.createDataFrame([("\t a \n", "12", "x")], "a string, n string, b string")
    r = C.convert_types(C.trim_strings(df), {"int": ["n"], "float": ["b"]}).first()
    assert (r.a, r.n, r.b) == ("a", 12, None)
    with pytest.raises(ValueError):
        C.convert_types(df, {"weird": ["a"]})


def test_small_functions(spark):
    df = spark.createDataFrame([(["a", "", None, "b"], "CWE-1, CWE-2 ", "Yes", "3.1")],
                               "l array<string>, s string, f string, v string")
    r = df.select(C.concat_list("l", "-").alias("c"), C.split_to_array("s").alias("sp"),
                  C.booleanize("f").alias("b"), C.replace_values("v", {"3.1": "V3.1"}).alias("rv"),
                  C.encode_ordinal("f", {"Yes": 1, "No": 2}).alias("o"), C.array_flag("l", "b").alias("fl"),
                  C.first_item("l").alias("fi")).first()
    assert r.c == "a-b" and r.sp == ["CWE-1", "CWE-2"] and r.b is True
    assert r.rv == "V3.1" and r.o == 1 and r.fl is True and r.fi == "a"
    assert spark.createDataFrame([(None,)], "l array<string>").select(
        C.concat_list("l").alias("c"), C.split_to_array(F.lit(None).cast("string")).alias("s")).first() == ("", [])
