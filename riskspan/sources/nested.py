"""Nested-document sources: JSON records (S3-S5), PoC listings (S8/S9),
platform lists (S11), NVD pages (S12), nested search results (S19), value
type profiles (P15).

Known fields are read with typed Spark expressions.  The any-depth path
search (a path ``a.b.c`` matches ``a``, then ``b`` anywhere below it, then
``c`` anywhere below that) is one expression as well: it opens the document
level by level, each object or list into its members.
"""

from __future__ import annotations

import json
import re
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspan.catalog import CVE_FIELD_PATHS, POC_FIELDS


# --- S4 / S9: any-depth path search ---------------------------------------

class _Number(str):
    """A number as the document writes it."""


_PLAIN_INTEGER = re.compile(r"0|-?[1-9][0-9]{0,17}")


def _written(value) -> str:
    """JSON text of a decoded value."""
    if isinstance(value, _Number):
        return value
    if isinstance(value, dict):
        return "{" + ",".join([f"{json.dumps(k)}:{_written(v)}" for k, v in value.items()]) + "}"
    if isinstance(value, list):
        return "[" + ",".join([_written(v) for v in value]) + "]"
    return json.dumps(value)


def _item(value) -> dict:
    """A string as it is, null as null; ``json``: the text is still JSON, for
    Spark to write in its own form."""
    if isinstance(value, _Number):
        return {"text": str(value), "json": _PLAIN_INTEGER.fullmatch(value) is None}
    if isinstance(value, str):
        # a lone surrogate has no UTF-8
        return {"text": value if value.isascii() else value.encode("utf-8", "replace").decode(), "json": False}
    return {"text": None if value is None else _written(value), "json": value is not None}


def _hits_in(doc, keys: list[str], again: bool) -> list[dict]:
    """The hits of one path in a decoded document, in match order."""
    hits, last = [], len(keys) - 1
    left = [(doc, 0, True)]
    while left:
        node, done, live = left.pop()
        if isinstance(node, list):
            end = len(node) - 1
            left += [(v, done, live and i == end) for i, v in reversed(list(enumerate(node))) if isinstance(v, (dict, list))]
        elif isinstance(node, dict):
            there = keys[done] in node
            if there and done == last:
                value = node[keys[done]]
                listed = isinstance(value, list)
                hits.append({"items": [_item(v) for v in (value if listed else [value])], "listed": listed, "live": live})
                continue
            if again or not there:
                left += [(v, done, live) for v in reversed(node.values()) if isinstance(v, (dict, list))]
            if there:
                left.append((node[keys[done]], done + 1, live))
    return hits


_ITEMS = pa.list_(pa.struct([("text", pa.string()), ("json", pa.bool_())]))
_ITEMS_SQL = "array<struct<text: string, json: boolean>>"


def _marks(keys: list[str]) -> list[str]:
    """How keys stand in a text without escapes."""
    return [json.dumps(k, ensure_ascii=False) for k in keys]


def _search(json_col, result: str, arrow: pa.DataType, of_document) -> Column:
    """``of_document`` of every JSON text: it gets a function that gives the
    hits of the keys of a path.  A document is read once."""
    doc = F.col(json_col) if isinstance(json_col, str) else json_col

    @F.arrow_udf(result)
    def search(texts: pa.Array) -> pa.Array:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000))  # Spark reads JSON of depth 1000
        decoder, out = json.JSONDecoder(strict=False, parse_int=_Number, parse_float=_Number), []
        for text in texts.to_pylist():
            if text is None:
                out.append(None)
                continue
            root = decoder.raw_decode(text.lstrip(" \t\r\n"))[0]
            escapes = "\\" in text

            def hits(keys, marks, again):
                return _hits_in(root, keys, again) if escapes or all(m in text for m in marks) else []
            out.append(of_document(hits))
        return pa.array(out, arrow)

    return search(F.when(F.try_parse_json(doc).isNotNull(), doc))


def _texts(items: Column) -> Column:
    def text_of(item):
        return F.when(item["json"], F.variant_get(F.parse_json(item["text"]), "$", "string")).otherwise(item["text"])
    return F.when(F.exists(items, lambda i: i["json"]), F.transform(items, text_of)).otherwise(items["text"])


def path_hits(json_col, path: str, again: bool = True) -> Column:
    """``array<struct<items, listed, live>>``: what ``path`` reaches in a JSON
    text, in match order; ``items``: the value's text, or those of the items of
    a list.  Null for a text that is not JSON.

    A node that holds the next key opens a match one level deeper; with
    ``again`` (S4), unless that key is the last one, the search for the same
    key goes on among all its members as well, so hits may repeat; without
    (S9), only nodes that lack the key are searched further.  ``live`` hits
    end a search of alternatives: of a list only the last item decides.
    """
    keys = path.split(".")
    marks = _marks(keys)
    arrow = pa.list_(pa.struct([("items", _ITEMS), ("listed", pa.bool_()), ("live", pa.bool_())]))
    found = _search(json_col, f"array<struct<items: {_ITEMS_SQL}, listed: boolean, live: boolean>>", arrow, lambda hits: hits(keys, marks, again))
    return F.transform(found, lambda h: F.struct(_texts(h["items"]).alias("items"), h["listed"].alias("listed"), h["live"].alias("live")))


def _fields(json_col, names, of_document) -> list[Column]:
    """A column for each name from ``of_document``'s lists of items."""
    found = _search(json_col, f"array<{_ITEMS_SQL}>", pa.list_(_ITEMS), of_document)
    return [_texts(F.get(found, i)).alias(name) for i, name in enumerate(names)]


def deep_searches(json_col, fields: dict[str, list[str]]) -> list[Column]:
    """For each field an ``array<string>`` of the values of its
    alternatives up to the first whose search succeeds; [null] without any;
    null for a text that is not JSON."""
    wanted = [[(p.split("."), _marks(p.split("."))) for p in paths] for paths in fields.values()]

    def values(hits, paths):
        items = []
        for keys, marks in paths:
            found = hits(keys, marks, True)
            items += [i for h in found for i in h["items"]]
            if any(h["live"] for h in found):
                break
        return items or [{"text": None, "json": False}]

    return _fields(json_col, fields, lambda hits: [values(hits, paths) for paths in wanted])


def deep_search(json_col, paths: list[str]) -> Column:
    """``deep_searches`` for one field."""
    return deep_searches(json_col, {"found": paths})[0]


def first_or_flats(json_col, fields: dict[str, str]) -> list[Column]:
    """For each field (a path) an ``array<string>``: the items of all hits
    if one of them is a list, else the first hit alone; null without any."""
    wanted = [(p.split("."), _marks(p.split("."))) for p in fields.values()]

    def values(found):
        if any(h["listed"] for h in found):
            return [i for h in found for i in h["items"]]
        return found[0]["items"] if found else None

    return _fields(json_col, fields, lambda hits: [values(hits(keys, marks, False)) for keys, marks in wanted])


def first_or_flat(json_col, path: str) -> Column:
    """``first_or_flats`` for one field."""
    return first_or_flats(json_col, {"found": path})[0]


# --- S5: the known fields, typed -------------------------------------------
_SCORE = "struct<baseScore:double, vectorString:string>"
_PROBLEMS = "array<struct<descriptions:array<struct<lang:string, description:string, cweId:string, type:string>>>>"
_AFFECTED = ("array<struct<vendor:string, product:string, defaultStatus:string, cpes:array<string>, "
             "versions:array<struct<version:string, status:string, versionType:string, lessThan:string, "
             "lessThanOrEqual:string>>>>")
_OTHER = ("struct<type:string, content:struct<options:array<struct<Exploitation:string, Automatable:string, "
          "`Technical Impact`:string>>>>")
_METRICS = (f"array<struct<cvssV2_0:{_SCORE}, cvssV3_0:{_SCORE}, cvssV3_1:{_SCORE}, cvssV4_0:{_SCORE}, other:{_OTHER}>>")
_CONTAINER = ("descriptions:array<struct<lang:string, value:string>>, datePublic:string, "
              f"problemTypes:{_PROBLEMS}, affected:{_AFFECTED}, solutions:array<struct<lang:string, value:string>>, "
              f"source:struct<discovery:string>, metrics:{_METRICS}")
CVE_SCHEMA = ("cveMetadata struct<cveId:string, state:string, dateReserved:string, datePublished:string>, "
              f"containers struct<cna:struct<{_CONTAINER}>, adp:array<struct<{_CONTAINER}>>>")


def _member(name: str):
    return lambda x: x.getField(name)


def _reach(root: Column, kind: T.DataType, steps: list[str]) -> Column:
    """``array`` of the values that ``steps`` lead to, lists on the way
    opened, missing values left out."""
    values, is_list = (root, True) if isinstance(kind, T.ArrayType) else (F.array(root), False)
    kind = kind.elementType if is_list else kind
    values = F.filter(F.coalesce(values, F.array().cast(T.ArrayType(kind))), lambda x: x.isNotNull())
    for step in steps:
        inner = kind[step].dataType
        values = F.transform(values, _member(step))
        values = F.filter(values, lambda x: x.isNotNull())
        if isinstance(inner, T.ArrayType):
            values = F.filter(F.flatten(values), lambda x: x.isNotNull())
            inner = inner.elementType
        kind = inner
    return values


def extract_cve_fields(docs: DataFrame, json_col: str, catalogue: dict = CVE_FIELD_PATHS) -> DataFrame:
    """One list-valued column per catalogue field, every value wrapped in
    a list, [null] without any.  Documents are parsed once into a typed
    record; scores are numbers and descriptions keep their language.  A path
    that names a container (cna, adp) looks there, other paths look in both;
    members that are null count as missing."""
    rec = docs.select("*", F.from_json(F.col(json_col), CVE_SCHEMA).alias("_rec"))
    kinds = {f.name: f.dataType for f in rec.schema["_rec"].dataType.fields}
    boxes = {f.name: f.dataType for f in kinds["containers"].fields}
    out = []
    for name, path in catalogue.items():
        steps = path.split(".")
        if steps[0] == "cveMetadata":
            found = _reach(F.col("_rec.cveMetadata"), kinds["cveMetadata"], steps[1:])
        else:
            steps = steps[1:] if steps[0] == "containers" else steps
            named = [s for s in steps if s in boxes]
            rest = [s for s in steps if s not in boxes]
            if rest[0] == "content":
                rest = ["metrics", "other", *rest]
            parts = [_reach(F.col(f"_rec.containers.{b}"), boxes[b], rest) for b in (named or list(boxes))]
            found = F.concat(*parts) if len(parts) > 1 else parts[0]
        out.append(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(None))).alias(name))
    return rec.select(*out)


# --- S3: JSON document scans ------------------------------------------------
def scan_json_documents(spark, path: str, schema: T.StructType | None = None,
                        glob: str = "CVE-*.json", one_per_file: bool = True):
    """Recursive scan of JSON documents.  Returns ``(good, rejected)``:
    ``good`` has ``file_path`` + ``doc`` (raw text) + parsed ``rec`` when a
    schema is given; ``rejected`` lists files whose text is not JSON.

    ``one_per_file`` reads each file whole (``wholetext``); otherwise one
    document per line.  Files are packed into tasks by
    ``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``, so hundreds
    of thousands of small files become a few hundred tasks.
    """
    r = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
         .option("wholetext", "true" if one_per_file else "false").text(path))
    df = r.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("doc"))
    ok = F.try_parse_json(F.col("doc")).isNotNull()
    good = df.filter(ok)
    if schema is not None:
        good = good.withColumn("rec", F.from_json("doc", schema))
    return good, df.filter(~ok).select("file_path", F.lit("invalid JSON").alias("reason"))


def file_audit(spark, path: str) -> DataFrame:
    """File counts by extension under ``path`` (recursive)."""
    r = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path).select("path", "length")
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    return r.groupBy(F.nullif(ext, F.lit("")).alias("extension")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


# --- fixtures shaped like the reference inputs -------------------------------
def conversation_documents(cwe: DataFrame) -> DataFrame:
    turns = F.transform(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text")),
                        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    doc = F.struct(F.struct(F.col("conv_id").alias("id"),
                            F.struct(turns.alias("turns")).alias("thread")).alias("meta"))
    return cwe.select("conv_id", F.to_json(doc).alias("doc"))


def _listed(n: str, item: str) -> Column:
    """``item`` (SQL over i) for i = 1 .. n."""
    return F.expr(f"case when {n} > 0 then transform(sequence(1, cast({n} as int)), i -> {item}) end")


def cve_documents(cve: DataFrame) -> DataFrame:
    """CVE-record-shaped JSON text per adapter row (fx_cve, or fx_cve_rec for
    full records)."""
    names = {"cvssV3_1": ("cvss_v3", "cvss_v3_vector"), "cvssV2_0": ("cvss_v2", "cvss_v2_vector"),
             "cvssV4_0": ("cvss_v4", "cvss_v4_vector")}

    def metric(name):
        s, v = names[name]
        # one struct type for every entry; null members are left out by to_json
        fields = [F.when(F.lit(n == name), F.struct(F.col(s).cast("double").alias("baseScore"),
                                                    F.col(v).alias("vectorString"))).alias(n) for n in names]
        return F.when(F.col(s).isNotNull(), F.struct(*fields))
    metrics = F.filter(F.array(*[metric(n) for n in names]), lambda m: m.isNotNull())
    second = F.date_format("public_date", "yyyy-MM-dd'T'HH:mm:ss").alias("datePublic")
    meta = [F.col("cve_id_raw").alias("cveId"), F.col("cve_state").alias("state"),
            F.date_format("publish_date", "yyyy-MM-dd'T'HH:mm:ss").alias("datePublished")]
    texts = F.array(F.struct(F.lit("en").alias("lang"), F.concat(F.lit("Issue in "), F.col("cve_id")).alias("value")))
    cna = [second, texts.alias("descriptions"), metrics.alias("metrics")]
    adp = []
    if "n_cwe" in cve.columns:
        meta.append(F.date_format("reserved", "yyyy-MM-dd'T'HH:mm:ss").alias("dateReserved"))
        entry = ("named_struct('descriptions', array(named_struct('lang', element_at(array('en', 'EN', 'de', 'english'), cast((k + i) % 4 + 1 as int)), "
                 "'description', concat('Weakness ', i, ' of ', k), 'cweId', if((k + i) % 5 = 0, null, concat('CWE-', (k * 7 + i) % 900)))))")
        releases = ("if((k + i) % 3 = 0, null, transform(array(1, 2), j -> named_struct('version', concat(i, '.', j), "
                    "'status', if((k + j) % 2 = 0, 'affected', 'unaffected'))))")
        product = (f"named_struct('vendor', concat('vendor ', k % 50 + i), 'product', concat('product ', k, '.', i), "
                   f"'defaultStatus', if((k + i) % 2 = 0, 'affected', 'unknown'), 'versions', {releases})")
        cna += [_listed("n_cwe", entry).alias("problemTypes"), _listed("n_aff", product).alias("affected"),
                _listed("n_solutions", "named_struct('lang', 'en', 'value', concat('Update to release ', i))").alias("solutions"),
                F.when(F.col("discovery").isNotNull(), F.struct(F.col("discovery"))).alias("source")]
        more = [F.expr("if(k % 6 = 0, array(named_struct('descriptions', array(named_struct('lang', 'en', 'description', 'added', 'cweId', 'CWE-20')))), null)").alias("problemTypes"),
                F.expr("if(k % 4 = 0, array(named_struct('versions', array(named_struct('versionType', 'semver', 'lessThan', concat('2.', k % 9), "
                       "'lessThanOrEqual', if(k % 8 = 0, concat('3.', k % 9), null))), 'cpes', if(k % 3 = 0, null, "
                       "transform(sequence(1, cast(k % 3 as int)), i -> concat('cpe:2.3:a:vendor', k % 50, ':p', i))))), null)").alias("affected"),
                F.expr("filter(array(if(k % 5 = 0, named_struct('other', named_struct('type', 'ssvc', 'content', named_struct('options', array("
                       "named_struct('Exploitation', 'PoC', 'Automatable', cast(null as string), 'Technical Impact', cast(null as string)), "
                       "named_struct('Exploitation', cast(null as string), 'Automatable', 'yes', 'Technical Impact', cast(null as string)), "
                       "named_struct('Exploitation', cast(null as string), 'Automatable', cast(null as string), 'Technical Impact', 'Partial'))))), null), "
                       "if(k % 25 = 0, named_struct('other', named_struct('type', 'kev', 'content', cast(null as struct<options: array<struct<"
                       "Exploitation: string, Automatable: string, `Technical Impact`: string>>>))), null)), m -> m is not null)").alias("metrics")]
        adp = [F.array(F.struct(*more)).alias("adp")]
    doc = F.struct(F.struct(*meta).alias("cveMetadata"), F.struct(F.struct(*cna).alias("cna"), *adp).alias("containers"))
    return cve.select("k", F.to_json(doc).alias("doc"))


def poc_listings(events: DataFrame, name: Column, backup: Column | None = None) -> DataFrame:
    """PoC listings (JSON arrays): the events of a user and hour.  Visibility
    lies below the entry; topics may hold a ``backup`` id."""
    topics = F.array(F.col("event_type"), backup) if backup is not None else F.array(F.col("event_type"))
    item = F.struct(name.alias("name"),
                    F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
                    F.date_format(F.expr("ts + interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss").alias("pushed_at"),
                    (F.col("event_id") % 7).alias("forks_count"),
                    F.struct(F.when(F.col("event_id") % 2 == 0, "public").otherwise("private").alias("visibility")).alias("repository"),
                    F.filter(topics, lambda t: t.isNotNull()).alias("topics"))
    return (events.groupBy("user_id", F.date_trunc("hour", "ts").alias("hour"))
                  .agg(F.to_json(F.array_sort(F.collect_list(item))).alias("listing")))


def poc_extract(listings: DataFrame, json_col: str) -> DataFrame:
    """Q8: one row per listing: its number of entries, the earliest creation
    text, and the fields of the catalogue by search (S9)."""
    found = dict(zip(POC_FIELDS, first_or_flats(json_col, POC_FIELDS)))
    entries = F.from_json(F.col(json_col), "array<struct<created_at:string>>")
    return listings.select(
        F.json_array_length(json_col).cast("long").alias("exploit_count"), F.array_min(entries["created_at"]).alias("earliest_date"),
        *[(c if name == "poc_topics" else F.get(c, 0)).alias(name) for name, c in found.items()])


def poc_file_summary(listings: DataFrame, json_col: str) -> DataFrame:
    """Per listing count, earliest creation text and the first name;
    then rolled up per CVE (sum of counts, earliest date)."""
    from riskspan.operators.joins import exploit_rollup
    return exploit_rollup(poc_extract(listings, json_col).select("cve_id", "exploit_count", "earliest_date"))


def platform_records(part: DataFrame) -> DataFrame:
    def one(name, cls, cond=None):
        s = F.array(F.struct(name.alias("_Name"), F.lit(cls).alias("_Class"), F.col("p_type").alias("_Prevalence")))
        empty = F.array().cast("array<struct<_Name:string,_Class:string,_Prevalence:string>>")
        return s if cond is None else F.when(cond, s).otherwise(empty)
    return part.select(F.col("p_partkey").alias("cwe_id"),
                       one(F.col("p_brand"), "Often").alias("Language"),
                       one(F.lit("x86"), "Sometimes", F.col("p_size") % 2 == 0).alias("Architecture"),
                       one(F.lit("Linux"), "Rarely", F.col("p_size") % 3 == 0).alias("Operating_System"),
                       one(F.col("p_name"), "Undetermined", F.col("p_size") % 5 == 0).alias("Technology"))


PLATFORM_TYPES = ["Language", "Architecture", "Operating_System", "Technology"]


def _tagged(c: str) -> Column:
    return F.transform(F.col(c), lambda e: F.struct(F.lit(c).alias("type"), e["_Name"].alias("name"),
                                                      e["_Class"].alias("class"), e["_Prevalence"].alias("prevalence")))


def platform_unpivot(df: DataFrame, id_col: str) -> DataFrame:
    """One row per platform element, tagged with its kind."""
    allp = F.concat(*[_tagged(c) for c in PLATFORM_TYPES])
    return df.select(F.col(id_col), F.explode(allp).alias("p")).select(id_col, "p.*")


# FIXED VALUE: records on one page of the source
NVD_PAGE = 2000
METRIC_PRIORITY = ["cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2"]


def nvd_pages(nvd: DataFrame) -> DataFrame:
    """NVD-response-shaped pages (records spread over hashed pages)."""
    entry = lambda s, v, vec: F.array(F.struct(F.struct(s.alias("baseScore"), v.alias("version"),
                                                        vec.alias("vectorString")).alias("cvssData")))
    empty = F.array().cast("array<struct<cvssData:struct<baseScore:double,version:string,vectorString:string>>>")
    ver = F.col("cvss_version")
    mine = entry(F.col("cvss"), ver, F.concat(F.lit("CVSS:"), ver, F.lit("/AV:N")))
    v2 = entry(F.lit(9.9), F.lit("2.0"), F.lit("AV:N/AC:L/Au:N/C:C/I:C/A:C"))
    metrics = F.struct(F.when(ver == "4.0", mine).otherwise(empty).alias("cvssMetricV40"),
                       F.when(ver == "3.1", mine).otherwise(empty).alias("cvssMetricV31"),
                       F.when(ver == "3.0", mine).otherwise(empty).alias("cvssMetricV30"),
                       v2.alias("cvssMetricV2"))
    vuln = F.struct(F.struct(F.col("cve_id").alias("id"), F.col("date_published").alias("published"),
                             metrics.alias("metrics")).alias("cve"))
    # a page holds the records of 2,000 consecutive numbers of a year, as the source pages do
    number = F.substring("cve_id", 10, 7).cast("long")
    return nvd.groupBy(F.substring("cve_id", 5, 4).alias("year"), F.floor(number / NVD_PAGE).alias("page")) \
        .agg(F.collect_list(vuln).alias("vulnerabilities")).select("vulnerabilities")


def nvd_best_metric(pages: DataFrame) -> DataFrame:
    """Per CVE the first entry of the best available metric list
    (V4.0 > V3.1 > V3.0 > V2): score, version and vector together."""
    v = pages.select(F.explode("vulnerabilities").alias("v")).select("v.cve.*")
    best = F.coalesce(*[F.try_element_at(F.col(f"metrics.{m}"), F.lit(1))["cvssData"] for m in METRIC_PRIORITY])
    return v.select(F.col("id").alias("cve_id"), "published", best["baseScore"].alias("cvss"),
                    best["version"].alias("cvss_version"), best["vectorString"].alias("cvss_vector"))


def search_records(cwe: DataFrame) -> DataFrame:
    results = F.transform(F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text")),
                          lambda r, i: F.struct((i + 1).cast("long").alias("turn"), r["role"].alias("title"),
                                                r["text"].alias("description")))
    return cwe.select(F.array(F.struct(F.col("conv_id").alias("search_id"),
                                       F.lit("conversations").alias("search_source"),
                                       results.alias("results"))).alias("searches"))


def nested_flatten(df: DataFrame, outer: str = "searches", inner: str = "results") -> DataFrame:
    """One row per inner result with the parent's fields repeated;
    parents without results disappear (inner explode)."""
    s = df.select(F.explode(outer).alias("s"))
    parent = [f.name for f in s.schema["s"].dataType.fields if f.name != inner]
    return s.select(*[F.col(f"s.{p}").alias(p) for p in parent], F.explode(f"s.{inner}").alias("r")) \
            .select(*parent, "r.*")


def type_profile(df: DataFrame, col: str) -> DataFrame:
    """Value-type profile of a JSON text column."""
    t = F.when(F.col(col).isNull(), F.lit("null")).otherwise(
        F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(col))), F.lit("not json")))
    return df.groupBy(t.alias("value_type")).agg(F.count(F.lit(1)).alias("count"))
