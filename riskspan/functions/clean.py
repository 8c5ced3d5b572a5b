"""Cleaning transforms (nulls, categories, whitespace, types, IDs, lists)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspan.catalog import CVE_ID_PATTERN, ENGLISH_TAGS, NULL_TOKENS, TYPE_ALIASES

_WS = "[ \\t\\n\\r\\f\\x0B]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_lit(v) -> str:
    """SQL literal text for a Python str/number/bool/None."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_sql(mapping: dict) -> str:
    return "map(" + ", ".join(f"{sql_lit(k)}, {sql_lit(v)}" for k, v in mapping.items()) + ")"


def _lit_map(mapping: dict) -> Column:
    # built as one SQL expression: a single JVM call instead of 2n
    return F.expr(map_sql(mapping))


# F1 -------------------------------------------------------------------------
_TOKENS_SQL = ", ".join(sql_lit(t) for t in NULL_TOKENS)


def standardize_nulls(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Null standardization: string tokens, NaN in floats, and the same inside
    string arrays.  Other types are left as they are (already SQL nulls)."""
    cols = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        n = f"`{f.name}`"
        t = f.dataType
        if cols is not None and f.name not in cols:
            out.append(n)
        elif isinstance(t, T.StringType):
            out.append(f"CASE WHEN {n} IN ({_TOKENS_SQL}) THEN NULL ELSE {n} END AS {n}")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            out.append(f"CASE WHEN isnan({n}) THEN NULL ELSE {n} END AS {n}")
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            out.append(f"transform({n}, x -> CASE WHEN x IN ({_TOKENS_SQL}) THEN NULL ELSE x END) AS {n}")
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.DoubleType, T.FloatType)):
            out.append(f"transform({n}, x -> CASE WHEN isnan(x) THEN NULL ELSE x END) AS {n}")
        else:
            out.append(n)
    return df.selectExpr(*out)


# F2 -------------------------------------------------------------------------
def standardize_category(c, mapping: dict) -> Column:
    """Look up lower(cell) in ``mapping``; keep the cell when unmapped."""
    c = _col(c)
    return F.coalesce(F.try_element_at(_lit_map(mapping), F.lower(c)), c)


def standardize_categories(df: DataFrame, maps: dict) -> DataFrame:
    present = {k: v for k, v in maps.items() if k in df.columns}
    return df.withColumns({k: standardize_category(k, v) for k, v in present.items()})


# F3 -------------------------------------------------------------------------
def strip(c) -> Column:
    """Remove leading/trailing ASCII whitespace (all kinds, not just spaces)."""
    return F.regexp_replace(_col(c), f"^{_WS}+|{_WS}+$", "")


def trim_strings(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if cols is not None:
        names = [n for n in names if n in set(cols)]
    pat = f"^{_WS}+|{_WS}+$".replace("\\", "\\\\")
    return df.withColumns({n: F.expr(f"regexp_replace(`{n}`, '{pat}', '')") for n in names}) if names else df


# F4 -------------------------------------------------------------------------


DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSSX", "yyyy-MM-dd'T'HH:mm:ss.SSSX",
                "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss",
                "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def to_timestamp_any(c, formats: list[str] | None = None) -> Column:
    """Parse text in any of ``formats`` (first that fits); timestamps pass."""
    c = _col(c)
    fmts = formats or DATE_FORMATS
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in fmts]).cast("timestamp_ntz")


def convert_column(c, kind: str, dtype: T.DataType | None = None) -> Column:
    target = TYPE_ALIASES.get(kind.lower())
    if target is None:
        raise ValueError(f"unknown type name: {kind!r}")
    c = _col(c)
    if target == "string":
        return strip(c.cast("string"))
    if target in ("long", "double", "boolean"):
        return c.try_cast(target)
    if target == "timestamp":
        # timestamps are kept as UTC wall-clock TIMESTAMP_NTZ throughout
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return c.cast("timestamp_ntz")
        return to_timestamp_any(c.cast("string"))
    if target == "category":
        return c.cast("string")
    return c


def converted(df: DataFrame, conversions: dict) -> dict[str, Column]:
    """The converted columns that ``conversions`` asks for."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for kind, cols in conversions.items():
        names = list(df.columns) if cols == "*" else [c for c in cols if c in types]
        for n in names:
            changes[n] = convert_column(F.col(f"`{n}`"), kind, types[n])
    return changes


def convert_types(df: DataFrame, conversions: dict) -> DataFrame:
    """``{type_name: [columns] | '*'}`` -> per-value ``try_cast``.

    A bad value becomes null on its own (the column keeps its other values).
    Columns named but missing from the frame are ignored.
    """
    changes = converted(df, conversions)
    return df.withColumns(changes) if changes else df


# F5 -------------------------------------------------------------------------
def validate_id(primary, backup=None, repair: bool = False) -> Column:
    """First CVE-ID match anywhere in the text, upper-cased; else (optional
    repair of 'YYYY-N' forms) else the first matching backup-list item; else
    null."""
    p = _col(primary)
    hit = F.nullif(F.upper(F.regexp_extract(p, CVE_ID_PATTERN, 0)), F.lit(""))
    parts = [hit]
    if repair:
        squeezed = F.upper(F.regexp_replace(p, "\\s+", ""))
        fixed = F.regexp_replace(squeezed, "^([0-9]{4})-([0-9]+)$", "CVE-$1-$2")
        y = F.regexp_extract(fixed, "^CVE-(1999|20[0-9]{2})-([0-9]+)$", 1)
        n = F.regexp_extract(fixed, "^CVE-(1999|20[0-9]{2})-([0-9]+)$", 2)
        rebuilt = F.when(y != "", F.concat(F.lit("CVE-"), y, F.lit("-"), F.lpad(n, F.greatest(F.length(n), F.lit(4)), "0")))
        parts.append(F.nullif(F.upper(F.regexp_extract(rebuilt, CVE_ID_PATTERN, 0)), F.lit("")))
    if backup is not None:
        b = _col(backup)
        found = F.filter(F.transform(b, lambda x: F.regexp_extract(F.trim(x.cast("string")), CVE_ID_PATTERN, 0)),
                         lambda x: x != "")
        first = F.get(found, 0)
        parts.append(F.concat(F.lit("CVE-"), F.regexp_extract(first, CVE_ID_PATTERN, 1), F.lit("-"),
                              F.lpad(F.regexp_extract(first, CVE_ID_PATTERN, 2),
                                     F.greatest(F.length(F.regexp_extract(first, CVE_ID_PATTERN, 2)), F.lit(4)), "0")))
    return F.coalesce(*parts)


# F6 -------------------------------------------------------------------------
def concat_list(c, sep: str = " ") -> Column:
    """Join a string list skipping null/empty items; null -> ''."""
    c = _col(c)
    return F.coalesce(F.array_join(F.filter(c, lambda x: x.isNotNull() & (x != "")), sep), F.lit(""))


# F7 -------------------------------------------------------------------------
def combine_text(*cols) -> Column:
    """Join the non-null parts with one space, trimmed; null when empty."""
    return F.nullif(F.trim(F.concat_ws(" ", *[_col(c) for c in cols])), F.lit(""))


# F8 -------------------------------------------------------------------------
def prefix_id(c, prefix: str = "CWE-") -> Column:
    return F.concat(F.lit(prefix), _col(c).cast("string"))


# F9 -------------------------------------------------------------------------
def split_to_array(c, sep: str = ",") -> Column:
    """Comma text -> trimmed items; null -> empty list."""
    c = _col(c)
    return F.coalesce(F.transform(F.split(c, sep), lambda x: F.trim(x)),
                      F.array().cast("array<string>"))


# F10 ------------------------------------------------------------------------
def first_item(c) -> Column:
    return F.get(_col(c), 0)


# F11 ------------------------------------------------------------------------
def flatten_singletons(df: DataFrame, cols: Iterable[str], key: str | None = None,
                       on_multi: str = "keep"):
    """Replace list columns by their single item when no row holds more than
    one item.  One aggregate pass decides every column.

    Returns ``(frame, report)``; ``report`` maps each column left as a list to
    (rows with several items, up to five sample keys).  ``on_multi='error'``
    raises instead of keeping such columns.
    """
    cand = [c for c in cols if c in df.columns
            and isinstance(df.schema[c].dataType, T.ArrayType)]
    if not cand:
        return df, {}
    aggs = [F.count_if(F.size(F.col(c)) > 1).alias(f"n__{c}") for c in cand]
    stats = df.agg(*aggs).first()  # one row, size bounded by the column count
    report = {}
    changes = {}
    for c in cand:
        n = stats[f"n__{c}"]
        if n:
            # the five smallest keys: each task passes on five rows at most
            some = df.where(F.size(F.col(c)) > 1).select(F.col(key)).distinct().orderBy(key).limit(5).collect() if key else []
            report[c] = (n, [r[0] for r in some])
        else:
            changes[c] = F.get(F.col(c), 0)
    if report and on_multi == "error":
        raise ValueError(f"columns with multi-item lists: {report}")
    return (df.withColumns(changes) if changes else df), report


# F12 / F13 ------------------------------------------------------------------
def pad_arrays(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pad the listed arrays of each row to the row's longest with nulls."""
    z = F.arrays_zip(*[F.col(c) for c in cols])
    return df.withColumns({c: _field_of(z, c) for c in cols})


def _field_of(arr: Column, field: str) -> Column:
    return F.transform(arr, lambda x: x[field])


def subtable_explode(df: DataFrame, id_col: str, cols: list[str], name: str,
                     label_col: str = "source_table") -> DataFrame:
    """``[id] + cols`` exploded together (unequal lengths padded with null,
    an empty or null list gives one all-null row) plus a table label."""
    missing = [c for c in [id_col] + cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    z = F.explode_outer(F.arrays_zip(*[F.col(c) for c in cols])).alias("_z")
    return (df.select(F.col(id_col), z)
              .select(F.col(id_col), *[F.col("_z")[c].alias(c) for c in cols])
              .withColumn(label_col, F.lit(name)))


# F24 - F28 ------------------------------------------------------------------
def array_flag(c, value: str = "kev") -> Column:
    return F.coalesce(F.array_contains(_col(c), F.lit(value)), F.lit(False))


def english_desc(c, lang_field: str = "lang", text_field: str = "description",
                 tags: list[str] = ENGLISH_TAGS) -> Column:
    """Texts of the English items of a list of structs; non-list -> []."""
    c = _col(c)
    picked = F.transform(F.filter(c, lambda x: F.lower(F.trim(x[lang_field])).isin(*tags)),
                         lambda x: x[text_field])
    return F.coalesce(picked, F.array().cast("array<string>"))


def booleanize(c) -> Column:
    c = F.lower(_col(c))
    return F.when(c == "yes", F.lit(True)).when(c == "no", F.lit(False))


def replace_values(c, mapping: dict) -> Column:
    c = _col(c)
    return F.coalesce(F.try_element_at(_lit_map(mapping), c), c)


def encode_ordinal(c, mapping: dict) -> Column:
    return F.try_element_at(_lit_map(mapping), _col(c))


def drop_by_pattern(df: DataFrame, prefixes=(), suffixes=(), names=()) -> DataFrame:
    """Drop columns by prefix, suffix or exact name."""
    gone = [c for c in df.columns
            if c in names or any(c.startswith(p) for p in prefixes)
            or any(c.endswith(s) for s in suffixes)]
    return df.drop(*gone)
