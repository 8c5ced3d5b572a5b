import hashlib

import duckdb
import pytest

from riskspan.llm import queries as Q
from riskspan.llm.line_dedup import line_stage, remove_repeated_lines
from tests.llm.data import clashing, empty, messy, messy_rows, write_tables


def expected(rows, run):
    """Brute force over (doc_id, text): kept text, lines, removed lines."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    heads, starts = {}, {}
    for i, t in docs:
        lines = t.split("\n")
        for k in range(len(lines) - run + 1):
            spot = (i is not None, i or 0)
            heads.setdefault(tuple(lines[k:k + run]), []).append((spot, k, (i, t)))
    for places in heads.values():
        first = min(p[:2] for p in places)
        for spot, k, doc in places:
            if (spot, k) > first:
                starts.setdefault(doc, set()).add(k)
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        gone = {p for k in starts.get((i, t), ()) for p in range(k, k + run)}
        out.append((i, "\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone)))
    return out


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_against_brute_force(spark, run):
    # null ids are ordered by content here, so only rows with an id are compared one by one
    rows = [(r[0], r[1]) for r in messy_rows() if r[0] is not None]
    rows += [(200 + i, "\n".join(f"t{(i * k) % 7}" for k in range(12))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_removed) for r in remove_repeated_lines(docs, run).collect()),
                 key=lambda r: (r[0], r[1] is None, r[1]))
    assert got == sorted(expected(rows, run), key=lambda r: (r[0], r[1] is None, r[1]))


def test_first_occurrence_of_every_line_stays(spark):
    docs = messy(spark)
    every = {x for r in messy_rows() if r[1] is not None for x in r[1].split("\n")}
    left = {x for r in line_stage(docs, 2).collect() if r.text is not None for x in r.text.split("\n")}
    assert left == every
    assert line_stage(docs, 2).schema.names == docs.schema.names


def test_extra_columns_and_empty_table(spark):
    docs = clashing(messy(spark))
    out = remove_repeated_lines(docs, 2)
    assert out.columns[:5] == docs.columns[:5] and out.count() == docs.count()
    assert remove_repeated_lines(empty(spark), 2).collect() == []
    assert line_stage(empty(spark), 2).collect() == []


def test_query_equals_sql(spark, tmp_path):
    rows = [r for r in messy_rows() if r[0] is not None and r[0] != 15]
    folder = write_tables(spark, tmp_path, spark.createDataFrame(rows, messy(spark).schema))
    got = sorted(map(tuple, Q.op1_line_dedup(spark, folder).collect()))
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert got == sorted(db.sql(Q.OP1_SQL).fetchall())
    want = sorted((i, n, g, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, n, g in expected([r[:2] for r in rows], 2))
    assert got == want
