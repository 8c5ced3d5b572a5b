"""Long lines that are a repeat by themselves."""

import random

import pytest

import corpus_pipeline
from riskspan.llm.line_dedup import remove_repeated_lines
from tests.llm.data import messy_rows


def expected(rows, run, lone):
    """Brute force over (doc_id, text) with different ids."""
    seen, out = set(), []
    for i, t in sorted(rows):
        lines, gone = t.split("\n"), set()
        for k in range(len(lines)):
            for n in {run, 1} if len(lines[k].encode()) >= lone else {run}:
                part = tuple(lines[k:k + n])
                if len(part) == n:
                    gone |= set(range(k, k + n)) if part in seen else set()
                    seen.add(part)
        out.append((i, "\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone)))
    return out


@pytest.mark.parametrize("run, lone", [(1, 5), (2, 0), (2, 6), (3, 6), (2, 1000)])
def test_against_brute_force(spark, run, lone):
    rng = random.Random(run)
    rows = list({r[0]: (r[0], r[1]) for r in messy_rows() if r[0] is not None and r[1] is not None}.values())
    rows += [(9000 + i, "\n".join(rng.choice(["a", "bé", "short", "longer line", "漢字漢字", "some other line", f"own line {i}"])
                                  for _ in range(rng.randint(1, 9)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeated_lines(docs, run, lone_bytes=lone).collect()
    assert sorted((r.doc_id, r.kept_text, r.n_lines, r.n_removed) for r in got) == expected(rows, run, lone)


def test_pipeline_stage_removes_copied_paragraphs(spark):
    long = "a paragraph of one line that was copied between other neighbours, " * 2
    rows = [(1, f"first\n{long}\nend"), (2, f"other\n{long}\nlast"), (3, long), (4, "first"), (5, "first\nend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {1: rows[0][1], 2: "other\nlast", 4: "first", 5: "first\nend"}
