import collections
import hashlib
import random
import re

import pytest

from riskspan.llm import queries as Q
from riskspan.llm.substring_dedup import remove_repeats, substring_stage
from riskspan.llm.suffix_dedup import remove_repeated_bytes
from tests.llm.data import CLASHING, clashing, empty, messy, messy_rows, write_tables

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def covered(sequences, window):
    """Brute force: marks of all elements in windows that occur twice."""
    seen = collections.Counter(tuple(s[i:i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        mark = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i:i + window])] > 1:
                mark[i:i + window] = [True] * window
        out.append(mark)
    return out


def words_expected(texts, window):
    seqs = [WORD.findall((t or "").encode()) for t in texts]
    out = []
    for s, m in zip(seqs, covered(seqs, window)):
        out.append((len(s), sum(m), b" ".join(w for w, x in zip(s, m) if not x).decode()))
    return out


def bytes_expected(texts, window):
    seqs = [(t or "").encode() for t in texts]
    out = []
    for s, m in zip(seqs, covered(seqs, window)):
        spans = sum(1 for i, x in enumerate(m) if x and (i == 0 or not m[i - 1]))
        out.append((len(s), sum(m), spans, hashlib.sha256(bytes(b for b, x in zip(s, m) if not x)).hexdigest()))
    return out


@pytest.mark.parametrize("window", [3, 12, 35])
def test_words_against_brute_force(spark, window):
    rows = messy_rows()
    got = remove_repeats(messy(spark), window).collect()
    want = words_expected([r[1] for r in rows], window)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text) for r in got), key=key) == \
        sorted(((r[0], r[1], *w) for r, w in zip(rows, want)), key=key)


@pytest.mark.parametrize("window,core,period", [(20, 10, 3), (64, 16, 8), (400, 64, 40)])
def test_bytes_against_brute_force(spark, window, core, period):
    rows = messy_rows(3)
    got = remove_repeated_bytes(messy(spark, 3), window, core, period).collect()
    want = bytes_expected([r[1] for r in rows], window)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=key) == \
        sorted(((r[0], r[1], *w) for r, w in zip(rows, want)), key=key)


def test_repeated_letters_small_alphabet(spark):
    """Dense repeats: short windows over few different words."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for window in (4, 9):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(docs, window).collect()}
        assert [got[i] for i in range(len(texts))] == words_expected(texts, window)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
               for r in remove_repeated_bytes(docs, 4 * window, 8, 4).collect()}
        assert [got[i] for i in range(len(texts))] == bytes_expected(texts, 4 * window)


def test_extra_columns_and_empty_tables(spark):
    docs = clashing(messy(spark))
    out = remove_repeats(docs, 12)
    assert [c for c in out.columns if c in docs.columns] == docs.columns
    row = next(r for r in out.collect() if r.doc_id == 5)
    assert all(row[c] == i for i, c in enumerate(CLASHING) if c not in ("kept_text", "n_words"))
    assert remove_repeats(empty(spark), 12).collect() == []
    assert remove_repeated_bytes(empty(spark), 40).collect() == []
    assert substring_stage(empty(spark), 12).collect() == []


def test_stage_keeps_columns_and_untouched_texts(spark):
    docs = messy(spark)
    out = substring_stage(docs, 12)
    assert out.schema.names == docs.schema.names
    rows, got = messy_rows(), collections.Counter((r.doc_id, r.text, r.n_chars) for r in out.collect())
    want = collections.Counter()
    for r, (n, gone, kept) in zip(rows, words_expected([r[1] for r in rows], 12)):
        if gone == 0:
            want[(r[0], r[1], len(r[1]) if r[1] is not None else None)] += 1
        elif gone < n:
            want[(r[0], kept, len(kept))] += 1
    assert got == want


def test_queries(spark, tmp_path):
    rng = random.Random(11)
    block = " ".join(str(rng.random()) for _ in range(50))
    rows = messy_rows(2) + [(900 + i, f"head {i} {block} tail {i}", "en", "s", 9) for i in range(30)]
    folder = write_tables(spark, tmp_path, spark.createDataFrame(rows, messy(spark).schema))
    key = lambda x: tuple((v is None, v) for v in x)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted(map(tuple, Q.op9_substring_dedup(spark, folder).collect()), key=key)
    texts = [r[1] for r in rows]
    assert got == sorted(((r[0], n, g, sha(k)) for r, (n, g, k) in zip(rows, words_expected(texts, 35))), key=key)
    got = sorted(map(tuple, Q.op10_suffix_dedup(spark, folder).collect()), key=key)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, bytes_expected(texts, 400))), key=key)
