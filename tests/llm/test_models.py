"""Quality classifier, language labels, tokens, packing, fingerprints, search."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskspan.llm import queries as Q
from riskspan.llm.bpe import ByteBPE, encode_texts
from riskspan.llm.fingerprints import fingerprint_documents
from riskspan.llm.language_id import fit_language, forward_backward, identify_language, label_texts
from riskspan.llm.packing import fullest, pack_documents, slack_plan
from riskspan.llm.quality import fit_quality, quality_stage, score_quality
from riskspan.llm.vector_search import top_inner_products, whole_vectors
from tests.llm.data import clashing, empty, messy, messy_rows, write_tables

SF = "/root/testdata/sf0.01"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# -- quality ------------------------------------------------------------
def test_quality_on_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = Q.op3_quality_classifier(spark, SF).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for p, y in unseen]) > 0.93


def test_quality_edge_cases(spark):
    docs = messy(spark)
    labels = spark.createDataFrame([(6, 1), (6, 0), (None, 1), (8, None), (9, 2)], "doc_id long, quality int")
    flat = fit_quality(docs, labels, F.lit(True))
    assert {r.score for r in score_quality(docs, flat).collect()} == {0.5}
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in messy_rows() if r[0] is not None and r[0] != 15],
                                   "doc_id long, quality int")
    model = fit_quality(docs, labels, F.lit(True))
    out = score_quality(clashing(docs), model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if not r.text}) == 1
    assert quality_stage(docs, model).columns == docs.columns
    assert score_quality(empty(spark), model).collect() == []
    assert fit_quality(empty(spark), labels, F.lit(True)).good == b""


# -- language -----------------------------------------------------------
def test_language_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = Q.op6_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    unseen = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert np.mean(unseen) > 0.95


def test_language_edge_cases(spark):
    docs = messy(spark)
    model = fit_language(docs, F.lit(True))
    out = identify_language(clashing(docs), model).collect()
    assert len(out) == docs.count()
    for r in out:
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0) and 0 <= r.score <= 1
    assert identify_language(empty(spark), model).collect() == []
    assert fit_language(empty(spark), F.lit(True)) is None
    assert {r.lang_pred for r in identify_language(docs, None).collect()} == {"und"}


def test_code_switched_text_and_exact_marginals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_language(docs, F.lit(True))
    model.key = "t"
    texts = {r.lang: r.text for r in docs.where("length(text) > 600").orderBy("doc_id").collect()}
    mixed = " ".join(texts["en"].split()[:30] + texts["fr"].split()[:60])
    assert label_texts(model, [mixed])[0][0] == "fr"
    rng = np.random.default_rng(3)
    scores, trans, start = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got = forward_backward(scores, np.array([4, 0, 5]), trans, start)
    at = 0
    for n in (4, 5):
        total = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = start[path[0]] + sum(scores[at + i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
            for i, y in enumerate(path):
                total[i, y] += math.exp(w)
        assert np.allclose(got[at:at + n], total / total.sum(axis=1, keepdims=True))
        at += n


# -- byte-level BPE -----------------------------------------------------
def test_bpe_equals_library():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "the", " the", "'s", "É", "ß", "漢", "\x1c", "\x85", "\xa0", "1", "<|endoftext|>",
             "!!", "\U0001f600", "aaaa", "\r\n", "x" * 40]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["", "a" * 3000, "ab" * 2000, "<|endoftext|>", "zq" * 130]
    model, library = ByteBPE(BYTES), Tokenizer.from_file(BYTES)
    for text, (n, ids, decoded), e in zip(texts, model.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert (n, ids) == (len(e.ids), ",".join(map(str, e.ids)))
        assert decoded.decode() == text == library.decode(e.ids, skip_special_tokens=False)


def test_bpe_pairs_equal_exact_merging():
    model = ByteBPE(BYTES)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3000, 5000), rng.integers(0, 3000, 5000)
    want = [model.merge(model.bytes[x] + model.bytes[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert model.compatible(a, b).tolist() == want


def test_bpe_query_and_operator(spark, tmp_path):
    library = Tokenizer.from_file(BYTES)
    docs = messy(spark)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = collections.Counter()
    for i, t, *_ in messy_rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    folder = write_tables(spark, tmp_path, docs)
    assert collections.Counter(map(tuple, Q.op7_bpe(spark, folder).collect())) == want
    for r in encode_texts(clashing(docs), BYTES).collect():
        assert list(r.ids) == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert encode_texts(empty(spark), BYTES).collect() == []


# -- packing ------------------------------------------------------------
def test_fullest_is_optimal():
    rng = random.Random(2)
    for _ in range(60):
        room = rng.randint(1, 40)
        counts = {k: rng.randint(1, 3) for k in rng.sample(range(1, 30), rng.randint(1, 6))}
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * m for s in sums for m in range(n + 1) if s + k * m <= room}
        used = fullest(counts, room)
        assert sum(k * n for k, n in used.items()) == max(sums)
        assert all(n <= counts[k] for k, n in used.items())


def test_plan_uses_every_piece():
    rng = random.Random(3)
    counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(40)}
    plan = slack_plan(counts, 64)
    used = collections.Counter()
    for times, part in plan:
        assert sum(k * n for k, n in part.items()) <= 64
        for k, n in part.items():
            used[k] += n * times
    assert used == collections.Counter(counts)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, capacity):
    library = Tokenizer.from_file(WORDS)
    rows = messy_rows() + [(700 + i, "same text here", "a", "b", 1) for i in range(200)]
    rows = [(i if i is not None else -k, t, *_) for k, (i, t, *_) in enumerate(rows)]
    rows = list({r[0]: r for r in rows}.values()) + [(3000, "a\x1cb \x1d c İ ΑΣ <|endoftext|>x", "a", "b", 1)]
    ids = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    got = pack_documents(spark.createDataFrame(rows, messy(spark).schema), WORDS, capacity, with_ids=True).collect()
    sequences, total = collections.defaultdict(list), collections.Counter()
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert list(r.ids) == own and r.start == r.piece * capacity and r.length == len(own) <= capacity
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        total[r.doc_id] += r.length
    assert total == {k: len(v) for k, v in ids.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) <= math.ceil(sum(total.values()) / capacity) + 2
    assert pack_documents(empty(spark), WORDS, capacity).collect() == []


# -- fingerprints -------------------------------------------------------
def test_fingerprints(spark, tmp_path):
    rows = sorted([r for r in messy_rows() if r[0] is not None and r[0] != 15], key=lambda r: r[0])
    folder = write_tables(spark, tmp_path, spark.createDataFrame(rows, messy(spark).schema))
    got = {r.doc_id: r for r in Q.op5_fingerprints(spark, folder).collect()}
    prints = collections.defaultdict(set)
    for k, (i, t, *_) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints[t].add(got[i].fingerprint)
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        if edited == t:
            assert got[i].near_edited == 1 and got[i].edited_fingerprint == got[i].fingerprint
    assert all(len(p) == 1 for p in prints.values())
    assert got[6].near_next == 1 and got[18].near_edited > 0.4 and got[18].near_next < 0.1
    assert fingerprint_documents(empty(spark)).collect() == []


def test_fingerprints_of_odd_ids(spark):
    docs = clashing(messy(spark))
    out = fingerprint_documents(docs).collect()
    assert len(out) == docs.count()
    big = spark.createDataFrame([(-2 ** 63, "a b c d e f g h"), (2 ** 63 - 1, "x y z x y z x y"), (0, "q")],
                                "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in fingerprint_documents(big).collect()}
    assert got[-2 ** 63] == hashlib.sha256(b"a b c d e f qq"[:12] + b"q").hexdigest()


# -- search -------------------------------------------------------------
def vectors(seed=1, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=dim)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(20)]
    rows += [(900, None), (901, [float("nan")] * dim), (902, [None] * dim), (903, [float("inf")] * dim), (904, []),
             (None, rows[0][1]), (905, [0.0] * dim), (906, [1.0] * 3), (920, [2.0] * 3), (907, [1e30] * dim)]
    return rows


@pytest.mark.parametrize("k", [1, 20])
def test_search_against_brute_force(spark, k):
    rows = vectors()
    usable = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) and abs(64 * x) < 2 ** 31 for x in v)]
    want = []
    for i, q in usable:
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near[:k])]
    table = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = top_inner_products(whole_vectors(table, 64), F.col("id") % 20 == 0, k).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_inner_products(whole_vectors(none, 64), F.col("id") % 20 == 0).collect() == []
