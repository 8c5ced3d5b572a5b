"""The rows of the pipeline against plain Python, stage by stage, with the
pipeline's own settings."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline as P
from riskspan.llm.quality import CHUNK, LEVEL, fit_quality, shortness
from riskspan.llm.queries import MIN_LINES, held_out
from tests.llm.data import SCHEMA, words, write_tables
from tests.llm.test_lone_lines import expected as kept_lines
from tests.llm.test_near_dedup import groups
from tests.llm.test_repeats import words_expected


def corpus():
    rng = random.Random(21)
    passage, paragraph = words(rng, 70), "a paragraph of one line that stands in several documents and is long enough to go " * 2
    vocabulary = [words(rng, 1) for _ in range(400)]
    good = lambda n: " ".join(rng.choices(vocabulary, k=n))
    rows = []
    for i in range(60):
        text = good(rng.randint(30, 200))
        if i % 5 == 0:
            text += "\n" + paragraph.strip()
        if i % 7 == 0:
            text += " " + passage + " " + good(9)
        if i % 6 == 0:
            text += "\nfirst shared line\nsecond shared line\n" + good(12)
        rows.append(text)
    for i in range(0, 20, 2):  # near and exact copies
        own = rows[i].split(" ")
        own[len(own) // 2] = "changed"
        rows += [" ".join(own), rows[i]]
    junk = ["".join(rng.choices("#@$%!?*&^~0123456789", k=rng.randint(50, 600))) for _ in range(30)]
    docs = [(i, t, "xx", "s", len(t)) for i, t in enumerate(rows + junk)]
    labels = [(i, int(i < len(rows)), 0) for i in range(len(docs)) if i % 4]
    return docs + [(900, None, None, None, 0), (901, "", "xx", "s", 0), (902, " \n ", "xx", "s", 3)], labels


def compressor(data):
    kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind),
                                    write_content_size=False, write_checksum=False, write_dict_id=False)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    docs, labels = corpus()
    folder = write_tables(spark, tmp_path_factory.mktemp("tables"), spark.createDataFrame(docs, SCHEMA),
                          spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return folder, docs


def test_scores_by_plain_compression(spark, tables):
    """op3's score: sizes under both dictionaries, then the logistic curve."""
    folder, docs = tables
    model = fit_quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"), ~held_out(3, 1))
    want = plain_scores(model, docs)
    from riskspan.llm.queries import op3_quality_classifier
    got = {r.doc_id: (r.score, r.predicted) for r in op3_quality_classifier(spark, folder).collect()}
    assert set(got) == set(want)
    for i, (score, predicted) in got.items():
        assert score == pytest.approx(want[i], abs=1e-9) and predicted == int(want[i] >= 0.5)


def plain_scores(model, docs):
    good, bad = compressor(model.good), compressor(model.bad)
    out = {}
    for i, text, *_ in docs:
        raw = (text or "").encode()
        chunks = [raw[k:k + CHUNK] for k in range(0, len(raw), CHUNK)]
        gain = sum(len(bad.compress(c)) - len(good.compress(c)) for c in chunks) / (len(raw) + 1)
        z = model.slope * gain + model.shortness * float(shortness(np.array([len(raw)]))[0]) + model.intercept
        out[i] = 1 / (1 + np.exp(-z))
    return out


def test_rows_of_every_stage(spark, tables):
    folder, docs = tables
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit_quality(frame, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"), ~held_out(3, 1))
    scores = plain_scores(model, docs)
    rows = [(i, t) for i, t, *_ in docs if scores[i] >= 0.5]
    assert 60 <= len(rows) < len(docs)
    found = {r.doc_id: r.text for r in P.quality(spark, frame, folder).collect()}
    assert found == dict(rows)

    null = [(i, t) for i, t in rows if t is None]
    rows = [(i, kept) for i, kept, n, gone in kept_lines([r for r in rows if r[1] is not None], MIN_LINES, P.LONE_BYTES) if gone < n] + null
    frame = P.lines(spark, spark.createDataFrame([(i, t, None, None, 0) for i, t in found.items()], SCHEMA), folder)
    assert sorted((r.doc_id, r.text or "") for r in frame.collect()) == sorted((i, t or "") for i, t in rows)

    rows.sort()
    sets, root = groups(rows, 5)
    first = {}
    for (i, t), s, r in zip(rows, sets, root):
        if s:
            first.setdefault(r, i)
    rows = [(i, t) for (i, t), s, r in zip(rows, sets, root) if not s or first[r] == i]
    frame = P.near_duplicates(spark, frame, folder)
    assert sorted((r.doc_id, r.text or "") for r in frame.collect()) == sorted((i, t or "") for i, t in rows)

    kept = words_expected([t for _, t in rows], P.REPEAT_WORDS)
    rows = [(i, text if gone else t) for (i, t), (n, gone, text) in zip(rows, kept) if not gone or gone < n]
    assert any(gone for _, gone, _ in kept)
    frame = P.substrings(spark, frame, folder)
    assert sorted((r.doc_id, r.text or "") for r in frame.collect()) == sorted((i, t or "") for i, t in rows)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, lo in enumerate(range(0, len(ids), P.CAPACITY)):
            part = np.asarray(ids[lo:lo + P.CAPACITY], "<u4")
            want.append((i, piece, lo, len(part), zlib.crc32(part.tobytes())))
    out = P.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= P.CAPACITY


def test_stages_on_empty_and_clashing_tables(spark, tables):
    from tests.llm.data import clashing, empty
    folder, docs = tables
    for name, stage in P.STAGES:
        assert stage(spark, empty(spark), folder).collect() == [], name
        if name != "packing":
            frame = clashing(spark.createDataFrame(docs[:12] + docs[-3:], SCHEMA))
            assert stage(spark, frame, folder).columns == frame.columns, name
