"""Compression classifier for text quality.

Two zstandard dictionaries are built from texts labelled good and bad.  A
text is cut into chunks of ``CHUNK`` bytes; each chunk is compressed once with
either dictionary.  The difference of the two compressed sizes, summed over
the whole text and divided by its bytes, tells which kind of text it
resembles; a logistic calibration on labelled rows that the dictionaries have
not seen turns it (with a term for very short texts) into a score.

The model is fitted on a bounded sample: at most ``sample_rows`` labelled rows
of each class, chosen by a hash of the id, and from each row at most
``sample_chunks`` chunks spread evenly over its text.  Scoring covers every
byte of every text.

Defined cases: null and empty texts get the score of zero difference; labels
with null or other values, null ids and ids whose labels disagree teach
nothing; without labels of both classes all texts get the smoothed share of
good labels; repeated rows are scored alike; input columns named like a
result column are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskspan.llm.common import carried, small_batches, text_bytes, uncarried

CHUNK = 1024
DICTIONARY_BYTES = 32 << 10
LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    shortness: float
    intercept: float

    def compressors(self):
        key = (self.good, self.bad)
        if key not in _COMPRESSORS:
            _COMPRESSORS.clear()
            _COMPRESSORS[key] = tuple(_compressor(d) for d in key)
        return _COMPRESSORS[key]

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) per byte."""
        if not self.good:
            return 0.0
        good, bad = self.compressors()
        total = 0
        for at in range(0, len(text), CHUNK):
            chunk = text[at:at + CHUNK]
            total += len(bad.compress(chunk)) - len(good.compress(chunk))
        return total / (len(text) + 1)

    def scores(self, difference: np.ndarray, size: np.ndarray) -> np.ndarray:
        z = self.slope * difference + self.shortness * shortness(size) + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


_COMPRESSORS: dict = {}


def shortness(size: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + size / 50.0)


def _compressor(data: bytes):
    kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    words = zstandard.ZstdCompressionDict(data, dict_type=kind)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


def _dictionary(chunks: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary themselves
        return b"".join(chunks)[-DICTIONARY_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    xs, w = x / scale, np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-3)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(xs @ w, -30, 30)))
        gradient = xs.T @ (weight * (p - y)) + ridge * w
        hessian = (xs * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ xs + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _spread_chunks(limit: int):
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            rows = []
            for i in range(batch.num_rows):
                lo, size = int(offsets[i]), int(offsets[i + 1] - offsets[i])
                chunks = max(1, -(-size // CHUNK))
                picked = np.unique(np.linspace(0, chunks - 1, min(limit, chunks)).astype(int))
                rows.append([raw[lo + k * CHUNK:min(lo + (k + 1) * CHUNK, lo + size)].tobytes() for k in picked.tolist()])
            yield pa.RecordBatch.from_arrays(
                [batch["label"], batch["turn"], pa.array(rows, pa.list_(pa.binary())),
                 pa.array(np.diff(offsets), pa.int64())], names=["label", "turn", "chunks", "size"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, teach: Column, sample_rows: int = 3000, sample_chunks: int = 16,
                text: str = "text") -> QualityModel:
    """``teach``: condition on doc_id that labelled rows must meet."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most").where(teach)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    share = (n1 + 1) / (n0 + n1 + 2)
    flat = QualityModel(b"", b"", 0.0, 0.0, float(np.log(share / (1 - share))))
    if not n0 or not n1:
        return flat
    turn = F.xxhash64("doc_id")
    sample = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).select("doc_id", "label", turn.alias("turn")) \
            .orderBy("turn", "doc_id").limit(sample_rows)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * sample_rows ids: a proven bound for the broadcast
    texts = small_batches(docs).select(F.col("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id") \
        .select(F.col("label").cast("long").alias("label"), "turn", "text")
    rows = texts.mapInArrow(_spread_chunks(sample_chunks),
                            "label long, turn long, chunks array<binary>, size long").collect()
    rows = sorted(((r["turn"], r["label"], [bytes(c) for c in r["chunks"]]) for r in rows), key=lambda r: (r[0], r[1], r[2]))
    halves: dict = {(label, k): [] for label in (0, 1) for k in (0, 1)}
    seen = {0: 0, 1: 0}
    for _, label, chunks in rows:
        halves[label, seen[label] % 2].append(chunks)
        seen[label] += 1
    if not all(len(x) for x in halves.values()):
        for label in (0, 1):
            halves[label, 0] = halves[label, 1] = halves[label, 0] + halves[label, 1]
        if not halves[0, 0] or not halves[1, 0]:
            return flat
    books = {label: _dictionary([c for chunks in halves[label, 0] for c in chunks if c]) for label in (0, 1)}
    if not books[0] or not books[1]:
        return flat
    model = QualityModel(books[1], books[0], 0.0, 0.0, 0.0)
    texts = [(b"".join(chunks), label) for label in (0, 1) for chunks in halves[label, 1]]
    size = np.array([len(t) for t, _ in texts], float)
    difference = np.array([model.difference(t) for t, _ in texts])
    y = np.array([label for _, label in texts], float)
    weight = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum()))
    weight *= len(y) / weight.sum()
    w = _logistic(np.stack([difference, shortness(size), np.ones(len(y))], axis=1), y, weight)
    model.slope, model.shortness, model.intercept = map(float, w)
    return model


def _score(model: QualityModel, names: list[str]):
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            data = raw.tobytes()
            diff = np.array([model.difference(data[offsets[i]:offsets[i + 1]]) for i in range(batch.num_rows)], float)
            score = model.scores(diff, np.diff(offsets).astype(float))
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], pa.array(score, pa.float64())],
                                             names=[*names, "made"])

    return run


def _scored(docs: DataFrame, model: QualityModel, text: str) -> DataFrame:
    base = carried(docs, text)
    schema = StructType([*base.schema.fields, StructField("made", DoubleType())])
    return base.mapInArrow(_score(model, base.columns), schema)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    return uncarried(_scored(docs, model, text), docs, text, score=F.col("made"),
                     predicted=(F.col("made") >= 0.5).cast("int"))


def quality_stage(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return uncarried(_scored(docs, model, text).where(F.col("made") >= 0.5), docs, text)
