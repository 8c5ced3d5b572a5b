"""Blocks of the token alignment stay small, whatever the size of a batch or a file."""

import glob
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from riskspan.llm.alignment import Aligner, _blocks, _counted, _packed, _unpacked
from riskspan.llm.common import SLICE_BYTES, stored

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MADE = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]


def test_blocks_of_a_batch():
    rng = random.Random(7)
    known = ["".join(rng.choice("abcdeés'.") for _ in range(rng.randint(1, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(known, k=rng.choice([1, 300, 2000]))) for _ in range(600)] + [None, "", "▁ mark", "a b a b"]
    rows = pa.array([{"doc_id": i} for i in range(len(texts))], pa.struct([("doc_id", pa.int64())]))
    kind = pa.struct([("row", rows.type), *MADE])
    size = sum(len((t or "").encode()) for t in texts)
    assert size > 2 * SLICE_BYTES
    blocks = list(_blocks(A, B, kind)([pa.RecordBatch.from_arrays([rows, pa.array(texts)], names=["row", "text"])]))
    # before: one block of a batch, larger than its texts
    assert len(blocks) > 2 and max(b.nbytes for b in blocks) < SLICE_BYTES and sum(b.nbytes for b in blocks) < size
    totals = Counter()
    for b in blocks:
        totals.update(dict(zip(b["pairs"][0].as_py(), b["times"][0].as_py())))
    aligner = Aligner(A, B)
    pieces, ends = aligner.numbers(texts)
    at = aligner.pairs.offsets
    links = [[p for k in pieces[lo:hi] for p in aligner.pairs.flat[at[k]:at[k + 1]].tolist()] for lo, hi in zip(ends[:-1], ends[1:])]
    assert totals == Counter(p for own in links for p in own)
    got = []
    for b in blocks:
        counts = [(i, totals[p], int(p % 7 == 0)) for i, p in enumerate(b["pairs"][0].as_py())]
        rng.shuffle(counts)
        place, n, best = (pa.array([c[i] for c in counts], pa.int32() if i != 1 else pa.int64()) for i in range(3))
        found = _counted(pa.Table.from_batches([b]), pa.table({"place": place, "n": n, "best": best}))
        got += [(r["row"]["doc_id"], r["n_links"], r["n_best"], r["count_sum"]) for r in found.to_pylist()]
    assert got == [(i, len(own), sum(p % 7 == 0 for p in own), sum(totals[p] for p in own)) for i, own in enumerate(links)]


def test_packed():
    for values in ([], [0], [0, 255], [1, 256], [65_536, 3], [1 << 32, 0]):
        assert _unpacked(_packed(np.array(values, np.int64)), len(values)).tolist() == values
    assert len(_packed(np.array([255, 0]))) == 2 and len(_packed(np.array([256, 0]))) == 4


def test_row_groups_of_wide_rows(spark):
    wide = spark.range(60, numPartitions=1).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 512), 2000).alias("x"))
    for group_bytes, most in ((0, 60), (1 << 20, 10)):
        back = stored(wide, "wide", group_bytes)
        files = [f for p in {f.rsplit("/", 1)[0] for f in back.inputFiles()} for f in glob.glob(p.removeprefix("file:").replace("//", "") + "/*.parquet")]
        found = [m.row_group(i).num_rows for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
        assert sum(found) == 60 and max(found) <= most
        if not group_bytes:  # what a hundred rows weigh is not looked at
            assert max(found) == 60
        assert back.agg(F.sum("id")).first()[0] == sum(range(60))
