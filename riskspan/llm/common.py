"""Helpers shared by the corpus operators: text and word arrays, rolling
fingerprints, tables kept in the shared folder.

Everything here works on Arrow batches inside Spark tasks; nothing is
collected to the driver.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspan.session import scratch_dir

# One task works through its texts in pieces of about this many bytes, so its
# arrays stay small however many texts a batch holds.
SLICE_BYTES = 1 << 20

# Arrow batches between Spark and Python (a longer text has one of its own).
BATCH_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_U = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the bytes of an Arrow batch: ten thousand rows, the default
    bound, can be any number of bytes.  A side effect on the caller's session:
    the setting stays, since it is read when the plan runs."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What an operator keeps between tasks in this Python worker.  What other
    operators kept goes: workers serve one stage after the other."""
    for other in [k for k in _CACHES if k != owner]:
        del _CACHES[other]
    return _CACHES.setdefault(owner, {})


def stored(df: DataFrame, name: str, group_bytes: int = 0) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, which
    cuts the lineage and survives lost executors.

    ``group_bytes``: for wide rows, about the size of a row group.  A writer
    holds one in memory and a reader opens up to 4096 rows of one at once; by
    default its size is looked at after a hundred rows only."""
    path = scratch_dir(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    if group_bytes:
        out = out.option("parquet.block.size", group_bytes).option("parquet.page.size.row.check.min", 1)
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: spreads every input bit over the result."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A fixed pseudo-random 64-bit code for each byte value."""
    return mix64((np.arange(256, dtype=_U) + _U(1)) * _U(0x9E3779B97F4A7C15) + _U(seed))


class Rolling:
    """Fingerprints of all windows of a sequence of 64-bit codes.

    ``sum(code[i] * base**(i - start))`` by prefix sums, times a mixing step;
    here modulo 2**64, in ``PrimeRolling`` modulo a prime.  Powers are kept for
    the first ``KEPT`` places; those further on are a kept one times a power of
    ``base**KEPT``.
    """

    KEPT = 1 << 18

    def __init__(self, base: int):
        self.base = base | 1

    def _inverse(self) -> int:
        return pow(self.base, -1, 1 << 64)

    def times(self, a, b):
        return a * b

    def whole(self, x: np.ndarray) -> np.ndarray:
        return x

    def terms(self, codes: np.ndarray) -> np.ndarray:
        return codes * self.power[:len(codes)]

    def summed(self, terms: np.ndarray) -> np.ndarray:
        return np.cumsum(terms, dtype=_U)

    def plus(self, a, b):
        return a + b

    def minus(self, a, b):
        return a - b

    def _powers(self, base: int) -> np.ndarray:
        out = np.ones(1, _U)
        step = np.full(1, base, _U)
        while len(out) < self.KEPT:
            out = np.concatenate([out, self.times(out, step)])
            step = self.times(step, step)
        return out

    @cached_property
    def power(self) -> np.ndarray:
        return self._powers(self.base)

    @cached_property
    def back(self) -> np.ndarray:
        return self._powers(self._inverse())

    def _far(self, kept: np.ndarray, count: int) -> np.ndarray:
        """Powers of (kept[-1] * kept[1]) = base**KEPT, ``count`` of them."""
        step, out = self.times(kept[-1:], kept[1:2]), [np.ones(1, _U)]
        for _ in range(count - 1):
            out.append(self.times(out[-1], step))
        return np.concatenate(out)

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        """Prefix sums with a leading zero."""
        n = len(codes)
        out = np.zeros(n + 1, dtype=_U)
        far = self._far(self.power, -(-n // self.KEPT)) if n > self.KEPT else None
        for k, lo in enumerate(range(0, n, self.KEPT)):
            terms = self.terms(codes[lo:lo + self.KEPT])
            if k:
                terms = self.times(terms, far[k])
            out[lo + 1:lo + 1 + len(terms)] = self.plus(self.summed(terms), out[lo])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Fingerprint of codes[start:end) for every pair."""
        start = np.asarray(start)
        value = self.minus(prefix[end], prefix[start])
        if len(prefix) <= self.KEPT:
            value = self.times(value, self.back[start])
        else:
            far = self._far(self.back, len(prefix) // self.KEPT + 1)
            value = self.times(self.times(value, self.back[start % self.KEPT]), far[start // self.KEPT])
        return mix64(self.whole(value) + (end - start).astype(_U))


class PrimeRolling(Rolling):
    """Modulo the prime 2**61 - 1, for which no pair of texts is the same
    whatever the base (modulo 2**64 some are, from 1024 codes on)."""

    P = (1 << 61) - 1

    def __init__(self, base: int):
        self.base = base % self.P

    def _inverse(self) -> int:
        return pow(self.base, -1, self.P)

    def reduced(self, x: np.ndarray) -> np.ndarray:
        """Below 2**61 + 8: enough for the next step, not yet the remainder."""
        return (x & _U(self.P)) + (x >> _U(61))

    def whole(self, x: np.ndarray) -> np.ndarray:
        return np.where(x >= _U(self.P), x - _U(self.P), x)

    def terms(self, codes: np.ndarray) -> np.ndarray:
        power = self.power[:len(codes)]
        if codes.dtype != np.uint32:
            return self.times(self.reduced(codes), power)
        # codes below 2**29 need half of the products
        cross = codes * (power >> _U(31))
        return self.reduced((cross >> _U(30)) + ((cross & _U((1 << 30) - 1)) << _U(31)) + codes * (power & _U((1 << 31) - 1)))

    def times(self, a, b):
        # halves of 31 bits: (2**31 * x + y) * (2**31 * u + v), and 2**61 = 1
        low = _U((1 << 31) - 1)
        x, y, u, v = a >> _U(31), a & low, b >> _U(31), b & low
        cross = x * v + y * u
        return self.reduced(x * u * _U(2) + (cross >> _U(30)) + ((cross & _U((1 << 30) - 1)) << _U(31)) + y * v)

    def summed(self, terms: np.ndarray) -> np.ndarray:
        # halves of 32 bits: no sum of up to 2**18 of them leaves 64 bits
        low = np.cumsum(terms & _U((1 << 32) - 1), dtype=_U)
        high = self.reduced(np.cumsum(terms >> _U(32), dtype=_U))
        # times 2**32 is a turn by 32 of 61 bits
        high = ((high << _U(32)) & _U(self.P)) | (high >> _U(29))
        return self.plus(high, self.reduced(low))

    def plus(self, a, b):
        return self.reduced(a + b)

    def minus(self, a, b):
        return self.reduced(a + (_U(2 * self.P) - b))


# equality of both decides; the first alone holds for any texts
ROLL_A = PrimeRolling(0x9E3779B97F4A7C15)
ROLL_B = Rolling(0xC2B2AE3D27D4EB4F)
CODE_A, CODE_B = byte_codes(0x51ED270B), byte_codes(0x2545F491)
# codes of bytes for ROLL_A, all different
SMALL_A = (CODE_A >> _U(35)).astype(np.uint32)


def local_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` codes, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        codes = codes[:-step] * _U(0x9E3779B97F4A7C15) + codes[step:]
        have += step
    return codes


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes of a string column (null: empty) and the
    offsets of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """Consecutive row ranges of about ``size`` bytes each (a longer text has
    a range of its own)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words_of(raw: np.ndarray, offsets: np.ndarray):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: start, end (byte places)
    and the first word of every text (one more entry at the end)."""
    gap = SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    inside = ~gap
    before = np.empty(len(raw), dtype=bool)
    if len(raw):
        before[0] = True
        before[1:] = gap[:-1]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(len(raw), dtype=bool)
    if len(raw):
        after[-1] = True
        after[:-1] = gap[1:]
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def word_codes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit code of every word; ``second``: another, unrelated one."""
    roll, code = (ROLL_B, CODE_B) if second else (ROLL_A, SMALL_A)
    return roll.spans(roll.prefix(code[raw]), start, end)


def pair_dtype():
    return np.dtype([("a", "<u8"), ("b", "<u8")])


def total_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and text bytes of a table: one small aggregate."""
    n, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(text)))).first()
    return n, size or 0


def carried(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``: every column but the text, as one struct, so that no name of
    the input can clash with a working column; ``text``."""
    small_batches(docs)
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).cast("int").alias("_none"))
    return docs.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))


def uncarried(df: DataFrame, docs: DataFrame, text: str = "text", **made) -> DataFrame:
    """The columns of ``docs`` again, in their order, then those in ``made``.
    A made column takes the place of an input column of the same name."""
    return _rebuilt(df, docs, text, made)


def _rebuilt(df: DataFrame, docs: DataFrame, text: str, made: dict) -> DataFrame:
    names = {k.lower(): k for k in made}
    out = []
    for c in docs.columns:
        if c.lower() in names:
            out.append(made[names.pop(c.lower())].alias(c))
        elif c.lower() == text.lower():
            out.append(F.col("text").alias(c))
        else:
            out.append(F.col("row").getField(c).alias(c))
    return df.select(*out, *[made[k].alias(k) for k in names.values()])


def with_text(docs: DataFrame, df: DataFrame, new: Column, text: str = "text") -> DataFrame:
    """``uncarried`` with the text replaced; a numeric column ``n_chars``
    follows the new text."""
    made = {text: new}
    for name, kind in docs.dtypes:
        if name.lower() == "n_chars" and kind in ("bigint", "int"):
            made[name] = F.length(new).cast(kind)
    return _rebuilt(df, docs, text, made)
