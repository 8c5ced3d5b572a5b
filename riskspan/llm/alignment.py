"""Alignment of two tokenizers by galloping intersection of token ends.

Every text is encoded by a byte-level BPE (A, with a space in front) and by a
sentencepiece BPE with byte fallback (B, which adds that space itself).  Each
side's tokens have ascending end offsets in the same bytes.  The shorter list
of ends drives an exponential, then a binary search into the longer; the ends
found in both cut the tokens of either side into groups, and differences of
the ends' ranks give the token ranges of a group (``gallop``).  The two tokens
that end a group are a link.

Texts are cut before single spaces between other characters: neither side has
a token across such a place, so pieces are encoded and aligned once and used
again (a bounded cache only saves work).  A link's count over all texts needs
one exchange of (pair, count) rows that are summed for each block of about
``SLICE_BYTES`` of texts before; texts are not shuffled.

Defined cases: null and empty texts, and texts whose bytes a side does not
give back, have no tokens, zeros and an empty digest, and count for no link;
special tokens in a text are plain text; repeated rows count again; ties for a
B token's most frequent partner are all best; extra columns are passed on, and
an input column named like a result column is replaced; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from riskspan.llm.bpe import byte_letters
from riskspan.llm.common import carried, slices, stored, uncarried

# Cached pieces are dropped beyond so many, or so many characters; so many at
# a time are encoded.
CACHE_PIECES, CACHE_CHARS = 120_000, 8 << 20
LEARNED = 4096
# Pieces that side A encodes as one text.
JOINED = 64
SHIFT = 32  # a pair of ids as one long: A's id above B's

_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every value of ``short`` its lower bound in ``long`` (both
    ascending).  Every 64th value gallops from the start; the values after it
    gallop from where it ended, all at the same time."""
    n, m = len(short), len(long)
    low = np.zeros(n, np.int64)
    if not n or not m:
        return low
    stride = 64
    heads = np.arange(0, n, stride)
    low[heads] = _search(short[heads], long, np.zeros(len(heads), np.int64))
    return _search(short, long, np.repeat(low[heads], stride)[:n])


def _search(values: np.ndarray, long: np.ndarray, low: np.ndarray) -> np.ndarray:
    m = len(long)
    low = low.copy()
    step = np.ones(len(values), np.int64)
    going = np.flatnonzero((low < m) & (long[np.minimum(low, m - 1)] < values))
    high = low.copy()
    while len(going):  # exponential: long[low] < value
        ahead = low[going] + step[going]
        below = (ahead < m) & (long[np.minimum(ahead, m - 1)] < values[going])
        high[going] = np.minimum(ahead, m)
        low[going[below]] = ahead[below]
        step[going[below]] *= 2
        going = going[below]
    # binary: long[low] < value <= long[high], or low == high
    going = np.flatnonzero(high > low)
    while len(going):
        middle = (low[going] + high[going]) // 2
        less = long[middle] < values[going]
        low[going] = np.where(less, middle + 1, low[going])
        high[going] = np.where(less, high[going], middle)
        going = going[low[going] < high[going]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` (ascending) of the values in both."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = gallop(short, long)
    found = np.flatnonzero((at < len(long)) & (long[np.minimum(at, max(len(long) - 1, 0))] == short)) \
        if len(long) else np.zeros(0, np.int64)
    return (found, at[found]) if short is a else (at[found], found)


def _rows(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``which`` of a list column, one after the other, and the
    offsets of the result."""
    size = offsets[which + 1] - offsets[which]
    ends = np.append(0, np.cumsum(size))
    at = np.repeat(offsets[which] - ends[:-1], size) + np.arange(ends[-1])
    return flat[at], ends


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists, one after the other, and their sizes."""
    return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


def _given_back(tokens, flat: np.ndarray, count: np.ndarray, raw: bytes, size: np.ndarray) -> np.ndarray:
    """Whether the ``count`` tokens of each piece have its ``size`` bytes."""
    parts = list(map(tokens.__getitem__, flat.tolist()))
    made = b"".join(parts)
    had = _sums(np.fromiter(map(len, parts), np.int64, len(parts)), np.append(0, np.cumsum(count)))
    if made == raw and (had == size).all():
        return np.ones(len(size), bool)
    to, at = np.cumsum(had).tolist(), np.cumsum(size).tolist()
    return np.array([made[i:j] == raw[k:m] for i, j, k, m in zip([0, *to], to, [0, *at], at)], bool)


class Lists:
    """A list column that grows by batches of lists."""

    def __init__(self):
        self.flat, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray):
        self.offsets = np.append(self.offsets, self.offsets[-1] + np.cumsum(sizes))
        self.flat = np.append(self.flat, flat)


class Side:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
                        for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, token in self.bytes_a.items():
            self.size_a[i] = len(token)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # ids with what follows one in the text of the groups
        self.ids = max(len(self.size_a), len(self.size_b))
        self.words = [f"{i}{mark}" for mark in ",|;\n" for i in range(self.ids)]
        # a token of B across a word's border would make cuts wrong
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)


@lru_cache(2)
def _sides(path_a: str, path_b: str) -> Side:
    """Loaded once in a worker."""
    return Side(path_a, path_b)


class Aligner:
    """Pieces of texts, encoded by both sides and aligned."""

    def __init__(self, path_a: str, path_b: str):
        self.side = _sides(path_a, path_b)
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.chars = 0
        self.whole = np.zeros(0, bool)
        self.text: list[str] = []
        self.ids_a, self.ids_b, self.cut_a, self.cut_b, self.pairs = (Lists() for _ in range(5))

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without the space before each."""
        if not self.side.cuts:
            return [text]
        if text[0] != " " and text[-1] != " " and not _WIDE.search(text):
            return text.split(" ")
        return _CUT.split(text)

    def _encoded_a(self, pieces: list[str], raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has.  Joined again by single
        spaces, pieces have the same tokens, since none crosses such a place."""
        texts = []
        for k in range(0, len(pieces), JOINED):
            text = " " + " ".join(pieces[k:k + JOINED])
            apart = _WIDE.search(text) or text[-1].isspace()
            texts += [" " + p for p in pieces[k:k + JOINED]] if apart else [text]
        side = self.side
        flat, _ = _flat([e.ids for e in side.a.encode_batch_fast(texts, add_special_tokens=False)])
        if b"".join(map(side.bytes_a.__getitem__, flat.tolist())) == raw:
            at, ends = np.cumsum(side.size_a[flat]), np.cumsum(size)
            last = np.searchsorted(at, ends)
            if (at[last] == ends).all():
                return flat, np.diff(last, prepend=-1)
        return _flat([e.ids for e in side.a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)])

    def learn(self, pieces: list[str]):
        """Encode and align pieces that are not known yet."""
        side = self.side
        raw = (" " + " ".join(pieces)).encode()
        size = 1 + np.fromiter(map(len, pieces) if raw.isascii() else (len(p.encode()) for p in pieces), np.int64, len(pieces))
        flat_a, size_a = self._encoded_a(pieces, raw, size)
        flat_b, size_b = _flat(side.b.encode(pieces, out_type=int, num_threads=1))
        whole = _given_back(side.bytes_a, flat_a, size_a, raw, size) & _given_back(side.bytes_b, flat_b, size_b, raw, size)
        if not whole.all():
            flat_a, flat_b = flat_a[np.repeat(whole, size_a)], flat_b[np.repeat(whole, size_b)]
            size_a, size_b = size_a * whole, size_b * whole
        # all pieces at once: offsets in their joined bytes
        at_a, at_b = common_ends(np.cumsum(side.size_a[flat_a]), np.cumsum(side.size_b[flat_b]))
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        owner = np.searchsorted(first_a + size_a, at_a, "right")
        groups = np.bincount(owner, minlength=len(pieces))
        self.ids_a.add(flat_a, size_a)
        self.ids_b.add(flat_b, size_b)
        self.cut_a.add(at_a + 1 - first_a[owner], groups)
        self.cut_b.add(at_b + 1 - first_b[owner], groups)
        self.pairs.add(flat_a[at_a] << SHIFT | flat_b[at_b], groups)
        self.whole = np.append(self.whole, whole)
        # the tokens in the order of the text: A's, then B's of each group
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        mark_a, mark_b = np.zeros((2, max(len(flat_a), len(flat_b))), np.int64)
        mark_a[at_a], mark_b[at_b] = 1, 2
        mark_b[at_b[np.diff(owner, append=-1) != 0]] = 3
        words = np.empty(len(flat_a) + len(flat_b), np.int64)
        words[np.arange(len(flat_a)) + np.repeat(at_b + 1 - in_b, in_a)] = mark_a[:len(flat_a)] * side.ids + flat_a
        words[np.arange(len(flat_b)) + np.repeat(at_a + 1, in_b)] = mark_b[:len(flat_b)] * side.ids + flat_b
        lines = iter("".join(map(side.words.__getitem__, words.tolist())).split("\n"))
        self.text += [next(lines) if n else "" for n in groups.tolist()]

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces of the texts and the offsets of the texts;
        a text that a side does not give back has no pieces."""
        if len(self.number) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.clear()
        held, new = [], []
        for text in texts:
            parts = self.pieces(text) if text else []
            for p in set(parts).difference(self.number):
                self.number[p] = len(self.number)
                self.chars += len(p)
                new.append(p)
            held.append(np.fromiter(map(self.number.__getitem__, parts), np.int32, len(parts)))
            if len(new) >= LEARNED:
                self.learn(new)
                new = []
        if new:
            self.learn(new)
        held = [found if self.whole[found].all() else found[:0] for found in held]
        ends = np.append(0, np.cumsum([len(h) for h in held])).astype(np.int64)
        return np.concatenate(held) if held else np.zeros(0, np.int32), ends


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[ends[1:]] - total[ends[:-1]]


def _list(values: np.ndarray, kind) -> pa.ListArray:
    """One list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


_MADE = [("n_a", LongType()), ("n_b", LongType()), ("n_groups", LongType()), ("n_links", LongType()),
         ("groups_sha256", StringType())]
# A block is a slice of an Arrow batch: its rows, the different pairs of ids
# that their links have and how often each occurs (``pairs``, ``times``), and
# for every row the places of its own pairs in that list and how often it has
# each (``places``, ``uses``: whole numbers as bytes; starts: where a row's begin).
_BLOCK = [("starts", ArrayType(IntegerType())), ("places", BinaryType()), ("uses", BinaryType()),
          ("pairs", ArrayType(LongType())), ("times", ArrayType(LongType()))]
# Blocks are read in groups of about so many bytes.
GROUP_BYTES = 8 << 20


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the smallest width that holds them all."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}") if n else np.zeros(0, np.uint8)


def _block(aligner: Aligner, row: pa.Array, texts: list[str | None], kind: pa.DataType) -> pa.RecordBatch:
    pieces, ends = aligner.numbers(texts)
    sizes = [np.diff(side.offsets) for side in (aligner.ids_a, aligner.ids_b, aligner.pairs)]
    n_a, n_b, n_groups = (_sums(s[pieces], ends) for s in sizes)
    digests = []
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
        text = ";".join(map(aligner.text.__getitem__, pieces[lo:hi].tolist()))
        digests.append(hashlib.sha256(text.encode()).hexdigest() if hi > lo else "")
    own, place = np.unique(pieces, return_inverse=True)
    links, links_at = _rows(aligner.pairs.flat, aligner.pairs.offsets, own)
    pairs, links = np.unique(links, return_inverse=True)
    links, _ = _rows(links.reshape(-1), links_at, place.reshape(-1))
    links += np.repeat(np.arange(len(texts)) * len(pairs), n_groups)
    held, uses = np.unique(links, return_counts=True)
    owner, held = np.divmod(held, max(len(pairs), 1))
    starts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))
    times = np.bincount(held, uses, len(pairs)).astype(np.int64)
    made = [pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_groups), pa.array(digests, pa.string())]
    rows = pa.StructArray.from_arrays([row, *made], fields=list(kind))
    columns = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), _list(starts, pa.int32()),
               pa.array([_packed(held)]), pa.array([_packed(uses)]), _list(pairs, pa.int64()), _list(times, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["rows", *[n for n, _ in _BLOCK]])


def _blocks(path_a: str, path_b: str, kind: pa.DataType):
    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            row, text = batch["row"], batch["text"]
            row = row.cast(kind[0].type) if row.type != kind[0].type else row
            size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            for lo, hi in slices(np.append(0, np.cumsum(size, dtype=np.int64))):
                yield _block(aligner, row.slice(lo, hi - lo), text.slice(lo, hi - lo).to_pylist(), kind)

    return run


def _counted(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The rows of one block with sums over the counts of their links."""
    one = blocks.combine_chunks().to_batches()[0]
    starts, pairs = (one[k].flatten().to_numpy(zero_copy_only=False) for k in ("starts", "pairs"))
    places, uses = (_unpacked(one[k][0].as_py(), starts[-1]) for k in ("places", "uses"))
    at, sums = counts["place"].to_numpy(), []
    for k in ("best", "n"):
        each = np.zeros(len(pairs), np.int64)
        each[at] = counts[k].to_numpy()
        sums.append(_sums(each[places] * uses.astype(np.int64), starts))
    rows = one["rows"].flatten()
    names = [rows.type[k].name for k in range(rows.type.num_fields)]
    return pa.Table.from_arrays([*rows.flatten(), *map(pa.array, sums)], names=[*names, "n_best", "count_sum"])


def _row_type(base: DataFrame) -> StructType:
    return StructType([base.schema["row"], *[StructField(n, t) for n, t in _MADE]])


def link_counts(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``docs`` with the sizes of each text's alignment (``n_a``, ``n_b``,
    ``n_groups``, ``n_links``), ``n_best`` (links whose pair of ids is the most
    frequent one of its B id over all texts), ``count_sum`` (over the links,
    how many links have the pair) and ``groups_sha256``."""
    base = carried(docs, text)
    row = _row_type(base)
    schema = StructType([StructField("rows", ArrayType(row)), *[StructField(n, t) for n, t in _BLOCK]])
    kind = pa.struct(list(to_arrow_schema(row)))
    blocks = stored(base.mapInArrow(_blocks(path_a, path_b, kind), schema)
                    .withColumn("gid", F.monotonically_increasing_id()), "blocks", GROUP_BYTES)
    entries = blocks.select("gid", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "e")) \
        .select("gid", "place", F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    totals = stored(entries.groupBy("pair").agg(F.sum("times").alias("n")), "pairs") \
        .withColumn("b", F.col("pair").bitwiseAND((1 << SHIFT) - 1))
    top = totals.groupBy("b").agg(F.max("n").alias("top"))
    known = totals.join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    answers = entries.join(known, "pair").select(F.col("gid").alias("of"), "place", "n", "best")
    out = StructType([*blocks.schema["rows"].dataType.elementType.fields, StructField("n_best", LongType()),
                      StructField("count_sum", LongType())])
    # a block meets the counts of its pairs as a sorted stream, not as one more list
    found = blocks.groupBy("gid").cogroup(answers.groupBy("of")).applyInArrow(_counted, out)
    names = [n for n, _ in _MADE] + ["n_best", "count_sum"]
    # the text is not carried along: it is no column of the result
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()])
    return uncarried(found, rest, text, **{n: F.col(n) for n in names})


def _aligned(path_a: str, path_b: str, names: list[str]):
    def run(batches):
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            pieces, ends = aligner.numbers(batch["text"].to_pylist())
            made = []
            for ids, cuts in ((aligner.ids_a, aligner.cut_a), (aligner.ids_b, aligner.cut_b)):
                flat, at = _rows(ids.flat, ids.offsets, pieces)
                cut, cut_at = _rows(cuts.flat, cuts.offsets, pieces)
                # a cut counts tokens of its piece; those of earlier pieces of the text come on top
                earlier = at[:-1] - np.repeat(at[ends[:-1]], np.diff(ends))
                cut = cut + np.repeat(earlier, np.diff(cut_at))
                made += [pa.ListArray.from_arrays(pa.array(at[ends], pa.int32()), pa.array(flat, pa.int32())),
                         pa.ListArray.from_arrays(pa.array(cut_at[ends], pa.int32()), pa.array(cut, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], made[0], made[2], made[1], made[3]],
                                             names=[*names, "ids_a", "ids_b", "ends_a", "ends_b"])

    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``docs`` with both sides' ids and the groups: group g holds the tokens
    up to (not with) ``ends_a[g]`` and ``ends_b[g]`` from where the one before
    it ends."""
    base = carried(docs, text)
    made = ["ids_a", "ids_b", "ends_a", "ends_b"]
    schema = StructType([*base.schema.fields, *[StructField(n, ArrayType(IntegerType())) for n in made]])
    out = base.mapInArrow(_aligned(path_a, path_b, base.columns), schema)
    return uncarried(out, docs, text, **{n: F.col(n) for n in made})
