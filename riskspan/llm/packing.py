"""Best-fit packing by minimum bin slack.

Every document becomes token ids and, if longer than a sequence, pieces.  The
packing needs only how many pieces there are of each length, so the plan is
made from that histogram (at most ``capacity`` counts, however many pieces):
take the longest length left, find by a bitset subset-sum over the available
lengths the fullest combination that fits beside it, use this combination as
often as the counts allow, remove it, repeat.  Pieces are then numbered within
their length (salted, so that a length which a third of all pieces share is
numbered by many tasks) and each looks its place up in the plan.

Defined cases: null texts are empty and become the closing id alone; repeated
rows are packed one by one; null ids are kept; of the input only the id and
the text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from riskspan.llm.bpe import byte_letters
from riskspan.llm.common import small_batches, stored, worker_cache

# words, and pretokens, of each of two generations in the cache
CACHE_WORDS = 100_000
# documents whose words are looked up together (a batch is bounded in bytes as well)
DOCS_AT_ONCE = 2048
# ASCII separators that str.split() takes for white space and the tokenizer does not
_SEPARATORS = re.compile("[\x1c-\x1f]")
# texts without these have the ids of their lower case (below U+0250 it goes letter by letter)
_ODD = re.compile("[\u0130\u0250-\U0010ffff]|<\\|")
# FIXED VALUES: the published pattern that splits a word into pretokens
_PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# a word of letters, with signs behind it or not, that splits into these two parts
_SIMPLE = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]{1,100})([.,;:!?)\"]*)")
_NEVER = 1 << 62


def _plain(text: str) -> bool:
    return "<|" not in text if text.isascii() else not _ODD.search(text)


_SLOTS, _SPREAD, _SHIFT = 1 << 18, 0x1E3779B97F4A7C15, 40


class WordEncoder:
    """Token ids of whole texts for a tokenizer that drops white space: ids
    are looked up word by word.

    New words of plain Latin letters, digits and signs are split and merged
    here; words with other characters, whose normal form or lower case need
    tables, and special tokens go to the library.
    """

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            x, y = pair if isinstance(pair, list) else pair.split(" ")
            merges[(vocab[x] << 20) | vocab[y]] = (rank << 20) | vocab[x + y]
        # pairs in a table of slots; a taken slot passes on to the next one
        self.slot_key, self.slot_value = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, np.int64)
        with np.errstate(over="ignore"):
            home = ((np.array(list(merges), np.int64) * _SPREAD) >> _SHIFT & (_SLOTS - 1)).tolist()
        taken: dict[int, tuple[int, int]] = {}
        for slot, (key, value) in zip(home, merges.items()):
            while slot in taken:
                slot = (slot + 1) & (_SLOTS - 1)
            taken[slot] = (key, value)
        at = np.array(list(taken), np.int64)
        self.slot_key[at], self.slot_value[at] = np.array(list(taken.values()), np.int64).reshape(-1, 2).T
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            self.inner[byte], self.last[byte] = vocab[letter], vocab[letter + end]
        self.known, self.known_before = {}, {}
        self.cached, self.cached_before = {}, {}

    def _by_library(self, texts: list[str]) -> list[bytes]:
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _pair(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """order << 20 | merged id of every pair, or _NEVER."""
        key = (x << 20) | y
        slot = (key * _SPREAD) >> _SHIFT & (_SLOTS - 1)
        held = self.slot_key[slot]
        out = np.where(held == key, self.slot_value[slot], _NEVER)
        more = np.flatnonzero((held != key) & (held >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & (_SLOTS - 1)
            held = self.slot_key[slot[more]]
            hit = held == key[more]
            out[more[hit]] = self.slot_value[slot[more[hit]]]
            more = more[~hit & (held >= 0)]
        return out

    def _merge_all(self, data: np.ndarray) -> list[bytes]:
        """Merges of tokens of one byte length (a row each): every round
        takes the first pair of the lowest order in each row that has one."""
        count, width = data.shape
        parts = self.inner[data]
        parts[:, -1] = self.last[data[:, -1]]
        out: list[bytes] = [b""] * count
        rows = np.arange(count)
        ranks = self._pair(parts[:, :-1].reshape(-1), parts[:, 1:].reshape(-1)).reshape(count, width - 1)
        while len(rows):
            if width > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
                done = best == _NEVER
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                flat = parts[done].astype("<u4").tobytes()
                for k, row in enumerate(rows[done].tolist()):
                    out[row] = flat[4 * width * k:4 * width * (k + 1)]
                go = ~done
                rows, parts = rows[go], parts[go]
                if not len(rows):
                    break
                ranks, at, best = ranks[go], at[go], best[go]
            every, place = np.arange(len(rows)), np.arange(width - 1)
            parts = np.take_along_axis(parts, place + (place > at[:, None]), 1)
            parts[every, at] = best & 0xFFFFF
            width -= 1
            if width == 1:
                continue
            place = place[:width - 1]
            ranks = np.take_along_axis(ranks, place + (place >= at[:, None]), 1)
            right, left = np.flatnonzero(at < width - 1), np.flatnonzero(at > 0)
            ranks[right, at[right]] = self._pair(parts[right, at[right]], parts[right, at[right] + 1])
            ranks[left, at[left] - 1] = self._pair(parts[left, at[left] - 1], parts[left, at[left]])
        return out

    def _learn(self, new: list[str]):
        """Ids of new words; a word is one or two pretokens most of the time."""
        known, find, simple = self.known, _PRETOKENS.findall, _SIMPLE.fullmatch
        alone, pairs, other, split, fresh = [], [], [], [], set()
        for word in new:
            parts = simple(word)
            if parts:
                if parts[2]:
                    pairs.append((word, parts[1].lower(), parts[2]))
                else:
                    alone.append(word)
            # below U+0250 texts are in normal form and lower case goes letter by letter
            elif len(word) > 100 or "<|" in word or not (word.isascii() or max(word) < "\u0250" and "\u0130" not in word):
                other.append(word)
            else:
                tokens = find(word.lower())
                split.append((word, tokens))
                fresh.update(tokens)
        lower = "\n".join(alone).lower().split("\n") if alone else []
        fresh.update(lower)
        fresh.update([p[1] for p in pairs], [p[2] for p in pairs])
        if len(self.cached) > CACHE_WORDS:
            self.cached, self.cached_before = {}, self.cached
        cached = self.cached
        fresh.difference_update(cached)
        for token in fresh & self.cached_before.keys():
            cached[token] = self.cached_before[token]
            fresh.discard(token)
        by_size: dict[int, list[str]] = {}
        for token in fresh:
            by_size.setdefault(len(token) if token.isascii() else len(token.encode("utf-8")), []).append(token)
        for size, tokens in by_size.items():
            data = np.frombuffer("".join(tokens).encode("utf-8"), np.uint8).reshape(len(tokens), size)
            cached.update(zip(tokens, self._merge_all(data)))
        known.update(zip(alone, map(cached.__getitem__, lower)))
        for word, x, y in pairs:
            known[word] = cached[x] + cached[y]
        for word, tokens in split:
            known[word] = b"".join([cached[t] for t in tokens])
        known.update(zip(other, self._by_library(other) if other else []))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [None if _SEPARATORS.search(t) else (t.lower() if _plain(t) else t).split() for t in texts]
        words = set().union(*[w for w in split if w]) if split else set()
        if len(self.known) > CACHE_WORDS:
            self.known, self.known_before = {}, self.known
        words.difference_update(self.known)
        for word in words & self.known_before.keys():
            self.known[word] = self.known_before[word]
            words.discard(word)
        self._learn(list(words))
        known = self.known
        return [self._by_library([t])[0] if w is None else b"".join([known[x] for x in w])
                for t, w in zip(texts, split)]


def encoder(path: str) -> WordEncoder:
    held = worker_cache("packing")
    if path not in held:
        held[path] = WordEncoder(path)
    return held[path]


def _pieces(path: str, capacity: int, closing: int, with_ids: bool):
    def run(batches):
        enc = encoder(path)
        close = np.asarray([closing], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                docs, texts = part["doc_id"].to_pylist(), [t or "" for t in part["text"].to_pylist()]
                rows: list[tuple] = []
                for doc, ids in zip(docs, enc.ids(texts)):
                    ids += close
                    total = len(ids) // 4
                    for k, start in enumerate(range(0, total, capacity)):
                        own = ids[4 * start:4 * (start + capacity)]
                        row = (doc, k, start, len(own) // 4, zlib.crc32(own))
                        rows.append((*row, np.frombuffer(own, "<u4").tolist()) if with_ids else row)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                                                 names=names[:len(rows[0])])

    return run


def tokenized_pieces(docs: DataFrame, path: str, capacity: int, closing: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32 (and
    ids)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_pieces(path, capacity, closing, with_ids), schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum <= room.

    Bit s of ``reach`` is set if some combination adds up to s; counts enter
    in powers of two, longer lengths first.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length)
        size = 1
        while left > 0:
            take = min(size, left)
            more = (reach | (reach << (take * length))) & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= take * length
    return used


def slack_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: number}) combinations that use up all counts."""
    left, plan = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = fullest({k: v for k, v in rest.items() if v and k <= capacity - longest}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        plan.append((times, used))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


SHIFT = 48


def _lookup_table(plan, capacity: int):
    """Rows (length, first rank, number in a sequence, first sequence, first
    place) sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, used in plan:
        place = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rank = taken.get(length, 0)
            rows.append(((length << SHIFT) + rank, n, sequence, place))
            taken[length] = rank + n * times
            place += n * length
        sequence += times
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 4)


def _place(table: np.ndarray):
    def run(batches):
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch["_rank"].to_numpy(zero_copy_only=False).astype(np.int64)
            row = table[np.searchsorted(table[:, 0], (length << SHIFT) + rank, "right") - 1]
            step = (length << SHIFT) + rank - row[:, 0]
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in names], pa.array(row[:, 2] + step // row[:, 1], pa.int64()),
                 pa.array(row[:, 3] + step % row[:, 1] * length, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (column ``length``; id columns doc_id, piece) with
    ``sequence_id`` and ``offset``."""
    pieces = stored(pieces, "pieces")
    n = pieces.count()
    salts = max(1, int(np.ceil(np.sqrt(n))))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    # at most `capacity` rows, whatever the number of pieces
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = _lookup_table(slack_plan(counts, capacity), capacity)
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_row", F.row_number().over(inside)).join(starts, ["length", "_salt"]) \
        .select(*pieces.columns, (F.col("_first") + F.col("_row") - 1).cast("long").alias("_rank"))
    schema = pieces.schema.add("sequence_id", LongType()).add("offset", LongType())
    return ranked.mapInArrow(_place(table), schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, closing: int = 0,
                   with_ids: bool = False) -> DataFrame:
    return pack(tokenized_pieces(docs, path, capacity, closing, with_ids), capacity)
