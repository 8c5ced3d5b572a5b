"""Exact repeated windows of long sequences, without pairs of documents.

Texts are dealt into groups of bounded size.  In every group the sequence
(words or bytes) of each text gets *anchors* that depend on local content
alone, so equal windows carry equal anchors at equal places.  Three rounds of
packed key exchanges then decide which windows occur twice:

1. anchors: an anchor whose content occurs once can't lie in a repeat;
2. stretches: all windows that share one anchor occurrence form a stretch;
   equal stretches settle all their windows at once, and one of each class of
   equal stretches speaks for the class;
3. windows: where several different stretches share an anchor, the windows
   of one of each class are compared one by one by 128-bit fingerprints.

Keys leave a group once, however often they occur in it, and a key's bucket
holds at most one copy per group: a run of text that a third of all rows
share costs no more than any other.  Only keys and bit flags travel after the
one shuffle that deals out the texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspan.llm.common import ROLL_A, ROLL_B, mix64, pair_dtype, slices, text_bytes, total_bytes, worker_cache

# Text bytes that one group holds on average.
GROUP_BYTES = 6 << 20
# Groups that even a small input gets, so that cores share the work.
LEAST_GROUPS = 64

KEYS = "bucket long, gid long, kind int, data binary"
FLAGS = "gid long, bucket long, kind int, data binary"
RESULT = ["row", "text", "kept", "size", "removed", "spans"]


@dataclass
class Slice:
    """Some texts of a group as one sequence.

    ``first``: place of each text's first element (one more at the end);
    ``a``: prefix sums of the elements' codes; ``codes``: gives the second
    codes, whose prefix sums only some rounds need; ``lo``, ``hi``: windows
    lo <= x < hi share the anchor at ``anchor`` (-1: no anchor);
    ``core``: 64-bit fingerprint of the anchor's content.
    """

    rows: tuple[int, int]
    first: np.ndarray
    a: np.ndarray
    codes: Callable[[], np.ndarray]
    lo: np.ndarray
    hi: np.ndarray
    anchor: np.ndarray
    core: np.ndarray

    @cached_property
    def b(self) -> np.ndarray:
        return ROLL_B.prefix(self.codes())


def group_count(docs: DataFrame) -> int:
    rows, size = total_bytes(docs)
    return max(LEAST_GROUPS, -(-size // GROUP_BYTES))


def _table(rows: list[tuple], names: tuple[str, ...], kinds) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), type=t) for n, c, t in zip(names, cols, kinds)})


_KEY_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.binary())


def _keys_table(gid: int, kind: int, packed) -> pa.Table:
    rows = [(k, gid, kind, v.tobytes()) for k, v in packed]
    return _table(rows, ("bucket", "gid", "kind", "data"), _KEY_TYPES)


def _reply(rows) -> pa.Table:
    return _table(rows, ("gid", "bucket", "kind", "data"), _KEY_TYPES)


def _entries(table: pa.Table, dtype):
    """All keys of a bucket with the row that sent each; rows of carried
    state apart."""
    gids, kinds = table["gid"].to_pylist(), table["kind"].to_pylist()
    buckets, data = table["bucket"].to_pylist(), table["data"].to_pylist()
    state = [(g, k, t, d) for g, k, t, d in zip(gids, buckets, kinds, data) if t < 0]
    sent = [(g, k, t, np.frombuffer(d, dtype)) for g, k, t, d in zip(gids, buckets, kinds, data) if t > 0]
    sent.sort(key=lambda x: x[0])
    keys = np.concatenate([x[3] for x in sent]) if sent else np.zeros(0, dtype)
    return state, sent, keys


def _unmark(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys without their mark, and which were marked."""
    keys, top = keys.copy(), np.uint64(1 << 63)
    last = keys["b"] if keys.dtype.names else keys
    many = (last & top) != 0
    last &= ~top
    return keys, many


def _repeated_keys(table: pa.Table, dtype) -> pa.Table:
    """For each row of a bucket: which of its keys are repeated.  A key that
    its group holds twice is sent with its top flag set (see ``_deal``)."""
    state, sent, keys = _entries(table, dtype)
    rows = [(g, k, t, d) for g, k, t, d in state]
    if len(keys):
        keys, many = _unmark(keys)
        _, inverse, count = _distinct(keys)
        count = count + np.bincount(inverse, weights=many, minlength=len(count)).astype(np.int64)
        flags = count[inverse] > 1
        at = 0
        for g, k, t, v in sent:
            rows.append((g, k, t, np.packbits(flags[at:at + len(v)]).tobytes()))
            at += len(v)
    return _reply(rows)


def _clear_top(keys: np.ndarray) -> np.ndarray:
    """Keys with the top bit of the last part free for ``_deal``."""
    if keys.dtype.names:
        keys["b"] &= np.uint64((1 << 63) - 1)
        return keys
    return keys & np.uint64((1 << 63) - 1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each different key, the number of the key that each
    entry equals, and counts.  Sorts by one 64-bit part, and by all parts only
    if two keys agree in that one."""
    part = keys["a"] if keys.dtype.names else keys
    order = np.argsort(part, kind="stable")
    run = part[order]
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1]
    if keys.dtype.names:
        whole = keys[order]
        for name in keys.dtype.names:
            if name != "a" and (whole[name][1:] != whole[name][:-1])[~new[1:]].any():
                _, head, inverse, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                return head, inverse.reshape(-1), count
    number = np.cumsum(new) - 1
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = number
    start = np.flatnonzero(new)
    return order[start], inverse, np.diff(np.append(start, len(keys)))


def _deal(keys: np.ndarray, groups: int, route: str = "a"):
    """Distinct keys by bucket, with the top bit of the last part set on those
    that the group holds more than once; what lines the replies up again."""
    head, inverse, count = _distinct(keys)
    sent = keys[head]
    mark = (count > 1).astype(np.uint64) << np.uint64(63)
    if sent.dtype.names:
        sent["b"] |= mark
        to = sent[route]
    else:
        to = sent.copy()
        sent |= mark
    to = (to % np.uint64(groups)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[order], np.arange(groups + 1))
    packed = [(k, sent[order[cut[k]:cut[k + 1]]]) for k in range(groups) if cut[k] < cut[k + 1]]
    return inverse, order, cut, packed


def _replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {k: d for k, t, d in zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["data"].to_pylist())
            if t == kind}


def _flags(dealt, replies: dict[int, bytes], bits: int) -> np.ndarray:
    """Flag of every key from the buckets' replies."""
    inverse, order, cut, _ = dealt
    flags = np.zeros(len(order), np.uint8)
    for k, data in replies.items():
        own = np.frombuffer(data, np.uint8)
        flags[order[cut[k]:cut[k + 1]]] = np.unpackbits(own)[:cut[k + 1] - cut[k]] if bits == 1 else own
    return flags[inverse]


def _stretch_replies(table: pa.Table) -> pa.Table:
    """For each stretch: 1 if equal stretches exist, plus 2 if it has to send
    its windows (the first of its class, where its anchor has more classes)."""
    dtype = np.dtype([("core", "<u8"), ("a", "<u8"), ("b", "<u8")])
    state, sent, keys = _entries(table, dtype)
    rows = list(state)
    if len(keys):
        keys, many = _unmark(keys)
        head, inverse, count = _distinct(keys)
        count = count + np.bincount(inverse, weights=many, minlength=len(count)).astype(np.int64)
        _, of, classes = np.unique(keys["core"][head], return_inverse=True, return_counts=True)
        flags = (count[inverse] > 1).astype(np.uint8)
        speaks = np.zeros(len(keys), bool)
        speaks[head] = True
        flags |= ((speaks & (classes[of.reshape(-1)][inverse] > 1)).astype(np.uint8) << 1)
        at = 0
        for g, k, t, v in sent:
            rows.append((g, k, t, flags[at:at + len(v)].tobytes()))
            at += len(v)
    return _reply(rows)


_STRETCH = np.dtype([("core", "<u8"), ("a", "<u8"), ("b", "<u8")])


def _spans(s: Slice, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), pair_dtype())
    out["a"], out["b"] = ROLL_A.spans(s.a, start, end), ROLL_B.spans(s.b, start, end)
    return _clear_top(out)


def _stretch_keys(s: Slice, chosen: np.ndarray, window: int) -> np.ndarray:
    lo, hi = s.lo[chosen], s.hi[chosen]
    out = np.empty(len(lo), _STRETCH)
    out["core"] = s.core[chosen]
    whole = _spans(s, lo, hi - 1 + window)
    # the anchor's place in the stretch is part of what must be equal
    out["a"] = whole["a"] ^ mix64((s.anchor[chosen] - lo).astype(np.uint64) + np.uint64(1))
    out["b"] = whole["b"]
    return out


def _expand(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All places of the half-open runs."""
    size = hi - lo
    if not len(size):
        return np.zeros(0, np.int64)
    return np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


class Repeats:
    """The rounds for one kind of sequence.

    ``parse(raw, offsets)`` gives the Slice of some texts;
    ``finish(slice, raw, offsets, covered)`` the columns ``kept`` (what is
    left of each text), ``size`` (elements), ``removed`` and ``spans``
    (removed elements and maximal removed runs), where ``covered`` marks the
    elements inside a repeated window.
    """

    def __init__(self, window: int, parse: Callable, finish: Callable):
        self.window, self.parse, self.finish = window, parse, finish

    # -- per-group steps -------------------------------------------------
    def _slices(self, table: pa.Table):
        worker_cache("repeats")
        raw, offsets = text_bytes(table["text"])
        for lo, hi in slices(offsets):
            part = raw[offsets[lo]:offsets[hi]]
            s = self.parse(part, offsets[lo:hi + 1] - offsets[lo])
            s.rows = (lo, hi)
            yield s

    def _anchored(self, s: Slice) -> np.ndarray:
        return np.flatnonzero(s.anchor >= 0)

    def _cores(self, s: Slice) -> np.ndarray:
        return _clear_top(s.core[self._anchored(s)])

    def round1(self, gid: int, table: pa.Table, groups: int) -> pa.Table:
        cores = [self._cores(s) for s in self._slices(table)]
        cores = np.concatenate(cores) if cores else np.zeros(0, np.uint64)
        return _keys_table(gid, 1, _deal(cores, groups)[3])

    def _live(self, table: pa.Table, state: dict, groups: int):
        """Slices with their anchored stretches whose core is repeated."""
        parts = list(self._slices(table))
        cores = [self._cores(s) for s in parts]
        flags = _flags(_deal(np.concatenate(cores) if cores else np.zeros(0, np.uint64), groups), state, 1)
        at = 0
        for s, c in zip(parts, cores):
            yield s, self._anchored(s)[flags[at:at + len(c)] > 0]
            at += len(c)

    def round2(self, gid: int, table: pa.Table, replies: pa.Table, groups: int) -> pa.Table:
        state = _replies(replies, 1)
        keys = [_stretch_keys(s, live, self.window) for s, live in self._live(table, state, groups)]
        keys = np.concatenate(keys) if keys else np.zeros(0, _STRETCH)
        out = _keys_table(gid, 2, _deal(keys, groups, "core")[3])
        return pa.concat_tables([out, _carry(gid, state, 1)])

    def _judged(self, table: pa.Table, first: dict, second: dict, groups: int):
        """Slices with live stretches and their flags."""
        parts = list(self._live(table, first, groups))
        keys = [_stretch_keys(s, live, self.window) for s, live in parts]
        every = np.concatenate(keys) if keys else np.zeros(0, _STRETCH)
        flags = _flags(_deal(every, groups, "core"), second, 8)
        at = 0
        for (s, live), k in zip(parts, keys):
            yield s, live, flags[at:at + len(k)]
            at += len(k)

    def _open(self, s: Slice, live: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """Windows that are compared one by one: those of stretches that speak
        for their class (an unsettled one is a class of its own), and those
        without an anchor."""
        free = np.flatnonzero(s.anchor < 0)
        pick = live[(flags & 2) > 0]
        return np.concatenate([_expand(s.lo[pick], s.hi[pick]), _expand(s.lo[free], s.hi[free])])

    def round3(self, gid: int, table: pa.Table, replies: pa.Table, groups: int) -> pa.Table:
        first, second = _replies(replies, -1), _replies(replies, 2)
        first = _uncarry(first)
        keys = [np.zeros(0, pair_dtype())]
        for s, live, flags in self._judged(table, first, second, groups):
            x = self._open(s, live, flags)
            keys.append(_spans(s, x, x + self.window))
        out = _keys_table(gid, 3, _deal(np.concatenate(keys), groups)[3])
        return pa.concat_tables([out, _carry(gid, first, 1), _carry(gid, second, 2)])

    def last(self, gid: int, table: pa.Table, replies: pa.Table, groups: int) -> pa.Table:
        first, second = _uncarry(_replies(replies, -1)), _uncarry(_replies(replies, -2))
        third = _replies(replies, 3)
        judged = [(s, live, flags, self._open(s, live, flags))
                  for s, live, flags in self._judged(table, first, second, groups)]
        sent = [_spans(s, x, x + self.window) for s, _, _, x in judged]
        sent = np.concatenate(sent) if sent else np.zeros(0, pair_dtype())
        repeated = _flags(_deal(sent, groups), third, 1) > 0
        out, at = [], 0
        for s, live, flags, x in judged:
            n = len(s.a) - 1
            done = live[(flags & 1) > 0]
            x, at = x[repeated[at:at + len(x)]], at + len(x)
            edge = np.bincount(s.lo[done], minlength=n + 1) - np.bincount(s.hi[done] - 1 + self.window, minlength=n + 1)
            edge += np.bincount(x, minlength=n + 1) - np.bincount(x + self.window, minlength=n + 1)
            covered = np.cumsum(edge[:-1]) > 0
            part = table.slice(s.rows[0], s.rows[1] - s.rows[0])
            raw, offsets = text_bytes(part["text"])
            kept, size, removed, spans = self.finish(s, raw, offsets, covered)
            out.append(pa.table([part["row"], part["text"], pa.array(kept, pa.string()), pa.array(size, pa.int64()),
                                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64())], names=RESULT))
        return pa.concat_tables(out)

    # -- the plan --------------------------------------------------------
    def run(self, docs: DataFrame) -> DataFrame:
        """``docs``: columns ``row`` (whatever goes along) and ``text``; the
        result has the columns RESULT."""
        groups = group_count(docs)
        dealt = docs.withColumn("gid", F.pmod(F.xxhash64("row", "text"), F.lit(groups))).repartition(groups, "gid")
        schema = StructType([*docs.select("row", "text").schema.fields, StructField("kept", StringType()),
                             *[StructField(c, LongType()) for c in RESULT[3:]]])
        empty = to_arrow_schema(schema).empty_table()

        def gid_of(table):
            return table["gid"][0].as_py()

        def one(table: pa.Table) -> pa.Table:
            return self.round1(gid_of(table), table, groups)

        def two(table: pa.Table, replies: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _table([], ("bucket", "gid", "kind", "data"), _KEY_TYPES)
            return self.round2(gid_of(table), table, replies, groups)

        def three(table: pa.Table, replies: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _table([], ("bucket", "gid", "kind", "data"), _KEY_TYPES)
            return self.round3(gid_of(table), table, replies, groups)

        def end(table: pa.Table, replies: pa.Table) -> pa.Table:
            if not table.num_rows:
                return empty
            return self.last(gid_of(table), table, replies, groups)

        def bucket(dtype):
            return lambda table: _repeated_keys(table, dtype)

        # a bucket for each group: a task's share does not grow with the input
        replies = dealt.groupBy("gid").applyInArrow(one, KEYS).repartition(groups, "bucket").groupBy("bucket") \
            .applyInArrow(bucket(np.dtype("<u8")), FLAGS)
        replies = dealt.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(two, KEYS) \
            .repartition(groups, "bucket").groupBy("bucket").applyInArrow(_stretch_replies, FLAGS)
        replies = dealt.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(three, KEYS) \
            .repartition(groups, "bucket").groupBy("bucket").applyInArrow(bucket(pair_dtype()), FLAGS)
        return dealt.groupBy("gid").cogroup(replies.groupBy("gid")).applyInArrow(end, schema)


def _carry(gid: int, replies: dict[int, bytes], kind: int) -> pa.Table:
    """Earlier replies travel on with the next keys, as rows of kind -kind
    that a bucket only passes back."""
    return _table([(gid, gid, -kind, pickle.dumps(replies))], ("bucket", "gid", "kind", "data"), _KEY_TYPES)


def _uncarry(found: dict[int, bytes]) -> dict[int, bytes]:
    out: dict[int, bytes] = {}
    for data in found.values():
        out |= pickle.loads(data)
    return out
