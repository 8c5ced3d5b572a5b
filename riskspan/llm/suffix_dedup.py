"""Exact substring dedup over bytes by anchored fingerprints.

A rolling hash of ``TRIGGER`` bytes marks an anchor wherever it falls in the
lowest part of its range, so anchors depend on content alone and equal
substrings have equal anchors inside.  This is the trigger of prefix-free
parsing and nothing more of it: no phrase dictionary, parse or suffix array is
built and nothing is sorted in corpus order, because removal asks only which
strings are equal.  Anchors whose surrounding bytes occur once drop out; whole
stretches around the rest are compared by 128-bit fingerprints together with
the anchor's place, and only where several contexts share an anchor does each
string get its own place (see ``repeats``).  Highly repetitive text costs one
entry for each different stretch, however many copies there are.

Strings without a trigger in reach (runs of one short period) are entered
directly, once for each different string of a group.

Defined cases: a null text is empty; bytes left between two removed runs may
split a character, so what is left is hex in the digest and, as text, has
U+FFFD in place of broken characters; repeated rows count as copies of each
other; null ids and extra columns are passed on; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.llm.common import CODE_A, CODE_B, ROLL_A, SMALL_A, carried, local_hashes, uncarried
from riskspan.llm.repeats import Repeats, Slice

TRIGGER = 8
PERIOD = 40
CORE = 64


@dataclass
class Parser:
    window: int
    core: int
    period: int

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> Slice:
        n = len(raw)
        a, codes = ROLL_A.prefix(SMALL_A[raw]), partial(np.take, CODE_B, raw)
        none = np.zeros(0, np.int64)
        # windows x with x + window inside their text, as runs of places
        last = offsets[1:] - self.window + 1
        lo0, hi0 = offsets[:-1], np.maximum(last, offsets[:-1])
        if not (hi0 > lo0).any():
            return Slice((0, 0), offsets, a, codes, none, none, none, np.zeros(0, np.uint64))
        here = local_hashes(CODE_A[raw], TRIGGER)
        phrase = np.flatnonzero(here < np.uint64((1 << 64) // self.period))
        # a trigger counts where its core lies in the same text
        text = np.searchsorted(offsets, phrase, "right") - 1
        phrase = phrase[phrase + self.core <= offsets[text + 1]]
        reach = self.window - self.core  # farthest trigger whose core the window covers
        # windows by their first trigger: cut the runs of places after each
        # trigger and, in long gaps, where the next trigger comes into reach
        far = phrase - reach
        far = far[far > np.append(-1, phrase[:-1])] if len(phrase) else far
        marks = np.unique(np.concatenate([lo0, hi0, phrase + 1, np.maximum(far, 0)]))
        lo, hi = marks[:-1], marks[1:]
        owner = np.searchsorted(offsets, lo, "right") - 1
        good = hi <= hi0[owner]
        lo, hi, owner = lo[good], hi[good], owner[good]
        k = np.searchsorted(phrase, lo)
        found = k < len(phrase)
        near = np.where(found, phrase[np.minimum(k, max(len(phrase) - 1, 0))] if len(phrase) else 0, -1)
        anchored = found & (near - lo <= reach) & (near >= hi - 1) if len(phrase) else np.zeros(len(lo), bool)
        anchor = np.where(anchored, near, -1)
        cores = np.zeros(len(lo), np.uint64)
        spot = anchor[anchored]
        cores[anchored] = ROLL_A.spans(a, spot, spot + self.core)
        return Slice((0, 0), offsets, a, codes, lo, hi, anchor, cores)


def finish(s: Slice, raw: np.ndarray, offsets: np.ndarray, covered: np.ndarray):
    kept, size, removed, spans = [], [], [], []
    total = np.append(0, np.cumsum(covered))
    for i in range(len(offsets) - 1):
        lo, hi = offsets[i], offsets[i + 1]
        gone = int(total[hi] - total[lo])
        part = raw[lo:hi]
        if gone:
            mark = covered[lo:hi]
            part = part[~mark]
            spans.append(int(mark[0]) + int((mark[1:] & ~mark[:-1]).sum()))
        else:
            spans.append(0)
        kept.append(hashlib.sha256(part.tobytes()).hexdigest() + part.tobytes().decode("utf-8", "replace"))
        size.append(int(hi - lo))
        removed.append(gone)
    return kept, size, removed, spans


def remove_repeated_bytes(docs: DataFrame, window: int = 400, core: int = CORE, period: int = PERIOD,
                          text: str = "text") -> DataFrame:
    """``docs`` with ``kept_text``, ``kept_sha256`` (of the remaining bytes),
    ``n_bytes``, ``n_removed`` and ``n_spans``."""
    out = Repeats(window, Parser(window, min(core, window), period), finish).run(carried(docs, text))
    return uncarried(out, docs, text, kept_text=F.col("kept").substr(F.lit(65), F.length("kept")),
                     kept_sha256=F.substring("kept", 1, 64), n_bytes=F.col("size"), n_removed=F.col("removed"),
                     n_spans=F.col("spans"))
