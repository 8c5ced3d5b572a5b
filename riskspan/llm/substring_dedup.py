"""Substring dedup by seed and extend.

Seeds: every window of ``window`` words picks one anchor by winnowing, the
``gram``-word run with the smallest fingerprint among those inside the window
(the leftmost of equals), so two equal windows have equal anchors at equal
places.  Documents are joined on these anchors.  Extension: the windows
around a shared anchor are matched on both sides of it at once, first whole
stretches of them, then window by window (see ``repeats``).  What is left of a
text is the words outside every repeated window, that is, outside the maximal
repeats of at least ``window`` words.

Defined cases: a null or empty text has no words; texts shorter than a window
lose nothing; rows are judged one by one, so repeated rows count as copies of
each other; null ids and extra columns are passed on; an input column named
like a result column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.llm.common import ROLL_A, carried, uncarried, with_text, word_codes, words_of
from riskspan.llm.repeats import Repeats, Slice

GRAM = 8


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in values[i:i+width], for each i."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, place, reach = values, np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        size = len(best) - step
        right = best[step:] < best[:size]
        place = np.where(right, place[step:], place[:size])
        best = np.where(right, best[step:], best[:size])
        reach += step
    return place[:n]


@dataclass
class Parser:
    window: int
    gram: int

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> Slice:
        start, end, first = words_of(raw, offsets)
        a, codes = ROLL_A.prefix(word_codes(raw, start, end)), partial(word_codes, raw, start, end, True)
        n = len(start)
        none = np.zeros(0, np.int64)
        if n < self.window:
            return Slice((0, 0), first, a, codes, none, none, none, np.zeros(0, np.uint64))
        at = np.arange(n - self.gram + 1)
        grams = ROLL_A.spans(a, at, at + self.gram)
        anchor = leftmost_minimum(grams, self.window - self.gram + 1)
        limit = np.repeat(first[1:], np.diff(first))
        x = np.flatnonzero(np.arange(n - self.window + 1) + self.window <= limit[:n - self.window + 1])
        if not len(x):
            return Slice((0, 0), first, a, codes, none, none, none, np.zeros(0, np.uint64))
        own = anchor[x]
        new = np.empty(len(x), bool)
        new[0] = True
        new[1:] = (own[1:] != own[:-1]) | (x[1:] != x[:-1] + 1)
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(x)))
        lo = x[head]
        return Slice((0, 0), first, a, codes, lo, lo + size, own[head], grams[own[head]])


def finish(s: Slice, raw: np.ndarray, offsets: np.ndarray, covered: np.ndarray):
    data = raw.tobytes()
    kept, size, removed, spans = [], [], [], []
    edge = np.append(0, np.cumsum(covered))
    for i in range(len(offsets) - 1):
        words = data[offsets[i]:offsets[i + 1]].split()
        lo, hi = s.first[i], s.first[i + 1]
        gone = int(edge[hi] - edge[lo])
        if gone:
            mark = covered[lo:hi]
            words = [w for w, m in zip(words, mark.tolist()) if not m]
            spans.append(int(mark[0]) + int((mark[1:] & ~mark[:-1]).sum()))
        else:
            spans.append(0)
        kept.append(b" ".join(words).decode("utf-8"))
        size.append(int(hi - lo))
        removed.append(gone)
    return kept, size, removed, spans


def remove_repeats(docs: DataFrame, window: int = 50, gram: int = GRAM, text: str = "text") -> DataFrame:
    """``docs`` with ``kept_text`` (remaining words joined by one space),
    ``n_words``, ``n_removed`` and ``n_spans``."""
    out = Repeats(window, Parser(window, min(gram, window)), finish).run(carried(docs, text))
    return uncarried(out, docs, text, kept_text=F.col("kept"), n_words=F.col("size"), n_removed=F.col("removed"),
                     n_spans=F.col("spans"))


def substring_stage(docs: DataFrame, window: int = 50, gram: int = GRAM, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without their repeated runs; texts that lose
    nothing stay as they are, and texts that lose every word go."""
    out = Repeats(window, Parser(window, min(gram, window)), finish).run(carried(docs, text))
    out = out.where((F.col("removed") == 0) | (F.col("removed") < F.col("size")))
    return with_text(docs, out, F.when(F.col("removed") > 0, F.col("kept")).otherwise(F.col("text")), text)
