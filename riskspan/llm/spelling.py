"""Spelling variants by a variable-length gram index.

A word is read between two border marks.  Its *grams* come from a dictionary
that is pruned by frequency: from every place the shortest gram of at least
``LEAST`` code points that is not frequent among the words is taken (``MOST``
at most); a gram that an earlier one covers is left out.  A gram depends on
its own code points alone.

One edit at a place of a word affects a bounded range of its grams: those that
touch the place, and those that a new gram there may cover.  The grams on both
sides of that range are the same in the two words, whichever of them one looks
from (``contexts``).  Every word therefore enters, for each place where it may
be edited, the list of its unaffected grams: the text up to the last gram
before the place and from the first gram after it.  Two words one edit apart
meet in at least one list, and what differs lies in the *middle*, fewer than
2 * ``MOST`` code points, all that travels with a list's entry.

Lists of up to ``BLOCK`` words are merged by comparing their middles pair by
pair on arrays; longer ones are first cut by the middles with one code point
left out, which words one edit apart share, so that a piece holds at most one
word for each place and letter.  Pairs that pass are verified on whole words.

Defined cases: null and empty texts have no words, a null document id reads as
empty text; repeated rows count again; ties go to the word that comes first in
code-point order; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspan.llm.common import ROLL_A, mix64, small_batches, stored

LEAST, MOST = 2, 4
# A gram is frequent if it makes up more than this share of all grams of its
# length, so at most 2000 grams of a length are.
FREQUENT = 1 / 2000
BLOCK = 64
# Different words that a task counts before it passes them on.
HELD_WORDS = 200_000
_OPEN, _CLOSE = "\x02", "\x03"
_POINT = 21  # bits of a code point


def _counter(least: int, every: int | None):
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % max(1, least))

    def add(total: Counter, doc, text: str):
        found = Counter(run.findall(text.encode("utf-8").lower().decode("utf-8")))
        if every is None:
            total.update(found)
            return
        seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
        for word, n in found.items():
            h = zlib.crc32(word.encode("utf-8"), seed)
            if h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
                if len(word) < least:
                    continue
            total[word] += n

    def table(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py()
                if text:
                    add(total, doc, text)
                if len(total) >= HELD_WORDS:
                    yield table(total)
                    total = Counter()
        yield table(total)

    return count


def count_words(docs: DataFrame, least: int = 6, occurrences: int = 5, every: int | None = None) -> DataFrame:
    """(word, n): the letter runs of whole texts, A-Z in lower case, with at
    least ``least`` code points and ``occurrences`` occurrences.

    ``every``: a run whose crc32 with its document's id is a multiple of it
    loses one code point (a seeded misspelling).
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    parts = small_batches(texts).mapInArrow(_counter(least, every), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def frequent_grams(words: DataFrame) -> list[str]:
    """Grams of LEAST to MOST - 1 code points that make up more than the share
    FREQUENT of the grams of their length: at most 1/FREQUENT of each length."""
    marked = F.concat(F.lit(_OPEN), F.col("word"), F.lit(_CLOSE))
    sizes = F.array(*[F.lit(q) for q in range(LEAST, MOST)])
    grams = words.select(marked.alias("w")).withColumn("q", F.explode(sizes)).where(F.length("w") >= F.col("q")) \
        .select("q", F.explode(F.expr("transform(sequence(1, length(w) - q + 1), i -> substring(w, i, q))")).alias("gram"))
    counts = grams.groupBy("q", "gram").agg(F.count(F.lit(1)).alias("c"))
    totals = counts.groupBy("q").agg(F.sum("c").alias("all"))
    return [r.gram for r in counts.join(F.broadcast(totals), "q").where(F.col("c") > F.col("all") * FREQUENT)
            .select("gram").collect()]


def _packed(gram) -> int:
    """Code points as one number; a leading 1 tells lengths apart."""
    out = 1
    for c in gram:
        out = out << _POINT | (ord(c) if isinstance(c, str) else int(c))
    return out


class Grams:
    """Contexts of words under a gram dictionary, for many words at once."""

    def __init__(self, frequent: list[str]):
        # without the leading 1, which a third code point would push out of 64 bits
        self.frequent = {q: np.array(sorted(_packed(g) - (1 << _POINT * q) for g in frequent if len(g) == q), np.uint64)
                         for q in range(LEAST, MOST)}

    def ends(self, codes: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """End of the gram that starts at every place; ``limit``: end of the
        place's word.  At a word's last place the end lies beyond the word."""
        n = len(codes)
        end = np.arange(n) + LEAST
        growing = np.ones(n, bool)
        wide = np.append(codes, np.zeros(MOST, np.uint64)).astype(np.uint64)
        value = wide[:n].copy()
        for q in range(2, MOST):
            value = value << np.uint64(_POINT) | wide[q - 1:q - 1 + n]
            if q >= LEAST:
                growing &= (end < limit) & np.isin(value, self.frequent[q])
                end += growing
        return end

    def contexts(self, words: list[str]):
        """(word number, key, middle) of every list that a word enters.

        With ``size`` code points of a word's marked form read from the left
        and the rest from ``back`` on shared, the left context ends with the
        last gram inside the shared head, and the right one starts with the
        first gram in the shared tail that no gram from before it can cover.
        Both follow from the shared parts alone.
        """
        text = "".join(f"{_OPEN}{w}{_CLOSE}" for w in words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        length = np.array([len(w) + 2 for w in words], np.int64)
        stop = np.cumsum(length)
        start = stop - length
        owner = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(codes))
        first, limit = start[owner], stop[owner]
        end = self.ends(codes, limit)
        whole = end <= limit
        before = np.maximum.accumulate(np.append(0, np.where(whole, end, 0)))[:-1]
        own = whole & (end > np.maximum(before, first))
        # last end of an own gram at or before each place
        mark = np.zeros(len(codes) + 1, np.int64)
        mark[end[own]] = end[own]
        cut = np.maximum(np.maximum.accumulate(mark)[:-1], first)
        # first gram from a place on that reaches MOST beyond it
        reach = place + MOST
        far = np.append(end, np.full(MOST, -1))
        after = np.where(far[:len(end)] >= reach, place, place + MOST - LEAST)
        for step in range(MOST - LEAST - 1, 0, -1):
            after = np.where((far[step:step + len(end)] >= reach) & (far[:len(end)] < reach), place + step, after)
        after = np.where(reach <= limit, after, limit)
        inner = place[place > first]  # heads of at least one code point
        skip = inner[inner + 1 < limit[inner]]
        at = np.concatenate([inner, skip])
        left, right = cut[at], np.concatenate([after[inner], after[skip + 1]])
        who = owner[at]
        # one entry for each pair of contexts of a word
        order = np.lexsort((right, left))
        left, right, who = left[order], right[order], who[order]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (who[1:] != who[:-1])
        left, right, who = left[new], right[new], who[new]
        prefix = ROLL_A.prefix(codes)
        key = mix64(ROLL_A.spans(prefix, start[who], left) * np.uint64(0x9E3779B97F4A7C15)
                    + ROLL_A.spans(prefix, right, stop[who]))
        middles = [text[a:b] for a, b in zip(left.tolist(), right.tolist())]
        return who, key.view(np.int64), middles


def _entries(frequent: list[str]):
    def run(batches):
        grams = Grams(frequent)
        for batch in batches:
            ids = batch["id"].to_numpy(zero_copy_only=False)
            words, held, size = [], [], 0
            for i, word in enumerate(batch["word"].to_pylist()):
                words.append(word)
                held.append(i)
                size += len(word)
                if size >= 1 << 16:
                    yield lists(grams, words, ids[held])
                    words, held, size = [], [], 0
            if words:
                yield lists(grams, words, ids[held])

    def lists(grams, words, ids):
        who, key, middles = grams.contexts(words)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[who]), pa.array(middles, pa.string())],
                                          names=["key", "id", "middle"])

    return run


def one_edit(points: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j (code points, zero filled) are exactly one
    inserted, deleted or replaced code point apart."""
    width = points.shape[1]
    swap = size[i] > size[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)  # j is never the shorter
    a, b = points[i], points[j]
    gap = size[j] - size[i]
    same = a == b
    head = np.where(same.all(axis=1), width, same.argmin(axis=1))
    # the tails after the first difference: b from there on without one point
    place = np.arange(width)
    later = np.take_along_axis(a, np.minimum(place + (gap == 0)[:, None], width - 1), axis=1)
    tail = np.take_along_axis(b, np.minimum(place + 1, width - 1)[None, :].repeat(len(b), axis=0), axis=1)
    agree = (later == tail) | (place[None, :] < head[:, None]) | (place[None, :] >= size[j][:, None] - 1)
    return (gap <= 1) & (head < size[j]) & agree.all(axis=1)


def _near(batches):
    """Pairs (a, b), a < b, of every list whose middles are one edit apart."""
    for batch in batches:
        lists = batch["list"]
        ends = lists.offsets.to_numpy()
        flat = lists.values
        ids = flat.field("id").to_numpy(zero_copy_only=False)
        middles = flat.field("middle").to_pylist()
        size = np.array([len(m) for m in middles], np.int64)
        width = max(1, int(size.max(initial=0))) + 1
        points = np.frombuffer("".join(m.ljust(width, "\0") for m in middles).encode("utf-32-le"), np.uint32)
        points = points.reshape(len(middles), width)
        # row r meets the later rows of its list
        stop = np.repeat(ends[1:], np.diff(ends))
        rows = np.arange(ends[0], ends[-1])
        many = stop - rows - 1
        total = np.cumsum(many)
        at = 0
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + (1 << 18), "right")))
            i = np.repeat(rows[at:to], many[at:to])
            base = np.repeat(total[at:to] - many[at:to], many[at:to]) - (total[at - 1] if at else 0)
            j = i + 1 + np.arange(len(i)) - base
            ok = np.abs(size[i] - size[j]) <= 1
            i, j = i[ok], j[ok]
            if len(i):
                ok = one_edit(points, size, i, j)
                a, b = ids[i[ok]], ids[j[ok]]
                pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            at = to


def near_words(words: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids of ``words`` (id, word) that differ by exactly one
    inserted, deleted or replaced code point, each pair once."""
    entries = stored(small_batches(words.select("id", "word")).mapInArrow(
        _entries(frequent_grams(words)), "key long, id long, middle string"), "grams")
    size = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = entries.join(size, "key")
    entry = F.struct("id", "middle")
    short = shared.where(F.col("m") <= BLOCK).groupBy("key").agg(F.collect_list(entry).alias("list"))
    # one code point left out, or none: what words one edit apart share
    forms = F.expr("array_distinct(concat(array(middle), transform(sequence(1, greatest(length(middle), 1)), "
                   "i -> concat(substring(middle, 1, i - 1), substring(middle, i + 1)))))")
    long_ = shared.where(F.col("m") > BLOCK).withColumn("form", F.explode(forms)) \
        .groupBy("key", "form").agg(F.collect_list(entry).alias("list")).where(F.size("list") > 1)
    lists = short.select("list").unionByName(long_.select("list"))
    found = lists.mapInArrow(_near, "a long, b long").distinct()
    texts = words.select("id", "word")
    pairs = found.join(texts.toDF("a", "word_a"), "a").join(texts.toDF("b", "word_b"), "b")
    return pairs.where(F.levenshtein("word_a", "word_b", 1) == 1).select("a", "b")


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word,
    n; each word once).

    A word's form is its near word of largest n, if that is at least ``ratio``
    times its own; its root is where its forms lead to.
    """
    if ratio < 2:
        raise ValueError("ratio has to be at least 2, so that forms cannot lead in a circle")
    words = stored(words.select("word", F.col("n").cast("long").alias("n"))
                   .withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = stored(near_words(words), "near_words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near", "b")).alias("best")
    found = both.join(other, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best)
    led = (-F.col("best.less") >= ratio * F.col("n"))
    judged = stored(words.join(found, F.col("id") == F.col("a"), "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(led, F.col("best.near")).alias("form"), F.when(led, F.col("best.b")).alias("form_id"),
        F.when(led, -F.col("best.less")).alias("form_n")), "forms")
    # n grows by the ratio at every step, so a way has at most 63 / log2(ratio) of them
    way = judged.where("form_id is not null").select("id", F.col("form_id").alias("to"))
    for _ in range(math.ceil(math.log2(63 / math.log2(ratio) + 1))):
        step = way.select(F.col("id").alias("to"), F.col("to").alias("further"))
        way = stored(way.join(step, "to", "left").select("id", F.coalesce("further", "to").alias("to")), "way")
    roots = way.join(words.select(F.col("id").alias("to"), F.col("word").alias("end")), "to").select("id", "end")
    return judged.join(roots, "id", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
