"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskspan.llm import spelling
from riskspan.llm.spelling import Grams, count_words, near_words, spelling_variants


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(counts, ratio):
    near = {w: sorted(v for v in counts if one_apart(w, v)) for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v), default=None) for w in counts}
    form = {w: b if b is not None and counts[b] >= ratio * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), None if form[w] is None else counts[form[w]]) for w, n in counts.items()}


def words_like(seed, n, letters, low, high):
    rng = random.Random(seed)
    made = set()
    while len(made) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        made.add(w)
        k = rng.randrange(len(w))
        made.add(rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]]))
    return {w: rng.choice([5, 6, 30, 200, 1100, 7000]) for w in sorted(made)}


@pytest.mark.parametrize("letters,low,high,share,block", [
    ("ab", 6, 8, 1 / 2000, 64), ("abcdefgé", 6, 12, 1 / 20, 64), ("abcÿ", 1, 7, 1 / 5, 4), ("xyzß", 5, 40, 1 / 50, 2)])
def test_variants(spark, monkeypatch, letters, low, high, share, block):
    monkeypatch.setattr(spelling, "FREQUENT", share)
    monkeypatch.setattr(spelling, "BLOCK", block)
    counts = words_like(7, 180, letters, low, high)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, 5).collect()}
    assert got == expected(counts, 5)


def test_long_words_differ_in_one_place(spark):
    base = "".join(random.Random(3).choices("acgt", k=20000))
    words = [base, base[:9000] + base[9001:], base[:9000] + "x" + base[9001:], base[::-1]]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, word string")
    assert sorted(map(tuple, near_words(df).collect())) == [(0, 1), (0, 2), (1, 2)]


def test_contexts_are_shared_and_middles_short():
    grams = Grams(["ab", "abc", "ca"])
    for a, b in [("xabcab", "xabab"), ("abcabc", "abcxabc"), ("zabcde", "zabcdf"), ("abcabd", "bcabd")]:
        who, key, middles = grams.contexts([a, b])
        lists = [dict(zip(key[who == k].tolist(), np.array(middles)[who == k])) for k in (0, 1)]
        common = set(lists[0]) & set(lists[1])
        assert any(one_apart(lists[0][k], lists[1][k]) for k in common)
        assert max(map(len, middles)) < 2 * spelling.MOST


def test_words_of_documents(spark):
    texts = ["Vulnér" + "able vulnérable VULNéRABLE short", None, "", "ÀBCDEF àbcdef123àbcdef",
             " ".join(f"word{c}letters" for c in "aaaaabbbbb"), "tabs\tletters÷×letters\nletters"]
    rows = [(i if i != 2 else None, t, "x") for i, t in enumerate(texts)] * 3 + [(None, "letters " * 4, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    for every in (None, 3, 199):
        counts = Counter()
        for doc, text, _ in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if every and h % every == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1:]
                counts[run] += 1
        wanted = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 2}
        assert {r.word: r.n for r in count_words(df, 6, 2, every).collect()} == wanted


def test_empty_and_bad_ratio(spark):
    df = spark.createDataFrame([], "word string, n long")
    assert spelling_variants(df).collect() == []
    assert count_words(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        spelling_variants(df, 1)
