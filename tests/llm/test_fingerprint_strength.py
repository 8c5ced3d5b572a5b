"""Texts that collide under any polynomial modulo 2**64 stay apart."""

import random

import numpy as np
import pytest

from riskspan.llm.common import ROLL_A, ROLL_B, PrimeRolling, Rolling, mix64, word_codes
from riskspan.llm.near_dedup import near_duplicates
from riskspan.llm.substring_dedup import remove_repeats
from riskspan.llm.suffix_dedup import remove_repeated_bytes
from tests.llm.data import words


def thue_morse(n, x="a", y="b"):
    return "".join((x, y)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_codes_of_colliding_words(n):
    text = (thue_morse(n) + " " + thue_morse(n, "b", "a")).encode()
    raw = np.frombuffer(text, np.uint8)
    start, end = np.array([0, n + 1]), np.array([n, 2 * n + 1])
    a = word_codes(raw, start, end)
    assert a[0] != a[1]
    if n >= 1024:  # what the second code alone cannot tell
        b = word_codes(raw, start, end, second=True)
        assert b[0] == b[1]


@pytest.mark.parametrize("kind", [Rolling, PrimeRolling])
def test_windows_by_whole_numbers(monkeypatch, kind):
    monkeypatch.setattr(kind, "KEPT", 64)
    roll = kind(0x9E3779B97F4A7C15)
    modulus = PrimeRolling.P if kind is PrimeRolling else 1 << 64
    rng = random.Random(3)
    codes = [rng.getrandbits(64) for _ in range(500)]
    prefix = roll.prefix(np.array(codes, np.uint64))
    start = np.array([0, 0, 1, 63, 64, 65, 127, 128, 300, 499, 250])
    end = np.array([0, 500, 64, 64, 128, 200, 129, 128, 499, 500, 420])
    got = roll.spans(prefix, start, end).tolist()
    for s, e, g in zip(start.tolist(), end.tolist(), got):
        value = sum(c * pow(roll.base, i, modulus) for i, c in enumerate(codes[s:e])) % modulus
        assert g == int(mix64(np.array([value + e - s], np.uint64))[0])


def test_long_words_are_told_apart(spark):
    rng = random.Random(6)
    before, after = words(rng, 20), words(rng, 19)
    rows = [(i, f"{before} {w} {after}") for i, w in enumerate([thue_morse(2048), thue_morse(2048, "b", "a")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in remove_repeats(docs, window=35).collect()] == [0, 0]
    # 37 shingles of 4 words, 33 of them common: one of 4 in each set differs
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, words=4, percent=85).collect()} == {0: 0, 1: 1}


@pytest.mark.parametrize("window", [512, 1024, 2048])
def test_long_byte_windows_are_told_apart(spark, window):
    rows = [(0, thue_morse(window)), (1, thue_morse(window, "b", "a")), (2, "x" + thue_morse(window, "c", "d")), (3, thue_morse(window, "c", "d") + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in remove_repeated_bytes(docs, window=window).collect()}
    assert got == {0: (0, rows[0][1]), 1: (0, rows[1][1]), 2: (window, "x"), 3: (window, "y")}


def test_passages_of_exactly_the_window(spark):
    """Of 400 bytes and more all copies go, of 399 none."""
    rng = random.Random(9)
    def text(n):
        return "".join(rng.choices("abcdefghijklmnop ", k=n))
    rows, wanted = [], {}
    for k, size in enumerate([399, 400, 401, 900]):
        passage = text(size)
        for j in range(3):
            rows.append((10 * k + j, f"<{10 * k + j}>{text(120)}|{j}{passage}{'xyz'[j]}|{text(90)}"))
            wanted[10 * k + j] = size if size >= 400 else 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in remove_repeated_bytes(docs, window=400).collect()} == wanted


def test_second_code_is_unrelated():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    at = np.arange(990)
    a, b = (r.spans(r.prefix(codes), at, at + 10) for r in (ROLL_A, ROLL_B))
    assert len(np.unique(a)) == len(np.unique(b)) == 990 and not (a == b).any()
