"""All anchors with their places and exact likeness, against brute force."""

import random
import re
import struct

import xxhash

from riskspan.llm.fingerprints import LONG, fingerprint_documents


def h64(*values):
    """xxhash64 of Spark over strings or longs."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<Q", v), seed)
    return seed


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


def chosen(symbols):
    h = [h64(x) for x in symbols]
    m = [h64(*h[i:i + 2]) for i in range(len(h) - 1)] if len(h) >= 4 else []
    return [(h64(m[i], m[i + 2]), i) for i in range(len(m) - 2)
            if min(signed(m[i]), signed(m[i + 2])) <= signed(m[i + 1])]


def by_words(text):
    return chosen([s for w in re.split("[ \t-\r]+", text) if w for s in (list(w) if len(w) > LONG else [w])])


def by_characters(text):
    return chosen(list(text)) or ([(h64(text), 0)] if text else [])


def likeness(a, b):
    x, y = by_words(a), by_words(b)
    if not x or not y:
        x, y = by_characters(a), by_characters(b)
    x, y = {v for v, _ in x}, {v for v, _ in y}
    return len(x & y) / len(x | y) if x | y else 1.0


def shown(text):
    return " ".join(f"{v:016X}@{i}" for v, i in by_words(text) or by_characters(text))


def test_all_anchors_against_brute_force(spark):
    rng = random.Random(4)
    texts = ["", " \n ", "a", "abc", "one two three", "one two three four", "one two three", "", "x" * 400,
             "漢字\U0001f600é" * 30, "".join(rng.choice("漢字仮名交文章例示") for _ in range(2000)), "a b c d"]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)) for n in (4, 5, 30, 300, 900, 900)]
    texts += [" ".join(f"w{rng.randint(0, 400)}" for _ in range(n)) + " y" * rng.randint(0, 40) for n in (3, 200, 3000)]
    rows = [(i * 3 - 7, t) for i, t in enumerate(texts)]
    got = fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    got = {r.doc_id: r for r in got}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + after[:cut]
        assert got[i].fingerprint == shown(t) and got[i].edited_fingerprint == shown(edited)
        assert abs(got[i].near_edited - likeness(t, edited)) < 1e-12
        assert abs(got[i].near_next - likeness(t, after)) < 1e-12


def test_edits_of_texts_without_words(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("漢字仮名交文章例示一二三四五六七八九十") for _ in range(400))
    rows = [(1, text), (2, "some words that follow the unspaced text " * 9), (3, "hello big wide"), (4, "a b c d e f g h")]
    got = {r.doc_id: r for r in fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].near_edited > 0.5 and got[3].near_edited > 0.4
