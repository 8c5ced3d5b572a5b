"""Personal data: base spans against the plain patterns, message passing
against full enumeration, what the field adds against planted notations."""

import itertools
import random
import re

import numpy as np
import pytest

from riskspan.llm import pii
from riskspan.llm.pii import (KINDS, LABELS, SkipChain, Tokens, base_spans, emails, features, find_private, fit_private, luhn,
                              skip_edges, train, windows)
from tests.llm.data import clashing, empty, messy, words

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def right(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == 1:
        return all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if right(k, m[0])]


def test_base_spans_on_random_texts():
    rng = random.Random(11)
    alphabets = ["a@.b", "01.2", "4 -0", "+1 ()-.5x", "a1@.+- 2é"]
    for n in range(6000):
        text = "".join(rng.choices(alphabets[n % 5], k=rng.randint(0, 30)))
        assert base_spans(text) == plain(text), text
    for text in ["4111 1111 1111 1111", "4111-1111-1111-1112", "x 256.1.1.1 1.1.1.1", "000000255.0.0.1", "+1 (988) 555-2485.",
                 "a@b.c@d.e", "%@x.y-.z", "+12 345", "é+1 988 555 2485é", "1" * 4000 + ".1.1.1"]:
        assert base_spans(text) == plain(text), text


def test_patterns_are_linear():
    for piece in ("a", "1", "1.", "a@", "+1 ", "+1(", "1 ", "-"):
        base_spans(piece * 200_000)


def enumerated(model, t, edges):
    """Marginals by summing over all labellings."""
    score = model.node[features(t)].sum(axis=1)
    total = np.zeros_like(score)
    for labels in itertools.product(range(LABELS), repeat=len(t.text)):
        s = sum(score[i, k] for i, k in enumerate(labels))
        s += sum(model.step[labels[i], labels[i + 1]] for i in range(len(labels) - 1) if t.chain[i] == t.chain[i + 1])
        s += sum(model.skip[k, labels[a], labels[b]] for a, b, k in zip(*edges))
        for i, k in enumerate(labels):
            total[i, k] += np.exp(s)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_are_exact_on_trees(monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 6)
    rng = np.random.default_rng(5)
    model = SkipChain(rng.normal(size=(pii.BUCKETS, LABELS)) * 0.3, rng.normal(size=(LABELS, LABELS)), rng.normal(size=(2, LABELS, LABELS)))
    model.skip = model.skip + model.skip.transpose(0, 2, 1)
    for text in ["a@b 7", "5551 x" + " " * 120 + "y 5551", "5551" + " " * 120 + "q 5551 z" + " " * 120 + "5551"]:
        t = Tokens()
        t.add(0, text)
        edges = skip_edges(t)
        got = model.beliefs(features(t), np.array(t.chain), edges)
        assert np.allclose(got, enumerated(model, t, edges), atol=1e-6), text
    # a loop: the same number twice in one chain; close, not exact
    t = Tokens()
    t.add(0, "5551 a 5551")
    got = model.beliefs(features(t), np.array(t.chain), skip_edges(t))
    assert np.allclose(got.sum(axis=1), 1) and np.isfinite(got).all()


def numbers(rng, n):
    return "".join(rng.choices("0123456789", k=n))


def card(rng):
    head = "4" + numbers(rng, 14)
    return next(head + c for c in "0123456789" if luhn(head + c))


def datum(rng, kind):
    return [f"{''.join(rng.choices('abcdefgh', k=5))}.{numbers(rng, 2)}@mail{rng.randint(1, 9)}.example.com",
            ".".join(str(rng.randint(1, 250)) for _ in range(4)), card(rng),
            f"+1 ({numbers(rng, 3)}) 555-{numbers(rng, 4)}"][kind]


def private_docs(n=240):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        parts = [words(rng, 15)]
        for _ in range(rng.randint(0, 2)):
            parts += [datum(rng, rng.randrange(4)), words(rng, 15)]
        if rng.random() < 0.5:
            parts.append(f"in {rng.randint(1950, 2020)} chapter {rng.randint(1, 90)} version {rng.randint(1, 9)}.{rng.randint(0, 20)}")
        rows.append((i, " ".join(parts)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return fit_private(spark.createDataFrame(private_docs(), "doc_id long, text string"))


def parse(spans):
    return [(KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in spans.split(",") if x)]


def test_other_notations_are_added_and_clean_texts_left(spark, model):
    rng = random.Random(77)
    planted, clean = [], []
    for i in range(120):
        kind = (0, 3)[i % 2]
        text = datum(rng, kind)
        text = text.replace("@", " (at) ") if kind == 0 else text[1:].strip()
        planted.append((i, f"{words(rng, 12)} {text} {words(rng, 12)}", kind))
        clean.append((1000 + i, f"{words(rng, 12)} in {rng.randint(1950, 2020)} and {numbers(rng, rng.randint(1, 6))} {words(rng, 9)}"))
    got = {r.doc_id: r for r in find_private(spark.createDataFrame([p[:2] for p in planted] + clean, "doc_id long, text string"), model).collect()}
    caught = sum(any(k == kind for k, _, _ in parse(got[i].spans)) for i, _, kind in planted)
    assert caught >= 0.9 * len(planted)
    assert sum(bool(got[i].spans) for i, _ in clean) <= 0.02 * len(clean)


def test_base_stays_and_added_spans_do_not_overlap(spark, model):
    rows = private_docs(80) + [(900 + i, t) for i, t in enumerate(["", None, "4111 1111 1111 1111 " * 3, "a@b.c " * 50])]
    for r in find_private(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        text = dict(rows)[r.doc_id] or ""
        base, spans = parse(r.base), parse(r.spans)
        assert base == plain(text) and set(base) <= set(spans) and spans == sorted(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in range(4)]
        more = [s for s in spans if s not in base]
        assert all(e <= a or b <= s for _, s, e in more for _, a, b in base)


def test_repeats_speak_for_each_other(model):
    """Learned skip weights favour equal labels of repeated numbers."""
    number = model.skip[1]
    assert all(number[k, k] > number[0, k] for k in (1, 3, 4))


def test_learning_is_the_same_each_time(spark, model):
    again = fit_private(spark.createDataFrame(private_docs()[::-1], "doc_id long, text string").repartition(5))
    assert np.array_equal(again.node, model.node) and np.array_equal(again.skip, model.skip)


def test_odd_tables(spark):
    docs = clashing(messy(spark))
    out = find_private(docs, fit_private(docs))
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() == docs.count()
    assert find_private(empty(spark), fit_private(empty(spark))).collect() == []
    assert train([("only 7 numbers 12", [])]) is None
    assert list(emails("@ @@ a@ @b.c")) == [] and windows("") == []
