"""Token alignment against whole-text encodings by the two libraries."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskspan.llm import alignment
from riskspan.llm.alignment import align_tokens, common_ends, gallop, link_counts
from riskspan.llm.bpe import byte_letters
from tests.llm.data import clashing, empty, messy, messy_rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  two  spaces ", "tab\tnew\nline\r\n\n x", "▁ mark", "a▁b", "<|endoftext|> x <s></s><0x41>", "it's 'll 1234567 ½",
       "日本語 テキスト 😀 é \x00   \x1c a", " 's", "x" * 5000, "ab " * 3000, "\n", "the end", "the end "]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = byte_letters()
    bytes_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def one(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def encode(text):
        if not text:
            return [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        tx, ty = [bytes_a[i] for i in x], [one(i) for i in y]
        if b"".join(tx) != raw or b"".join(ty) != raw:
            return [], []
        return [(i, e) for i, e in zip(x, np.cumsum([len(t) for t in tx]).tolist())], \
            [(i, e) for i, e in zip(y, np.cumsum([len(t) for t in ty]).tolist())]

    return encode


def expected(texts, encode):
    groups, links, counts = [], [], Counter()
    for text in texts:
        a, b = encode(text)
        at, shared = {e: i for i, (_, e) in enumerate(b)}, []
        for i, (_, e) in enumerate(a):
            if e in at:
                shared.append((i, at[e]))
        parts, x, y = [], 0, 0
        for i, j in shared:
            parts.append(([t for t, _ in a[x:i + 1]], [t for t, _ in b[y:j + 1]]))
            x, y = i + 1, j + 1
        groups.append((len(a), len(b), parts))
        links.append([(a[i][0], b[j][0]) for i, j in shared])
        counts.update(links[-1])
    top = Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for (n_a, n_b, parts), own in zip(groups, links):
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in parts)
        out.append((n_a, n_b, len(parts), len(own), sum(counts[k] == top[k[1]] for k in own), sum(counts[k] for k in own),
                    hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return out, groups


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("pieces", [300_000, 3])
def test_link_counts(spark, monkeypatch, sides, pieces):
    monkeypatch.setattr(alignment, "CACHE_PIECES", pieces)
    texts = ODD + [r[1] for r in messy_rows()] + ["the cat sat on the mat", "The cat's hat"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in link_counts(df, A, B).collect()}
    wanted, _ = expected(texts, sides)
    for i, t in enumerate(texts):
        assert got[i] == wanted[i], t
    assert wanted[5] == (0, 0, 0, 0, 0, 0, "")  # a text with the mark does not come back from side B


def test_groups(spark, sides):
    texts = ODD + [r[1] for r in messy_rows()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    _, groups = expected(texts, sides)
    for r in align_tokens(df, A, B).collect():
        parts, x, y = [], 0, 0
        for i, j in zip(r.ends_a, r.ends_b):
            parts.append((r.ids_a[x:i], r.ids_b[y:j]))
            x, y = i, j
        assert (len(r.ids_a), len(r.ids_b), parts) == groups[r.doc_id]


def test_gallop():
    rng = random.Random(5)
    for n, m in [(0, 0), (0, 5), (5, 0), (1, 1000), (300, 400), (1000, 1000), (64, 129)]:
        a, b = (np.array(sorted(rng.sample(range(3000), k)), np.int64) for k in (n, m))
        assert gallop(a, b).tolist() == ([bisect.bisect_left(b.tolist(), x) for x in a.tolist()] if m else [0] * n)
        i, j = common_ends(a, b)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_pieces_are_encoded_together(monkeypatch, sides):
    """Side A gets joined pieces, unless a border has more white space."""
    class Counting:
        given = 0

        def encode_batch_fast(self, texts, **kw):
            Counting.given += len(texts)
            return plain.encode_batch_fast(texts, **kw)

    aligner = alignment.Aligner(A, B)
    plain = aligner.side.a
    monkeypatch.setattr(aligner.side, "a", Counting())
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choice("aeéstr1'.") for _ in range(rng.randint(1, 9))) for _ in range(2000)))
    odd = [" lead", "trail ", "in  side", "\n", "a▁b", "日本語", "\u3000x", "tab\t"]
    for pieces, most in [(words, len(words) // alignment.JOINED + 1), (words[:100] + odd + words[100:300], 300)]:
        Counting.given = 0
        aligner.clear()
        aligner.learn(pieces)
        assert Counting.given <= most
        for k, piece in enumerate(pieces):
            a, b = sides(piece)
            own = [side.flat[side.offsets[k]:side.offsets[k + 1]].tolist() for side in (aligner.ids_a, aligner.ids_b)]
            assert own == [[i for i, _ in a], [i for i, _ in b]], piece
            assert aligner.whole[k] == bool(a) and bool(aligner.text[k]) == bool(a)


def test_clashing_and_empty(spark):
    docs = clashing(messy(spark))
    out = link_counts(docs, A, B)
    assert out.columns[:len(docs.columns) - 1] == [c for c in docs.columns if c != "text"]
    assert out.count() == docs.count()
    assert link_counts(empty(spark), A, B).collect() == []
    assert align_tokens(empty(spark), A, B).collect() == []
