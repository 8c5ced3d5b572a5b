"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns (e-mail and IP addresses, card and phone
numbers).  A random field then labels the tokens around digits and at-signs
(tokens out of their reach are outside any span): a linear chain joins
neighbours, and *skip* edges join tokens of a document that repeat, so what is
clear in one place speaks for the same number or name in another.  Marginals
come from loopy message passing: forward-backward along all chains, then
messages over the skip edges, in ``ROUNDS`` rounds.  What the field marks
beside the base spans is added; base spans stay as they are.

The field learns from windows around base spans and other numbers, and from
copies of them in which the notation is changed ("(at)", other separators, no
plus sign), alone or beside the unchanged one, by gradient ascent with the same
message passing.  At most ``SAMPLE`` windows of each kind are used, chosen by
hash from the whole table.

Defined cases: null and empty texts have no spans; long texts are labelled as
a whole, each edge joining a token with its next repeat only; repeated rows
are treated alike; without any base span in the table nothing is learned and
nothing added; extra columns are passed on, and an input column named like a
result column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspan.llm.common import carried, mix64, uncarried

KINDS = ("email", "ip", "card", "phone")  # label k + 1; label 0: outside
LABELS = len(KINDS) + 1
# Windows of each kind, and of numbers that are no spans, to learn from.
SAMPLE = 200
REACH = 48  # code points beside a digit or at-sign that a window takes in
BUCKETS = 1 << 13
ROUNDS = 3
EPOCHS = 8
SURE = 0.9
# Tokens that are labelled together.
MANY_TOKENS = 60_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can't start within digits: what follows them is the same for all of them
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_TRIGGER = re.compile(r"[0-9@]+|[(\[]at[)\]]", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
# words that notations use
_LEXICON = {w: i + 1 for i, w in enumerate(
    ("at", "dot", "mail", "email", "tel", "phone", "call", "fax", "card", "visa", "ip", "host", "server", "version", "v"))}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def emails(text: str):
    """Leftmost matches of local part, at-sign and dotted domain, in time
    linear in the text: a match starts where the characters of the local part
    before an at-sign do."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            # characters up to this at-sign are in no later match
            end = max(end, at + 1)
        at = text.find("@", at + 1 if not found else end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def plausible(kind: int, text: str) -> bool:
    """Whether a marked stretch holds what its kind needs."""
    digits = "".join(_DIGIT.findall(text))
    if kind == 0:
        return bool(re.search(r"\w.*(?:@|[(\[]at[)\]]).*\w.*(?:\.|\bdot\b).*\w", text, re.IGNORECASE | re.DOTALL))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_octet, parts))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.search("[^0-9]", text))


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches of the text within reach of a digit or at-sign, to the next
    white space or as far again."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return [(_outward(text, lo, -1), _outward(text, hi, 1)) for lo, hi in out]


def _outward(text: str, at: int, step: int) -> int:
    for _ in range(REACH // 2):
        if at in (0, len(text)) or text[at - 1].isspace() or text[at].isspace():
            break
        at += step
    return at


@dataclass
class Tokens:
    """Tokens of the windows of some documents, as arrays."""

    doc: list[int] = field(default_factory=list)
    chain: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)

    def add(self, doc: int, text: str):
        chain, last = (self.chain[-1] if self.chain else -1), 0
        for lo, hi in windows(text):
            chain += 1
            for m in _TOKEN.finditer(text, max(lo, last), hi):
                self.doc.append(doc)
                self.chain.append(chain)
                self.start.append(m.start())
                self.end.append(m.end())
                self.text.append(m[0])
            last = hi


def _shape(t: str) -> int:
    c = t[0]
    if "0" <= c <= "9":
        return min(len(t), 25)
    if c.isalpha():
        case = 0 if t.islower() else 1 if t.isupper() else 2
        return 30 + 5 * case + min((len(t) + 1) // 2, 4)
    return 64 + min(ord(c), 1 << 16)


def features(t: Tokens) -> np.ndarray:
    """Hashed features, one row for each token."""
    n = len(t.text)
    chain, start, end = (np.array(x, np.int64) for x in (t.chain, t.start, t.end))
    shape = np.fromiter(map(_shape, t.text), np.int64, n)
    word = np.fromiter((_LEXICON.get(x.lower(), 0) if len(x) < 8 else 0 for x in t.text), np.int64, n)
    digit = (shape >= 1) & (shape <= 25)
    octet = np.fromiter((d and _octet(x) for d, x in zip(digit, t.text)), np.int64, n)
    new = np.ones(n, bool)
    new[1:] = chain[1:] != chain[:-1]
    gap = np.ones(n, np.int64)
    gap[1:] = np.where(new[1:], 3, np.minimum(start[1:] - end[:-1], 2))
    # fields: tokens without white space between them
    run = np.cumsum(gap > 0) - 1
    at = np.isin(shape, [64 + ord("@")])
    dots = np.minimum(np.bincount(run, shape == 64 + ord("."), run[-1] + 1), 4).astype(np.int64)
    signs = np.minimum(np.bincount(run, at, run[-1] + 1), 2).astype(np.int64)
    # groups of digits: numbers with at most two other characters between them
    far = np.ones(n, bool)
    numbers = np.flatnonzero(digit)
    group = np.full(n, -1)
    if len(numbers):
        far = (np.diff(numbers) > 3) | (start[numbers[1:]] - end[numbers[:-1]] > 3) | (chain[numbers[1:]] != chain[numbers[:-1]])
        group[numbers] = np.append(0, np.cumsum(far))
    size = np.bincount(group[numbers], (end - start)[numbers]).astype(np.int64) if len(numbers) else np.zeros(1, np.int64)
    parts = np.bincount(group[numbers]).astype(np.int64) if len(numbers) else np.zeros(1, np.int64)
    valid = np.zeros(len(size), np.int64)
    joined: dict[int, list[str]] = {}
    for k in numbers[(size[group[numbers]] >= 13) & (size[group[numbers]] <= 19)].tolist():
        joined.setdefault(int(group[k]), []).append(t.text[k])
    for g, numbers_of in joined.items():
        valid[g] = 1 + luhn("".join(numbers_of))
    octets = np.ones(len(size), np.int64)
    np.minimum.at(octets, group[numbers], octet[numbers])
    # a token between two numbers of a group shares it
    here = group.copy()
    ahead = np.append(group[1:], -1)
    inside = (here < 0) & (ahead >= 0)
    here[inside] = ahead[inside]
    known = here >= 0
    total = np.where(known, np.minimum(size[here], 20), -1)
    pieces = np.where(known, np.minimum(parts[here], 6), -1)
    check, small = np.where(known, valid[here], -1), np.where(known, octets[here], -1)

    def beside(values, k):
        out = np.full(n, -7)
        if k > 0:
            out[:-k] = np.where(chain[k:] == chain[:-k], values[k:], -7)
        else:
            out[-k:] = np.where(chain[:k] == chain[-k:], values[:k], -7)
        return out

    s = {k: (shape if k == 0 else beside(shape, k)) for k in range(-3, 4)}
    after = beside(gap, 1)
    templates = [
        (s[0],), (s[0], gap, after), (s[-1], s[0], gap), (s[0], s[1], after), (s[-2], s[-1], s[0]), (s[0], s[1], s[2]),
        (s[-1], s[0], s[1], gap, after), (s[-3], s[-2]), (s[2], s[3]), (s[-2], s[-1], s[0], s[1], s[2]),
        (word, s[-1], s[1]), (beside(word, -1), s[0]), (beside(word, 1), s[0]), (total, pieces, s[0] > 25), (check, s[0] > 25),
        (small, pieces, s[0] > 25), (signs[run], dots[run], s[0] > 25, s[0] > 60), (beside(signs[run], 2), beside(signs[run], -2), s[0]),
        (total, s[-1], s[1]), (np.zeros(n, np.int64),)]
    out = np.empty((n, len(templates)), np.int64)
    for k, parts_of in enumerate(templates):
        h = np.full(n, k + 1, np.uint64)
        for p in parts_of:
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.int64).view(np.uint64))
        out[:, k] = (h % np.uint64(BUCKETS)).astype(np.int64)
    return out


def skip_edges(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges from every number of three digits and more, and every name of
    four letters and more, to its next repeat in the document (case aside),
    and whether they are numbers."""
    last: dict[tuple[int, str], int] = {}
    a, b, kind = [], [], []
    for i, (doc, text) in enumerate(zip(t.doc, t.text)):
        c = text[0]
        number = "0" <= c <= "9"
        if len(text) < (3 if number else 4):
            continue
        key = (doc, text.lower())
        if key in last:
            a.append(last[key])
            b.append(i)
            kind.append(int(number))
        last[key] = i
    return np.array(a, np.int64), np.array(b, np.int64), np.array(kind, np.int64)


@dataclass
class SkipChain:
    """Weights of the field."""

    node: np.ndarray
    step: np.ndarray  # neighbours
    skip: np.ndarray  # repeats: names, numbers

    @staticmethod
    def blank() -> "SkipChain":
        return SkipChain(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((2, LABELS, LABELS)))

    def beliefs(self, feats, chain, edges, pairs: bool = False):
        """Marginals of tokens (and of neighbours and repeats) by loopy
        message passing."""
        a, b, kind = edges
        score = self.node[feats].sum(axis=1)
        local = np.exp(score - score.max(axis=1, keepdims=True))
        link = np.exp(self.skip[kind]) if len(a) else np.zeros((0, LABELS, LABELS))
        to_b = np.full((len(a), LABELS), 1 / LABELS)
        to_a = to_b.copy()
        for last in range(ROUNDS):
            evidence = np.zeros_like(local)
            if len(a):
                np.add.at(evidence, b, np.log(to_b))
                np.add.at(evidence, a, np.log(to_a))
                evidence -= evidence.max(axis=1, keepdims=True)
            node, step = _along(local * np.exp(evidence), np.exp(self.step), chain, pairs and last == ROUNDS - 1)
            if not len(a):
                break
            if last < ROUNDS - 1:
                # what a token says without what it was told over the edge
                from_a, from_b = node[a] / to_a, node[b] / to_b
                to_b = np.einsum("ex,exy->ey", from_a, link)
                to_a = np.einsum("ey,exy->ex", from_b, link)
                to_b /= to_b.sum(axis=1, keepdims=True)
                to_a /= to_a.sum(axis=1, keepdims=True)
        if not pairs:
            return node
        if not len(a):
            _, step = _along(local, np.exp(self.step), chain, True)
        both = (node[a] / to_a)[:, :, None] * link * (node[b] / to_b)[:, None, :]
        return node, step, both / np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)


def _along(local: np.ndarray, step: np.ndarray, chain: np.ndarray, pairs: bool):
    """Forward-backward over all chains at the same time: token marginals and
    the expected number of each pair of neighbouring labels."""
    n = len(local)
    first = np.flatnonzero(np.append(True, chain[1:] != chain[:-1]))
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if n else 0) + 1), "right")
    ahead, back = local.copy(), np.ones_like(local)
    for k in range(1, len(active)):
        at = first[:active[k]] + k
        v = (ahead[at - 1] @ step) * local[at]
        ahead[at] = v / v.sum(axis=1, keepdims=True)
    ahead[first] /= ahead[first].sum(axis=1, keepdims=True)
    for k in range(len(active) - 1, 0, -1):
        at = first[:active[k]] + k
        v = (back[at] * local[at]) @ step.T
        back[at - 1] = v / v.sum(axis=1, keepdims=True)
    node = ahead * back + 1e-12
    node /= node.sum(axis=1, keepdims=True)
    if not pairs:
        return node, None
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    both = ahead[inner][:, :, None] * step * (local * back)[inner + 1][:, None, :]
    return node, (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


# -- learning ---------------------------------------------------------------

def _changed(rng: random.Random, kind: int, text: str) -> str:
    """The same datum in another notation."""
    if kind == 0:
        at = rng.choice([" (at) ", " [at] ", "(at)", " @ "])
        name, _, host = text.partition("@")
        return name + at + host.replace(".", rng.choice([".", " (dot) ", " . ", " dot "]))
    if kind == 1:
        return text.replace(".", rng.choice([" . ", "[.]", "-", ","]))
    digits = "".join(_DIGIT.findall(text))
    if kind == 2:
        mark = rng.choice([".", "/", " - ", "_"])
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    tail = [digits[-10:-7], digits[-7:-4], digits[-4:]]
    head = digits[:-10]
    mark = rng.choice(["-", ".", " "])
    return rng.choice([text[1:].strip(), "00" + text[1:].strip(), mark.join(tail), f"({tail[0]}) {tail[1]}{mark}{tail[2]}",
                       f"{head}{mark}{mark.join(tail)}"])


def _examples(samples: list[tuple[str, list[tuple[int, int, int]]]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Small documents with their spans: windows as they are, in another
    notation, and both after one another."""
    out = []
    for number, (text, spans) in enumerate(samples):
        rng = random.Random(zlib.crc32(text.encode()) + number)
        out.append((text, spans))
        if not spans:
            continue
        changed, moved, at = "", [], 0
        for kind, lo, hi in sorted(spans, key=lambda s: s[1]):
            if lo < at:
                break
            changed += text[at:lo]
            new = _changed(rng, kind, text[lo:hi])
            moved.append((kind, len(changed), len(changed) + len(new)))
            changed, at = changed + new, hi
        changed += text[at:]
        out.append((changed, moved))
        gap = " " * (3 * REACH)
        shift = len(text) + len(gap)
        out.append((text + gap + changed, spans + [(k, lo + shift, hi + shift) for k, lo, hi in moved]))
    return out


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> SkipChain | None:
    """Ascent on the (Bethe) likelihood of the examples, in small batches with
    step sizes that shrink for each weight (AdaGrad)."""
    examples = _examples(sorted(samples))
    if not any(spans for _, spans in examples):
        return None
    rng = random.Random(13)
    rng.shuffle(examples)
    batches = []
    for lo in range(0, len(examples), 64):
        t = Tokens()
        gold = []
        for doc, (text, spans) in enumerate(examples[lo:lo + 64]):
            before = len(t.text)
            t.add(doc, text)
            label = np.zeros(len(text) + 1, np.int64)
            for kind, a, b in spans:
                label[a:b] = kind + 1
            gold += [label[s] for s in t.start[before:]]
        if t.text:
            batches.append((features(t), np.array(t.chain), skip_edges(t), np.array(gold)))
    model = SkipChain.blank()
    seen = [np.full_like(w, 1e-2) for w in (model.node, model.step, model.skip)]
    for _ in range(epochs):
        for feats, chain, edges, gold in batches:
            node, step, both = model.beliefs(feats, chain, edges, pairs=True)
            goal = np.eye(LABELS)[gold]
            grads = [np.zeros_like(model.node), -step, np.zeros_like(model.skip)]
            for k in range(LABELS):
                grads[0][:, k] = np.bincount(feats.ravel(), np.repeat((goal - node)[:, k], feats.shape[1]), BUCKETS)
            inner = np.flatnonzero(chain[1:] == chain[:-1])
            np.add.at(grads[1], (gold[inner], gold[inner + 1]), 1)
            a, b, kind = edges
            if len(a):
                np.add.at(grads[2], kind, -both)
                np.add.at(grads[2], (kind, gold[a], gold[b]), 1)
                grads[2] = (grads[2] + grads[2].transpose(0, 2, 1)) / 2
            for w, g, total in zip((model.node, model.step, model.skip), grads, seen):
                g = g - 1e-3 * w
                total += g * g
                w += 0.3 * g / np.sqrt(total)
    return model


def _samples(batches):
    """Windows with the kind of their first span (4: none), a hash to choose
    by, and their spans."""
    for batch in batches:
        out = []
        for text in batch["text"].to_pylist():
            if not text:
                continue
            spans = base_spans(text)
            for lo, hi in windows(text):
                if hi - lo > 40 * REACH:
                    continue  # one long table of numbers is no example
                inside = [(k, s - lo, e - lo) for k, s, e in spans if lo <= s and e <= hi]
                if any(s < hi and e > lo and not (lo <= s and e <= hi) for _, s, e in spans):
                    continue
                part = text[lo:hi]
                kinds = {k for k, _, _ in inside} or {len(KINDS)}
                order = zlib.crc32(part.encode())
                out += [(k, order, part, ";".join(f"{a}:{b}:{c}" for a, b, c in inside)) for k in kinds]
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
            names=["kind", "turn", "part", "spans"])


def fit_private(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> SkipChain | None:
    """The field, learned from at most ``sample`` different windows of each
    kind of all texts; None where no text has a base span."""
    base = carried(docs, text).select("text").mapInArrow(_samples, "kind int, turn long, part string, spans string")
    turn = Window.partitionBy("kind").orderBy("turn", "part")
    held = base.distinct().withColumn("nth", F.row_number().over(turn)).where(F.col("nth") <= sample).select("part", "spans").distinct()
    return train([(r.part, [tuple(map(int, s.split(":"))) for s in r.spans.split(";")] if r.spans else [])
                  for r in held.collect()])


# -- marking ----------------------------------------------------------------

def _added(model: SkipChain, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds to each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    t = Tokens()
    for doc, text in enumerate(texts):
        t.add(doc, text)
        if len(t.text) >= MANY_TOKENS or doc == len(texts) - 1:
            _mark(model, t, texts, base, out)
            t = Tokens()
    return out


def _mark(model, t: Tokens, texts, base, out):
    if not t.text:
        return
    node = model.beliefs(features(t), np.array(t.chain), skip_edges(t))
    label = node.argmax(axis=1)
    label[node.max(axis=1) < SURE] = 0
    marked = np.flatnonzero(label)
    i = 0
    while i < len(marked):
        j = i
        while j + 1 < len(marked) and marked[j + 1] == marked[j] + 1 and label[marked[j + 1]] == label[marked[i]] \
                and t.chain[marked[j + 1]] == t.chain[marked[i]]:
            j += 1
        lo, hi, doc = t.start[marked[i]], t.end[marked[j]], t.doc[marked[i]]
        kind = int(label[marked[i]]) - 1
        if not any(s < hi and e > lo for _, s, e in base[doc]) and plausible(kind, texts[doc][lo:hi]):
            out[doc].append((kind, lo, hi))
        i = j + 1


_MADE = ["n_email", "n_ip", "n_card", "n_phone", "base", "spans"]


def _finder(model: SkipChain | None, names: list[str]):
    def written(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            base = [base_spans(t) for t in texts]
            more = _added(model, texts, base) if model is not None else [[] for _ in texts]
            counts = np.zeros((len(texts), len(KINDS)), np.int64)
            for i, spans in enumerate(base):
                for kind, _, _ in spans:
                    counts[i, kind] += 1
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in names], *[pa.array(counts[:, k]) for k in range(len(KINDS))],
                 pa.array(map(written, base), pa.string()),
                 pa.array([written(sorted(b + m)) for b, m in zip(base, more)], pa.string())], names=[*names, *_MADE])

    return run


def find_private(docs: DataFrame, model: SkipChain | None, text: str = "text") -> DataFrame:
    """``docs`` with the number of base spans of each kind, the base spans
    (``base``) and all spans (``spans``) as ``kind:start:end`` in code points,
    joined by commas."""
    base = carried(docs, text)
    fields = [*base.schema.fields, *[StructField(n, LongType()) for n in _MADE[:4]], *[StructField(n, StringType()) for n in _MADE[4:]]]
    out = base.mapInArrow(_finder(model, base.columns), StructType(fields))
    return uncarried(out, docs, text, **{n: F.col(n) for n in _MADE})
