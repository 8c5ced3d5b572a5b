"""Language identification by a linear-chain conditional random field.

Every word of a text gets a label.  Its evidence is the sum of learned weights
of its byte n-grams (of one to four bytes, with marks at both ends of the
word, so that prefixes and suffixes are features of their own) and of the
whole word (the lexicon); learned transitions tie neighbouring words.
Forward-backward gives each word the probability of every language, also
where a text changes language midway; the text's language has the largest
mean probability over its words with a letter, and the score is that mean.

The model is fitted on a bounded sample: at most ``sample_docs`` texts of each
language, chosen by a hash of the id, and of each at most ``sample_words``
words in a run from a hashed place.  Half of the training sequences are
spliced from two languages, which teaches the transitions.  Prediction reads
every word of every text.

Defined cases: null texts and texts without a letter are ``und`` with score
0; null languages and null ids teach nothing; with nothing to learn from all
texts are ``und``; equal means go to the first language by name; repeated
rows are labelled alike; extra columns are passed on, and an input column
named like a result column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskspan.llm.common import CODE_A, Rolling, carried, uncarried, worker_cache

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
SEQUENCE = 30
UNKNOWN = "und"
CACHE_WORDS = 200_000
NEW_WORDS = 10_000
# text that is split into words and labelled together
CHARS_AT_ONCE = 2_000_000

_ROLL = Rolling(0xA0761D6478BD642F)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words, and the word that each belongs to."""
    data = [b"\x02" + w.encode("utf-8", "replace") + b"\x03" for w in words]
    size = np.array([len(d) for d in data], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer(b"".join(data), np.uint8)
    prefix = _ROLL.prefix(CODE_A[raw])
    owner = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(raw))
    buckets, owners = [], []
    for n in GRAMS:
        ok = np.flatnonzero(at + n <= first[owner + 1])
        buckets.append(_ROLL.spans(prefix, ok, ok + n) % np.uint64(BUCKETS))
        owners.append(owner[ok])
    # whole words have buckets of their own
    buckets.append(_ROLL.spans(prefix, first[:-1], first[1:]) % np.uint64(BUCKETS) + np.uint64(BUCKETS))
    owners.append(np.arange(len(words)))
    bucket, owner = np.concatenate(buckets).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


def evidence(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of each word's feature weights, damped by the number of features."""
    bucket, owner = features(words)
    count = np.bincount(owner, minlength=len(words))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    return np.add.reduceat(weights[bucket], first, axis=0) / np.sqrt(count)[:, None].astype(np.float32)


def forward_backward(scores: np.ndarray, size: np.ndarray, transition: np.ndarray, start: np.ndarray,
                     pairs: bool = False):
    """Label probabilities of every word of several sequences.

    ``scores``: one row per word, sequences one after another, of the given
    sizes; ``transition``: log weights.  With ``pairs`` also the expected
    number of each transition.  All sequences advance together, longest first.
    """
    k = scores.shape[1]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    order = np.argsort(-size, kind="stable")
    head, length = first[order], size[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")  # sequences longer than t
    node = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transition).astype(scores.dtype)
    alpha = np.empty_like(node)
    for t in range(longest):
        at = head[:active[t]] + t
        a = node[at] * (np.exp(start) if t == 0 else alpha[at - 1] @ step)
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    counts = np.zeros((k, k))
    beta = np.ones((0, k), scores.dtype)
    for t in range(longest - 1, -1, -1):
        at = head[:active[t]] + t
        if len(beta) < len(at):  # sequences that end here
            beta = np.concatenate([beta, np.ones((len(at) - len(beta), k), scores.dtype)])
        a = alpha[at]
        if t:
            own = node[at] * beta
            back = own @ step.T
            if pairs:
                joint = alpha[at - 1][:, :, None] * step[None] * own[:, None, :]
                counts += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        post = a * beta
        alpha[at] = post / post.sum(axis=1, keepdims=True)
        if t:
            beta = back / back.sum(axis=1, keepdims=True)
    return (alpha, counts) if pairs else alpha


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    key: str = ""


def fit_crf(texts: list[tuple[list[str], str]], steps: int = 40, rate: float = 0.25) -> LanguageModel:
    """``texts``: (words, language) samples, in a fixed order."""
    languages = sorted({lang for _, lang in texts})
    k = len(languages)
    label = {lang: i for i, lang in enumerate(languages)}
    runs: list[list[tuple[list[str], int]]] = [[] for _ in languages]
    for words, lang in texts:
        for at in range(0, len(words), SEQUENCE):
            runs[label[lang]].append((words[at:at + SEQUENCE], label[lang]))
    sequences, turn = [], 0
    for i in range(k):
        for n, (words, own) in enumerate(runs[i]):
            if n % 2 and k > 1:  # splice with a run of another language
                turn += 1
                j = (i + 1 + turn % (k - 1)) % k
                other = runs[j][turn % len(runs[j])] if runs[j] else (words, own)
                cut = 5 + turn % 20
                sequences.append([*[(w, own) for w in words[:cut]], *[(w, other[1]) for w in other[0][:SEQUENCE - cut]]])
            else:
                sequences.append([(w, own) for w in words])
    vocabulary = sorted({w for s in sequences for w, _ in s})
    place = {w: i for i, w in enumerate(vocabulary)}
    word = np.array([place[w] for s in sequences for w, _ in s], np.int64)
    truth = np.array([y for s in sequences for _, y in s], np.int64)
    size = np.array([len(s) for s in sequences], np.int64)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    inner = np.ones(len(word), bool)
    inner[first] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
    begun = np.bincount(truth[first], minlength=k).astype(float)
    bucket, owner = features(vocabulary)
    count = np.bincount(owner, minlength=len(vocabulary))
    at = np.concatenate([[0], np.cumsum(count)[:-1]])
    damp = 1 / np.sqrt(count)[:, None]
    width = 2 * BUCKETS
    params = [np.zeros((width, k)), np.zeros((k, k)), np.zeros(k)]
    first_m, second_m = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    onehot = np.eye(k)[truth]
    for n in range(1, steps + 1):
        rows = np.add.reduceat(params[0][bucket], at, axis=0) * damp
        post, pairs = forward_backward(rows[word], size, params[1], params[2], True)
        slope = (post - onehot) / len(sequences)
        per_word = np.stack([np.bincount(word, slope[:, j], len(vocabulary)) for j in range(k)], axis=1) * damp
        spread = per_word[owner]
        grads = [np.stack([np.bincount(bucket, spread[:, j], width) for j in range(k)], axis=1) + 1e-5 * params[0],
                 (pairs - seen) / len(sequences) + 1e-4 * params[1],
                 (post[first].sum(axis=0) - begun) / len(sequences)]
        for i, g in enumerate(grads):
            first_m[i] = 0.9 * first_m[i] + 0.1 * g
            second_m[i] = 0.99 * second_m[i] + 0.01 * g * g
            move = first_m[i] / (1 - 0.9 ** n) / (np.sqrt(second_m[i] / (1 - 0.99 ** n)) + 1e-7)
            params[i] = params[i] - rate * move
    return LanguageModel(languages, params[0].astype(np.float32), params[1], params[2])


def fit_language(docs: DataFrame, teach: Column, sample_docs: int = 250, sample_words: int = 150, text: str = "text",
                 lang: str = "lang") -> LanguageModel | None:
    """``teach``: condition on doc_id that the texts to learn from must meet."""
    known = docs.where(F.col(lang).isNotNull() & F.col("doc_id").isNotNull() & F.col(text).isNotNull()).where(teach)
    turn = F.xxhash64("doc_id")
    # how many languages there are bounds what is collected, not how many texts
    bound = known.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).select(F.col(lang).alias("lang"), "n")
    shares = {r["lang"]: r["n"] for r in bound.collect()}
    if not shares:
        return None
    # texts whose hash falls into a share that holds about twice the sample, then the smallest hashes
    part = F.create_map(*[x for k, n in shares.items() for x in (F.lit(k), F.lit(min(1.0, 2.0 * sample_docs / n)))])
    drawn = known.select(F.col(lang).alias("lang"), turn.alias("turn"), F.col(text).alias("text")) \
        .where(F.pmod("turn", F.lit(1 << 20)) < part[F.col("lang")] * (1 << 20))
    # white space as str.split() has it, which splits texts to be labelled
    words = F.filter(F.split(F.lower("text"), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    drawn = drawn.withColumn("words", words).where(F.size("words") > 0) \
        .withColumn("at", F.pmod("turn", F.greatest(F.size("words") - sample_words, F.lit(0)) + 1).cast("int")) \
        .select("lang", "turn", F.slice("words", F.col("at") + 1, F.lit(sample_words)).alias("words"))
    # a share can be no smaller than one hash, whatever the number of texts
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "words"))
    drawn = drawn.withColumn("nth", nth).where(F.col("nth") <= sample_docs)
    texts: dict[str, list] = {}
    for r in drawn.collect():
        texts.setdefault(r["lang"], []).append((r["turn"], r["words"]))
    sample = [(w, k) for k in sorted(texts) for _, w in sorted(texts[k])[:sample_docs]]
    return fit_crf(sample) if sample else None


def _word_rows(model: LanguageModel, words: list[str]):
    """Evidence rows of the words, from a bounded cache."""
    held = worker_cache("language")
    place, rows = held.get(model.key, ({}, np.zeros((0, len(model.languages)), np.float32)))
    if len(place) > CACHE_WORDS:
        place, rows = {}, rows[:0]
    new = list(set(words).difference(place))
    if new:
        more = np.concatenate([evidence([w.lower() for w in new[k:k + NEW_WORDS]], model.weights)
                               for k in range(0, len(new), NEW_WORDS)]).astype(np.float32)
        letters = np.array([any(map(str.isalpha, w)) for w in new])
        more[~letters] = np.nan  # no letter: no evidence, no vote
        place.update(zip(new, range(len(rows), len(rows) + len(new))))
        rows = np.concatenate([rows, more])
    held.clear()
    held[model.key] = (place, rows)
    return place, rows


def label_texts(model: LanguageModel, texts: list[str]) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    out = []
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to]) <= CHARS_AT_ONCE):
            total += len(texts[to])
            to += 1
        part = [t.split() for t in texts[at:to]]
        flat = [w for ws in part for w in ws]
        size = np.array([len(ws) for ws in part], np.int64)
        mean = np.zeros((len(part), len(model.languages)))
        votes = np.zeros(len(part))
        if flat:
            place, rows = _word_rows(model, flat)
            scores = rows[np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))]
            vote = ~np.isnan(scores[:, 0])
            scores[~vote] = 0
            full = np.flatnonzero(size > 0)
            post = forward_backward(scores, size[full], model.transition, model.start)
            post[~vote] = 0
            first = np.concatenate([[0], np.cumsum(size[full])[:-1]])
            mean[full] = np.add.reduceat(post.astype(np.float64), first, axis=0)
            votes[full] = np.add.reduceat(vote.astype(np.int64), first)
        for m, n in zip(mean, votes):
            if n == 0:
                out.append((UNKNOWN, 0.0))
            else:
                best = int(np.argmax(m))
                out.append((model.languages[best], float(min(1.0, m[best] / n))))
        at = to
    return out


def _labeller(model: LanguageModel | None, names: list[str]):
    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            found = label_texts(model, texts) if model else [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in names], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=[*names, "label", "score"])

    return run


def identify_language(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    if model is not None and not model.key:
        model.key = hashlib.sha256(model.weights.tobytes()).hexdigest()
    base = carried(docs, text)
    schema = StructType([*base.schema.fields, StructField("label", StringType()), StructField("score", DoubleType())])
    out = base.mapInArrow(_labeller(model, base.columns), schema)
    return uncarried(out, docs, text, lang_pred=F.col("label"), score=F.col("score"))
