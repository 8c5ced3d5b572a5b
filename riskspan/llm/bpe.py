"""BPE encoding by speculation and verification, and decoding.

Speculate: each pretoken is cut greedily into the longest vocabulary entries.
Verify: a cut is the BPE encoding if and only if every adjacent pair of its
tokens is compatible, that is, if merging the pair's bytes gives the pair
back.  All different pairs of a batch are tested at once on arrays: along the
right edge of the left token and the left edge of the right token no merge
across the border may come before those that absorb its two sides.  Only
pretokens with an incompatible pair go through exact merging.

Texts are cut into chunks before single spaces (a border of pretokens
wherever the space does not lie within a longer run of white space), and a
chunk's ids are kept for the next time; a bounded cache only saves work.

Defined cases: a null or empty text has no tokens; special tokens in a text
become their ids; every text decodes to itself; repeated rows are encoded
alike; extra columns are passed on, and an input column named like a result
column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from riskspan.llm.common import carried, uncarried

# FIXED VALUES: the published pattern that splits text before byte-level merges
PRETOKENS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# a space inside or at the end of a longer run of white space
_RUN = re.compile(r"\s (?:\s|$)")
CACHE_CHUNKS = 400_000
_NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids = {as_bytes(t): i for t, i in vocab.items()}
        size = max([*vocab.values(), *[t["id"] for t in spec["added_tokens"]]]) + 1
        self.bytes = [b""] * size
        for t, i in self.ids.items():
            self.bytes[i] = t
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") \
            if self.special else None
        # every prefix of a token: its own id, or -1 where it is only a prefix
        self.prefixes = {t[:k]: -1 for t in self.ids for k in range(1, len(t))} | self.ids
        # merges: (left, right) -> (order, merged token)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.packed: dict[tuple[int, int], int] = {}  # order << 20 | merged token
        left, right, order = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            i, j, t = vocab[a], vocab[b], vocab[a + b]
            self.merges[i, j] = (k, t)
            self.packed[i, j] = (k << 20) | t
            if order[t] < 0:
                left[t], right[t], order[t] = i, j, k
        keys = np.array([(i << 20) | j for i, j in self.merges], np.int64)
        ranks = np.array([k for k, _ in self.merges.values()], np.int64)
        sort = np.argsort(keys)
        self.keys, self.ranks = keys[sort], ranks[sort]
        self.left, self.right, self.order = left, right, order
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.pairs = np.zeros(0, np.int64)
        self.fine = np.zeros(0, bool)
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.cached: dict[str, tuple[int, str, bytes]] = {}

    # -- speculate -------------------------------------------------------
    def greedy(self, word: bytes) -> list[int]:
        out, at, n, prefixes = [], 0, len(word), self.prefixes
        while at < n:
            best, end, to = -1, at, at + 1
            while to <= n and (t := prefixes.get(word[at:to])) is not None:
                if t >= 0:
                    best, end = t, to
                to += 1
            out.append(best)
            at = end
        return out

    # -- verify ----------------------------------------------------------
    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 20) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER) if len(self.keys) else np.full(len(a), _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of tokens: no merge crosses the border between them."""
        fine = np.ones(len(a), bool)
        live, r, r_gone = np.arange(len(a)), a.copy(), np.full(len(a), _NEVER)
        while len(live):
            inner, left, l_gone = live, b[live].copy(), np.full(len(live), _NEVER)
            r_in, gone_in = r, r_gone
            while len(inner):
                rank = self._rank(r_in, left)
                # of merges of one kind the leftmost comes first
                fine[inner[(rank < gone_in) & (rank <= l_gone) & (rank < _NEVER)]] = False
                l_gone, left = self.order[left], self.left[left]
                go = (left >= 0) & fine[inner]
                inner, left, l_gone, r_in, gone_in = inner[go], left[go], l_gone[go], r_in[go], gone_in[go]
            r_gone, r = self.order[r], self.right[r]
            go = (r >= 0) & fine[live]
            live, r, r_gone = live[go], r[go], r_gone[go]
        return fine

    def _judge(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair (left << 20 | right) is compatible."""
        distinct, inverse = np.unique(pairs, return_inverse=True)
        at = np.searchsorted(self.pairs, distinct)
        seen = np.zeros(len(distinct), bool)
        inside = at < len(self.pairs)
        seen[inside] = self.pairs[at[inside]] == distinct[inside]
        fine = np.zeros(len(distinct), bool)
        fine[seen] = self.fine[at[seen]]
        new = distinct[~seen]
        fine[~seen] = self.compatible(new >> 20, new & ((1 << 20) - 1))
        if len(self.pairs) > 4 * CACHE_CHUNKS:
            self.pairs, self.fine = np.zeros(0, np.int64), np.zeros(0, bool)
        keys = np.concatenate([self.pairs, new])
        sort = np.argsort(keys, kind="stable")
        self.pairs, self.fine = keys[sort], np.concatenate([self.fine, fine[~seen]])[sort]
        return fine[inverse.reshape(-1)]

    # -- exact merging ---------------------------------------------------
    def merge(self, word: bytes) -> list[int]:
        get, single = self.packed.get, self.single
        parts = [single[b] for b in word]
        ranks = [get(p, _NEVER) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            at = ranks.index(best)
            token = best & 0xFFFFF
            parts[at:at + 2] = [token]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get((token, parts[at + 1]), _NEVER)
            if at:
                ranks[at - 1] = get((parts[at - 1], token), _NEVER)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        """As ``merge``, with a heap and links, for very long pretokens."""
        import heapq
        n = len(word)
        token = [self.ids[word[i:i + 1]] for i in range(n)]
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(self.merges[p][0], i, *p) for i in range(n - 1) if (p := (token[i], token[i + 1])) in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if not alive[i] or token[i] != a or after[i] >= n or token[after[i]] != b:
                continue
            j = after[i]
            token[i], alive[j] = self.merges[a, b][1], False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := (token[i], token[after[i]])) in self.merges:
                    heapq.heappush(heap, (self.merges[p][0], i, *p))
            if before[i] >= 0 and (p := (token[before[i]], token[i])) in self.merges:
                heapq.heappush(heap, (self.merges[p][0], before[i], *p))
        return [token[i] for i in range(n) if alive[i]]

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Encodings of pretokens."""
        cuts = [self.greedy(w) for w in words]
        size = np.array([len(c) for c in cuts], np.int64)
        flat = np.array([t for c in cuts for t in c], np.int64)
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(cuts)), size)
            joint = np.flatnonzero(owner[1:] == owner[:-1])
            wrong = joint[~self._judge((flat[joint] << 20) | flat[joint + 1])] if len(joint) else joint
            for k in np.unique(owner[wrong]).tolist():
                cuts[k] = self.merge(words[k]) if len(words[k]) < 256 else self.merge_long(words[k])
        return cuts

    # -- texts -----------------------------------------------------------
    def _chunks(self, text: str) -> list[str]:
        if _RUN.search(text):
            return PRETOKENS.findall(text)
        head, *rest = text.split(" ")
        chunks = [" " + c for c in rest]
        return [head, *chunks] if head else chunks

    def _learn(self, new: list[str]):
        find, cached = PRETOKENS.findall, self.cached
        tokens = [find(c) for c in new]
        distinct = [w for w in dict.fromkeys([w for ws in tokens for w in ws]) if w not in cached]
        for w, own in zip(distinct, self.words([w.encode("utf-8") for w in distinct])):
            cached[w] = (len(own), ",".join(map(str, own)), b"".join([self.bytes[t] for t in own]))
        known = self.known
        for c, ws in zip(new, tokens):
            if len(ws) == 1:
                known[c] = cached[ws[0]]
            else:
                own = [cached[w] for w in ws]
                known[c] = (sum([f[0] for f in own]), ",".join([f[1] for f in own]), b"".join([f[2] for f in own]))

    def encode(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """(number of ids, ids joined by commas, bytes they decode to)."""
        parts: list[list] = []
        for t in texts:
            own: list = []
            for piece in (self.cut.split(t) if self.cut is not None and self.cut.search(t) else (t,)):
                if piece in self.special:
                    own.append(piece)
                elif piece:
                    own.append(self._chunks(piece))
            parts.append(own)
        used = set()
        for own in parts:
            for p in own:
                if isinstance(p, list):
                    used.update(p)
        if len(self.known) > CACHE_CHUNKS:  # keep what these texts use
            self.known = {c: self.known[c] for c in used if c in self.known}
        if len(self.cached) > CACHE_CHUNKS:
            self.cached = {c: v for c, v in self.known.items() if c in self.cached}
        self._learn(list(used.difference(self.known)))
        known, out = self.known, []
        for own in parts:
            found: list = []
            for p in own:
                if isinstance(p, list):
                    found += [known[c] for c in p]
                else:
                    found.append((1, str(self.special[p]), self.bytes[self.special[p]]))
            out.append((sum([f[0] for f in found]), ",".join([f[1] for f in found]), b"".join([f[2] for f in found])))
        return out


_MODELS: dict[str, ByteBPE] = {}


def model(path: str) -> ByteBPE:
    if path not in _MODELS:
        _MODELS[path] = ByteBPE(path)
    return _MODELS[path]


_MADE = [StructField("n", LongType()), StructField("ids", StringType()), StructField("decoded", StringType())]


def _encoder(path: str, names: list[str], digest: bool):
    def run(batches):
        bpe = model(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            rows: list = []
            for at in range(0, len(texts), 256):
                done = bpe.encode([t or "" for t in texts[at:at + 256]])
                if digest:
                    rows += [(n, hashlib.sha256(i.encode()).hexdigest(),
                              hashlib.sha256(d.decode("utf-8", "replace").encode()).hexdigest()) for n, i, d in done]
                else:
                    rows += [(n, i, d.decode("utf-8", "replace")) for n, i, d in done]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], *cols], names=[*names, "n", "ids", "decoded"])

    return run


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` (array) and ``decoded``."""
    base = carried(docs, text)
    out = base.mapInArrow(_encoder(path, base.columns, False), StructType([*base.schema.fields, *_MADE]))
    ids = F.when(F.col("n") == 0, F.array().cast("array<long>")).otherwise(F.split("ids", ",").cast("array<long>"))
    return uncarried(out, docs, text, n_tokens=F.col("n"), ids=ids, decoded=F.col("decoded"))


def encode_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; the
    digests are taken where the ids are made, so ids don't travel."""
    base = carried(docs, text)
    out = base.mapInArrow(_encoder(path, base.columns, True), StructType([*base.schema.fields, *_MADE]))
    return uncarried(out, docs, text, n_tokens=F.col("n"), ids_sha256=F.col("ids"), decoded_sha256=F.col("decoded"))
