"""Near-duplicate groups by bottom-k sketches.

A document's set are its distinct word shingles; one hash function orders
them, and the ``SKETCH`` smallest make the sketch.  Documents with equal sets
are one node.  Inverted lists of the retained values give the candidates:

* Two sets with similarity t share at least ``need`` retained values (all but
  certainly for large sets, see ``needed``; always for small ones).  With the
  values of each sketch in one order, rarest first, two such sketches
  therefore meet within their first size - need + 1 values, and only these
  enter lists.  A value that very many documents share (a common line or
  passage) is left out wherever rarer values decide.
* Star round: every node of a list is compared with the list's hub, the node
  whose sketch is least unusual.  Overlaps of the two sketches estimate the
  similarity; candidates that pass are verified on full sets, and links make
  components.
* Remaining pairs: in a list whose nodes are still in several components, the
  nodes outside its largest component are its *open* ones; pairs without an
  open node are in one component already.  Nodes are cut into bands by set
  size (linked sets are in the same or neighbouring bands) and bands into
  blocks of bounded size; a node goes into its own block, an open node also
  into the blocks it may have links in.  Tasks compare sketches first, then
  full sets of what passes.  Only a spanning forest of the links found leaves
  a task, never all pairs.

Components are spread by smallest labels with pointer jumping.

Defined cases: null and wordless texts have empty sets and link with nothing;
a text with fewer words than a shingle is one shingle; a group is named after
its smallest doc_id, null if it has none; repeated rows are in one group;
extra columns are passed on; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from riskspan.llm.common import (LOWER, ROLL_A, carried, mix64, slices, small_batches, stored, text_bytes, uncarried,
                                 word_codes, words_of, worker_cache)

SKETCH = 64
# Nodes, and open nodes beside them, of a list that meet in one unit of work.
BLOCK, OPEN_BLOCK = 1024, 2048
# Values whose bits are held at the same time.
VALUES = 1 << 15
# Hub rounds: each takes a new hub for every list that is still open.
ROUNDS = 3


def needed(n: int, percent: int) -> int:
    """Retained values that two sets of similarity percent/100 share.

    Small sets are their own sketch (and that of the partner, at most n/t
    large): exactly t*n.  For large ones the shared values among the k
    smallest of the union are hypergeometric with mean t*k; six deviations
    below the mean, fewer than two pairs in 10**8 right at the limit are missed
    (and for less similar pairs nothing is lost).
    """
    t = percent / 100
    if n <= SKETCH * t * t:
        return max(1, -(-n * percent // 100))
    mean = SKETCH * t
    return max(1, int(mean - 6 * math.sqrt(mean * (1 - t))))


def _shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    raw = LOWER[raw]
    start, end, first = words_of(raw, offsets)
    prefix = ROLL_A.prefix(word_codes(raw, start, end))
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo <= words:
            at, to = np.array([lo] * (hi > lo), np.int64), np.array([hi] * (hi > lo), np.int64)
        else:
            at = np.arange(lo, hi - words + 1)
            to = at + words
        out.append(np.unique(ROLL_A.spans(prefix, at, to).view(np.int64)))
    return out


def _set_key(s: np.ndarray) -> tuple[int, int]:
    u = s.view(np.uint64)
    return tuple(int(mix64(u ^ np.uint64(c)).sum(dtype=np.uint64).astype(np.int64))
                 for c in (0x243F6A8885A308D3, 0x13198A2E03707344))


def _signer(names: list[str], words: int, keep: str):
    """Batches with n_shingles, h1, h2 and, by ``keep``, sketch or full set."""
    def run(batches):
        worker_cache("near_dedup")
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            sets = []
            for lo, hi in slices(offsets):
                sets += _shingle_sets(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words)
            keys = [_set_key(s) for s in sets]
            cols = [pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64())]
            made = ["n_shingles", "h1", "h2"]
            if keep:
                held = [s[:SKETCH] for s in sets] if keep == "sketch" else sets
                ends = np.cumsum([0, *[len(s) for s in held]]).astype(np.int32)
                flat = np.concatenate(held) if held else np.zeros(0, np.int64)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                made.append(keep)
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], *cols], names=[*names, *made])

    return run


def _signed(df: DataFrame, words: int, keep: str, names: list[str]) -> DataFrame:
    fields = [df.schema[n] for n in names]
    fields += [StructField(n, LongType()) for n in ("n_shingles", "h1", "h2")]
    if keep:
        fields.append(StructField(keep, ArrayType(LongType())))
    return small_batches(df).mapInArrow(_signer(names, words, keep), StructType(fields))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for edges (a, b): the smallest node reachable."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp"))
                    .withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        step = stored(step.join(up, "comp").select("node", F.least("comp", "top").alias("comp"), "old"), "labels")
        labels = step.select("node", "comp")
        if step.where(F.col("comp") != F.col("old")).limit(1).count() == 0:
            return labels


def _lists(column) -> list[np.ndarray]:
    """The lists of an Arrow column of longs, as views of its values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[lo:hi] for lo, hi in zip(at[:-1].tolist(), at[1:].tolist())]


def _common_counts(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """|sets[i] & sets[j]| for the given pairs, by bit rows over the values
    that at least two of the sets hold, some of the values at a time."""
    out = np.zeros(len(i), np.int64)
    flat = np.concatenate(sets)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])
    shared = ~(new & np.append(new[1:], True))
    owner, column = owner[shared], np.cumsum(new[shared]) - 1
    width = max(1, VALUES // 64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, VALUES):
        lo, hi = np.searchsorted(column, (first, first + VALUES))
        own, bit = owner[lo:hi], column[lo:hi] - first
        wide = min(width, (int(bit[-1]) >> 6) + 1)
        bits = np.zeros((len(sets), wide), np.uint64)
        np.bitwise_or.at(bits, (own, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        step = max(1, (1 << 21) // wide)
        for at in range(0, len(i), step):
            out[at:at + step] += np.bitwise_count(bits[i[at:at + step]] & bits[j[at:at + step]]).sum(axis=1, dtype=np.int64)
    return out


def _open_pairs(t: pa.Table, percent: int):
    """Pairs (node of the block, open node) of a unit that are in different
    components, of fitting size, in their first common list, and whose
    sketches overlap enough; a pair of open nodes only where the block's node
    has the larger number."""
    v = t["v"][0].as_py()
    guest, open_, node, comp = (t[c].to_numpy() for c in ("guest", "open", "node", "comp"))
    n, need = t["n"].to_numpy(), t["need"].to_numpy()
    left, right = np.flatnonzero(~guest), np.flatnonzero(guest)
    none = np.zeros(0, np.int64)
    if not len(left) or not len(right):
        return none, none
    found = []
    step = max(1, (1 << 20) // len(right))
    for at in range(0, len(left), step):
        own = left[at:at + step]
        ok = comp[own][:, None] != comp[right][None, :]
        ok &= np.minimum(n[own][:, None], n[right][None, :]) * 100 >= percent * np.maximum(n[own][:, None], n[right][None, :])
        ok &= ~open_[own][:, None] | (node[own][:, None] > node[right][None, :])
        a, b = np.nonzero(ok)
        found.append((own[a], right[b]))
    i, j = (np.concatenate(x) for x in zip(*found))
    if not len(i):
        return none, none
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    own = t.take(pa.array(used))
    i, j = place[:len(i)], place[len(i):]
    prefixes = _lists(own["prefix"])
    earlier = [p[:int(np.flatnonzero(p == v)[0])] for p in prefixes]
    first = _common_counts(earlier, i, j) == 0 if any(map(len, earlier)) else np.ones(len(i), bool)
    i, j = i[first], j[first]
    if not len(i):
        return none, none
    sketches = _lists(own["sketch"])
    enough = _common_counts(sketches, i, j) >= np.maximum(need[used[i]], need[used[j]])
    return used[i[enough]], used[j[enough]]


_UNIT = ("v long, band int, block int, part int, guest boolean, open boolean, node long, comp long, n long, need int, "
         "prefix array<long>, sketch array<long>")


def _screen(percent: int):
    def run(t: pa.Table) -> pa.Table:
        i, j = _open_pairs(t, percent)
        return t.take(pa.array(np.unique(np.concatenate([i, j]))))

    return run


def _link(percent: int):
    def run(t: pa.Table) -> pa.Table:
        i, j = _open_pairs(t, percent)
        edges = []
        if len(i):
            sets = _lists(t["set"])
            n, node, comp = t["n"].to_numpy(), t["node"].to_pylist(), t["comp"].to_pylist()
            common = _common_counts(sets, i, j)
            linked = 100 * common >= percent * (n[i] + n[j] - common)
            parent: dict[int, int] = {}

            def top(c):
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            for a, b in zip(i[linked].tolist(), j[linked].tolist()):
                p, q = top(comp[a]), top(comp[b])
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    edges.append((node[a], node[b]))
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _links(reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame | None:
    """A forest (a, b) of links between nodes that connects what is linked."""
    t = percent / 100
    small = SKETCH * t * t
    mean = SKETCH * t
    large = max(1, int(mean - 6 * math.sqrt(mean * (1 - t))))
    need = F.when(F.col("n") <= small, F.greatest(F.ceil(F.col("n") * percent / 100), F.lit(1))).otherwise(F.lit(large))
    entries = reps.select("node", "n", F.explode("sketch").alias("v"))
    counts = entries.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    size = F.least(F.col("n"), F.lit(SKETCH))
    found = entries.join(counts, "v").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("c", "v"))).alias("held"))
    room = (size - F.col("need") + 1 - (size - F.size("held"))).cast("int")
    prefixes = stored(found.withColumn("need", need.cast("int")).withColumn("room", room).where("room > 0")
                      .select("node", "n", "need", (size - F.size("held")).cast("int").alias("odd"),
                              F.expr("transform(slice(held, 1, room), e -> e.v)").alias("prefix")), "prefixes")
    listed = prefixes.select("node", "n", "odd", F.explode("prefix").alias("v"))
    hubs = listed.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("odd", "node", "n")).alias("hub")).where("m > 1")
    hubs = stored(hubs, "lists")
    members = stored(listed.join(hubs, "v").select("v", "node", "n", "odd", F.col("hub.node").alias("hub"),
                                                   F.col("hub.n").alias("hub_n")), "members")
    # full sets of all nodes that are in a list
    wanted = members.select("node").distinct().join(reps.select("node", "doc", "h1", "h2"), "node") \
        .select("node", "doc", F.col("h1").alias("w1"), F.col("h2").alias("w2"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("doc"))).select("node", "w1", "w2", "text")
    full = _signed(texts, words, "set", ["node", "w1", "w2"]).where("w1 = h1 and w2 = h2")
    full = stored(full.groupBy("node").agg(F.first("set").alias("set")), "sets")
    # a set is in the order of the hash, so it begins with its sketch
    sketches = full.select("node", F.slice("set", 1, SKETCH).alias("sketch"))

    def both(pairs: DataFrame, table: DataFrame, col: str) -> DataFrame:
        for k in ("a", "b"):
            pairs = pairs.join(table.select(F.col("node").alias(k), F.col(col).alias(f"{col}_{k}")), k)
        return pairs

    least = F.when(F.greatest("na", "nb") <= small, F.ceil(F.greatest("na", "nb") * percent / 100)).otherwise(F.lit(large))
    common = F.size(F.array_intersect("set_a", "set_b"))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb")).distinct()
        likely = both(pairs, sketches, "sketch").where(F.size(F.array_intersect("sketch_a", "sketch_b")) >= least) \
            .select("a", "b", "na", "nb")
        return both(likely, full, "set").withColumn("common", common) \
            .where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")

    links = stored(linked(members.where(F.col("node") != F.col("hub"))
                          .select(F.col("node").alias("a"), F.col("hub").alias("b"), F.col("n").alias("na"), F.col("hub_n").alias("nb"))), "star")
    open_ = _open_lists(members, components(links))
    for _ in range(ROUNDS - 1):
        # the least unusual open node of a list is its next hub
        hubs = open_.where("open").groupBy("v").agg(F.min(F.struct("odd", "node", "n", "comp")).alias("next"))
        pairs = open_.join(hubs, "v").where(F.col("comp") != F.col("next.comp")).select(
            F.col("node").alias("a"), F.col("next.node").alias("b"), F.col("n").alias("na"), F.col("next.n").alias("nb"))
        links = stored(links.unionByName(linked(pairs)), "star")
        open_ = _open_lists(members, components(links))
    # linked sets differ in size by less than a band
    band = F.floor(F.log(F.col("n") + 0.0) / (1.001 * math.log(100 / percent) + 1e-9)).cast("int")
    open_ = open_.withColumn("band", band)
    sizes = open_.groupBy("v", "band").agg(F.count(F.lit(1)).alias("mb"))
    guests = open_.where("open").groupBy("v").agg(F.ceil(F.count(F.lit(1)) / OPEN_BLOCK).cast("int").alias("parts"))
    sizes = sizes.join(guests, "v").select("v", "band", F.ceil(F.col("mb") / BLOCK).cast("int").alias("blocks"), "parts")
    code = F.xxhash64("node")
    hosts = open_.join(sizes, ["v", "band"]).select(
        "v", "band", F.pmod(code, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("guest"), "open", "node", "comp", "n")
    visits = open_.where("open").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).join(sizes, ["v", "band"])
    visits = visits.select("v", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                           F.pmod(code, F.col("parts")).cast("int").alias("part"), F.lit(True).alias("guest"), "open", "node", "comp", "n")
    units = hosts.unionByName(visits).join(prefixes.select("node", "need", "prefix"), "node").join(sketches, "node") \
        .select("v", "band", "block", "part", "guest", "open", "node", "comp", "n", "need", "prefix", "sketch")
    unit = ["v", "band", "block", "part"]
    passed = units.groupBy(*unit).applyInArrow(_screen(percent), _UNIT)
    more = stored(passed.join(full, "node").select(*unit, "guest", "open", "node", "comp", "n", "need", "prefix", "sketch", "set")
                  .groupBy(*unit).applyInArrow(_link(percent), "a long, b long"), "links")
    return links.unionByName(more)


def _open_lists(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries of the lists that hold several components, with ``comp`` and
    ``open``: outside the list's largest component."""
    entries = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).select("v", "node", "n", "odd", "comp")
    counts = entries.groupBy("v", "comp").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy("v").agg(F.count(F.lit(1)).alias("several"), F.max(F.struct("c", "comp"))["comp"].alias("main")).where("several > 1")
    return stored(entries.join(largest.select("v", "main"), "v").select("v", "node", "n", "odd", "comp", (F.col("comp") != F.col("main")).alias("open")), "open")


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signatures (doc_id, n_shingles, h1, h2) of all rows, and (h1, h2,
    component_id) of the sets that are linked to others or not."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signs = stored(_signed(base, words, "sketch", ["doc_id"]), "signatures")
    reps = signs.where("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    # ids are fixed once the table is written
    reps = stored(reps.withColumn("node", F.monotonically_increasing_id()), "nodes")
    comps = components(_links(reps, base, words, percent))
    named = reps.select("node", "h1", "h2", "doc").join(comps, "node", "left") \
        .withColumn("comp", F.coalesce("comp", "node"))
    # the group's smallest id (null ids last), and the one set that stands for it
    first = F.min(F.struct(F.col("doc").isNull(), "doc", "h1", "h2")).alias("first")
    names = named.groupBy("comp").agg(first)
    classes = named.join(names, "comp").select(
        "h1", "h2", F.col("first.doc").alias("component_id"),
        ((F.col("h1") == F.col("first.h1")) & (F.col("h2") == F.col("first.h2"))).alias("leads"))
    return signs.drop("sketch"), classes


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    signs, classes = _classes(docs, words, percent)
    linked = signs.where("n_shingles > 0").join(classes, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id")
    alone = signs.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup_stage(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near duplicates
    (the one with the smallest doc_id; of several with that id the one with
    the smallest text), and every wordless row."""
    _, classes = _classes(docs, words, percent)
    base = carried(docs)
    rows = _signed(base.withColumn("id", F.col("row.doc_id").cast("long")), words, "", ["row", "text", "id"])
    alone = rows.where("n_shingles = 0").select("row", "text")
    # plain equality of all keys, by which rows are grouped too: texts are shuffled once
    key = ["h1", "h2", "known", "none"]
    rows = rows.where("n_shingles > 0").withColumns({"known": F.coalesce("id", F.lit(0)), "none": F.col("id").isNull()})
    leads = classes.where("leads").select("h1", "h2", F.coalesce("component_id", F.lit(0)).alias("known"),
                                          F.col("component_id").isNull().alias("none"))
    first = rows.join(leads, key).groupBy(*key).agg(F.min_by(F.struct("row", "text"), "text").alias("first"))
    return uncarried(first.select("first.row", "first.text").unionByName(alone), docs)
