import collections
import random
import re

import pyarrow as pa
import pytest

from riskspan.llm import queries as Q
from riskspan.llm.common import text_bytes
from riskspan.llm.near_dedup import _shingle_sets, components, near_dedup_stage, near_duplicates, needed
from tests.llm.data import clashing, empty, messy, messy_rows, words, write_tables

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def groups(rows, n, percent=80):
    """Brute force over all pairs: root of each row."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def family(seed=4):
    """Copies with a few changed words, chains, and a line that all share."""
    rng = random.Random(seed)
    line = words(rng, 12)
    rows = []
    for k in range(6):
        base = words(rng, rng.choice([8, 30, 150, 400])).split()
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = words(rng, 1)
            rows.append((len(rows) + 1000, " ".join(own) + " " + (line if rng.random() < 0.4 else "")))
    rows += [(5000 + i, line + " " + words(rng, rng.randint(0, 30))) for i in range(60)]
    return rows


@pytest.mark.parametrize("n", [4, 5])
def test_components_against_brute_force(spark, n):
    rows = [(r[0], r[1]) for r in messy_rows()] + family()
    sets, root = groups(rows, n)
    ids = collections.defaultdict(list)
    for r, k in zip(rows, root):
        ids[k].append(r[0])
    want = collections.Counter()
    for (i, _), s, k in zip(rows, sets, root):
        known = [x for x in ids[k] if x is not None]
        comp = (min(known) if known else None) if s else i
        want[(i, len(s), comp, i == comp)] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(map(tuple, near_duplicates(docs, n).collect()))
    assert got == want


def test_stage_keeps_one_of_each_group(spark):
    rows = [(r[0], r[1]) for r in messy_rows()] + family(9)
    sets, root = groups(rows, 5)
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = near_dedup_stage(docs)
    assert out.columns == docs.columns
    left = out.collect()
    assert sum(1 for r in left if not shingles(r.text, 5)) == sum(1 for s in sets if not s)
    by_row = {}
    for (i, t), k in zip(rows, root):
        by_row[(i, t)] = k
    kept = [by_row[(r.doc_id, r.text)] for r in left if shingles(r.text, 5)]
    assert len(kept) == len(set(kept)) == len({k for k, s in zip(root, sets) if s})


def test_stage_shuffles_texts_once(spark):
    """What is joined by set and id is grouped where it lies.  One row of a
    group stays: the smallest id's smallest text; a null id is not 0."""
    one, two = "a b c d e f g h", "A b c d e f g h"
    rows = [(7, one), (0, two), (0, one), (None, one), (0, one), (None, "k l m n o p"), (None, "K l m n o p")]
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_dedup_stage(spark.createDataFrame(rows, "doc_id long, text string"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    above, join, _ = plan.partition("SortMergeJoin")
    assert join and "Aggregate" in above and "Exchange" not in above
    assert collections.Counter(map(tuple, out.collect())) == collections.Counter([(0, two), (None, "K l m n o p")])


def test_sets_begin_with_their_sketch():
    raw, offsets = text_bytes(pa.array([t for _, t in family(5)]))
    for s in _shingle_sets(raw, offsets, 5):
        assert (s[1:] > s[:-1]).all()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (90, 95, 100)} == {90}


def test_needed_values():
    for n in range(1, 41):
        assert needed(n, 80) == -(-n * 8 // 10)
    assert needed(1000, 80) == 32


def test_query_and_empty_table(spark, tmp_path):
    rows = [(r[0], r[1]) for r in messy_rows() if r[0] is not None]
    folder = write_tables(spark, tmp_path, spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.n_shingles) for r in Q.op4_minhash_near_dedup(spark, folder).collect()}
    assert got == {(i, len(shingles(t, 4))) for i, t in rows}
    assert near_duplicates(empty(spark)).collect() == []
    assert near_dedup_stage(empty(spark)).collect() == []
