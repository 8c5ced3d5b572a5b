"""Small corpora with the cases every operator must stand."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use for columns of their own
CLASHING = ["gid", "bucket", "row", "kept", "size", "removed", "place", "node", "score", "predicted", "kept_text",
            "n_words", "label", "ids", "comp", "lines", "starts"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) for _ in range(n))


def messy_rows(seed=1):
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = words(rng, 120)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "two words"), (5, passage), (6, base), (7, base),
            (8, words(rng, 20) + " " + passage + " " + words(rng, 20)), (9, words(rng, 5) + "\n" + passage),
            (10, " ".join(["x"] * 300)), (11, "a" * 3000), (12, "l1 l1\nl2 l2\nl3\n" * 4), (13, "l2 l2\nl3\nother"),
            (14, base.replace(base.split()[50], "zzz", 1)), (15, base.upper()), (15, base.upper()), (None, base),
            (16, "é漢字 " * 200), (17, "q w e\n\n\n"), (18, words(rng, 8000)), (None, None), (19, "12 34 !!")]
    rows += [(20 + i, words(rng, rng.randint(0, 80))) for i in range(20)]
    return [(i, t, rng.choice(["xx", "yy", None]), None if i is None else f"s{i % 3}", len(t or "")) for i, t in rows]


def messy(spark, seed=1):
    return spark.createDataFrame(messy_rows(seed), SCHEMA)


def clashing(docs):
    """``docs`` with extra columns named like working columns."""
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def write_tables(spark, folder, docs, labels=None, vectors=None):
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    if labels is not None:
        labels.write.parquet(f"{folder}/labels.parquet")
    if vectors is not None:
        vectors.write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)
