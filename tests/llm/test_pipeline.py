import collections

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tests.conftest import SF


def test_stages_in_order_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    docs = start = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == start.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, start.schema)
    assert docs.count() > 0.4 * start.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    tokens = collections.Counter()
    for r in last:
        tokens[r.doc_id] += r.length
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert tokens == {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()}


def test_registered(spark):
    queries = __spark_entry__.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert sum(n.startswith("op") and n[2].isdigit() for n in queries) == 13
    assert corpus_pipeline.run(spark, SF).count() > 0
