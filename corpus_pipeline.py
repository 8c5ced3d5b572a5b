"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; ``run`` writes every stage's rows as Parquet to the shared
folder and reads them again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from riskspan.llm.common import documents, stored
from riskspan.llm.line_dedup import line_stage
from riskspan.llm.near_dedup import near_dedup_stage
from riskspan.llm.packing import pack_documents
from riskspan.llm.quality import fit_quality, quality_stage
from riskspan.llm.queries import MIN_LINES, held_out
from riskspan.llm.substring_dedup import substring_stage

CAPACITY = 2048
# a line of so many bytes (some 15 words) is a passage by itself
LONE_BYTES = 80
REPEAT_WORDS = 40


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_stage(docs, fit_quality(docs, labels, ~held_out(3, 1)))


def lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs and of long lines go, and documents of nothing else."""
    return line_stage(docs, MIN_LINES, lone_bytes=LONE_BYTES)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup_stage(docs, words=5, percent=80)


def substrings(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of at least 40 words that occur twice go (passages of over 50 words,
    also where their first and last words touch other text)."""
    return substring_stage(docs, REPEAT_WORDS)


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes token sequences: one row for each piece."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("substring_dedup", substrings), ("packing", packing)]

# Classifier, tokenizer and packing have no SQL form; tests/llm hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
