"""Queries of the corpus operators: each applies one operator with its
production parameters to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from riskspan.llm.alignment import link_counts
from riskspan.llm.bpe import encode_digests
from riskspan.llm.common import documents
from riskspan.llm.fingerprints import fingerprint_documents
from riskspan.llm.language_id import fit_language, identify_language
from riskspan.llm.line_dedup import remove_repeated_lines
from riskspan.llm.near_dedup import near_duplicates
from riskspan.llm.packing import pack_documents
from riskspan.llm.pii import find_private, fit_private
from riskspan.llm.quality import fit_quality, score_quality
from riskspan.llm.spelling import count_words, spelling_variants
from riskspan.llm.substring_dedup import remove_repeats
from riskspan.llm.suffix_dedup import remove_repeated_bytes
from riskspan.llm.vector_search import top_inner_products, whole_vectors

MIN_LINES = 2
# a line of so many bytes (some 15 words) is a passage by itself
LONE_BYTES = 80


def op1_line_dedup(spark, sf_dir):
    out = remove_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"), MIN_LINES, lone_bytes=LONE_BYTES)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = f"""
with d as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
starts as (
  select doc_id, i, ls[i] || chr(10) || ls[i + 1] as run
  from (select doc_id, ls, unnest(range(1, len(ls))) as i from d)),
later as (
  select doc_id, i from (
    select doc_id, i, row_number() over (partition by run order by doc_id, i) as nth from starts)
  where nth > 1),
lines as (select doc_id, unnest(range(1, len(ls) + 1)) as p, unnest(ls) as line from d),
lone as (
  select doc_id, p from (select doc_id, p, row_number() over (partition by line order by doc_id, p) as nth from lines where strlen(line) >= {LONE_BYTES})
  where nth > 1),
gone as (select distinct doc_id, p from (select doc_id, unnest([i, i + 1]) as p from later union all select doc_id, p from lone)),
kept as (
  select l.doc_id, count(*) as n_lines, count(g.p) as n_removed,
    coalesce(string_agg(case when g.p is null then l.line end, chr(10) order by l.p), '') as kept_text
  from lines l left join gone g on g.doc_id = l.doc_id and g.p = l.p group by l.doc_id)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept_text, '')) as kept_sha256
from (select doc_id from documents) left join kept using (doc_id)"""


def held_out(divisor: int, rest: int):
    """Whether crc32(doc_id as text) leaves ``rest``; a null id does not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == rest, F.lit(False))


def op2_topk_search(spark, sf_dir):
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 64)
    return top_inner_products(vectors, F.col("id") % 20 == 0, 20)


def op3_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = fit_quality(docs, labels, ~held_out(3, 1))
    return score_quality(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op4_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), words=4, percent=80) \
        .select("doc_id", "n_shingles", "component_id", "kept")


def op5_fingerprints(spark, sf_dir):
    return fingerprint_documents(documents(spark, sf_dir))


def op6_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = fit_language(docs, ~held_out(4, 2))
    return identify_language(docs.select("doc_id", "text"), model) \
        .select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op7_bpe(spark, sf_dir):
    out = encode_digests(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op9_substring_dedup(spark, sf_dir):
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_suffix_dedup(spark, sf_dir):
    out = remove_repeated_bytes(documents(spark, sf_dir).select("doc_id", "text"), window=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_token_alignment(spark, sf_dir):
    out = link_counts(documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_spelling_variants(spark, sf_dir):
    words = count_words(documents(spark, sf_dir), least=6, occurrences=5, every=199)
    return spelling_variants(words, ratio=5)


def op13_pii(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = find_private(docs, fit_private(docs))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_topk_search, op3_quality_classifier, op4_minhash_near_dedup,
                                   op5_fingerprints, op6_language_id, op7_bpe,
                                   op8_best_fit_packing, op9_substring_dedup,
                                   op10_suffix_dedup, op11_token_alignment, op12_spelling_variants, op13_pii)}
ORACLE: dict[str, str] = {"op1_line_dedup": OP1_SQL}
