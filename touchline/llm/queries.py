"""A query for each operator over the whole of its table, with the columns that are compared."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    copies,
    decontaminate,
    jaccard,
    lines,
    negatives,
    packing,
    pii,
    quality,
    runs,
    secrets,
    shards,
    substrings,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Ranks of the 50k byte-level vocabulary; ids are those of its other file formats."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.digest(pii.find_personal_data(docs, pii.fitted(docs)))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), 4, 85)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_hits(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.remove_lines(_table(spark, sf_dir, "documents")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(substrings.remove_repeats(_table(spark, sf_dir, "documents")))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_documents(_table(spark, sf_dir, "documents")))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fitted(docs, _table(spark, sf_dir, "labels"))
    return toxicity.digest(toxicity.score_documents(docs, model))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judged(_table(spark, sf_dir, "documents"), ["doc_id"]))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_runs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.digest(runs.find_runs(docs))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.scaled(_table(spark, sf_dir, "embeddings"), 256)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.digest(copies.copies(_table(spark, sf_dir, "documents"), ["doc_id"], True))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_personal_data, op3_ngram_jaccard, op4_decontamination,
    op5_line_dedup, op6_substring_dedup, op7_secret_scans, op8_sharding, op9_toxicity,
    op10_quality_rules, op11_periodic_runs,
    op12_hard_negatives, op13_exact_dedup)}

#: SQL for the queries that SQL can express over whole tables in reasonable time.
ORACLE: dict[str, str] = {
    "op12_hard_negatives": """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    cast(list_inner_product(a.v, b.v) as bigint) as score
  from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as int) as rank, vec_id as negative_id,
  positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not same
  and 80 * positive_score <= 100 * score and score <= positive_score
window w as (partition by p.anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over w <= 5""",
    "op13_exact_dedup": r"""
with plain as (
  select doc_id, length(coalesce(text, '')) as n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
grouped as (
  select *, count(*) over (partition by text_sha256) as group_size,
    first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id nulls last)
      as keep_id
  from plain)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from grouped""",
}
