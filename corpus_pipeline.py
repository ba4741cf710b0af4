"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written before the next one reads
it. All but the last keep the columns of ``documents``. What a stage wrote for itself is removed when the
next one begins: by then its result is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import attach, decontaminate, jaccard, lines, packing, quality
from touchline.llm.queries import vocabulary
from touchline.sources import files, sinks
from touchline.sources.sinks import materialise


#: Folders that the stage before wrote for itself.
_made: list[str] = []


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]
          ) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _made:
            files.remove_folder(spark, _made.pop())
        with sinks.noted(_made):
            return work(spark, docs, sf_dir)

    return run_stage


@stage
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the thresholds of their language and source."""
    return quality.keep_good(docs)


@stage
def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that come earlier; one that has no other line goes."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    cut = lines.remove_lines(rows)
    left = (F.col("n_removed") == 0) | (F.trim(F.coalesce("text", F.lit(""))) != "")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.where(left).select(*[
        (new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


@stage
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8 or more)."""
    found = materialise(jaccard.jaccard_components(docs, 5, 80), "components")
    kept = attach.without(docs, found.where("doc_id <> component_id"))
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(
        kept.where("doc_id is null"))


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.remove_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: Sketches, edit distances and packing are not expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = materialise(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
