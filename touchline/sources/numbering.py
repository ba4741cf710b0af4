"""Numbers for the lines of text files, in file and line order, without bringing them together.

Files are read in splits, each by one task and from front to back. One pass writes the lines with their
file, the offset of their split and their place in the task. The lines of every split are counted, the
counts are summed up over the splits of a file and over the files, and a line's number is what lies
before its split plus its place in it. Only counts, one for each split, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

SPLIT = ["_file", "_block"]


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with what :func:`numbered` needs to know about where they are from."""
    return with_places(spark.read.text(path))


def with_places(lines: DataFrame) -> DataFrame:
    """``value`` of a text source (also of a streaming one) with its file and split."""
    return lines.select("value", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_block"))


def numbered(lines: DataFrame, name: str = "line_no") -> DataFrame:
    """``lines`` from :func:`with_places` numbered from 0: by path of the file, then by line."""
    # Written once: the place in the task belongs to one run of the scan.
    placed = materialise(lines.withColumn("_place", F.monotonically_increasing_id()), "placed-lines")
    splits = placed.groupBy(*SPLIT).agg(F.count("*").alias("_lines"), F.min("_place").alias("_first"))
    splits = materialise(splits, "line-counts")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_file = before.partitionBy("_file").orderBy("_block")
    files = splits.groupBy("_file").agg(F.sum("_lines").alias("_all")).select(
        "_file", F.coalesce(F.sum("_all").over(before.orderBy("_file")), F.lit(0)).alias("_files"))
    starts = splits.withColumn("_blocks", F.coalesce(F.sum("_lines").over(in_file), F.lit(0))).join(
        files, "_file").select(*SPLIT, (F.col("_files") + F.col("_blocks") - F.col("_first"))
                               .alias("_shift"))
    kept = [c for c in placed.columns if c not in (*SPLIT, "_place", name)]
    # One row for each split, so that the lines stay where they are.
    return placed.join(F.broadcast(starts), SPLIT).select(
        *kept, (F.col("_shift") + F.col("_place")).alias(name))
