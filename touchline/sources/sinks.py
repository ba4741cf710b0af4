"""Where results go, and the shared folder that intermediate tables use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_responses(responses: DataFrame, path: str) -> None:
    """One JSON answer per line in request order (range-partitioned, so it scales)."""
    responses.orderBy("request_seq").select("response").write.mode("overwrite").text(path)


def append_matches(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Match table plus newly arrived records; of a match sent again the arrived version counts."""
    both = stored.withColumn("_arrived", F.lit(0)).unionByName(
        arrived.withColumn("_arrived", F.lit(1)))
    newest = both.groupBy("wyId").agg(
        F.max_by(F.struct(*stored.columns), "_arrived").alias("m"))
    return newest.select("m.*")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one named in ``spark.checkpoint.dir``.

    A local session without that setting uses its warehouse; on a cluster there is no telling whether
    executors reach that, so the setting has to be there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Lists that the folders of stage tables are noted in at the moment.
_noted: list[list[str]] = []


@contextmanager
def noted(folders: list[str]) -> Iterator[None]:
    """Folders that :func:`materialise` writes inside are added to ``folders``, for whoever knows when
    they aren't needed any more."""
    _noted.append(folders)
    try:
        yield
    finally:
        _noted.remove(folders)


def materialise(frame: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write a stage table to the shared folder and read it back.

    Used where one stage feeds several jobs; survives the loss of executors because
    the files do not live on them.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    for folders in _noted:
        folders.append(path)
    frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def latest_per_key(batches: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Newest version of every key in a table that holds several."""
    values = [c for c in batches.columns if c not in (*keys, version)]
    newest = F.max_by(F.struct(*batches.columns), version).alias("n")
    return batches.groupBy(*keys).agg(newest).select(
        *keys, *[f"n.{c}" for c in values], f"n.{version}")
