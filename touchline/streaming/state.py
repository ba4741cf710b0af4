"""Settings that streams with arbitrary state need."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
VERSIONS = "spark.sql.streaming.maxBatchesToRetainInMemory"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Queries started inside take these settings; the session's own are put back (a query takes the
    settings it starts with)."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    with settings(spark, {PROVIDER: ROCKSDB}):
        yield


@contextmanager
def newest_in_memory(spark: SparkSession) -> Iterator[None]:
    """Queries started inside hold only the newest version of their state on the heap; an older one,
    for a batch that is run again, is read from the checkpoint."""
    with settings(spark, {VERSIONS: "1"}):
        yield


@contextmanager
def without_empty_batches(spark: SparkSession) -> Iterator[None]:
    """Queries started inside run no batch that only moves the watermark. What such a batch would have
    given out or dropped comes with the next batch of the query, which has the same watermark."""
    with settings(spark, {EMPTY_BATCHES: "false"}):
        yield
