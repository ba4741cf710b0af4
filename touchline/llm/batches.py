"""How much text is handed to Python at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Spark's own limit is 64 MB, which a task holds several times: in the JVM, on its way and in the worker.
BATCH = "4m"


def small_batches(spark: SparkSession) -> None:
    """Let tasks of this session send Arrow batches of about ``BATCH`` to Python; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
