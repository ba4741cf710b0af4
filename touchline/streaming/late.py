"""Rows behind the watermark, kept apart instead of dropped.

Stateful operators drop rows that come too late without a trace. Here every batch is split before it
reaches them: rows older than the latest time seen in earlier batches, less the allowed delay, are
stored as late, under the batch that refused them; the others are accepted. An operator that reads the
accepted rows with the same delay drops none of them, so what it counted and what is late together
are all rows, which :func:`reconciled` checks counter by counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from touchline.operators import metrics
from touchline.sources import files
from touchline.streaming.counters import trigger


def write_split(stream: DataFrame, path: str, checkpoint: str, delay: str, time: str = "ts",
                once: bool = True) -> StreamingQuery:
    """Start a query that stores every batch below ``path/rows``, split by ``late``.

    ``path/seen`` has the latest time up to each batch. A batch that is retried after it was stored
    is left as it is, so readers never see a row twice.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/seen/batch_id={batch_id - 1}"
        limit = None
        if files.is_complete(spark, before):
            limit = spark.read.parquet(before).select(
                F.col("seen") - F.expr(f"INTERVAL {delay}")).first()[0]
        # A row without a time cannot be behind anything.
        late = F.coalesce(F.col(time) < F.lit(limit), F.lit(False))
        rows = f"{path}/rows/batch_id={batch_id}"
        if not files.is_complete(spark, rows):
            batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        seen = spark.read.schema(batch.schema).parquet(rows).agg(F.max(time).alias("seen"))
        if limit is not None:
            seen = seen.unionByName(spark.read.parquet(before)).agg(F.max("seen").alias("seen"))
        seen.write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")

    return (stream.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def _with_split(schema: StructType) -> StructType:
    return StructType([*schema, StructField("batch_id", LongType()),
                       StructField("late", BooleanType())])


def read_split(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stored rows with ``batch_id`` and ``late``."""
    return spark.read.schema(_with_split(schema)).parquet(f"{path}/rows")


def accepted_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The accepted rows as a stream."""
    rows = spark.readStream.schema(_with_split(schema)).parquet(f"{path}/rows")
    return rows.where(~F.col("late")).drop("late", "batch_id")


def reconciled(counted: DataFrame, late: DataFrame, stored: DataFrame) -> DataFrame:
    """For every match and player, what the stream counted, what came late, and all that is stored.

    ``counted`` has the streamed counters (several rows of a player add up), ``late`` and ``stored``
    are events. For each counter there is the difference, 0 where accepted and late rows make up all;
    ``agrees`` says whether all of them are 0.
    """
    counters = metrics.all_counters()

    def totals(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.groupBy(*metrics.KEYS).agg(
            *[F.sum(c).alias(f"{prefix}_{c}") for c in counters])

    parts = [totals(counted, "counted"), totals(metrics.count_events(late, counters), "late"),
             totals(metrics.count_events(stored, counters), "stored")]
    joined = parts[0].join(parts[1], metrics.KEYS, "full").join(parts[2], metrics.KEYS, "full")

    def number(prefix: str, counter: str) -> Column:
        return F.coalesce(F.col(f"{prefix}_{counter}"), F.lit(0).cast("bigint"))

    differences = {c: number("counted", c) + number("late", c) - number("stored", c)
                   for c in counters}
    kinds = ["actionsCounted", "actionsLate", "actionsStored"]
    found = joined.select(
        *metrics.KEYS, *[d.alias(c) for c, d in differences.items()],
        *[sum((number(p, c) for c in ONE_EACH), F.lit(0).cast("bigint")).alias(kind)
          for p, kind in zip(("counted", "late", "stored"), kinds)])
    wrong = sum((F.abs(F.col(c)) for c in counters), F.lit(0))
    return found.withColumn("agrees", wrong == 0)


#: Counters of which an event raises one at most; together they are the actions of a player.
ONE_EACH = ["normalPasses", "keyPasses", "totalDuels", "totalFreeKicks", "totalShots", "foulLoss"]
