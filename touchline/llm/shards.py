"""Shards of nearly equal size by longest-processing-time scheduling.

Rows with the same text form a group that stays together. The largest unit goes first, always to
the shard with the least load, through a heap. A unit is a group that is large against a
shard, or a *bin* of small groups (a size class and a hash), so that the number of units depends on the
number of shards only and the schedule takes a moment on the driver at any corpus size. Bins of
the smaller size classes are small too and even out the loads at the end.

Nothing but sizes of units is collected. Positions inside a shard come from counts of small cells
(a hash of the id), so no shard, however large, is numbered by one task.

Defined results: a null text has no bytes and is grouped with the empty one; a null ``doc_id`` gets
a place as any row does; repeated rows are one group; an empty table gives no rows; other columns
are passed over.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.sources.sinks import materialise

#: What a row takes beside its text.
ROW_BYTES = 16
#: A group with more than this part of a shard is a unit of its own.
LARGE_PART = 1 / 64
BINS_PER_SHARD = 8
SIZE_CLASSES = 24
CELLS = 256


def least_loaded(units: list[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(unit, shard) for units of the given sizes, the largest first."""
    heap = [(0, shard) for shard in range(shards)]
    placed = []
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = heapq.heappop(heap)
        placed.append((unit, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row."""
    text = F.coalesce("text", F.lit(""))
    sized = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"),
    ), "sizes")
    group = ["h1", "h2", "text_crc32"]
    groups = sized.groupBy(*group).agg(F.sum("size").alias("bytes"))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = total * LARGE_PART / shards
    size_class = F.least(F.lit(SIZE_CLASSES - 1), F.floor(F.log2("bytes"))).cast("int")
    bins = F.pmod(F.xxhash64("h1", "h2"), F.lit(BINS_PER_SHARD * shards))
    units = materialise(groups.select(*group, "bytes", F.when(
        F.col("bytes") > large, F.concat_ws(":", F.lit("group"), *group)
    ).otherwise(F.concat_ws(":", F.lit("bin"), size_class, bins)).alias("unit")), "units")
    # At most shards / LARGE_PART large groups and SIZE_CLASSES * BINS_PER_SHARD * shards bins.
    loads = [(r["unit"], r["load"])
             for r in units.groupBy("unit").agg(F.sum("bytes").alias("load")).collect()]
    plan = docs.sparkSession.createDataFrame(
        least_loaded(loads, shards), "unit string, shard int")
    shard_of = units.join(F.broadcast(plan), "unit").select(*group, "shard")
    placed = materialise(
        sized.join(shard_of, group)
        .withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).cast("int")), "placed")
    cells = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = cells.select("shard", "cell", (
        F.sum("rows").over(Window.partitionBy("shard").orderBy("cell")) - F.col("rows")
    ).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id"))
    # shards * CELLS rows.
    return (placed.withColumn("inside", inside)
            .join(F.broadcast(before), ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("before") + F.col("inside") - 1).alias("slot")))
