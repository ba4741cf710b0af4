"""Lists that belong to documents, or documents to leave out, without moving the texts if they are few."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

#: Bytes of lists up to which they are sent to all tasks; more meet the documents in a shuffle.
BROADCAST_BYTES = 32 << 20


def attached(docs: DataFrame, places: DataFrame, item: Column, item_bytes: int,
             name: str) -> DataFrame:
    """``docs`` with an array ``name`` of the items that ``places`` has for their ``doc_id``.

    A document without items gets null. The lists of a document are bounded by its own length.
    """
    lists = materialise(places.groupBy("doc_id").agg(F.collect_set(item).alias(name)), name)
    lists = lists.withColumnRenamed("doc_id", "_list_doc")
    size = lists.agg(F.sum(F.size(name) * item_bytes + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    return docs.join(lists, F.col("doc_id") == F.col("_list_doc"), "left").drop("_list_doc")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose ``doc_id`` is not in ``ids``."""
    ids = materialise(ids.select("doc_id").distinct(), "left-out")
    if ids.count() * 64 <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns)
