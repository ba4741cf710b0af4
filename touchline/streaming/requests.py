"""Requests answered as they arrive.

Every micro-batch of request lines is answered from one consistent view of the tables. Which view that
is gets written down before the batch is answered, and the answers of a batch are a folder that
is written once: a batch that is tried again gives the same answers, in the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.plans.requests import answer_requests
from touchline.plans.season import Season
from touchline.sources import files, numbering, sinks, tables
from touchline.streaming.counters import trigger


def write_answers(lines: DataFrame, current: Callable[[], int], season: Callable[[int], Season],
                  out: str, checkpoint: str, once: bool = True, **options) -> StreamingQuery:
    """Start a query that answers every batch of a text stream of request lines.

    ``current`` gives the number of the latest view, ``season`` the tables of a view. Answers lie in
    ``out/responses/batch_id=N`` as JSON lines in the order of the requests (files by path, then line),
    the number of the view in ``out/views/N``. ``options`` go to the answers.
    """
    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        responses, view = f"{out}/responses/batch_id={batch_id}", f"{out}/views/{batch_id}"
        if files.is_complete(spark, responses):
            return
        if not files.exists(spark, view):
            files.write_new(spark, view, str(current()))
        requests = tables.parse_requests(numbering.numbered(batch, "request_seq"))
        found = answer_requests(requests, season(int(files.read_text(spark, view))), **options)
        sinks.write_responses(found, responses)

    return (numbering.with_places(lines).writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def read_answers(spark, out: str) -> DataFrame:
    """Answers of all batches with their ``batch_id``."""
    return spark.read.schema("response STRING, batch_id BIGINT").text(
        f"{out}/responses").select("batch_id", F.col("response"))
