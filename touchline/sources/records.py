"""Decoding of the line feed: JSON text to typed events and matches.

All functions take and return DataFrames, batch or streaming alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import text
from touchline.sources import numbering


def line_stream(spark: SparkSession, source: str = "text", **options: str) -> DataFrame:
    """A streaming ``value string`` from any Spark source (text files, Kafka, socket)."""
    return (
        spark.readStream.format(source).options(**options).load()
        .select(F.col("value").cast("string").alias("value"))
    )


def placed_stream(spark: SparkSession, source: str = "text", **options: str) -> DataFrame:
    """The same with the file and split a line is from, where the source is text files."""
    if source != "text":
        return line_stream(spark, source, **options)
    return numbering.with_places(spark.readStream.format(source).options(**options).load())


def parse_lines(lines: DataFrame, fields: dict[str, str] = schemas.RECORD) -> DataFrame:
    """One row per line; a field of the wrong type becomes NULL, and a line with such a field or
    that is no JSON at all keeps its text in ``_corrupt_record``.

    The record is unpacked by a generator: later filters then stay above it, where a projection
    would let every one of them parse the line again.
    """
    # Keys in double quotes only, so that no record is parsed that ``read_matches`` passes over.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
               "allowSingleQuotes": "false"}
    passthrough = [c for c in lines.columns if c != "value"]
    record = F.from_json("value", schemas.ddl(fields), options)
    return lines.select(*passthrough, F.inline(F.array(record)))


def read_events(lines: DataFrame) -> DataFrame:
    """Typed events of the feed."""
    return route_events(parse_lines(lines, schemas.EVENT))


def read_matches(lines: DataFrame) -> DataFrame:
    """Match records of the feed.

    Matches are a tiny part of the lines, so lines that cannot be one are passed over without
    parsing. A key may be spelled with an escape, so lines with one are always parsed.
    """
    value = F.col("value")
    likely = value.contains('"wyId"') | value.contains("\\u")
    return route_matches(parse_lines(lines.where(likely), {**schemas.MATCH, "eventId": "INT"}))


def newest_matches(matches: DataFrame) -> DataFrame:
    """One record of each match: the last by ``arrival``, and where the feed has no such column, or
    several arrived at once, a played one before any other."""
    order = [F.col(c) for c in ("arrival",) if c in matches.columns]
    order.append(F.coalesce(F.col("status") == "Played", F.lit(False)))
    newest = matches.groupBy("wyId").agg(
        F.max_by(F.struct(*matches.columns), F.struct(*order)).alias("m"))
    return newest.select("m.*")


def corrupt_lines(records: DataFrame) -> DataFrame:
    """Lines from which neither an event nor a match could be read."""
    lost = F.col("eventId").isNull() & F.col("wyId").isNull()
    return records.where(lost & F.col("_corrupt_record").isNotNull()).select("_corrupt_record")


def route_events(records: DataFrame) -> DataFrame:
    """Records carrying an ``eventId``, with the tag ids as a plain array."""
    keep = [c for c in records.columns if c not in schemas.RECORD]
    return records.where(F.col("eventId").isNotNull()).select(
        *keep,
        "matchId",
        "playerId",
        "eventId",
        F.col("subEventId").try_cast("int").alias("subEventId"),
        F.transform("tags", lambda t: t["id"]).alias("tag_ids"),
    )


def route_matches(records: DataFrame) -> DataFrame:
    """Records without an ``eventId`` that decode to a match, with the date parsed."""
    keep = [c for c in records.columns if c not in schemas.RECORD]
    is_match = F.col("eventId").isNull() & F.col("wyId").isNotNull()
    return records.where(is_match).select(
        *keep, *schemas.MATCH, text.match_date(F.col("date")).alias("match_date")
    )


def event_line(events: DataFrame, *carry: str) -> DataFrame:
    """The inverse of :func:`route_events`: typed events as feed lines."""
    tags = F.transform("tag_ids", lambda t: F.struct(t.alias("id"))).alias("tags")
    sub = F.col("subEventId").cast("string").alias("subEventId")
    line = F.to_json(F.struct("eventId", sub, "playerId", "matchId", tags))
    return events.select(*carry, line.alias("value"))


def match_line(matches: DataFrame, *carry: str) -> DataFrame:
    """Match records as feed lines."""
    return matches.select(*carry, F.to_json(F.struct(*schemas.MATCH)).alias("value"))


def feed_lines(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events and match records as one feed: match by match, the record before its events.

    Only events whose match is known are sent. The order is a distributed range sort.
    """
    headers = match_line(matches, "wyId", "match_date").select(
        "match_date", F.col("wyId").alias("matchId"), F.lit(False).alias("is_event"),
        F.lit(None).cast("bigint").alias("event_id"), "value")
    dates = matches.select(F.col("wyId").alias("matchId"), "match_date")
    lines = event_line(events.join(dates, "matchId"), "match_date", "matchId", "event_id").select(
        "match_date", "matchId", F.lit(True).alias("is_event"), "event_id", "value")
    return headers.unionByName(lines).orderBy("match_date", "matchId", "is_event", "event_id")
