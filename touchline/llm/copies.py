"""Exact duplicates by progressive refinement.

Texts are equal when they are identical without white space. One scan writes two numbers for each row:
the size of the normalised text and a hash of its start. Rows are grouped by size; only in sizes that
occur twice they are grouped by start as well; and only texts whose size and start occur twice are
read whole, hashed (SHA-256) and grouped. What survives a step is marked in a bit map that all tasks
get, sized from the number of marks up to a bound: a text without partners never enters a shuffle, and
no text is ever moved. A fuller map lets more texts through to the last step and changes no result.

A group is summed up before it is shuffled, and the rows meet the groups in a join with one row per
group on one side, so that a group with a third of all rows can be split.

Defined results: of equal texts the one with the most characters before normalising stays, then the
smallest ``doc_id`` (one that is null comes last); null counts as an empty text, and empty texts are
equal to one another; rows with the same ``doc_id`` and the same text stay or go together, except in
:func:`without_copies`, which returns one row of every group; an empty table gives no rows; columns
other than those named are passed over. Texts are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

#: Characters of the normalised text that the second step looks at.
START = 64
#: Bits of the map for each mark, and the least and most bits of a map (a power of two each).
BITS_PER_MARK = 16
LEAST_BITS, MOST_BITS = 16, 28
#: Bits in one row of the map.
ROW_BITS = 15


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _sized(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns beside the normalised text, its size in bytes and the hash of its start."""
    found = docs.select(*columns, normalised(F.col("text")).alias("norm"))
    return found.withColumns({
        "size": F.octet_length("norm").cast("long"),
        "start": F.xxhash64(F.substring("norm", 1, START))})


def _place(bits: int) -> Column:
    return F.xxhash64("size", "start").bitwiseAND((1 << bits) - 1)


def _map_of(marks: DataFrame) -> tuple[DataFrame, int]:
    """A map with a bit for each (size, start), as rows of 4 KB, and its number of bits."""
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_PER_MARK * marks.count()).bit_length()))
    place = _place(bits)
    rows = marks.groupBy(F.shiftright(place, ROW_BITS).alias("map_row")).agg(
        F.bitmap_construct_agg(place.bitwiseAND((1 << ROW_BITS) - 1)).alias("marks"))
    return materialise(rows, "text-marks"), bits


def _is_marked() -> Column:
    bit = F.col("place").bitwiseAND((1 << ROW_BITS) - 1)
    byte = F.substring(F.col("marks"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]),
                        bit.bitwiseAND(7).cast("int") + 1)
    return F.coalesce(number.bitwiseAND(mask) > 0, F.lit(False))


def copies(docs: DataFrame, carried: list[str], hash_all: bool = False) -> DataFrame:
    """For every row: the carried columns in ``row``, ``keep_id``, ``group_size``, ``kept``, ``hash``.

    ``hash`` is the SHA-256 of the normalised text. It is only needed, and only there, for texts that
    survive the first two steps, unless ``hash_all`` asks for it everywhere.
    """
    keys = materialise(_sized(docs).select("size", "start"), "text-keys")
    sizes = keys.groupBy("size").count().where("count > 1").select("size")
    marks = (keys.join(sizes, "size", "left_semi").groupBy("size", "start").count()
             .where("count > 1").select("size", "start"))
    marked, bits = _map_of(materialise(marks, "repeated-starts"))

    known = _sized(docs, F.struct(*carried).alias("row"), F.col("doc_id"),
                   F.length(F.coalesce("text", F.lit(""))).alias("n_chars"))
    known = known.withColumn("place", _place(bits))
    # At most 2 ** MOST_BITS bits (32 MB), whatever the number of rows.
    looked = known.join(F.broadcast(marked),
                        F.shiftright("place", ROW_BITS) == F.col("map_row"), "left")
    looked = looked.withColumn("again", _is_marked())
    whole = F.when(F.lit(hash_all) | F.col("again"), F.sha2("norm", 256))
    rows = materialise(looked.select("row", "doc_id", "n_chars", "again", whole.alias("hash")),
                       "text-hashes")

    first = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"),
                           F.col("doc_id").alias("keep_id")))
    groups = (rows.where("again").groupBy("hash").agg(F.count("*").alias("group_size"),
                                                      first.alias("first"))
              .where("group_size > 1"))
    met = rows.where("again").join(groups, "hash", "left")
    alone = F.col("group_size").isNull()
    stays = ((F.col("n_chars") == -F.col("first.less"))
             & F.col("doc_id").eqNullSafe(F.col("first.keep_id")))
    met = met.select("row", F.when(alone, F.col("doc_id")).otherwise(F.col("first.keep_id"))
                     .alias("keep_id"),
                     F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                     (alone | stays).alias("kept"), "hash")
    single = rows.where("not again").select(
        "row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "hash")
    return met.unionByName(single)


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of every group of equal texts, with all columns of ``docs``."""
    kept = copies(docs, docs.columns).where("kept")
    # Rows that share doc_id and text; of such a group one row is taken before the shuffle.
    several = kept.where("group_size > 1").groupBy("hash").agg(F.min_by("row", F.to_json("row")))
    return (kept.where("group_size = 1").select("row.*")
            .unionByName(several.toDF("hash", "row").select("row.*")))


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", "keep_id", "group_size", "kept",
                        F.col("hash").alias("text_sha256"))
