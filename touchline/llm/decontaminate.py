"""Documents that contain a benchmark item, up to a few edits.

Text is compared in lower case, as letters and digits with single spaces between words. An item
of n characters may differ from some part of a document by ``n * percent // 100`` edits. Cut into one
piece more than that, at least one of its pieces is in the document unchanged; an automaton finds
all pieces of all items in one pass over the text. Around each hit, Myers' bit-parallel
algorithm gives the least distance of the item to any part of the text there.

The benchmark is the query set: it is read in blocks of a fixed number of characters, and each block
is compared with all documents. Hits near each other are verified as one stretch of text, so a
document is read at most once per item, however often a piece occurs in it.

Defined results: a null or empty text contains nothing; an item without a letter or digit is in no
document; a null id is passed on; equal rows give equal rows; an empty table on either side gives
none; other columns are passed over. Texts are searched whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

PERCENT = 8
#: Characters of items that are compared in one pass (what is sent to all tasks).
BLOCK_CHARS = 4_000_000

_WORD = re.compile(r"[^\W_]+")
_HITS = "doc_id long, item_id long, distance long, found_end long"


def plain(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` parts of nearly equal length with their places."""
    bounds = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def least_distance(item: str, text: str) -> tuple[int, int]:
    """Least edits between ``item`` and any part of ``text``, and where that part ends."""
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        places[c] |= 1 << i
    more, less = full, 0  # vertical steps up and down
    distance = best = size
    best_end = 0
    for end, c in enumerate(text, 1):
        equal = places.get(c, 0)
        vertical = equal | less
        across = (((equal & more) + more) ^ more) | equal
        up = less | (full & ~(across | more))
        down = more & across
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        if distance < best:
            best, best_end = distance, end
        up, down = (up << 1) & full, (down << 1) & full
        more = down | (full & ~(vertical | up))
        less = up & vertical
    return best, best_end


class Matcher:
    """All items of a block."""

    def __init__(self, items: Iterable[tuple[int, str]], percent: int):
        self.items = [(item_id, text, len(text) * percent // 100) for item_id, text in items]
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, text, budget) in enumerate(self.items):
            for at, piece in pieces(text, budget):
                owners[piece].append((number, at))
        for piece, of in owners.items():
            self.automaton.add_word(piece, (len(piece), of))
        if owners:
            self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item id, distance, end) for each item in the text."""
        if not self.items or not text:
            return
        begins: dict[int, set[int]] = defaultdict(set)
        for last, (length, owners) in self.automaton.iter(text):
            for number, at in owners:
                begins[number].add(last - length + 1 - at)
        for number, found in begins.items():
            item_id, item, budget = self.items[number]
            best: tuple[int, int] | None = None
            for begin, end in _stretches(sorted(found), len(item), budget, len(text)):
                distance, at = least_distance(item, text[begin:end])
                if distance <= budget and (best is None or distance < best[0]):
                    best = distance, begin + at
            if best:
                yield item_id, *best


def _stretches(starts: list[int], size: int, budget: int, most: int) -> list[tuple[int, int]]:
    """Parts of the text around the places where an item may start, joined where they meet."""
    out: list[tuple[int, int]] = []
    for start in starts:
        begin, end = max(0, start - budget), min(most, start + size + budget)
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    for row in rows.toLocalIterator():
        text = plain(row["text"])
        if text:
            block.append((row["item_id"], text))
            size += len(text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, distance, found_end) for every item that a document contains."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    context = docs.sparkSession.sparkContext

    def scan(block: list[tuple[int, str]]) -> DataFrame:
        shared = context.broadcast(block)
        made: list[Matcher] = []

        def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not made:
                made.append(Matcher(shared.value, percent))
            for batch in batches:
                found = [(doc_id.as_py(), *hit)
                         for doc_id, text in zip(batch.column(0), batch.column(1), strict=True)
                         for hit in made[0].search(plain(text.as_py()))]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["doc_id", "item_id", "distance", "found_end"])

        return docs.mapInArrow(per_partition, _HITS)

    hits = None
    for block in _blocks(benchmark):
        found = materialise(scan(block), "hits")
        hits = found if hits is None else hits.unionByName(found)
    return docs.sparkSession.createDataFrame([], _HITS) if hits is None else hits


def remove_contaminated(docs: DataFrame, benchmark: DataFrame,
                        percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that contain no item; rows without ``doc_id`` are judged by text."""
    # Rows are carried whole, so that no column of theirs can clash with one in here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       "text")
    with_id = rows.where("id is not null")
    hits = benchmark_hits(with_id.withColumnRenamed("id", "doc_id"), benchmark, percent).select(
        F.col("doc_id").alias("id")).distinct()
    clean = with_id.join(hits, "id", "left_anti")
    nameless = rows.where("id is null").withColumn("id", F.xxhash64("text"))
    bad = benchmark_hits(nameless.select(F.col("id").alias("doc_id"), "text"), benchmark,
                         percent).select(F.col("doc_id").alias("id")).distinct()
    return clean.select("row.*").unionByName(nameless.join(bad, "id", "left_anti").select("row.*"))
