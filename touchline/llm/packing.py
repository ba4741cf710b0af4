"""Packing of tokenised documents into as few sequences of a fixed length as possible.

Texts become tokens in the tasks that read them; only lengths go on. A document longer than a sequence is
cut into full pieces, the first of which may be shorter. A full piece is a sequence by itself. All
others are items of a grouping genetic algorithm:

* Items are dealt by a hash into *blocks* of about ``BLOCK`` items, and each block is solved on several
  *islands*, a task each. An island keeps a few packings, starting from best fit over
  shuffled orders and best-fit decreasing.
* *Crossover* injects the well-filled bins of one packing whole into another, removes the bins that
  hold any of their documents, and puts the displaced documents back by best fit, largest first.
* After an epoch each island's *elite* moves to the next island of its block and takes part in the
  next epoch. The best packing of a block wins.
* Bins that are still not well filled are dissolved, and their documents of all blocks are dealt into
  new blocks and packed once more, so blocks don't each leave an ill-filled rest.

A block has the same size whatever the corpus has; there are only more of them. Documents of one length,
source or text are spread by the hash. Nothing but the numbers of items goes to the driver.

Defined results: a null or empty text is the end token alone; a null ``doc_id`` is packed as any
other; repeated rows are packed each; an empty table gives no rows; other columns are passed over.
Texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.batches import small_batches
from touchline.llm.tokens import SLICE, slice_encoder
from touchline.sources.sinks import materialise

LENGTH = 1024
BLOCK = 16_384
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 4
#: Part of a sequence that counts as well filled.
WELL_FILLED = 0.98
_REST = 0.97

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ITEM = f"uid long, block long, {_PIECES}"
_ELITE = "block long, island int, bins long, groups binary"


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of parts of a batch that are encoded together."""
    doc_ids, texts, begin, held = batch.column(0), [], 0, 0
    for row, text in enumerate(batch.column(1), 1):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= SLICE or row == batch.num_rows:
            yield doc_ids.slice(begin, row - begin).to_pylist(), texts
            texts, begin, held = [], row, 0


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = slice_encoder(vocabulary)
        for doc_ids, texts in (x for batch in batches for x in _slices(batch)):
            out: list[list] = [[], [], [], [], []]
            for doc_id, raw in zip(doc_ids, encode(texts), strict=True):
                count = len(raw) // 4
                begin, end, number = 0, count % length or length, 0
                while begin < count:
                    end = min(end, count)
                    for column, value in zip(out, (
                            doc_id, number, begin, end - begin,
                            zlib.crc32(raw[4 * begin:4 * end])), strict=True):
                        column.append(value)
                    begin, end, number = end, end + length, number + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                    strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_partition, _PIECES)


class Bins:
    """Groups of items under construction; finds the fullest bin with enough room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.members: list[list[int]] = []
        self.room: list[int] = []
        self._with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._rooms = 0  # bit r is set if a bin has room r

    def add(self, members: list[int], room: int) -> None:
        self._note(len(self.members), room)
        self.members.append(members)
        self.room.append(room)

    def _note(self, number: int, room: int) -> None:
        self._with_room[room].append(number)
        self._rooms |= 1 << room

    def best_fit(self, item: int, size: int) -> None:
        enough = self._rooms >> size
        if not enough:
            self.add([item], self.capacity - size)
            return
        room = size + (enough & -enough).bit_length() - 1
        waiting = self._with_room[room]
        number = waiting.pop()
        if not waiting:
            self._rooms &= ~(1 << room)
        self.members[number].append(item)
        self.room[number] = room - size
        self._note(number, room - size)


class Packing:
    """Groups of items, how much each holds, and how good that is."""

    def __init__(self, groups: list[list[int]], held: list[int], capacity: int):
        self.groups, self.held = groups, held
        fill = np.array(held) / capacity
        #: Fewer bins first; among as many, the more unevenly filled, which leaves room together.
        self.quality = len(groups), -float((fill ** 2).sum())

    @classmethod
    def of(cls, groups: list[list[int]], sizes: list[int], capacity: int) -> Packing:
        return cls(groups, [sum([sizes[i] for i in g]) for g in groups], capacity)


def _best_fit(order: list[int], sizes: list[int], capacity: int, kept: list[list[int]] = (),
              held: list[int] = ()) -> Packing:
    """``kept`` bins that hold ``held``, and the items of ``order`` by best fit."""
    bins = Bins(capacity)
    for members, size in zip(kept, held, strict=True):
        bins.add(members, capacity - size)
    for item in order:
        bins.best_fit(item, sizes[item])
    return Packing(bins.members, [capacity - room for room in bins.room], capacity)


def _packed(order: np.ndarray, sizes: list[int], capacity: int) -> list[list[int]]:
    return _best_fit(order.tolist(), sizes, capacity).groups


def crossover(mother: Packing, father: Packing, sizes: list[int], capacity: int,
              random: np.random.Generator) -> Packing:
    """Well-filled bins of the father in the mother; what they displace is put back by best fit."""
    least = WELL_FILLED * capacity
    well = [(g, held) for g, held in zip(father.groups, father.held, strict=True) if held >= least]
    injected = [x for x, take in zip(well, random.random(len(well)) < 0.5, strict=True) if take]
    taken = {i for g, _ in injected for i in g}
    full, displaced, loose = [list(g) for g, _ in injected], [], []
    filled = [held for _, held in injected]
    for g, held in zip(mother.groups, mother.held, strict=True):
        if not taken.isdisjoint(g):
            displaced += [i for i in g if i not in taken]
        elif held >= least:
            full.append(list(g))
            filled.append(held)
        else:
            # Ill-filled bins give their documents back too, for another combination.
            loose += g
    order = sorted(sorted(displaced + loose), key=sizes.__getitem__, reverse=True)
    return _best_fit(order, sizes, capacity, full, filled)


def evolved(sizes: list[int], capacity: int, seed: int,
            migrants: list[list[list[int]]]) -> list[list[int]]:
    """The best packing after one epoch on an island."""
    random = np.random.default_rng(seed)
    fewest = -(-sum(sizes) // capacity)
    decreasing = np.argsort(-np.array(sizes), kind="stable")
    people = [Packing.of(groups, sizes, capacity) for groups in migrants]
    if not people:
        people.append(_best_fit(decreasing.tolist(), sizes, capacity))
    while len(people) < POPULATION and len(people[0].groups) > fewest:
        noise = np.array(sizes) * random.uniform(0.8, 1.25, len(sizes))
        people.append(_best_fit(np.argsort(-noise, kind="stable").tolist(), sizes, capacity))
    ranked = sorted(people, key=lambda p: p.quality)
    for _ in range(GENERATIONS):
        if len(ranked[0].groups) <= fewest or len(ranked) < 2:
            break
        father = ranked[0]
        children = [crossover(mother, father, sizes, capacity, random) for mother in ranked[1:]]
        children.append(crossover(father, ranked[1], sizes, capacity, random))
        ranked = sorted([*ranked, *children], key=lambda p: p.quality)[:POPULATION]
    return ranked[0].groups


def _as_bytes(groups: list[list[int]], count: int) -> bytes:
    number = np.zeros(count, np.int32)
    for k, g in enumerate(groups):
        number[g] = k
    return number.tobytes()


def _as_groups(raw: bytes) -> list[list[int]]:
    number = np.frombuffer(raw, np.int32)
    order = np.argsort(number, kind="stable")
    return [g.tolist() for g in np.split(order, np.cumsum(np.bincount(number))[:-1])]


def _epoch(length: int, epoch: int):
    """Function for ``cogroup``: items of a block and the packings that have come to this island."""

    def run(key: tuple, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        if items.empty:
            return pd.DataFrame({"block": [], "island": [], "bins": [], "groups": []})
        block, island = int(key[0]), int(key[1])
        sizes = items.sort_values("uid")["length"].tolist()
        arrived = [_as_groups(x) for x in elites["groups"]] if len(elites) else []
        best = evolved(sizes, length, 1000 * epoch + island, arrived)
        return pd.DataFrame({"block": [block], "island": [island], "bins": [len(best)],
                             "groups": [_as_bytes(best, len(sizes))]})

    return run


def _placed(length: int, level: int):
    """Function for ``cogroup``: items of a block with their sequence and place."""

    def run(key: tuple, items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("uid").reset_index(drop=True)
        if items.empty:
            return items.assign(sequence_id=[], offset=[], filled=[])
        number = np.frombuffer(best["groups"].iloc[0], np.int32).astype(np.int64)
        items["sequence_id"] = (number + (int(key[0]) << 20)) * 4 + 1 + level
        by = items.groupby("sequence_id")["length"]
        items["offset"] = by.cumsum() - items["length"]
        items["filled"] = by.transform("sum")
        return items

    return run


def _solve(items: DataFrame, length: int, level: int) -> DataFrame:
    """Items (uid, block, ...) with ``sequence_id``, ``offset`` and ``filled``."""
    spark = items.sparkSession
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")
    copies = items.select("uid", "block", "length", islands)
    elites = spark.createDataFrame([], _ELITE)
    for epoch in range(EPOCHS):
        # An elite stays where it is and also goes on to the next island.
        arrived = elites.unionByName(elites.withColumn(
            "island", ((F.col("island") + 1) % ISLANDS).cast("int")))
        elites = materialise(
            copies.groupBy("block", "island").cogroup(arrived.groupBy("block", "island"))
            .applyInPandas(_epoch(length, epoch), _ELITE), "elites")
    best = elites.groupBy("block").agg(
        F.min_by("groups", F.struct("bins", "island")).alias("groups"))
    return items.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
        _placed(length, level), f"{_ITEM}, sequence_id long, offset long, filled long")


def _dealt(items: DataFrame, seed: int) -> DataFrame:
    blocks = -(-items.count() // BLOCK)
    return items.withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(max(blocks, 1))))


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    small_batches(docs.sparkSession)
    cut = materialise(pieces(docs, vocabulary, length).withColumn(
        "uid", F.monotonically_increasing_id()), "pieces")
    columns = [*[c.split()[0] for c in _PIECES.split(", ")], "sequence_id", "offset"]
    full = (cut.where(F.col("length") == length)
            .withColumn("sequence_id", F.col("uid") * 4).withColumn("offset", F.lit(0).cast("long")))
    items = _dealt(cut.where(F.col("length") < length), 1)
    first = materialise(_solve(items, length, 0), "packed")
    good = first.where(F.col("filled") >= _REST * length)
    loose = first.where(F.col("filled") < _REST * length).drop("sequence_id", "offset", "filled")
    second = _solve(_dealt(loose, 2), length, 1)
    return (full.select(columns).unionByName(good.select(columns))
            .unionByName(second.select(columns)))
