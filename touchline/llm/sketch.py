"""A count-min sketch over 64-bit hashes: built per partition, added up piece by piece."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import mixed

DEPTH = 2
#: Pieces that a sketch is sent in, and sketches of which a task adds up a piece.
PIECES, FAN_IN = 64, 64


def cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of every hash in each row of the sketch (independent bits of the hash)."""
    mask = np.uint64((1 << bits) - 1)
    return [((hashes >> np.uint64(32 * row)) & mask).astype(np.int64) for row in range(DEPTH)]


def added(counts: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    """Count ``hashes`` in place; cells stop at the largest value they hold."""
    most = np.iinfo(counts.dtype).max
    for row, cell in enumerate(cells(hashes, bits)):
        if 4 * len(cell) > counts.shape[1]:
            at, times = slice(None), np.bincount(cell, minlength=counts.shape[1])
        else:
            at, times = np.unique(cell, return_counts=True)
        counts[row, at] = np.minimum(counts[row, at].astype(np.int64) + times, most)


def estimates(counts: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """At least the true count of every hash (or the largest value a cell holds)."""
    first, second = (counts[row, cell] for row, cell in enumerate(cells(hashes, bits)))
    return np.minimum(first, second)


def merged(frame: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
           bits: int, dtype: str) -> np.ndarray:
    """Sketch of the whole frame: one per partition, added up on the executors.

    A sketch travels in ``PIECES`` pieces, and a task adds up the same piece of ``FAN_IN`` sketches, level
    by level, so it never holds more than that. The size is fixed by ``bits`` and ``dtype``: the
    driver gets the same few megabytes whatever the number of rows.
    """
    most = int(np.iinfo(dtype).max)
    schema = "place int, piece int, cells binary"

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((DEPTH, 1 << bits), dtype)
        for batch in batches:
            for hashes in hashes_of(batch):
                added(counts, hashes, bits)
        place = TaskContext.get().partitionId()
        for piece, cells in enumerate(counts.reshape(PIECES, -1)):
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([place], pa.int32()), "piece": pa.array([piece], pa.int32()),
                "cells": [zlib.compress(cells.tobytes(), 1)]})

    def add_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for cells in rows["cells"]:
            part = np.frombuffer(zlib.decompress(cells), dtype)
            total = part if total is None else (
                total + np.minimum(part, np.array(most, dtype) - total))
        return pd.DataFrame({"place": [key[1]], "piece": [key[0]],
                             "cells": [zlib.compress(total.tobytes(), 1)]})

    partitions = frame.rdd.getNumPartitions()
    parts = frame.mapInArrow(per_partition, schema)
    while True:
        partitions = -(-partitions // FAN_IN)
        parts = parts.withColumn("place", F.floor(F.col("place") / FAN_IN).cast("int")).groupBy(
            "piece", "place").applyInPandas(add_up, schema)
        if partitions <= 1:
            break
    total = np.zeros((PIECES, (DEPTH << bits) // PIECES), dtype)
    for row in parts.collect():  # one row for each piece
        total[row["piece"]] = np.frombuffer(zlib.decompress(row["cells"]), dtype)
    return total.reshape(DEPTH, 1 << bits)


def filter_of(keys: DataFrame, name: str, bits: int):
    """Packed sketch that tells which values cannot be among ``keys``, sent to all tasks."""

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield mixed(batch.column(name).to_numpy().astype(np.int64).view(np.uint64))

    counts = merged(keys.select(name), hashes_of, bits, "uint8")
    return keys.sparkSession.sparkContext.broadcast(np.packbits(counts > 0, axis=1))


def may_have(packed: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """False where a value is certainly not among the keys of the filter."""
    keep = np.ones(len(values), bool)
    for row, cell in enumerate(cells(mixed(values.view(np.uint64)), bits)):
        keep &= (packed[row, cell >> 3] >> (7 - (cell & 7)) & 1) > 0
    return keep
