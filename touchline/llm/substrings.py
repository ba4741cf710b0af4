"""Removal of long passages that already occur in an earlier document.

A window is ``size`` consecutive words of one document. Every word that lies in a window whose
word sequence also starts in a document with a smaller ``doc_id`` is removed.

1. Every window has an *anchor*: the smallest hash among its runs of ``ANCHOR`` words. Equal
   windows have equal anchors, and neighbouring windows mostly share one, so there are about
   fourteen times fewer anchors than windows. Count-min sketches of the anchors, one per partition,
   are merged; they never count too little.
2. A second pass keeps only windows whose anchor is estimated to be repeated. A window that
   really is repeated has a repeated anchor, so none is lost; a wrong estimate only costs a row.
   Consecutive kept windows with one anchor form a *segment*, and segments are grouped exactly.
   In a segment that an earlier document has too, all windows are repeated. Only first
   copies are opened, where different segments have an anchor in common, and their windows are
   grouped exactly: whatever window of a smaller document equals one of them is in the first
   copy of some segment.

Windows are compared by the hash of the window and the hash of its anchor together (128 bits), so
wrong matches are not to be expected at any corpus size. Hot passages are minima over a key, which
are combined before the shuffle.

Defined results: a null or empty text has no words; a row without ``doc_id`` keeps everything and
is nobody's earlier document; rows that share a ``doc_id`` don't remove each other's words; other
columns are passed over. Texts are handled whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import sketch
from touchline.llm.words import Words, mixed, range_hashes, signed, text_slices
from touchline.sources.sinks import materialise

SIZE = 50
ANCHOR = 24
#: Cells per row of the sketch, as a power of two. Wider sketches let fewer single windows through.
SKETCH_BITS = 25
#: The same for the segments to open; a wrong one opened adds rows, but changes no result.
OPEN_BITS = 23

_SEGMENTS = "doc_id long, start int, anchor long, digest long, windows binary"


def _sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of every ``span`` neighbours, by doubling."""
    done = 1
    while done * 2 <= span:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = span - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _anchored(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and anchor of every window."""
    hashes, starts = words.windows(size)
    if not len(starts):
        return hashes, starts, hashes
    short = min(ANCHOR, size)
    grams = len(words.hashes) - short + 1
    at = np.arange(grams)
    runs = mixed(range_hashes(words.hashes, at, at + short))
    return hashes, starts, _sliding_least(runs, size - short + 1)[starts]


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal neighbours begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _anchor_hashes(size: int):
    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in text_slices(batch):
            words = Words(data, offsets)
            _, starts, anchors = _anchored(words, size)
            if len(starts):
                document = words.document[starts]
                order = np.lexsort((anchors, document))
                anchors, document = anchors[order], document[order]
                yield anchors[_changes(anchors, document)]
    return hashes_of


def segments(docs: DataFrame, size: int = SIZE, bits: int = SKETCH_BITS) -> DataFrame:
    """Runs of windows that may be repeated: (doc_id, start, anchor, digest, windows)."""
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    counts = sketch.merged(docs.select("text"), _anchor_hashes(size), bits, "uint8")
    repeated = docs.sparkSession.sparkContext.broadcast(np.packbits(counts >= 2, axis=1))

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for row, _, data, offsets in text_slices(batch):
                words = Words(data, offsets)
                hashes, starts, anchors = _anchored(words, size)
                keep = np.ones(len(starts), bool)
                for line, cell in enumerate(sketch.cells(anchors, bits)):
                    keep &= (repeated.value[line, cell >> 3] >> (7 - (cell & 7)) & 1) > 0
                hashes, starts, anchors = hashes[keep], starts[keep], anchors[keep]
                if not len(starts):
                    continue
                document = words.document[starts]
                begins = _changes(document, anchors, starts - np.arange(len(starts)))
                ends = np.append(begins[1:], len(starts))
                digests = range_hashes(hashes, begins, ends)
                raw = hashes.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[row + document[begins]], pa.int64()),
                    pa.array(starts[begins] - words.first[document[begins]], pa.int32()),
                    pa.array(signed(anchors[begins])), pa.array(signed(digests)),
                    pa.array([raw[8 * a:8 * b] for a, b in zip(begins, ends, strict=True)],
                             pa.binary()),
                ], ["doc_id", "start", "anchor", "digest", "windows"])

    return docs.mapInArrow(per_partition, _SEGMENTS)


def _opened(wanted):
    """A row for every window of a wanted segment."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = sketch.may_have(wanted.value, batch.column("key").to_numpy(), OPEN_BITS)
            batch = batch.filter(pa.array(keep))
            blobs = batch.column("windows").to_pylist()
            counts = np.array([len(b) // 8 for b in blobs], np.int64)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            column = {name: np.repeat(batch.column(name).to_numpy(), counts)
                      for name in ("doc_id", "start", "anchor")}
            yield pa.RecordBatch.from_arrays(
                [pa.array(column["doc_id"]),
                 pa.array((column["start"] + inside).astype(np.int32)),
                 pa.array(column["anchor"]), pa.array(np.frombuffer(b"".join(blobs), np.int64))],
                ["doc_id", "start", "anchor", "window"])

    return per_partition


def repeated_ranges(docs: DataFrame, size: int = SIZE, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, start, windows): runs of window starts that an earlier document has as well."""
    found = materialise(segments(docs, size, bits), "segments")
    small = found.drop("windows")
    firsts = materialise(
        small.groupBy("anchor", "digest").agg(F.min("doc_id").alias("first_doc")), "firsts")
    # One row per key on the right, so that a hot passage can be split.
    later = (found.select("anchor", "digest", "doc_id", "start",
                          (F.length("windows") / 8).cast("int").alias("windows"))
             .join(firsts, ["anchor", "digest"]).where("doc_id > first_doc")
             .select("doc_id", "start", "windows"))
    # Segments that differ and have an anchor in common; all others are done with, and so is what
    # the sketch took for repeated and is not.
    mixed_anchors = (firsts.groupBy("anchor").agg(F.count("*").alias("digests"))
                     .where("digests > 1").select("anchor"))
    asked = firsts.join(mixed_anchors, "anchor", "left_semi").select(
        F.xxhash64("anchor", "digest", "first_doc").alias("key"))
    opened = materialise(
        found.withColumn("key", F.xxhash64("anchor", "digest", "doc_id")).mapInArrow(
            _opened(sketch.filter_of(asked, "key", OPEN_BITS)),
            "doc_id long, start int, anchor long, window long"), "windows")
    least = (opened.groupBy("anchor", "window")
             .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
             .where("first_doc < last_doc").drop("last_doc"))
    single = (opened.join(least, ["anchor", "window"]).where("doc_id > first_doc")
              .select("doc_id", "start", F.lit(1).alias("windows")))
    return later.unionByName(single)


def _covered(count: int, starts: np.ndarray, windows: np.ndarray, size: int) -> np.ndarray:
    """Which of ``count`` words lie in one of the windows."""
    change = np.zeros(count + 1, np.int32)
    np.add.at(change, np.minimum(starts, count), 1)
    np.add.at(change, np.minimum(starts + windows + size - 1, count), -1)
    return np.cumsum(change[:-1]) > 0


def _cut(size: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id"), "n_words": [],
                                    "n_removed": [], "kept_text": []}
            texts, ranges = batch.column("text"), batch.column("ranges")
            for row in range(batch.num_rows):
                words = (texts[row].as_py() or "").encode().split()
                found = ranges[row].as_py()
                count = len(words)
                if found:
                    at = np.array([(r["start"], r["windows"]) for r in found], np.int64)
                    gone = _covered(count, at[:, 0], at[:, 1], size)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out["n_words"].append(count)
                out["n_removed"].append(count - len(words))
                out["kept_text"].append(b" ".join(words).decode())
            yield pa.RecordBatch.from_pydict(out)
    return per_partition


def remove_repeats(docs: DataFrame, size: int = SIZE, bits: int = SKETCH_BITS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A document's ranges are bounded by its own length.
    ranges = (repeated_ranges(docs, size, bits).groupBy("doc_id")
              .agg(F.collect_list(F.struct("start", "windows")).alias("ranges")))
    return docs.join(ranges, "doc_id", "left").mapInArrow(
        _cut(size), "doc_id long, n_words long, n_removed long, kept_text string")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
