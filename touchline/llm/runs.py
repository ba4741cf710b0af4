"""Periodic runs of words, and texts without the repetitions.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 * q)`` words
long, that cannot be extended with that period. Documents are independent, so there is no
shuffle: every task takes a slice of documents, numbers their words and puts those that may hold a
run behind each other, each closed by a symbol of its own.

* A run holds a stretch of ``max(least - q, q)`` words that are equal to the word q places on, hence
  some six words in a row that come again q places on. Documents in which no six words come twice
  have no run.
* For every period q, a grid of places is laid so that each such stretch holds the six words that
  start at one of them; the places of all periods together are a harmonic sum, n log n. Places whose
  six words come again q places on are candidates.
* The extensions of a candidate to both sides come from run-length grammars of the sequence and of its
  reverse (:mod:`grammar`). They are exact, so candidates only have to be complete.
* Periods are taken in octaves, 1, 2-3, 4-7 and so on: a multiple of a period is in a later octave, so
  a candidate inside a run found before, whose period divides its own, is passed over, and a stretch
  found a second time with a multiple of its period is not a run.

Defined results: a null or empty text has no words, hence no runs; words are runs of characters other
than space and ``\\t \\n \\v \\f \\r``; repeated rows are treated each for itself; an empty table gives
no rows; all columns of the input are kept, and the new ones replace any of the same name. Texts are
handled whole. A document is handled in one task, in memory of some hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.llm.grammar import Grammar
from touchline.llm.words import BASE_INVERSE, mixed, powers

#: Least words of a run.
LEAST_WORDS = 12
#: Words handled at a time (a longer document is handled alone).
SLICE_WORDS = 150_000
#: Candidates whose extensions are asked for at once.
QUERIES = 1 << 18
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` values from every place on (as many as there are places for)."""
    values = mixed(ids.astype(np.uint64))
    total = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(values * powers(0x9E3779B97F4A7C13, len(ids)), out=total[1:])
    count = max(len(ids) - size + 1, 0)
    return (total[size:size + count] - total[:count]) * powers(BASE_INVERSE, count + 1)[:count]


def _with_repeats(ids: np.ndarray, document: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the documents in which some ``size`` words in a row come twice."""
    hashes = _window_hashes(ids, size)
    inside = document[:len(hashes)] == document[size - 1:]
    key = mixed(hashes[inside]) ^ mixed(document[:len(hashes)][inside].astype(np.uint64))
    owner = document[:len(hashes)][inside]
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    return np.unique(owner[1:][key[1:] == key[:-1]])


class _Found:
    """Runs of the octaves done so far, and for every place the run that covered it last."""

    def __init__(self, size: int):
        self.end, self.period = np.zeros(size, np.int64), np.ones(size, np.int64)
        self.runs: dict[tuple[int, int], int] = {}

    def covered(self, place: np.ndarray, period: np.ndarray) -> np.ndarray:
        return (place + period < self.end[place]) & (period % self.period[place] == 0)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        for s, e, q in sorted(zip(start.tolist(), end.tolist(), period.tolist()),
                              key=lambda r: r[1] - r[0]):
            if (s, e) not in self.runs:  # else a multiple of the period it has
                self.runs[s, e] = q
                self.end[s:e], self.period[s:e] = e, q


def _candidates(hashes: np.ndarray, document: np.ndarray, lengths: np.ndarray, first: int,
                least: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grid for the periods ``first`` to ``2 * first - 1``.

    Documents come longest first, so those that have room for two periods are the first ones.
    """
    places, periods = [], []
    ends = np.cumsum(lengths + 1)
    for q in range(first, 2 * first):
        fits = np.searchsorted(-lengths, -max(least, 2 * q), "right")
        if fits == 0:
            break
        # Windows that start in those documents; those that reach beyond one are never equal.
        last = min(int(ends[fits - 1]), len(hashes)) - q
        step = max(least - q, q) - window + 1
        if last <= 0:
            continue
        at = step * np.flatnonzero(hashes[:last:step] == hashes[q:last + q:step])
        at = at[document[at] == document[at + q]]
        places.append(at)
        periods.append(np.full(len(at), q, np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(sequences: list[np.ndarray], least: int = LEAST_WORDS) -> list[list[tuple]]:
    """(start, length, period) of every run of every sequence, by start, then period."""
    window = least // 2
    lengths = np.array([len(s) for s in sequences], np.int64)
    found: list[list[tuple]] = [[] for _ in sequences]
    if not len(lengths) or lengths.max() < least:
        return found
    document = np.repeat(np.arange(len(sequences)), lengths)
    chosen = _with_repeats(np.concatenate(sequences), document, window)
    if not len(chosen):
        return found
    chosen = chosen[np.argsort(-lengths[chosen], kind="stable")]
    lengths = lengths[chosen]
    unused = max(int(sequences[k].max()) for k in chosen) + 1
    joined = np.concatenate([np.append(sequences[k], unused + n) for n, k in enumerate(chosen)])
    owner = np.repeat(np.arange(len(chosen)), lengths + 1)
    begins = np.cumsum(lengths + 1) - lengths - 1
    size = len(joined)
    forward, backward = Grammar(joined), Grammar(joined[::-1])
    hashes = _window_hashes(joined, window)
    done = _Found(size)
    first = 1
    while max(least, 2 * first) <= lengths[0]:
        place, period = _candidates(hashes, owner, lengths, first, least, window)
        open_ = ~done.covered(place, period)
        place, period = place[open_], period[open_]
        parts = []
        for k in range(0, len(place), QUERIES):
            at, q = place[k:k + QUERIES], period[k:k + QUERIES]
            ahead = forward.extensions(at, at + q)
            behind = backward.extensions(size - at - q, size - at)
            start, end = at - behind, at + q + ahead
            whole = end - start >= np.maximum(least, 2 * q)
            parts.append(np.unique(np.stack([start, end, q], 1)[whole], axis=0))
        if parts:
            done.add(*np.unique(np.concatenate(parts), axis=0).T)
        first *= 2
    for (start, end), q in done.runs.items():
        n = owner[start]
        found[chosen[n]].append((int(start - begins[n]), end - start, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def _collapsed(words: list[bytes], runs: list[tuple]) -> bytes:
    """The words that no run holds beyond its first period, joined by a space."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


def _of_slice(texts: list[bytes], least: int) -> Iterator[tuple[list[tuple], bytes, int]]:
    words = [text.split() for text in texts]
    number: dict[bytes, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in each), np.int64, len(each))
           for each in words]
    for each, runs in zip(words, runs_of(ids, least)):
        yield runs, _collapsed(each, runs) if runs else b" ".join(each), len(each)


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts:
        count = len(text) // 4  # an estimate
        if part and size + count > SLICE_WORDS:
            yield part
            part, size = [], 0
        part.append(text)
        size += count
    if part:
        yield part


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period), ``collapsed`` (the text without the
    repetitions) and ``n_words``."""
    new = StructType.fromDDL(f"runs {RUN}, collapsed string, n_words bigint")
    kept = [c for c in docs.columns if c not in new.names]
    schema = StructType([*docs.select(kept).schema, *new])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                   ("period", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
            row = 0
            for part in _slices(texts):
                results = list(_of_slice(part, least))
                runs = [[dict(zip(("start", "length", "period"), r)) for r in found]
                        for found, _, _ in results]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(row, len(part)).columns, pa.array(runs, run_type),
                     pa.array([t for _, t, _ in results], pa.binary()).cast(pa.string()),
                     pa.array([n for _, _, n in results], pa.int64())],
                    names=schema.names)
                row += len(part)

    return docs.select(kept).mapInArrow(search, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with runs put into a tenth of the texts, chosen by a checksum of ``doc_id``.

    With h the checksum, g = h div 10 and n words, every word i from a = g % n on becomes
    word a + (i - a) % p, where p = 1 + (n - a) div (3 + g % 8). A null ``doc_id`` changes nothing.
    """
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")

    def repeated(s: Column) -> Column:
        n, g = F.size(s["words"]).cast("long"), s["g"]
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        # Bound to a name once, so that they are not computed for every word.
        return F.transform(F.array(F.struct(s["words"].alias("w"), a.alias("a"), p.alias("p"))),
                           lambda b: F.array_join(F.transform(b["w"], lambda w, i: F.when(
                               i < b["a"], w).otherwise(F.get(b["w"], (
                                   b["a"] + F.pmod(i - b["a"], b["p"])).cast("int")))), " "))[0]

    h = F.crc32(F.col("doc_id").cast("string"))
    bound = F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g")))
    changed = F.transform(bound, lambda s: F.when(F.size(s["words"]) > 0, repeated(s)))[0]
    text = F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(changed, F.col("text"))).otherwise(
        F.col("text"))
    return docs.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    # Greatest length first, then least start and period: the array is in that order.
    longest = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint,"
                                                   " period: bigint>"),
                          lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r)
                          .otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"], r["length"], r["period"]), F.lit("\n")))
    exponent = F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period"))
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        exponent.alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
