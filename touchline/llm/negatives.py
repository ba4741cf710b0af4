"""Hard negatives: for anchors and their nearest rows of the same label, the near rows of other labels.

1. Rows are sorted by vector length, label and place on a Hilbert curve through the dimensions that vary
   most, and written in *chunks*, one row of a Parquet table each. A chunk is made of blocks of
   one label, and holds a zone map: the least and greatest value of every dimension of every block.
2. Anchors are packed in groups, in the same order. The scores within an anchor's own block give
   a first bound on its worst positive.
3. Interval arithmetic on the zone maps bounds the scores that a block can have with an anchor from
   both sides. For positives, blocks of the anchor's label whose upper bound reaches the first bound
   are read; for negatives, blocks of other labels whose bounds meet one of the anchor's windows.
   Chunks with no such block for a group are not joined with it.
4. Chosen blocks are scored as integer matrix products. Every task hands on no more than the few
   best rows of an anchor or window in a chunk.

Anchors meet the zone maps, not the rows, group by group and chunk by chunk; this and the chosen pairs are
spread over tasks by chunk, and nothing is sent to all tasks or to the driver but the statistics of the
dimensions. Where vectors have no structure the bounds exclude nothing, and every chunk is read once for
each group of anchors.

Defined results: rows without ``vec_id``, label or vector, or with a component that is null or not
finite, take no part; vectors only meet vectors of the same length; rows are told apart by
their place, so a repeated row is another row; ties go to the smaller ``vec_id``; scores are exact
and held at the ends of the 64-bit range; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.hilbert import hilbert_keys
from touchline.sources.sinks import materialise

#: Rows of a block (the unit of choice), blocks of a chunk (the unit of transport), anchors of a group.
BLOCK_ROWS, CHUNK_BLOCKS, GROUP_ROWS = 256, 8, 256
#: Chunks whose zone maps one task looks at together.
CHUNKS_TOGETHER = 16
#: Most tasks that the chunks are dealt to.
MOST_TASKS = 20_000
#: Dimensions and bits of the curve; standard deviations that its cells span on either side.
CURVE_DIMENSIONS, CURVE_BITS, CURVE_SPREAD = 8, 7, 3.0
LEAST, MOST = -(2**63), 2**63 - 1

CHUNK = ("chunk long, size int, vec_ids binary, labels binary, vectors binary, starts binary,"
         " block_labels binary, lows binary, highs binary")
ANCHOR = "chunk long, place int, size int, anchor_id long, label long, vector binary, least long"
GROUP = "group long, size int, chunks binary, places binary, anchor_ids binary, labels binary," \
        " vectors binary, needs binary, windows binary"
Rows = Iterator[pa.RecordBatch]


def scaled(embeddings: DataFrame, factor: int) -> DataFrame:
    """(vec_id, label, vector) with components ``floor(factor * x)``, of the rows that take part."""
    def unusable(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~F.exists(
        F.col("embedding"), unusable)
    return embeddings.where(F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform(
            "embedding", lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
        .alias("vector"))


# Integer arithmetic


def _packed(values: np.ndarray) -> bytes:
    """The least signed type that holds all values; its size tells it when read back."""
    for kind in (np.int16, np.int32):
        if values.size == 0 or (values.min() >= np.iinfo(kind).min
                                and values.max() <= np.iinfo(kind).max):
            return values.astype(kind).tobytes()
    return values.tobytes()


def _unpacked(data: bytes, rows: int, size: int) -> np.ndarray:
    if rows * size == 0:
        return np.zeros((rows, size), np.int64)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(data) // (rows * size)]
    return np.frombuffer(data, kind).reshape(rows, size).astype(np.int64)


def _reach(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of integers."""
    bound = _reach(a) * _reach(b) * max(a.shape[1], 1)
    if bound < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound <= MOST:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of every row of ``a`` with vectors inside every box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    # One product of twice the length, so that no sum leaves the 64-bit range on its way.
    sides = np.concatenate([up, down], 1)
    return (products(sides, np.concatenate([low, high], 1)),
            products(sides, np.concatenate([high, low], 1)))


def _best(owner: np.ndarray, score: np.ndarray, vec_id: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count`` of every owner, higher scores first, then smaller ids."""
    order = np.lexsort((vec_id, -score.astype(np.float64), owner))
    if len(score) and _reach(score) >= 2**53:
        order = np.array(sorted(range(len(score)), key=lambda k: (
            owner[k], -int(score[k]), vec_id[k])), np.int64)
    owner = owner[order]
    first = np.searchsorted(owner, owner)
    return order[np.arange(len(order)) - first < count]


# 1. Chunks of rows along the curve


def _statistics(rows: DataFrame, size: int) -> DataFrame:
    """Sum, sum of squares and number of every dimension of the vectors of length ``size``."""
    def summed(batches: Rows) -> Rows:
        total = np.zeros((2, size))
        count = 0
        for batch in batches:
            values = np.array(batch.column("vector").to_pylist(), np.float64).reshape(-1, size)
            total += np.stack([values.sum(0), np.square(values).sum(0)])
            count += len(values)
        yield pa.RecordBatch.from_pydict({
            "dimension": np.arange(size), "total": total[0], "squares": total[1],
            "number": np.full(size, count)})

    parts = rows.where(F.size("vector") == size).select("vector").mapInArrow(
        summed, "dimension long, total double, squares double, number long")
    return parts.groupBy("dimension").agg(F.sum("total").alias("total"), F.sum("squares")
                                          .alias("squares"), F.sum("number").alias("number"))


def _with_curve(rows: DataFrame) -> DataFrame:
    """``rows`` with ``size`` and their place ``curve``; vectors of a rare length have place 0."""
    usual = rows.groupBy(F.size("vector").alias("size")).count().orderBy(
        F.desc("count"), "size").first()
    size = usual["size"] if usual else 0
    found = sorted(_statistics(rows, size).collect(), key=lambda r: r["dimension"])  # one a dimension
    number = max(found[0]["number"] if found else 0, 1)
    mean = np.array([r["total"] for r in found]) / number
    spread = np.sqrt(np.maximum(np.array([r["squares"] for r in found]) / number - mean**2, 0))
    chosen = np.sort(np.argsort(-spread, kind="stable")[:CURVE_DIMENSIONS])
    lower = (mean - CURVE_SPREAD * spread)[chosen]
    cell = np.maximum(2 * CURVE_SPREAD * spread[chosen], 1e-9) / (1 << CURVE_BITS)

    def placed(batches: Rows) -> Rows:
        for batch in batches:
            values = batch.column("vector").to_pylist()
            usual_ones = np.array([len(v) == size for v in values], bool)
            curve = np.zeros(len(values), np.int64)
            if usual_ones.any() and len(chosen):
                points = np.array([v for v in values if len(v) == size], np.float64)[:, chosen]
                cells = np.clip((points - lower) // cell, 0, (1 << CURVE_BITS) - 1)
                curve[usual_ones] = hilbert_keys(cells.astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve)],
                                             names=[*batch.schema.names, "curve"])

    return rows.select("vec_id", "label", "vector").mapInArrow(
        placed, "vec_id long, label long, vector array<long>, curve long").withColumn(
        "size", F.size("vector"))


def _chunk(number: int, size: int, vec_ids: list, labels: list, vectors: list) -> dict:
    ids, label = np.array(vec_ids, np.int64), np.array(labels, np.int64)
    matrix = np.array(vectors, np.int64).reshape(len(ids), size)
    edge = np.flatnonzero(np.append(True, label[1:] != label[:-1]))
    stop = np.append(edge[1:], len(label))
    starts = np.concatenate([np.arange(a, b, BLOCK_ROWS) for a, b in zip(edge, stop)])
    lows = np.minimum.reduceat(matrix, starts) if size else np.zeros((len(starts), 0), np.int64)
    highs = np.maximum.reduceat(matrix, starts) if size else lows
    return {"chunk": number, "size": size, "vec_ids": ids.tobytes(), "labels": label.tobytes(),
            "vectors": _packed(matrix), "starts": starts.astype(np.int64).tobytes(),
            "block_labels": label[starts].tobytes(), "lows": _packed(lows), "highs": _packed(highs)}


def _chunks(rows: DataFrame) -> DataFrame:
    """One row for each run of at most ``BLOCK_ROWS * CHUNK_BLOCKS`` rows along the curve."""
    most = BLOCK_ROWS * CHUNK_BLOCKS
    schema = pa.schema([("chunk", pa.int64()), ("size", pa.int32()), *[
        (name, pa.binary()) for name in ("vec_ids", "labels", "vectors", "starts", "block_labels",
                                         "lows", "highs")]])

    def packed(batches: Rows) -> Rows:
        number = TaskContext.get().partitionId() << 32
        size, held = None, ([], [], [])

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_chunk(number, size, *held)], schema)

        for table in batches:
            columns = [table.column(c).to_pylist() for c in ("size", "vec_id", "label", "vector")]
            for each, *row in zip(*columns):
                if held[0] and (each != size or len(held[0]) == most):
                    yield batch()
                    number, held = number + 1, ([], [], [])
                size = each
                for column, value in zip(held, row):
                    column.append(value)
        if held[0]:
            yield batch()

    order = ["size", "label", "curve", "vec_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, CHUNK)


# 2. Groups of anchors


def _anchors(chunks: DataFrame, every: int, positives: int) -> DataFrame:
    """The anchors, and a score that their last positive has at least."""
    def found(batches: Rows) -> Rows:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["vec_ids"], np.int64)
                matrix = _unpacked(row["vectors"], len(ids), row["size"])
                starts = np.frombuffer(row["starts"], np.int64)
                place = np.flatnonzero(ids % every == 0)
                block = np.searchsorted(starts, place, "right") - 1
                least = np.full(len(place), LEAST)
                for b in np.unique(block):
                    part = slice(starts[b], starts[b + 1] if b + 1 < len(starts) else len(ids))
                    mine = np.flatnonzero(block == b)
                    scores = products(matrix[place[mine]], matrix[part])
                    if scores.shape[1] > positives:
                        # The anchor itself is taken out by leaving room for one score more.
                        scores[np.arange(len(mine)), place[mine] - starts[b]] = LEAST
                        least[mine] = np.partition(scores, -positives, 1)[:, -positives]
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([row["chunk"]] * len(place), pa.int64()),
                    "place": pa.array(place, pa.int32()),
                    "size": pa.array([row["size"]] * len(place), pa.int32()),
                    "anchor_id": pa.array(ids[place], pa.int64()),
                    "label": pa.array(np.frombuffer(row["labels"], np.int64)[place], pa.int64()),
                    "vector": pa.array([_packed(v) if len(v) else b"" for v in matrix[place]],
                                       pa.binary()),
                    "least": pa.array(least, pa.int64())})

    return chunks.select("chunk", "size", "vec_ids", "labels", "vectors", "starts").mapInArrow(
        found, ANCHOR)


def _groups(anchors: DataFrame) -> DataFrame:
    """Anchors packed in the order of their chunks. ``windows`` is a list of (low, high) or null."""
    names = ["group", "size", "chunks", "places", "anchor_ids", "labels", "vectors", "needs",
             "windows"]
    schema = pa.schema([("group", pa.int64()), ("size", pa.int32()),
                        *[(name, pa.binary()) for name in names[2:]]])

    def packed(batches: Rows) -> Rows:
        number, held = TaskContext.get().partitionId() << 32, []

        def batch() -> pa.RecordBatch:
            size = held[0]["size"]
            matrix = np.concatenate([_unpacked(r["vector"], 1, size) for r in held])
            windows = np.array([r["windows"] for r in held], np.int64)

            def column(name: str) -> bytes:
                return np.array([r[name] for r in held], np.int64).tobytes()

            return pa.RecordBatch.from_pylist([dict(zip(names, (
                number, size, column("chunk"), column("place"), column("anchor_id"),
                column("label"), _packed(matrix), column("least"), windows.tobytes())))], schema)

        for table in batches:
            for row in table.to_pylist():
                if held and (len(held) == GROUP_ROWS or row["size"] != held[0]["size"]):
                    yield batch()
                    number, held = number + 1, []
                held.append(row)
        if held:
            yield batch()

    order = ["size", "chunk", "place"]
    return anchors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, GROUP)


# 3. Choice of blocks


class _Group:
    def __init__(self, row: dict):
        self.chunks, self.places, self.ids, self.labels, self.least = (
            np.frombuffer(row[f"g_{n}"], np.int64)
            for n in ("chunks", "places", "anchor_ids", "labels", "needs"))
        self.vectors = _unpacked(row["g_vectors"], len(self.ids), row["size"])
        self.windows = np.frombuffer(row["g_windows"], np.int64).reshape(len(self.ids), -1, 2)


def _wanted(group: _Group, block_labels: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which blocks each anchor has to read: for positives if it has no windows, else for those."""
    least, most = bounds(group.vectors, low, high)
    same = group.labels[:, None] == block_labels[None, :]
    if group.windows.shape[1] == 0:
        return same & (most >= group.least[:, None])
    meets = np.zeros(same.shape, bool)
    for k in range(group.windows.shape[1]):
        lower, upper = group.windows[:, k, :1], group.windows[:, k, 1:]
        meets |= (most >= lower) & (least <= upper)
    return ~same & meets


def _chosen(groups: DataFrame, chunks: DataFrame, number: int) -> DataFrame:
    """(group, chunk, wanted): a bit for every anchor of the group and block of the chunk."""
    parts = number // CHUNKS_TOGETHER + 1
    zones = chunks.select("chunk", "size", "block_labels", "lows", "highs").withColumn(
        "part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    asked = groups.select(*[F.col(c).alias(c if c in ("group", "size") else f"g_{c}")
                            for c in groups.columns]).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = asked.repartition(parts, "part").join(zones.repartition(parts, "part"), ["part", "size"])

    def choose(batches: Rows) -> Rows:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                labels = np.frombuffer(row["block_labels"], np.int64)
                low, high = (_unpacked(row[c], len(labels), row["size"]) for c in ("lows", "highs"))
                wanted = _wanted(_Group(row), labels, low, high)
                if wanted.any():
                    yield pa.RecordBatch.from_pydict({
                        "group": [row["group"]], "chunk": [row["chunk"]],
                        "wanted": [np.packbits(wanted).tobytes()],
                        "blocks": pa.array([wanted.any(0).sum()], pa.int64())})

    return materialise(met.mapInArrow(choose, "group long, chunk long, wanted binary, blocks long"),
                       "wanted-blocks")


# 4. Scores of the chosen blocks


def _scored(groups: DataFrame, chunks: DataFrame, number: int,
            pick: Callable[[_Group, np.ndarray, np.ndarray, np.ndarray], tuple],
            count: int) -> DataFrame:
    """Best rows of every window: (chunk, place) of the anchor, window, vec_id, score.

    ``pick`` gives the candidates of a group among the rows of a chunk as (anchor, window, row).
    """
    tasks = min(max(number, 1), MOST_TASKS)
    asked = groups.select(*[F.col(c).alias(c if c == "group" else f"g_{c}") for c in groups.columns])
    pairs = _chosen(groups, chunks, number).select("group", "chunk", "wanted").join(asked, "group")
    rows = chunks.select("chunk", "size", "vec_ids", "labels", "vectors", "starts")
    met = pairs.repartition(tasks, "chunk").join(rows.repartition(tasks, "chunk"), "chunk")

    def score(batches: Rows) -> Rows:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                group = _Group(row)
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("vec_ids", "labels"))
                starts = np.frombuffer(row["starts"], np.int64)
                wanted = np.unpackbits(np.frombuffer(row["wanted"], np.uint8),
                                       count=len(group.ids) * len(starts)).astype(bool).reshape(
                    len(group.ids), len(starts))
                anchors, blocks = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
                size = np.diff(np.append(starts, len(ids)))
                read = np.flatnonzero(np.repeat(wanted.any(0), size))
                matrix = _unpacked(row["vectors"], len(ids), row["size"])[read]
                scores = products(group.vectors[anchors], matrix)
                allowed = np.repeat(wanted[np.ix_(anchors, blocks)], size[blocks], 1)
                own = group.chunks[anchors] == row["chunk"]
                at = np.searchsorted(read, group.places[anchors])
                own &= (at < len(read)) & (read[np.minimum(at, len(read) - 1)] == group.places[anchors])
                allowed[np.flatnonzero(own), at[own]] = False
                a, w, r = pick(group, anchors, scores, allowed)
                owner = a * max(group.windows.shape[1], 1) + w
                best = _best(owner, scores[a, r], ids[read[r]], count)
                a, w, r = a[best], w[best], r[best]
                yield pa.RecordBatch.from_pydict({
                    "a_chunk": group.chunks[anchors[a]], "a_place": group.places[anchors[a]],
                    "nth": w, "vec_id": ids[read[r]], "score": scores[a, r]})

    found = met.mapInArrow(score, "a_chunk long, a_place long, nth long, vec_id long, score long")
    order = Window.partitionBy("a_chunk", "a_place", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _near(group: _Group, anchors: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> tuple:
    a, r = np.nonzero(allowed & (scores >= group.least[anchors][:, None]))
    return a, np.zeros(len(a), np.int64), r


def _inside(group: _Group, anchors: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> tuple:
    """Candidates of all windows; those outside of every window are left out first."""
    windows = group.windows[anchors]
    a, r = np.nonzero(allowed & (scores >= windows[:, :, 0].min(1)[:, None])
                      & (scores <= windows[:, :, 1].max(1)[:, None]))
    score = scores[a, r]
    parts = []
    for k in range(windows.shape[1]):
        fits = np.flatnonzero((score >= windows[a, k, 0]) & (score <= windows[a, k, 1]))
        parts.append((a[fits], np.full(len(fits), k, np.int64), r[fits]))
    return tuple(np.concatenate(column) for column in zip(*parts))


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has ``vec_id``, ``label`` and an integer ``vector``. Anchors are the rows whose id is
    divisible by ``every``. Negatives have ``low`` to ``high`` per cent of the positive's score.
    """
    chunks = materialise(_chunks(_with_curve(materialise(rows, "vectors"))), "vector-chunks")
    number = chunks.count()
    anchors = materialise(_anchors(chunks, every, positives), "anchors")
    none = F.array().cast("array<array<long>>")
    first = materialise(_groups(anchors.withColumn("windows", none)), "anchor-groups")
    near = materialise(_scored(first, chunks, number, _near, positives), "positives")

    def percent(part: int, up: bool) -> Column:
        exact = F.col("score").cast("decimal(38,0)") * part / 100
        whole = F.ceil(exact) if up else F.floor(exact)
        return F.least(F.greatest(whole, F.lit(LEAST)), F.lit(MOST)).cast("long")

    window = F.struct("rank", F.col("vec_id").alias("positive_id"),
                      F.col("score").alias("positive_score"),
                      percent(low, True).alias("least"), percent(high, False).alias("most"))
    asked = near.groupBy("a_chunk", "a_place").agg(  # at most ``positives`` rows
        F.array_sort(F.collect_list(window)).alias("asked"))
    # Places beyond the last positive get a window that nothing fits.
    nothing = F.array_repeat(F.array(F.lit(MOST), F.lit(LEAST)), positives)
    limits = F.transform("asked", lambda w: F.array(w["least"], w["most"]))
    with_windows = materialise(
        anchors.join(asked, (F.col("chunk") == F.col("a_chunk")) & (F.col("place") == F.col("a_place")))
        .withColumn("windows", F.slice(F.concat(limits, nothing), 1, positives)), "windows")
    second = materialise(_groups(with_windows.select(*anchors.columns, "windows")),
                         "window-groups")
    found = _scored(second, chunks, number, _inside, negatives)
    named = with_windows.select("a_chunk", F.col("a_place").cast("long").alias("a_place"),
                                "anchor_id", F.posexplode("asked").alias("nth", "positive"))
    return named.withColumn("nth", F.col("nth").cast("long")).join(
        found, ["a_chunk", "a_place", "nth"]).select(
        "anchor_id", F.col("positive.positive_id").alias("positive_id"), "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("positive.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"))
