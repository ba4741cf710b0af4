"""Toxic passages as maximum-scoring segments, and the toxicity of documents.

* *Token weights.* From labelled documents (one of each group of very near copies with the same label, so
  that a token is not taken for toxic because a copied document is), the log-odds of every token between toxic and other
  documents with a Dirichlet prior in proportion to the token's overall frequency, moved towards
  zero by a multiple of their standard error, less a constant so that ordinary text scores below 0.
* *Segments.* One scan over a document finds all its maximal-scoring segments.
* *Calibration.* The best segment of ordinary text follows an extreme-value distribution
  whose location grows with the logarithm of the length. Its parameters are fitted on
  labelled documents that had no part in the weights. A document's evidence is that of its best
  segment plus that of all others that are significant; a logistic curve, fitted on the same documents,
  turns it into a score between 0 and 1.

Weights come from one half of the labelled rows, calibration from the other; at most
``MAX_LABELLED`` labelled rows are used, chosen by a hash of their id, and at most
``MAX_TOKENS`` weights are kept, so the model has a fixed size. Everything else covers all documents.
Nothing but the text takes part in a score.

Defined results: a null or empty text has no segment and gets the score of no evidence; null labels are
not used; a null ``doc_id`` is passed on and is not held out; repeated rows get equal scores; without
labels of both kinds the score is the share of toxic labels (0 without labels); other columns are
passed over. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import PUNCTUATION, Words, mixed, range_hashes, signed, text_slices
from touchline.sources.sinks import materialise

MAX_LABELLED = 20_000
MAX_TOKENS = 50_000
#: Weight of the prior as a part of the tokens counted.
PRIOR_PART = 0.05
#: Labelled documents that must have a token.
LEAST_DOCUMENTS = 3
#: Standard errors by which a log-odds moves towards zero.
CAUTION = 1.64
#: What every token costs.
DRIFT = 0.35
MOST_WEIGHT = 6.0
#: Expected number of segments as good by chance, below which a passage is significant.
SIGNIFICANT = 0.01
THRESHOLD = 0.3
#: Least hashes that make a family of copies.
FAMILY_HASHES = 4
#: Tokens that a shorter text counts as: the distribution holds for long texts.
LEAST_LENGTH = 100


@dataclass(frozen=True)
class Model:
    tokens: np.ndarray  # ascending hashes
    weights: np.ndarray
    scale: float = 1.0  # lambda of the extreme-value distribution
    log_rate: float = 0.0  # logarithm of its K
    bias: float = 0.0
    slope: float = 0.0

    def evidence(self, score: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Minus the logarithm of the expected number of segments as good in such a text; 0 for a
        text without a segment."""
        found = self.scale * score - self.log_rate - np.log(np.maximum(length, LEAST_LENGTH))
        return np.where(score > 0, np.maximum(found, 0.0), 0.0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + self.slope * np.clip(evidence, -20, 60))))


def maximal_segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), in linear time.

    Every candidate knows the nearest one before it whose total at the start is lower (``back``). Looking
    for such a one from a new candidate skips all between, and what was skipped once is behind
    the new candidate from then on.
    """
    total = np.append(0.0, np.cumsum(weights))
    kept: list[tuple[int, int, float, float, int]] = []  # first, end, total before, after, back
    for at in np.flatnonzero(weights > 0).tolist():
        first, end, low, high = at, at + 1, float(total[at]), float(total[at + 1])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((first, end, low, high, j))
                break
            first, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(first, end, high - low) for first, end, low, high, _ in kept]


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    for row, _, data, offsets in text_slices(batch):
        yield row, Words(data, offsets, lower=True, between=PUNCTUATION)


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, toxic, other): documents of this part that have the token."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for row, words in _tokens(batch):
            order = np.lexsort((words.hashes, words.document))
            hashes, document = words.hashes[order], words.document[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
            hashes, label = hashes[new], toxic[row + document[new]]
            token, where = np.unique(hashes, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(token)),
                 pa.array(np.bincount(where, label == 1, len(token)).astype(np.int64)),
                 pa.array(np.bincount(where, label != 1, len(token)).astype(np.int64))],
                ["token", "toxic", "other"])


def token_weights(labelled: DataFrame) -> Model:
    """Weights from rows (text, toxic)."""
    counts = materialise(
        labelled.mapInArrow(_token_counts, "token long, toxic long, other long")
        .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")),
        "token-counts")
    toxic, other = (x or 0 for x in counts.agg(F.sum("toxic"), F.sum("other")).first())
    prior = PRIOR_PART * (F.col("toxic") + F.col("other"))
    whole = PRIOR_PART * (toxic + other)

    def odds(seen: str, total: int):
        return F.log((F.col(seen) + prior) / (total + whole - F.col(seen) - prior))

    scored = counts.withColumn("odds", odds("toxic", toxic) - odds("other", other)).withColumn(
        "error", F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("other") + prior)))
    shrunk = F.signum("odds") * F.greatest(F.lit(0.0), F.abs("odds") - CAUTION * F.col("error"))
    rows = (scored.select("token", "toxic", "other", shrunk.alias("weight"),
                          F.abs(F.col("odds") / F.col("error")).alias("z"))
            .where(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS).where("weight <> 0").orderBy(F.desc("z"), "token").limit(MAX_TOKENS)
            .select("token", "weight").toPandas())
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return Model(tokens[order], np.clip(rows["weight"].to_numpy(float)[order],
                                        -MOST_WEIGHT, MOST_WEIGHT))


def _segments(model: Model, words: Words) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(tokens, segments) of every document."""
    weights = np.full(len(words.hashes), -DRIFT)
    if len(model.tokens):
        at = np.minimum(np.searchsorted(model.tokens, words.hashes), len(model.tokens) - 1)
        known = model.tokens[at] == words.hashes
        weights[known] += model.weights[at[known]]
    for first, count in zip(words.first[:-1].tolist(), words.counts.tolist(), strict=True):
        yield count, maximal_segments(weights[first:first + count])


def calibrated(model: Model, labelled: DataFrame) -> Model:
    """The model with parameters fitted on rows (text, toxic) that had no part in its weights."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(count, max((s[2] for s in found), default=0.0))
                   for _, words in _tokens(batch) for count, found in _segments(shared.value, words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int32()), pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.float64())], ["toxic", "length", "score"])

    # One row of three numbers for each of at most MAX_LABELLED documents.
    rows = labelled.mapInArrow(best, "toxic int, length long, score double").toPandas()
    toxic = rows["toxic"].to_numpy() == 1
    if toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(toxic) else 0.0
        edge = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(model.tokens, model.weights, bias=float(np.log(edge / (1 - edge))))
    length = np.maximum(rows["length"].to_numpy(float), LEAST_LENGTH)
    score = rows["score"].to_numpy(float)
    scale = 1.0
    for _ in range(20):  # the spread of a Gumbel variable is pi / (sqrt(6) * scale)
        spread = np.std(score[~toxic] - np.log(length[~toxic]) / scale)
        scale = float(np.clip(np.pi / np.sqrt(6) / max(spread, 1e-6), 0.2, 2.0))
    rate = (~toxic).sum() / np.sum(length[~toxic] * np.exp(-scale * score[~toxic]))
    model = Model(model.tokens, model.weights, scale, float(np.log(rate)))
    x = np.clip(model.evidence(score, length), -20, 60)
    bias, slope = 0.0, 0.1
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):  # Newton steps with a small ridge on the slope
        p = 1 / (1 + np.exp(-np.clip(bias + slope * x, -30, 30)))
        gradient = design.T @ (toxic - p) - np.array([0.0, 1e-2 * slope])
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-2])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        bias, slope = bias + step[0], slope + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.tokens, model.weights, scale, float(np.log(rate)), float(bias),
                 float(max(slope, 0.0)))


def _with_family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few least hashes of three words in a row, together: copies and very near copies share all of
    them, documents that only have a passage in common don't."""
    for batch in batches:
        family = np.zeros(batch.num_rows, np.uint64)
        for row, words in _tokens(batch):
            hashes, starts = words.windows(3)
            short = np.flatnonzero(words.counts < 3)
            first = words.first[short]
            whole = range_hashes(words.hashes, first, first + words.counts[short])
            key = np.zeros(len(words.counts), np.uint64)
            for k in range(FAMILY_HASHES):
                salt = np.uint64(0x632BE59BD9B4E019 * (k + 1) % 2**64)
                least = np.full(len(words.counts), np.uint64(2**64 - 1))
                np.minimum.at(least, words.document[starts], mixed(hashes ^ salt))
                least[short] = whole
                key = mixed(key ^ least)
            family[row:row + len(key)] = key
        yield pa.RecordBatch.from_arrays(
            [batch.column("text"), batch.column("toxic").cast(pa.int32()),
             pa.array(signed(family))], ["text", "toxic", "family"])


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled documents that are not held out."""
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
              .where("doc_id is not null and toxic is not null").where(~is_held_out("doc_id"))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    # MAX_LABELLED rows of twelve bytes.
    found = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic").mapInArrow(
        _with_family, "text string, toxic int, family long")
    labelled = materialise(
        found.groupBy("family", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"),
        "labelled")
    half = F.xxhash64("text") % 2 == 0
    return calibrated(token_weights(labelled.where(half)), labelled.where(~half))


_SCORED = ("doc_id long, score double,"
           " passages array<struct<first:int,end:int,weight:double,chance:double>>")


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages): significant passages as ranges of tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            evidence, passages = [], []
            for _, words in _tokens(batch):
                for count, found in _segments(model, words):
                    best = max((s[2] for s in found), default=0.0)
                    each = model.evidence(np.array([s[2] for s in found] or [0.0]),
                                          np.full(max(len(found), 1), count))
                    clear = each > -np.log(SIGNIFICANT)
                    own = float(model.evidence(np.array([best]), np.array([count]))[0])
                    evidence.append(max(own, float(each[clear].sum())))
                    passages.append([
                        {"first": a, "end": b, "weight": w, "chance": float(np.exp(-e))}
                        for (a, b, w), e, c in zip(found, each, clear, strict=False) if c])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.probability(np.array(evidence))),
                 pa.array(passages, pa.list_(pa.struct([
                     ("first", pa.int32()), ("end", pa.int32()), ("weight", pa.float64()),
                     ("chance", pa.float64())])))], ["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_partition, _SCORED)


def digest(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.size("passages").alias("n_passages"))
