"""Documents linked by the Jaccard similarity of their word shingles, as connected components.

Two documents link when ``100 * common shingles >= percent * all shingles of both``. The result is
that of comparing every pair; how pairs are avoided:

1. *Copies.* Documents with the same shingle set become one representative.
2. *Groups.* Representatives that share one of a few min-hashes are compared with one leader of
   their min-hash: the one whose shingles are the most common, which is the likely origin of the
   others. Components of the links found are the groups of similar documents.
3. *Token-group matrix.* All shingles have one global order, the rarest first. A document's signature
   is the part of its shingles from which every partner has at least ``SHARED``, however the rest
   may match (prefix filtering). A document looks for partners that are not larger than itself;
   those share so much with it that a shorter part of their signature is enough to index. The
   matrix holds the union of these parts for each group: a (shingle, group) entry once, however
   many members have it. For a document and another group, the number of its signature shingles in
   the union bounds its overlap with every member, and the group's smallest and largest set bound
   the sizes, hence how many shingles must be found. If all that was found belongs to one member, the
   pair is known; other groups that reach the bounds are opened, which gives pairs with members whose
   signatures share what their two sizes ask for. Members of one
   group are linked already, so a passage or family that thousands share opens nothing.
4. *Parities.* A document has a bit for each residue of the shingles' hashes: whether it has an odd number
   with that residue. Each bit in which two documents differ stands for at least one shingle that only
   one of them has, which bounds what they have in common. Pairs within that bound are compared exactly.

The order comes from a count-min sketch. Any order gives the same links, so a sketch that is too
small for a corpus costs time only. Sets needed for a comparison are read again from the texts of just
those documents, found with a second sketch of their ids.

Shingles are compared by 64-bit hashes. Defined results: a null or empty text, or one without words,
has an empty set and its own component; a text shorter than a shingle is one shingle; a row
without ``doc_id`` links with nothing and has no component; repeated rows are copies; other
columns are passed over. Texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm import sketch
from touchline.llm.batches import small_batches
from touchline.llm.components import components
from touchline.llm.words import Words, mixed, range_hashes, signed, text_slices
from touchline.sources.sinks import materialise

#: Shingles that the signatures of two linked documents have in common at least.
SHARED = 3
MIN_HASHES = 4
ORDER_BITS = 19
ID_BITS = 20
TOKEN_BITS = 22

#: Bits of the shortest and the longest parity; between them, the power of two from the number of shingles on.
LEAST_PARITY, MOST_PARITY = 64, 1 << 15

_ID = "doc_id long, n_shingles long"


def _sets(batch: pa.RecordBatch, size: int, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, document, shingle): distinct shingles of parts of a batch, ascending."""
    for row, end, data, offsets in text_slices(batch):
        words = Words(data, offsets, lower)
        hashes, starts = words.windows(size)
        document = words.document[starts]
        short = np.flatnonzero((words.counts > 0) & (words.counts < size))
        if len(short):
            first = words.first[short]
            whole = range_hashes(words.hashes, first, first + words.counts[short])
            hashes, document = np.append(hashes, whole), np.append(document, short)
        order = np.lexsort((hashes, document))
        hashes, document = hashes[order], document[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
        yield row, end - row, document[new], hashes[new]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(values)))


def _parities(document: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Of every document, which residues of its hashes are taken by an odd number of them (little-endian)."""
    bits = np.full(len(n), LEAST_PARITY)
    while (bits < np.minimum(n, MOST_PARITY)).any():
        bits = np.where(bits < np.minimum(n, MOST_PARITY), 2 * bits, bits)
    ends = np.cumsum(bits)
    spread = mixed(hashes ^ np.uint64(0xA24BAED4963EE407))
    place = (spread & (bits[document] - 1).astype(np.uint64)).astype(np.int64) + (ends - bits)[document]
    odd = np.bincount(place, minlength=int(bits.sum())) & 1
    raw = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [raw[(end - size) // 8:end // 8] for end, size in zip(ends.tolist(), bits.tolist(), strict=True)]


def _differing(a: bytes, b: bytes) -> int:
    """Bits in which two parities differ; the longer one is folded to the length of the other."""
    long, short = (a, b) if len(a) > len(b) else (b, a)
    folded, size = int.from_bytes(long, "little"), 8 * len(long)
    while size > 8 * len(short):
        size //= 2
        folded = (folded >> size) ^ (folded & ((1 << size) - 1))
    return (folded ^ int.from_bytes(short, "little")).bit_count()


def _least_overlap(n, percent: int):
    """Shingles that a set of ``n`` has in common with every partner at least."""
    return -(-n * percent // 100)


def _signatures(size: int, lower: bool, percent: int, counts, heavy: int):
    """Function for ``mapInArrow``: set size, digest, min-hashes, signature and parity of every document."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, rows, document, hashes in _sets(batch, size, lower):
                n = np.bincount(document, minlength=rows)
                ends = np.cumsum(n)
                begins = ends - n
                seen = sketch.estimates(counts.value, hashes, ORDER_BITS)
                total = np.append(0.0, np.cumsum(np.log2(1.0 + seen)))
                common = (total[ends] - total[begins]) / np.maximum(n, 1)
                least = np.zeros((rows, MIN_HASHES), np.uint64)
                full = np.flatnonzero(n)
                for k in range(MIN_HASHES):
                    salted = mixed(hashes ^ np.uint64(0x632BE59BD9B4E019 * (k + 1) % 2**64))
                    if len(full):
                        least[full, k] = np.minimum.reduceat(salted, begins[full])
                # Rarest first: what the sketch can't tell apart from single shingles by hash.
                order = np.lexsort((hashes, np.where(seen >= heavy, seen, 0), document))
                t = _least_overlap(n, percent)
                length = np.minimum(n - t + np.minimum(SHARED, t), n)
                rank = np.arange(len(hashes)) - begins[document]
                chosen = hashes[order][rank < length[document]]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(row, rows), pa.array(n.astype(np.int64)),
                    pa.array(signed(range_hashes(hashes, begins, ends))),
                    pa.array(signed(range_hashes(mixed(hashes + np.uint64(1)), begins, ends))),
                    pa.array(common), _lists(least.reshape(-1), np.full(rows, MIN_HASHES)),
                    _lists(chosen, length),
                    pa.array(_parities(document, hashes, n), pa.binary()),
                ], ["doc_id", "n_shingles", "digest1", "digest2", "common", "least", "signature",
                    "parity"])

    return per_partition


def _sets_of(docs: DataFrame, pairs: DataFrame, size: int, lower: bool) -> DataFrame:
    """(id, set) for the documents in ``pairs``, and a few more."""
    wanted = sketch.filter_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", ID_BITS)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            keep = sketch.may_have(wanted.value, ids, ID_BITS)
            batch = batch.filter(pa.array(keep))
            ids = ids[keep]
            for row, rows, document, hashes in _sets(batch, size, lower):
                ends = np.cumsum(np.bincount(document, minlength=rows))
                raw = hashes.tobytes()
                blobs = [raw[8 * a:8 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row:row + rows]), pa.array(blobs, pa.binary())], ["id", "set"])

    return docs.mapInArrow(per_partition, "id long, set binary").dropDuplicates(["id"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles common to both sets of a pair."""
    for batch in batches:
        left, right = batch.column("set_a"), batch.column("set_b")
        found = [len(np.intersect1d(np.frombuffer(left[i].as_buffer(), np.uint64),
                                    np.frombuffer(right[i].as_buffer(), np.uint64),
                                    assume_unique=True)) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"),
             pa.array(found, pa.int64())], ["a", "b", "n_a", "n_b", "common"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits in which the parities of a pair differ."""
    for batch in batches:
        differ = [_differing(a, b) for a, b in zip(batch.column("parity_a").to_pylist(),
                                                   batch.column("parity_b").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"),
             pa.array(differ, pa.int64())], ["a", "b", "n_a", "n_b", "differ"])


def _may_link(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose parities allow a link."""
    # An id may stand for several texts; those of the pair's size are meant.
    of = rows.where("doc_id is not null").select("doc_id", "n_shingles", "parity")
    both = (pairs.join(of.toDF("a", "n_a", "parity_a"), ["a", "n_a"])
            .join(of.toDF("b", "n_b", "parity_b"), ["b", "n_b"])
            .select("a", "b", "n_a", "n_b", "parity_a", "parity_b"))
    compared = both.mapInArrow(_near, "a long, b long, n_a long, n_b long, differ long")
    # Common are at most (n_a + n_b - differ) / 2, and at least what _linked_share says.
    return compared.where(F.col("n_a") + F.col("n_b") - F.col("differ")
                          >= 2 * F.expr(_linked_share("n_a", "n_b", percent))).drop("differ")


def _linked(docs: DataFrame, rows: DataFrame, pairs: DataFrame, size: int, percent: int,
            lower: bool) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that link, by exact comparison of those whose parities allow it."""
    pairs = pairs.select("a", "b", "n_a", "n_b").distinct()
    pairs = materialise(_may_link(rows, pairs, percent).distinct(), "pairs")
    # Dealt by id once: both joins read that shuffle, so the sets are neither written nor moved again.
    sets = _sets_of(docs, pairs, size, lower)
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b"))
    counted = both.mapInArrow(_common, "a long, b long, n_a long, n_b long, common long")
    return counted.where(100 * F.col("common")
                         >= percent * (F.col("n_a") + F.col("n_b") - F.col("common")))


def _sizes_fit(least: Column, most: Column, n: Column, percent: int) -> Column:
    """Whether a set of ``n`` can link with one of a size between the two."""
    return (100 * n >= percent * least) & (100 * most >= percent * n)


def _linked_share(a: str, b: str, percent: int) -> str:
    """SQL for the shingles that linked sets of sizes ``a`` and ``b`` have in common at least."""
    return f"({percent} * ({a} + {b}) + {99 + percent}) DIV {100 + percent}"


def _outside_signature(n: str, percent: int) -> str:
    """Shingles that a set of ``n`` has behind its signature."""
    return f"greatest(0, ({percent} * {n} + 99) DIV 100 - {SHARED})"


def _outside_index(n: str, percent: int) -> str:
    """Shingles behind the part of the signature that is indexed.

    A partner that is not smaller has ceil(2 * percent * n / (100 + percent)) of them at least, so the
    part that holds ``SHARED`` common ones is shorter than the signature.
    """
    return f"greatest(0, (2 * {percent} * {n} + {99 + percent}) DIV {100 + percent} - {SHARED})"


def _least_found(larger: str, smaller: str, percent: int) -> str:
    """Shingles that the larger set's signature and the indexed part of the smaller one share at least:
    of the common ones, in their order, only as many can be missed as lie behind either."""
    behind = (f"greatest({_outside_signature(larger, percent)},"
              f" {_outside_index(smaller, percent)})")
    return f"greatest(1, {_linked_share(larger, smaller, percent)} - {behind})"


def _least_shared(larger: str, smaller: str, percent: int) -> str:
    """Shingles that both signatures share at least."""
    return (f"greatest(1, {_linked_share(larger, smaller, percent)}"
            f" - {_outside_signature(larger, percent)})")


def _with_leaders(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of a representative and the leader of one of its min-hashes."""
    keyed = reps.select("doc_id", "n_shingles", "common", F.posexplode("least").alias("k", "key"))
    leader = (keyed.groupBy("k", "key")
              .agg(F.max(F.struct("common", (-F.col("doc_id")).alias("least_id"),
                                  "n_shingles")).alias("leader"), F.count("*").alias("members"))
              .where("members > 1")
              .select("k", "key", (-F.col("leader.least_id")).alias("leader_id"),
                      F.col("leader.n_shingles").alias("n_leader")))
    return (keyed.join(leader, ["k", "key"])
            .where((F.col("doc_id") != F.col("leader_id"))
                   & _sizes_fit(F.col("n_leader"), F.col("n_leader"), F.col("n_shingles"), percent))
            .select(F.col("doc_id").alias("a"), F.col("leader_id").alias("b"),
                    F.col("n_shingles").alias("n_a"), F.col("n_leader").alias("n_b")).distinct())


def _across_groups(signed_reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents in different groups that the matrix lets through, the larger one as ``a``."""
    entries = signed_reps.select("group_id", F.explode("signature").alias("token"))
    shared = materialise(
        entries.groupBy("token").agg(F.min("group_id").alias("g0"), F.max("group_id").alias("g1"))
        .where("g0 < g1").select("token"), "shared")
    known = sketch.filter_of(shared, "token", TOKEN_BITS)

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signature = batch.column("signature")
            values = signature.flatten().to_numpy()
            counts = np.diff(signature.offsets.to_numpy())
            place = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
            keep = sketch.may_have(known.value, values, TOKEN_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(c).to_numpy(), counts)[keep])
                 for c in ("doc_id", "group_id", "n_shingles")]
                + [pa.array(values[keep]), pa.array(place[keep].astype(np.int32))],
                ["doc_id", "group_id", "n_shingles", "token", "place"])

    entries = signed_reps.select("doc_id", "group_id", "n_shingles", "signature").mapInArrow(
        per_partition, f"{_ID.split(',')[0]}, group_id long, n_shingles long, token long, place int")
    # What the filter lets through grows faster than the input; what is shared does not.
    entries = materialise(entries.join(shared, "token", "left_semi"), "entries")
    matrix = (entries.where(f"place < n_shingles - {_outside_index('n_shingles', percent)}")
              .groupBy("token", "group_id")
              .agg(F.min("n_shingles").alias("n_least"), F.max("n_shingles").alias("n_most"),
                   F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .withColumnRenamed("group_id", "other"))
    # What must be found is least with the smallest or with the largest partner that fits.
    smallest = f"greatest(n_least, ({percent} * n_shingles + 99) DIV 100)"
    largest = "least(n_most, n_shingles)"
    least = F.expr(f"least({_least_found('n_shingles', smallest, percent)},"
                   f" {_least_found('n_shingles', largest, percent)})")
    qualifying = (
        entries.join(matrix, "token")
        .where((F.col("group_id") != F.col("other")) & (F.col("n_least") <= F.col("n_shingles"))
               & (100 * F.col("n_most") >= percent * F.col("n_shingles")))
        .groupBy("doc_id", "group_id", "n_shingles", "other")
        .agg(F.count("*").alias("overlap"), F.min("n_least").alias("n_least"),
             F.max("n_most").alias("n_most"), F.min("first").alias("first"),
             F.max("last").alias("last"))
        .where(F.col("overlap") >= least))
    found = materialise(qualifying.drop("group_id", "overlap"), "qualifying")
    # A member that shares nothing in the matrix can't be a partner, so one that has all of it is alone.
    alone = (F.col("first") == F.col("last")) & (F.col("n_least") == F.col("n_most"))
    smaller = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a"))
                                               & (F.col("b") < F.col("a")))
    fits = smaller & (100 * F.col("n_b") >= percent * F.col("n_a"))
    known_pairs = found.where(alone).select(
        F.col("doc_id").alias("a"), F.col("first").alias("b"), F.col("n_shingles").alias("n_a"),
        F.col("n_least").alias("n_b")).where(fits)
    # Written apart, for then it shows that they are few and the entries need not move.
    asked = materialise(found.where(~alone).select("doc_id", "n_shingles", "other"), "asked")
    query = entries.select(F.col("doc_id").alias("a"), "token").join(
        asked.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), "other"), "a")
    opened = materialise(asked.select(F.col("other").alias("group_id")).distinct(), "opened")
    member = entries.join(opened, "group_id", "left_semi").select(
        F.col("doc_id").alias("b"), F.col("group_id").alias("other"), F.col("n_shingles").alias("n_b"),
        "token")
    return known_pairs.unionByName(
        query.join(member, ["other", "token"]).where(fits)
        .groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("overlap"))
        .where(F.col("overlap") >= F.expr(_least_shared("n_a", "n_b", percent)))
        .drop("overlap"))


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85,
                       lower: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; the id is the smallest reachable one."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    small_batches(spark)

    def set_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, _, hashes in _sets(batch, size, lower):
            yield hashes

    counts = sketch.merged(docs.select("text"), set_hashes, ORDER_BITS, "uint32")
    # Few single shingles have two cells as crowded as the fullest hundredth.
    heavy = max(32, int(np.quantile(counts, 0.99)))
    known = docs.where("doc_id is not null")
    rows = materialise(docs.mapInArrow(
        _signatures(size, lower, percent, spark.sparkContext.broadcast(counts), heavy),
        f"{_ID}, digest1 long, digest2 long, common double, least array<long>,"
        " signature array<long>, parity binary"), "signatures")

    digest = ["digest1", "digest2", "n_shingles"]
    linkable = rows.where("doc_id is not null and n_shingles > 0")
    copies = linkable.groupBy(*digest).agg(F.min("doc_id").alias("rep_id"))
    members = materialise(
        linkable.select("doc_id", *digest).join(copies, digest).select("doc_id", "rep_id")
        .distinct(), "members")
    # One row for each representative, even if its row is repeated.
    own = members.where("doc_id = rep_id").select("doc_id")
    light = materialise(
        linkable.select("doc_id", "n_shingles", "common", "least").join(own, "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.max(F.struct("n_shingles", "common", "least")).alias("r"))
        .select("doc_id", "r.*"), "representatives")
    first_links = materialise(
        _linked(known, rows, _with_leaders(light, percent), size, percent, lower).select("a", "b"),
        "links")
    groups = materialise(
        components(first_links).withColumnsRenamed({"node": "doc_id", "component": "found_id"}),
        "groups")
    # Documents that stand for themselves and are in no group are nearly all: the others are named, so
    # that the signatures need not move if those are few.
    others = materialise(
        members.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("rep_id")).alias("own"))
        .where("not own").select("doc_id"), "others")
    signed_reps = materialise(
        linkable.select("doc_id", "n_shingles", "signature").join(others, "doc_id", "left_anti")
        .join(groups, "doc_id", "left")
        .select("doc_id", "n_shingles", "signature",
                F.coalesce("found_id", "doc_id").alias("group_id")), "grouped")
    more_links = _linked(known, rows, _across_groups(signed_reps, percent), size, percent, lower)
    links = materialise(first_links.unionByName(more_links.select("a", "b")), "links")
    final = components(links).withColumnsRenamed({"node": "rep_id", "component": "found_id"})
    placed = members.join(final, "rep_id", "left").select(
        "doc_id", F.coalesce("found_id", "rep_id").alias("component_id")
    ).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return (rows.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component_id", "doc_id").alias("component_id")))
