"""Removal of lines that occur, exactly or nearly, earlier in the corpus.

Lines are compared trimmed and in lower case; order is (doc_id, line number). A line is removed if
an equal line comes earlier, or, for lines of at least ``LEAST_CHARS`` characters, if the first
occurrence of a line within ``THRESHOLD`` edits comes earlier. This is judged on the input,
so the order of work has no influence. Lines without a character stay.

Equal lines meet by a 128-bit hash. Near lines are found by a segment-partition join: a line is cut
into ``THRESHOLD + 1`` segments, of which one at least survives that many edits. Segments of the
indexed line are hashed with its length and their number; for each length and segment the other
line is probed with the few substrings that can still lead to a match (the edits to the left and to
the right of the segment are bounded by its number and by the difference of the lengths). Lines
that meet no other one are left out first. Of the others only those become a pair whose letters
are alike, so the many variants of one long line don't all pair up. What is left is compared by a banded bit-parallel automaton: a word of ``2 * THRESHOLD + 1`` bits for each
number of edits, bit d standing for diagonal d. All steps are built-in functions.

Defined results: a null or empty text has no lines and stays as it is; a row without ``doc_id`` is
left as it is and is nobody's earlier line; rows with the same ``doc_id`` share positions, so
repeated rows stay alike; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.attach import attached
from touchline.sources.sinks import materialise

THRESHOLD = 2
LEAST_CHARS = 24
#: Bits of the map of line ids that all tasks get.
MAP_BITS = 25

_BLANK = " \t\r\x0b\x0c"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, norm) of every line with a character; needs a column ``gone`` to skip."""
    numbered = docs.select("doc_id", "gone", F.posexplode(F.split("text", "\n", -1))
                           .alias("line_no", "line"))
    norm = F.lower(F.btrim("line", F.lit(_BLANK)))
    here = F.col("gone").isNull() | ~F.array_contains("gone", F.col("line_no"))
    return (numbered.where(here).select("doc_id", "line_no", norm.alias("norm"))
            .where("norm <> ''"))


def _with_gone(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Documents with the array of line numbers that ``places`` (doc_id, line_no) has for them."""
    return attached(docs, places, F.col("line_no"), 4, "gone")


def _segments(length: Column, threshold: int) -> list[tuple[Column, Column]]:
    """(first character from 1, length) of each segment of a line; the last ones are longer."""
    parts = threshold + 1
    short = F.call_function("div", length, F.lit(parts)).cast("int")
    longer = length - short * parts
    out, start = [], F.lit(1)
    for i in range(parts):
        size = short + F.when(longer >= parts - i, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def _part(norm: Column, start: Column, size: Column) -> Column:
    """Bytes of a substring. In a line of one byte a character they are found without counting
    characters from its start."""
    plain = F.octet_length(norm) == F.col("chars")
    return F.when(plain, F.substring(norm.cast("binary"), start, size)).otherwise(
        F.substring(norm, start, size).cast("binary"))


def _key(length: Column, segment: int, part: Column) -> Column:
    return F.xxhash64(length, F.lit(segment), part)


def _index_keys(threshold: int) -> Column:
    length, norm = F.col("chars"), F.col("norm")
    return F.array(*[_key(length, i, _part(norm, start, size))
                     for i, (start, size) in enumerate(_segments(length, threshold))])


def _probe_keys(threshold: int) -> Column:
    """Keys of the substrings to look up: lines of the same length or up to ``threshold`` shorter.

    The first ``threshold + 1`` of them are those that the line is indexed under.
    """
    norm, own, others = F.col("norm"), [], []
    for shorter in range(threshold + 1):
        length = F.col("chars") - shorter
        for i, (start, size) in enumerate(_segments(length, threshold)):
            # i edits at most to the left of a surviving segment, the others to the right.
            least = max(-i, shorter - (threshold - i))
            most = min(i, shorter + (threshold - i))
            for shift in range(least, most + 1):
                place = start + shift
                inside = (place >= 1) & (place + size - 1 <= F.col("chars"))
                key = F.when(inside, _key(length, i, _part(norm, place, size)))
                (own if shorter == 0 and shift == 0 else others).append(key)
    return F.array_compact(F.array(*own, *others))


def _shift(name: str, x: Column, by: Column) -> Column:
    return F.call_function(name, x, by)


def within(a: Column, b: Column, threshold: int) -> Column:
    """Whether two arrays of characters are at most ``threshold`` edits apart.

    ``r[e]`` holds, for the characters of b read so far, the diagonals on which a prefix of a
    is reached with at most e edits.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    levels = [f"r{e}" for e in range(threshold + 1)]
    begin = F.struct(F.lit(0).alias("j"), *[
        F.lit(sum(1 << d for d in range(threshold, threshold + e + 1))).alias(name)
        for e, name in enumerate(levels)])

    def step(state: Column, c: Column) -> Column:
        j = state["j"]
        equal = reduce(lambda x, y: x.bitwiseOR(y), [
            F.when(F.get(a, j + (d - threshold)) == c, 1 << d).otherwise(0)
            for d in range(width)])
        # Prefixes of a have 0 to size(a) characters.
        reach = F.least(F.lit(width), F.size(a) - j + threshold)
        below = F.greatest(F.lit(0), F.lit(threshold - 1) - j)
        valid = F.when(reach <= 0, 0).otherwise(
            _shift("shiftright", F.lit(full), F.lit(width) - reach)
            .bitwiseAND(_shift("shiftleft", F.lit(full), below)))

        def moved(m: Column) -> Column:
            new: list[Column] = []
            for e, name in enumerate(levels):
                reached = state[name].bitwiseAND(m["equal"])
                if e:
                    before = state[levels[e - 1]]
                    reached = (reached.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                               .bitwiseOR(F.shiftleft(new[-1], 1)))
                new.append(reached.bitwiseAND(m["valid"]))
            return F.struct((j + 1).alias("j"), *[
                x.alias(name) for x, name in zip(new, levels, strict=True)])

        # The masks are bound to a name, so that every level reads them instead of making them.
        masks = F.array(F.struct(equal.alias("equal"), valid.alias("valid")))
        return F.when(state[levels[-1]] == 0, state).otherwise(F.transform(masks, moved)[0])

    last = F.size(a) - F.size(b) + threshold
    return F.aggregate(b, begin, step, lambda s: F.when(
        (last < 0) | (last >= width), F.lit(False)).otherwise(
        _shift("shiftright", s[levels[-1]], last).bitwiseAND(1) == 1))


def _pieces_agree(a: Column, b: Column, threshold: int) -> Column:
    """Whether all pieces of a but ``threshold`` at most are in b, up to ``threshold`` places off.

    An edit spoils one of the pieces at most, so lines that are near enough always pass; it takes
    far less time than the distance and leaves few lines that are not near.
    """
    parts = 2 * threshold + 2
    length, missing = F.length(a), F.lit(0)
    for i in range(parts):
        start = F.floor(length * i / parts).cast("int")
        piece = F.substring(a, start + 1, F.floor(length * (i + 1) / parts).cast("int") - start)
        around = F.substring(b, F.greatest(F.lit(1), start + 1 - threshold),
                             F.length(piece) + 2 * threshold
                             - F.greatest(F.lit(0), threshold - start))
        missing = missing + F.when(F.contains(around, piece), 0).otherwise(1)
    return missing <= threshold


def _common_start(a: Column, b: Column) -> Column:
    """Characters with which both begin, from halving steps that cover a text of any length."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    shorter = F.least(F.length(a), F.length(b))
    return F.aggregate(steps, F.lit(0), lambda done, step: done + F.when(
        (done + step <= shorter)
        & (F.substr(a, done + 1, step) == F.substr(b, done + 1, step)), step).otherwise(0))


def _without_common_ends(pairs: DataFrame) -> DataFrame:
    """``norm_a`` and ``norm_b`` without their common start and end, which no edit needs."""
    def rest(name: str) -> Column:
        return F.substr(F.col(name), F.col("start") + 1)

    cut = materialise(pairs.withColumn("start", _common_start(F.col("norm_a"), F.col("norm_b"))),
                      "close-lines").select("a", "b", rest("norm_a").alias("norm_a"),
                                            rest("norm_b").alias("norm_b"))
    cut = cut.select("a", "b", F.reverse("norm_a").alias("norm_a"),
                     F.reverse("norm_b").alias("norm_b"))
    return materialise(cut.withColumn("start", _common_start(F.col("norm_a"), F.col("norm_b"))),
                       "close-lines").select("a", "b", rest("norm_a").alias("norm_a"),
                                             rest("norm_b").alias("norm_b"))


def _edits_at_ends(a: Column, b: Column) -> Column:
    """Whether two texts without common ends can be two edits apart.

    Their first and their last step are edits then, so all between must be equal.
    """
    sides = [(1, 1), (1, 0), (0, 1)]

    def rest(x: Column, left: int, right: int) -> Column:
        return F.substr(x, F.lit(left + 1), F.length(x) - left - right)

    alike = [rest(a, i, k) == rest(b, j, m) for i, j in sides for k, m in sides]
    return (F.length(a) <= 2) | (F.length(b) <= 2) | reduce(lambda x, y: x | y, alike)


def _letters(norm: Column) -> Column:
    """A bit for each kind of character, set if the line has an odd number of them.

    Characters may share a bit; an edit takes one away, adds one or both, so it changes two bits at
    most.
    """
    one = F.lit(1).cast("long")
    return F.aggregate(F.split(norm, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(
        _shift("shiftleft", one, F.pmod(F.hash(c), F.lit(64)))))


def _likely_among(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """All lines whose id is in ``ids`` and a few more, found without moving the texts.

    The ids are marked in a map of ``2 ** MAP_BITS`` bits, 4 MB however many they are, which every
    task gets. A map too full for a corpus lets more lines through and changes no result.
    """
    place = F.col("id").bitwiseAND((1 << MAP_BITS) - 1)
    block, bit = F.shiftright(place, 15).alias("block"), place.bitwiseAND((1 << 15) - 1)
    marks = ids.select(block, bit.alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("marks"))
    byte = F.conv(F.hex(F.substring(F.col("marks"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    marked = _shift("shiftright", byte, bit.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
    return lines.join(F.broadcast(marks), (block == F.col("block")) & marked, "left_semi")


def _with_partners(distinct: DataFrame, threshold: int) -> DataFrame:
    """The lines that meet another one under some key, with their letters.

    The keys that a line is indexed under are among those it is probed with, so only the probes are
    moved, and the last bit of their id says whether they are of the index: the rows of a key see the
    least and the greatest id indexed under it. The first bit of the id goes for that, so two
    lines are told apart here by 63 bits of their hash.
    """
    packed, same_key = F.col("packed"), Window.partitionBy("key")
    probe = distinct.select("id", F.posexplode(_probe_keys(threshold)).alias("at", "key")).select(
        "key", F.shiftleft("id", 1).bitwiseOR(
            F.when(F.col("at") <= threshold, 1).otherwise(0)).alias("packed"))
    # Dealt out here, since what the window reads would else be unpacked before the shuffle.
    probe = probe.repartition("key")
    indexed = F.when(packed.bitwiseAND(1) == 1, F.shiftright(packed, 1))
    hits = (probe.select(F.shiftright(packed, 1).alias("id"),
                         F.min(indexed).over(same_key).alias("least"),
                         F.max(indexed).over(same_key).alias("most"))
            .where("id <> least or id <> most")
            .select(F.explode(F.array("id", "least", "most")).alias("id")).distinct())
    hits = materialise(hits, "lines-that-meet")
    # Shuffled at every size: these ids grow with the lines.
    short = F.shiftright(F.shiftleft("id", 1), 1)
    return materialise(_likely_among(distinct, hits).withColumn("short", short)
                       .join(hits.withColumnRenamed("id", "short").hint("merge"), "short", "left_semi")
                       .select("id", "norm", "chars", _letters(F.col("norm")).alias("letters")),
                       "lines-with-partners")


def near_lines(distinct: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): line ids at most ``threshold`` edits apart, from (id, norm, chars)."""
    found = _with_partners(distinct, threshold)
    index = found.select("id", "chars", "letters", F.explode(_index_keys(threshold)).alias("key"))
    probe = found.select("id", "chars", "letters", F.explode(_probe_keys(threshold)).alias("key"))
    other = index.withColumnsRenamed({"id": "y", "chars": "chars_y", "letters": "letters_y"})
    # Of two lines of one length either finds the other, so one direction is enough.
    met = (probe.withColumnRenamed("id", "x").join(other, "key")
           .where(((F.col("x") < F.col("y")) | (F.col("chars") > F.col("chars_y")))
                  & (F.bit_count(F.col("letters").bitwiseXOR(F.col("letters_y")))
                     <= 2 * threshold))
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    met = materialise(met, "line-pairs")
    text = found.select("id", "norm")
    texts = (met.join(text.withColumnsRenamed({"id": "a", "norm": "norm_a"}), "a")
             .join(text.withColumnsRenamed({"id": "b", "norm": "norm_b"}), "b")
             .where(_pieces_agree(F.col("norm_a"), F.col("norm_b"), threshold)))
    middles = _without_common_ends(texts)
    if threshold == 2:
        middles = middles.where(_edits_at_ends(F.col("norm_a"), F.col("norm_b")))

    def chars(name: str) -> Column:
        return F.when(F.col(name) == "", F.array().cast("array<string>")).otherwise(
            F.split(name, ""))

    # Bound to a name: inside the automaton an expression is evaluated at every character.
    both = F.struct(chars("norm_a").alias("a"), chars("norm_b").alias("b"))
    close = F.transform(F.array(both), lambda p: within(p["a"], p["b"], threshold))[0]
    return materialise(middles.where(close).select("a", "b"), "near-lines")


def repeated_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, line_no) of the lines to remove."""
    docs = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    places = materialise(
        _lines(docs.withColumn("gone", F.lit(None).cast("array<int>")))
        .select(F.xxhash64("norm").alias("id"), F.xxhash64(F.lit(1), "norm").alias("id2"),
                "doc_id", "line_no"), "lines")
    first = materialise(
        places.groupBy("id", "id2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"),
                                        F.count("*").alias("n")).where("n > 1").drop("n"),
        "first-lines")
    # Lines that come once are not moved again.
    again = materialise(
        _likely_among(places, first.select("id")).join(first, ["id", "id2"])
        .where(F.struct("doc_id", "line_no") > F.col("first"))
        .select("doc_id", "line_no"), "copied-lines")
    chars = F.length("norm")
    distinct = (_lines(_with_gone(docs, again)).where(chars >= LEAST_CHARS)
                .select(F.xxhash64("norm").alias("id"), "norm", chars.alias("chars"),
                        F.struct("doc_id", "line_no").alias("first")))
    distinct = materialise(distinct, "distinct-lines", "zstd")
    near = near_lines(distinct, threshold)
    start = _likely_among(distinct.select("id", "first"),
                          near.select(F.explode(F.array("a", "b")).alias("id")))
    ordered = (near.join(start.withColumnsRenamed({"id": "a", "first": "first_a"}), "a")
               .join(start.withColumnsRenamed({"id": "b", "first": "first_b"}), "b"))
    later = (ordered.where("first_a <> first_b")
             .select(F.greatest("first_a", "first_b").alias("p")).select("p.*").distinct())
    return again.unionByName(later)


def remove_lines(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, and ``n_lines``, ``n_removed`` (which
    replace columns of these names)."""
    new = ["n_lines", "n_removed"]
    # Other columns are carried together, so that none can clash with one in here.
    rest = [c for c in docs.columns if c not in ("text", *new)]
    rows = docs.select(F.struct(*rest).alias("row"), "doc_id", "text")
    gone = _with_gone(rows, repeated_lines(docs, threshold))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("gone"), i))
    cut = F.col("gone").isNotNull() & F.col("text").isNotNull()
    found = gone.select(
        "row", F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    return found.select(*["text" if c == "text" else F.col("row")[c].alias(c)
                          for c in docs.columns if c not in new], *new)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_removed",
                        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
