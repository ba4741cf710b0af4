"""Near-duplicate lines against comparing every pair."""

import random

from pyspark.sql import functions as F

from touchline.llm import lines
from touchline.sources.sinks import materialise


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(text, edits, letters, rng):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice(letters))
        elif chars and kind == 1:
            chars.pop(at % len(chars))
        elif chars:
            chars[at % len(chars)] = rng.choice(letters)
    return "".join(chars)


def test_automaton_is_the_edit_distance(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(10)))
        pairs.append((a, changed(a, rng.randrange(5), "ab", rng)))
    table = spark.createDataFrame(pairs, "a string, b string")

    def chars(c):
        return F.filter(F.split(c, ""), lambda x: x != "")

    for threshold in (1, 2, 3):
        rows = table.withColumn("near", lines.within(chars("a"), chars("b"), threshold)).collect()
        assert all(r.near == (distance(r.a, r.b) <= threshold) for r in rows)


def test_lines_against_all_pairs(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(24, 60))) for _ in range(12)]
    docs = []
    for doc_id in range(40):
        text = "\n".join([changed(rng.choice(base), rng.randrange(4), "abxé", rng)
                          for _ in range(rng.randrange(6))] + ["", "Tiny line."])
        docs.append((doc_id, text))
    docs += [(7, docs[7][1]), (None, base[0]), (90, None), (91, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("gone", F.lit(1))
    found = {tuple(r) for r in lines.repeated_lines(table).collect()}
    places, first = [], {}
    for doc_id, text in sorted(set(d for d in docs if d[0] is not None), key=lambda d: d[0]):
        for k, line in enumerate((text or "").split("\n")):
            norm = line.strip(" \t\r\x0b\x0c").lower()
            if norm:
                places.append((doc_id, k, norm))
                first.setdefault(norm, (doc_id, k))
    expected = {(d, k) for d, k, n in places if first[n] != (d, k)}
    long = [n for n in first if len(n) >= lines.LEAST_CHARS]
    for i, a in enumerate(long):
        expected |= {max(first[a], first[b]) for b in long[i + 1:] if distance(a, b) <= 2}
    assert found == expected
    kept = {r.doc_id: r for r in lines.remove_lines(
        spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept[None].text == base[0] and kept[90].text is None and kept[91].text == ""


def test_long_lines_with_long_common_ends(spark):
    rng = random.Random(3)
    rows, expected = [], set()
    # Two substitutions each, around and beyond 131,071 characters from either end; the last has three.
    for k, (size, places) in enumerate([
            (200_000, (140_000, 170_000)), (200_000, (150_000, 150_010)), (200_000, (10, 50)),
            (500_000, (300_000, 300_050)), (500_000, (140_000, 300_000)),
            (200_000, (150_000, 150_005, 150_010))]):
        a = "".join(rng.choices("abcdefgh ", k=size))
        b = list(a)
        for at in places:
            b[at] = "x"
        rows += [(2 * k, a, size), (2 * k + 1, "".join(b), size)]
        if len(places) == 2:
            expected.add((2 * k, 2 * k + 1))
    table = spark.createDataFrame(rows, "id long, norm string, chars int")
    assert {tuple(r) for r in lines.near_lines(table).collect()} == expected


def test_map_loses_no_line(spark):
    table = spark.range(5000).select(F.xxhash64("id").alias("id"))
    ids = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("id"))
    kept = {r.id for r in lines._likely_among(table, ids).collect()}
    asked = {r.id for r in ids.collect()}
    assert asked <= kept and len(kept) < len(asked) + 50
    assert lines._likely_among(table, ids.where("false")).count() == 0


def test_what_is_moved_to_find_repeated_lines(spark, monkeypatch):
    rng, written = random.Random(5), {}
    texts = ["\n".join("".join(rng.choices("abcdefgh ", k=40)) for _ in range(5)) for _ in range(20)]
    docs = spark.createDataFrame([*enumerate(texts), (50, texts[3].split("\n")[2])],
                                 "doc_id long, text string")

    def noted(frame, purpose, *more):
        written[purpose] = frame
        return materialise(frame, purpose, *more)

    monkeypatch.setattr(lines, "materialise", noted)
    assert [tuple(r) for r in lines.repeated_lines(docs).collect()] == [(50, 0)]
    # Only a line that comes again has its first place looked up.
    assert [tuple(r.first) for r in written["first-lines"].collect()] == [(3, 2)]
    # The probes carry the index, so keys are dealt out once.
    plan = written["lines-that-meet"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(key") == 1


def test_ids_that_use_all_bits(spark):
    rng = random.Random(6)
    rows, expected = [], set()
    for k, (i, j) in enumerate([(2**63 - 1, -2**63 + 5), (-1, 2**62), (-2**62, 7)]):
        a = "".join(rng.choices("abcdefgh ", k=30 + k))
        rows += [(i, a, len(a)), (j, a[:10] + "x" + a[11:], len(a))]
        expected.add((min(i, j), max(i, j)))
    table = spark.createDataFrame(rows, "id long, norm string, chars int")
    assert {tuple(r) for r in lines.near_lines(table).collect()} == expected
