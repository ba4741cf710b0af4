"""Operators against brute force on a small table with nulls, copies, near copies and long texts."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from touchline.llm import (
    decontaminate,
    jaccard,
    packing,
    pii,
    quality,
    secrets,
    shards,
    substrings,
    tokens,
    toxicity,
)
from touchline.llm.queries import vocabulary
from touchline.sources.sinks import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone int, _row int"


def _rows():
    rng = random.Random(4)
    words = ["w%d" % i for i in range(300)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    base, rows = some(200), []
    for i in range(24):
        near = list(base)
        for _ in range(i % 6):
            near[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(near if i < 12 else some(rng.randrange(120)) + base[20:90])))
    rows += [(30, "a b"), (31, "A\tB"), (32, ""), (33, None), (34, " \n "), (None, " ".join(base)),
             (35, rows[3][1]), (35, rows[3][1]), (36, " ".join(some(9000)))]
    return [(*r, "en" if r[0] else None, None, 1, 2, 3) for r in rows]


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def test_passages(docs):
    first = {}
    for doc_id, text, *_ in ROWS:
        w = split(text)
        for j in range(len(w) - 49 if doc_id is not None else 0):
            key = tuple(w[j:j + 50])
            first[key] = min(first.get(key, doc_id), doc_id)
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        w = split(text)
        gone = [False] * len(w)
        for j in range(len(w) - 49 if doc_id is not None else 0):
            if first[tuple(w[j:j + 50])] < doc_id:
                gone[j:j + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected[doc_id, len(w), sum(gone), kept] += 1
    assert Counter(map(tuple, substrings.remove_repeats(docs).collect())) == expected


def test_components(docs):
    sets = {}
    for doc_id, text, *_ in ROWS:
        w = split(text.translate({c: c + 32 for c in range(65, 91)}) if text else "")
        sets[doc_id] = ({tuple(w[j:j + 4]) for j in range(len(w) - 3)} if len(w) > 3
                        else {tuple(w)} if w else set())
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    found = {r.doc_id: (r.n_shingles, r.component_id)
             for r in jaccard.jaccard_components(docs).collect()}
    assert found == {i: (len(s), None if i is None else find(i)) for i, s in sets.items()}


def test_quality_and_shards(docs):
    rows = quality.digest(quality.judged(docs, ["doc_id"])).collect()
    assert len(rows) == len(ROWS) and all(not (r.base_failed and r.kept) for r in rows)
    texts = dict((r[0], r[1]) for r in ROWS)
    for r in rows:
        w = split(texts[r.doc_id])
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {j + k for j in range(len(w) - 2) if grams[tuple(w[j:j + 3])] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(again))
    placed = shards.assign_shards(docs, 4).collect()
    slots, shard_of = defaultdict(list), {}
    for r in placed:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        assert shard_of.setdefault(raw, r.shard) == r.shard
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_quality_is_judged_by_what_is_usual_for_the_source(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def text(least, most):
        return " ".join("".join(rng.choices(letters, k=rng.randint(least, most)))
                        for _ in range(80))

    rows, short, long = [], text(3, 6), text(10, 16)
    for i in range(220):
        rows += [(i, text(3, 6), "en", "plain"), (1000 + i, text(10, 16), "en", "terms")]
    rows += [(5000, short, "en", "plain"), (5001, short, "en", "terms"),
             (5002, long, "en", "plain"), (5003, long, "en", "terms")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.digest(quality.judged(table, ["doc_id"])).collect()}
    assert [kept[i] for i in range(5000, 5004)] == [True, False, False, True]
    assert all(kept[i] for i in kept if i < 5000)


def test_packing(docs):
    encode = tokens.encoder(vocabulary())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, vocabulary(), 256).collect():
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    rooms = []  # first fit, the longest first
    for length in sorted((n for m in bins.values() for _, n in m), reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= length), None)
        if at is None:
            rooms.append(256 - length)
        else:
            rooms[at] -= length
    assert len(bins) <= len(rooms)
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 256
    for doc_id, text, *_ in ROWS:
        if doc_id != 35:
            raw, at = encode(text or ""), 0
            for p in sorted(pieces[doc_id], key=lambda p: p.piece):
                assert p.start == at and p.ids_crc32 == zlib.crc32(raw[4 * at:4 * (at + p.length)])
                at += p.length
            assert 4 * at == len(raw)


def test_ids_are_those_of_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = tokens.encoder(vocabulary())
    for text in ["", "  ", "a  b", " a\n b", "a \n\n  b", "x<|endoftext|> y", "don't é　x ", "\tq"]:
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_texts_encoded_together_have_the_ids_of_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(5)
    parts = ["a", "bé", " ", "  ", "\n", "\n\n", "\t", "\u3000", "\xa0", "\x1c", "\x85", "'s", "don't", "12",
             "<|endoftext|>", "!!", "漢字", "\r\n", " \n", "\n ", " x", " the end"]
    texts = ["", " ", "x " * 9, *["".join(rng.choice(parts, n)) for n in rng.integers(0, 14, 2000)]]
    encode = tokens.slice_encoder(vocabulary())
    for slice_ in (texts, texts[:1], [texts[1]], []):
        for text, raw in zip(slice_, encode(slice_), strict=True):
            ids = np.frombuffer(raw, "<u4").tolist()
            assert ids == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_a_word_is_encoded_once_and_not_remembered():
    """Nothing of the words stays in a worker, and a slice takes one call besides its first words."""
    import tracemalloc

    texts = [" ".join(f"w{i * j:x}y" for j in range(1, 500)) for i in range(1, 60)]
    encode, calls = tokens.slice_encoder(vocabulary()), []
    before = tokens._vocabularies[vocabulary()]
    tokens._vocabularies[vocabulary()] = (lambda x: calls.append(x) or before[0](x), before[1])
    try:
        want = [tokens.encoder(vocabulary())(text) for text in texts]
        counted, calls[:] = tokens.slice_encoder(vocabulary()), []
        assert counted(texts) == want and len(calls) == len(texts) + 1
        assert len(calls[-1].split()) == len({w for t in texts for w in t.split()[1:]})
    finally:
        tokens._vocabularies[vocabulary()] = before
    encode(texts)
    tracemalloc.start()
    encode([text.replace("y", "z") for text in texts])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 100_000


def test_tasks_hand_texts_to_python_in_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for run in (lambda docs: jaccard.jaccard_components(docs), lambda docs: packing.pack(docs, vocabulary())):
        spark.conf.unset(key)
        run(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string"))
        texts = spark.range(0, 600, 1, 1).selectExpr("id", "repeat('abcdefg ', 5000) text")
        found = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 20_000_000 and max(found) < 5_000_000
    spark.conf.unset(key)


def test_secrets_personal_data_and_benchmark(spark):
    texts = ["token = 'abcdef12' x", "é AKIA" + "A" * 16, "secret=token:abcdefgh", "f" * 24,
             "mail a.b@c.org, +1 (415) 555-7279 and 10.0.0.1", "4111 1111 1111 1111", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.digest(secrets.scan_documents(docs)).collect()}
    assert found == {0: "assign:0:17", 1: "access:2:22", 2: "", 3: "hex:0:24", 4: "", 5: "", 6: "", 7: ""}
    ledger = secrets.ledger_entries(docs)
    assert secrets.ledger_entries(docs, ledger).count() == 0
    assert secrets.ledger_entries(docs, ledger, version=2).count() == 7
    spans = {r.doc_id: r.base for r in pii.find_personal_data(docs, pii.fitted(docs)).collect()}
    assert spans[4] == "email:5:14,ip:38:46,phone:16:33" and spans[5] == "card:0:19"
    assert spans[6] == spans[7] == ""
    item = "the quick brown fox jumps over the lazy dog while nobody looks at it"
    pages = spark.createDataFrame(
        [(1, "x " + item.upper() + "!"), (2, item.replace("fox", "fix")), (3, item[:30]), (4, None)],
        "doc_id long, text string")
    tests = spark.createDataFrame([(9, item), (8, "--"), (7, None)], "item_id long, text string")
    hits = {(r.doc_id, r.item_id, r.distance)
            for r in decontaminate.benchmark_hits(pages, tests).collect()}
    assert hits == {(1, 9, 0), (2, 9, 1)}


def test_maximal_segments_and_scores(spark):
    assert [s[:2] for s in toxicity.maximal_segments(
        np.array([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5.0]))] == [(0, 1), (2, 3), (4, 11)]
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(800):
        w = ["n%d" % rng.randrange(500) for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            w[20:24] = ["vile", "Awful,", "vile", "nasty"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(None, None), (900, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fitted(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r for r in toxicity.digest(toxicity.score_documents(docs, model)).collect()}
    held = [r for r in found.values() if r.held_out and r.doc_id < 800]
    assert len(held) > 100
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert found[None].predicted == found[900].predicted == 0
    empty = docs.where("doc_id < 0")
    assert toxicity.score_documents(empty, model).count() == 0


def test_sets_are_dealt_once(spark, monkeypatch):
    rng, written = random.Random(4), []
    base = [str(rng.randrange(10**6)) for _ in range(60)]
    texts = [" ".join([*base[:k], "changed", *base[k + 1:]]) for k in (5, 20, 40)] + ["other words"]
    docs = spark.createDataFrame([*enumerate(texts), (2, texts[2])], "doc_id long, text string")

    def noted(frame, purpose, *more):
        written.append(purpose)
        return materialise(frame, purpose, *more)

    monkeypatch.setattr(jaccard, "materialise", noted)
    found = sorted((r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs, 2, 80).collect())
    assert found == [(0, 0), (1, 0), (2, 0), (2, 0), (3, 3)]
    assert "pairs" in written and "sets" not in written


def _families():
    """Texts of random words: families of near copies, and pairs that have half their words in common."""
    rng, texts = random.Random(9), []

    def some(n):
        return [f"v{rng.randrange(10**6)}" for _ in range(n)]

    for size in (8, 60, 400):
        for _ in range(6):
            base = some(size)
            for k in range(5):
                at = rng.randrange(size)
                texts.append([*base[:at], *some(k * size // 40), *base[at:]])
        for _ in range(20):
            half = some(size)
            texts += [half + some(size), half + some(size)]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def test_pairs_that_share_half_are_not_compared_whole(spark, monkeypatch):
    texts, compared, root = _families(), [], {}
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    linked = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
              if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)

    def noted(frame, purpose, *more):
        written = materialise(frame, purpose, *more)
        if purpose == "pairs":
            compared.extend((r.a, r.b) for r in written.collect())
        return written

    monkeypatch.setattr(jaccard, "materialise", noted)
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 5, 80).collect()}
    assert found == {i: find(i) for i in range(len(texts))}
    assert len(linked) > 50
    far = [(a, b) for a, b in compared if 100 * len(sets[a] & sets[b]) < 60 * len(sets[a] | sets[b])]
    assert not far


def test_parities_bound_what_two_sets_have_in_common():
    rng = np.random.default_rng(5)
    for n, m, both in ((0, 3, 0), (1, 1, 1), (70, 900, 50), (400, 500, 390), (5000, 40, 40), (90_000, 70_000, 9)):
        values = rng.integers(0, 2**63, n + m - both, dtype=np.uint64)
        a, b = values[:n], values[n - both:]
        left, right = jaccard._parities(np.repeat([0, 1], [n, m]), np.append(a, b), np.array([n, m]))
        differ = jaccard._differing(left, right)
        assert differ <= n + m - 2 * both and (n + m - differ) % 2 == 0
        assert differ == jaccard._differing(right, left)
    assert jaccard._differing(left, right) > 10_000
