"""Exact duplicates against brute force: nulls, empty and long texts, ties, repeated rows."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from touchline.llm import copies

SCHEMA = "doc_id long, text string, row string, hash int, size int, kept string, place int"


def rows():
    rng = random.Random(1)
    texts = ["", None, " \n", "a b", "ab", "a\tb ", "a b", "é b", "é\nb", "x" * 300_000,
             "x" * 299_999 + " x", "ab" * 40 + "1", "ab" * 40 + "2", "\U0001f600 1", "\U0001f6001"]
    found = [(i, t, "r", 1, 2, "no", 3) for i, t in enumerate(texts * 2)]
    found += [(100 + i, "copy " + " " * rng.randrange(3) + "of many", None, 1, 2, "no", 3)
              for i in range(200)]
    found += [(7, "a b", "r", 1, 2, "no", 3), (None, "ab", "r", 1, 2, "no", 3),
              (None, "alone", None, None, None, None, None), (7, "two  of it", "p", 1, 2, "no", 3),
              (7, "two  of it", "q", 1, 2, "no", 3)]
    return found


def expected(found):
    groups = defaultdict(list)
    for doc_id, text, *_ in found:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(doc_id, best[0], len(members), (doc_id, size) == best, digest)
                for doc_id, size in members]
    return sorted(out, key=str)


def test_copies(spark):
    found = rows()
    docs = spark.createDataFrame(found, SCHEMA).repartition(5)
    got = copies.digest(copies.copies(docs, ["doc_id"], True)).collect()
    assert sorted(map(tuple, got), key=str) == expected(found)


def test_only_survivors_are_hashed(spark):
    docs = spark.createDataFrame([(1, "one"), (2, "two, other size"), (3, "eno"), (4, "same"),
                                  (5, "sa me")], "doc_id long, text string")
    got = {r.row.doc_id: r.hash for r in copies.copies(docs, ["doc_id"]).collect()}
    assert [k for k, v in got.items() if v is None] and got[4] == got[5] is not None


def test_full_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(copies, "LEAST_BITS", 1)
    monkeypatch.setattr(copies, "MOST_BITS", 1)
    found = rows()
    docs = spark.createDataFrame(found, SCHEMA)
    got = copies.digest(copies.copies(docs, ["doc_id"], True)).collect()
    assert sorted(map(tuple, got), key=str) == expected(found)


def test_without_copies_keeps_one_row_a_group(spark):
    found = rows()
    docs = spark.createDataFrame(found, SCHEMA).repartition(4)
    kept = copies.without_copies(docs)
    assert kept.columns == docs.columns
    norms = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert sorted(norms) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t, *_ in found})


@pytest.mark.parametrize("every", [True, False])
def test_empty_table(spark, every):
    docs = spark.createDataFrame([], SCHEMA)
    assert copies.copies(docs, ["doc_id"], every).count() == 0
    assert copies.without_copies(docs).count() == 0
