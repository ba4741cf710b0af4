"""Grammars, extensions and runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from touchline.llm import runs
from touchline.llm.grammar import Grammar


def runs_by_force(s, least):
    found, n = {}, len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and s[k] == s[k + q]:
                k += 1
            if k + q - i >= max(least, 2 * q) and (i, k + q) not in found:
                found[i, k + q] = q
            i = max(k, i) + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=60))
def test_extensions(sequence):
    grammar, n = Grammar(np.array(sequence)), len(sequence)
    i, j = np.meshgrid(np.arange(n), np.arange(n + 1))
    i, j = i.ravel(), j.ravel()
    keep = i != j
    i, j = i[keep], j[keep]
    want = []
    for a, b in zip(i.tolist(), j.tolist()):
        k = 0
        while a + k < n and b + k < n and sequence[a + k] == sequence[b + k]:
            k += 1
        want.append(k)
    assert grammar.extensions(i, j).tolist() == want


def _periodic(rng):
    out = []
    while len(out) < 150:
        block = [rng.randrange(3) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13]))]
        out += block * rng.randrange(1, 9) + block[:rng.randrange(len(block))]
    return out


@pytest.mark.parametrize("least", [12, 8, 2])
def test_runs_of_many_sequences(least):
    rng = random.Random(least)
    fib = [0], [0, 1]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    sequences = [fib[1], [0] * 300, [0] * 11, [0] * 12, [], [1], list(range(40)) * 3,
                 [rng.randrange(2) for _ in range(400)], list(range(30))]
    sequences += [_periodic(rng) for _ in range(60)]
    got = runs.runs_of([np.array(s, np.int64) for s in sequences], least)
    assert got == [runs_by_force(s, least) for s in sequences]


def test_long_sequences_take_no_quadratic_time():
    n = 1_000_000
    rng = np.random.default_rng(2)
    got = runs.runs_of([np.zeros(n, np.int64), np.tile(rng.integers(0, 9, 777), n // 777),
                        np.tile(np.array([0, 1]), n // 2)])
    assert got[0] == [(0, n, 1)] and got[2] == [(0, n, 2)]
    assert (0, n // 777 * 777, 777) in got[1]


def planted(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    found = runs_by_force(words, 12)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    lines = "".join("%d,%d,%d\n" % r for r in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed.encode()).hexdigest())


SCHEMA = "doc_id long, text string, runs int, n_words string, p int"


def test_query_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(
        rng.choice("ab cé d".split() if i % 2 else ["w%d" % k for k in range(50)])
        for _ in range(rng.randrange(90))), 1, "x", 2) for i in range(300)]
    rows += [(1000, None, 1, None, 2), (1001, "", 1, "", 2), (1002, " \n", 1, "", 2), (3, rows[3][1], 1, "", 2),
             (None, "a b " * 20, None, None, None), (1003, "x y z " * 400, 1, "", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = runs.digest(runs.find_runs(runs.with_planted_runs(docs))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        (expected(r[0], r[1]) for r in rows), key=str)


def test_columns_and_empty_table(spark):
    empty = runs.find_runs(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "text", "p", "runs", "collapsed", "n_words"]
    assert runs.digest(empty).count() == 0
