"""What every operator and every stage of the pipeline must take: nulls, empty and very long texts,
ties, repeated rows, an empty table, and columns with the names that are used inside."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import (
    decontaminate,
    lines,
    packing,
    pii,
    quality,
    queries,
    secrets,
    toxicity,
)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, gone string,"
          " _key string, n_lines string, n_removed string, row string, size string, id string,"
          " hash string, chunk string, runs string, label string, kept string, norm string")
EXTRA = ("g", "k", "l", "r", "w", "s", "i", "h", "c", "u", "b", "p", "n")


def rows():
    rng = random.Random(9)
    words = ["word%d" % i for i in range(200)]

    def some(n):
        return " ".join(rng.choice(words) for _ in range(n))

    long_line = some(150_000)
    texts = ["", None, " \n\t", some(60), "\n".join(some(12) for _ in range(8)), long_line,
             some(80), some(80).upper()]
    texts += [texts[3], texts[4], texts[4].replace("word1", "word2", 1)]
    found = [(i, t, "en" if i % 2 else None, "web" if i % 3 else None, 5, *EXTRA)
             for i, t in enumerate(texts)]
    return found + [found[3], found[3], (None, texts[3], None, None, None, *EXTRA),
                    (None, None, None, None, None, *[None] * len(EXTRA))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of tables as the queries read them, and one in which they are empty."""
    out = {}
    for name, found in (("full", rows()), ("empty", [])):
        path = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(found, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
        bench = [(1, "one benchmark item that is in no document at all")] if found else []
        spark.createDataFrame(bench, "item_id long, text string").write.parquet(
            f"{path}/benchmark.parquet")
        marks = [(i, i % 2, i % 2) for i in range(8)] if found else []
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(
            f"{path}/labels.parquet")
        vectors = [(i, [float(i % 3), None if i == 4 else 1.0], i % 2) for i in range(9)] * 2
        spark.createDataFrame(vectors if found else [],
                              "vec_id long, embedding array<float>, label int").write.parquet(
            f"{path}/embeddings.parquet")
        out[name] = path
    return out


PER_ROW = ["op2_personal_data", "op3_ngram_jaccard", "op5_line_dedup", "op6_substring_dedup",
           "op7_secret_scans", "op8_sharding", "op9_toxicity", "op10_quality_rules",
           "op11_periodic_runs", "op13_exact_dedup"]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_operators(spark, folder, name):
    got = queries.QUERIES[name](spark, folder["full"])
    assert len(set(got.columns)) == len(got.columns)
    count = len(got.collect())
    if name in PER_ROW:
        assert count == len(rows())
    assert queries.QUERIES[name](spark, folder["empty"]).collect() == []


@pytest.mark.parametrize("kind", ["full", "empty"])
def test_stages(spark, folder, kind):
    docs = spark.read.parquet(f"{folder[kind]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder[kind])
        assert kept.columns == docs.columns, name
        found = {(r.doc_id, r.source) for r in docs.collect()}
        assert {(r.doc_id, r.source) for r in kept.collect()} <= found, name
    assert (corpus_pipeline.run(spark, folder[kind]).count() > 0) == (kind == "full")


def test_clashing_columns_come_out_as_they_went_in(spark, folder):
    docs = spark.read.parquet(f"{folder['full']}/documents.parquet")
    bench = spark.read.parquet(f"{folder['full']}/benchmark.parquet")
    assert {r._key for r in decontaminate.remove_contaminated(docs, bench).collect()} == {"k", None}
    cut = lines.remove_lines(docs)
    assert {r.gone for r in cut.collect()} == {"g", None}
    assert dict(cut.dtypes)["n_lines"] == "bigint"


def secret_text(n):
    return " ".join("password = secret%d\n" % i for i in range(n))


def seconds(run):
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def test_secrets_take_linear_time(spark):
    def scan(n):
        frame = spark.createDataFrame([(1, secret_text(n))], "doc_id long, text string")
        return secrets.scan(frame).select(F.size("findings")).first()[0]

    assert scan(15_000) == 15_000
    assert seconds(lambda: scan(60_000)) < 6 * max(seconds(lambda: scan(15_000)), 0.5)


def test_places_of_secrets_across_parts(spark):
    text = "é" + secret_text(1000) + "AKIA" + "A" * 20
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = secrets.scan(frame).select("findings").first()[0]
    want = [m.span() for m in re.finditer(
        r"""(?i:password)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text)]
    assert [(f.start, f.end) for f in found if f.kind == "assign"] == want


def segments_by_force(weights):
    """Maximal segments by definition: the best segment, then those to its left and right."""
    best = None
    total = np.append(0, np.cumsum(weights))
    for i in range(len(weights)):
        for j in range(i + 1, len(weights) + 1):
            score = total[j] - total[i]
            if score > 0 and (best is None or score > best[2]):
                best = i, j, score
    if best is None:
        return []
    i, j, _ = best
    return segments_by_force(weights[:i]) + [best] + [
        (a + j, b + j, s) for a, b, s in segments_by_force(weights[j:])]


def test_segments_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(300):
        # Fractions, so that no two segments score the same.
        weights = rng.integers(-4, 4, 14) + rng.random(14) * 1e-3
        assert [s[:2] for s in toxicity.maximal_segments(weights)] == [
            s[:2] for s in segments_by_force(weights)]


def test_segments_take_linear_time():
    def scan(n):
        weights = np.where(np.arange(n) % 2, 1.0, -1.1)
        return seconds(lambda: toxicity.maximal_segments(weights))

    scan(1000)
    assert scan(200_000) < 12 * max(scan(20_000), 0.01)


def measured(rng, i, source):
    size = 12 if source == "long" else 4
    return " ".join("x" * max(1, round(rng.gauss(size, 0.4))) + str(rng.randrange(999))
                    for _ in range(120))


def test_sketches_decide_by_source(spark):
    """Words that are usual in one source are an exception in the other; verdicts never change."""
    rng = random.Random(3)
    found = [(i, measured(rng, i, s), "en", s) for i in range(800)
             for s in ["long" if i % 2 else "short"]]
    found += [(1000, measured(rng, 0, "long"), "en", "short"), (1001, measured(rng, 0, "short"), "en",
                                                                "long")]
    docs = spark.createDataFrame(found, "doc_id long, text string, lang string, source string")
    verdicts = [sorted((r.doc_id, r.kept) for r in quality.digest(quality.judged(
        docs.repartition(n), ["doc_id"])).collect()) for n in (2, 7)]
    assert verdicts[0] == verdicts[1]
    assert [i for i, kept in verdicts[0] if not kept] == [1000, 1001]


def test_quartiles_of_sketches(spark):
    rng = random.Random(1)
    values = [rng.lognormvariate(1, 1) if i % 5 else 0.0 for i in range(4000)]
    frame = spark.createDataFrame([(v,) for v in values], "word_length double").withColumns(
        {n: F.lit(0.0) for n in quality.MEASURES if n != "word_length"}).withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string")})
    found = quality.quartiles(quality.sketches(frame.repartition(5)), ["lang", "source"])
    row = found.where("measure = 'word_length'").first()
    want = np.quantile(values, [0.25, 0.75])
    assert row["rows"] == 4000 and [row["q1"], row["q3"]] == pytest.approx(list(want), rel=0.02)


def test_base_spans_against_patterns(spark):
    """Counts of the base kinds on odd strings, against Python's own patterns."""
    rng = random.Random(12)
    parts = ["a@b.co", "x.y+z@mail-1.org.uk", "@", ".", "1.2.3.4", "256.1.1.1", "+49 (30) 1234-567",
             "+1", "4111 1111 1111 1111", "4111111111111112", " ", "\n", "é", "-", "9", "0.0.0.0.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]

    def luhn(digits):
        total = 0
        for k, d in enumerate(reversed(digits)):
            n = int(d) * (2 if k % 2 else 1)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    def counts(text):
        ip = [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
        card = [d for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                for d in [re.sub("[^0-9]", "", m[0])] if 16 <= len(d) <= 19 and luhn(d)]
        phone = [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                 if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        mail = re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", text)
        return len(mail), len(ip), len(card), len(phone)

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = pii.digest(pii.find_personal_data(docs, pii.fitted(docs))).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got} == {
        i: counts(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("kind", ["triplets", "middling"])
def test_evolution_saves_sequences_where_best_fit_falls_short(kind):
    """Lengths that only fit together in certain threes: fewer bins than best-fit decreasing."""
    rng = np.random.default_rng(1)
    if kind == "triplets":
        pairs = rng.integers(256, 400, (200, 2))
        sizes = [int(x) for a, b in pairs for x in (a, b, 1024 - a - b)]
    else:
        sizes = [int(x) for x in rng.integers(200, 500, 600)]
    decreasing = packing._packed(np.argsort(-np.array(sizes), kind="stable"), sizes, 1024)
    best = packing.evolved(sizes, 1024, 0, [])
    assert sorted(i for g in best for i in g) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in g) <= 1024 for g in best)
    assert len(best) <= len(decreasing) - 3


def test_the_tagger_finds_forms_that_the_patterns_do_not_know(spark, sf_dir):
    """Values never seen in training, put into other texts; look-alikes stay alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tagger = pii.fitted(docs)
    rng = np.random.default_rng(99)
    plain = ["".join(c for c in r.text if not c.isdigit() and c not in "@+")[:900]
             for r in docs.where("length(text) > 900").limit(40).collect()]
    rows_, want = [], {}
    for i in range(200):
        forms = pii._forms(rng)
        kind, value = forms[(5, 7)[i % 2]] if i < 100 else forms[9 + i % 7]
        text = plain[i % len(plain)]
        at = text.index(" ", int(rng.integers(50, 700)))
        rows_.append((i, f"{text[:at]} {value} {text[at:]}"))
        want[i] = f"{kind}:{at + 1}:{at + 1 + len(value)}"
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(
        spark.createDataFrame(rows_, "doc_id long, text string"), tagger)).collect()}
    assert sum(want[i] in got[i].split(",") for i in range(100)) >= 80
    assert sum(got[i] != "" for i in range(100, 200)) <= 4
