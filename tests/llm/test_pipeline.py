"""The whole pipeline on documents whose fate at every stage is known by construction."""

import random
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import attach


def corpus():
    rng = random.Random(21)
    words = ["%s%s%s" % (a, b, c) for a in "bdfgklm" for b in "aeiou" for c in ("nt", "rs", "l", "mp")]

    def line(n=14):
        return " ".join(rng.choice(words) + str(rng.randrange(10**4)) for _ in range(n))

    good = {i: "\n".join(line() for _ in range(12)) for i in range(60)}
    bench = "the answer to this question is %s and nothing else at all" % line(6)
    docs = dict(good)
    gone = defaultdict(set)
    docs[100], docs[101], docs[102] = "too short", "", None
    docs[103] = " ".join(["again and again"] * 40)  # three words over and over
    docs[104] = " ".join("#" * 9 for _ in range(80)) + " " + line(60)
    gone["quality rules"] = {100, 101, 102, 103, 104}
    docs[110] = good[3]  # all of its lines come earlier
    gone["line dedup"] = {110}
    near = good[5].split()
    near[40] = "changedword"
    docs[120] = " ".join(near)  # one long line, so no line of it comes earlier
    gone["n-gram Jaccard join"] = {120}
    docs[130] = good[7][:0] + line(30) + "\n" + bench + "\n" + line(30)
    gone["benchmark decontamination"] = {130}
    docs[140] = line(50) + "\n" + good[9].split("\n")[2] + "\n" + line(50)  # one line comes earlier
    return docs, gone, bench


def test_every_stage_and_the_sequences(spark, tmp_path):
    docs, gone, bench = corpus()
    rows = [(i, t, "en", "web", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
        4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")

    found = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = set(docs)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = f"{tmp_path}/stage{k}"
        stage(spark, found, str(tmp_path)).write.parquet(out)
        found = spark.read.parquet(out)
        left -= gone[name]
        assert {r.doc_id for r in found.collect()} == left, name
    texts = {r.doc_id: r.text for r in found.collect()}
    want = {i: docs[i] for i in left} | {140: "\n".join(docs[140].split("\n")[::2])}
    assert texts == want

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {i: len(encoder.encode(t, add_special_tokens=False).ids) + 1 for i, t in want.items()}
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append((p.piece, p.start, p.length))
        of_sequence[p.sequence_id].append((p.offset, p.length))
    assert set(of_doc) == left
    for i, parts in of_doc.items():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(parts)):
            assert (piece, start) == (k, at) and length <= 1024
            at += length
        assert at == lengths[i]
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_texts_stay_where_they_are_when_few_documents_go(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "none"), (3, "again")],
                                 "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        left = attach.without(docs, docs.where("doc_id % 3 = 0"))
        assert "SortMergeJoin" not in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [
            i for i in range(50) if i % 3]
        assert left.where("doc_id is null").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
