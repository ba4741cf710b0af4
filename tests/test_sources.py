"""Line numbers over files and splits, small files, snapshots and merging."""

import json
import random

import pytest

from touchline.sources import files, numbering
from touchline.sources.sinks import latest_per_key, shared_folder
from touchline.sources.snapshots import Kept, Snapshots


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_lines_of_several_files_and_splits(spark, tmp_path, small_splits):
    rng = random.Random(2)
    want = []
    for name, count in (("a.txt", 57), ("b.txt", 0), ("c.txt", 400), ("d.txt", 1)):
        lines = ["%s%d %s" % (name, i, "x" * rng.randrange(40)) for i in range(count)]
        want += lines
        (tmp_path / name).write_text("".join(line + "\n" for line in lines))
    lines = numbering.text_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 8
    got = numbering.numbered(lines).orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in got] == list(enumerate(want))


def test_a_file_without_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    assert numbering.numbered(numbering.text_lines(spark, str(tmp_path))).count() == 0


def test_a_small_file_is_never_replaced(spark, tmp_path):
    path = f"{tmp_path}/sub/one"
    files.write_new(spark, path, "first é")
    with pytest.raises(FileExistsError):
        files.write_new(spark, path, "second")
    assert files.read_text(spark, path) == "first é"
    assert files.names(spark, f"{tmp_path}/none") == []


TABLES = {
    "sums": Kept("k BIGINT, n BIGINT", lambda rows: rows.groupBy("k").sum("n").toDF("k", "n")),
    "versions": Kept("k BIGINT, day DATE, v BIGINT, batch_id BIGINT",
                     lambda rows: latest_per_key(rows, ["k"]).select("k", "day", "v", "batch_id"),
                     "day"),
    "never": Kept("k BIGINT"),
}


def add(spark, store, name, batch):
    if name == "sums":
        rows = spark.createDataFrame([(batch % 3, batch), (7, 1)], "k BIGINT, n BIGINT")
    else:
        rows = spark.range(1).selectExpr(
            f"{batch % 4}L AS k", f"date_add(DATE'2024-01-01', {batch % 4}) AS d", f"{batch}L AS v"
        ).withColumnRenamed("d", "day")
    rows.coalesce(1).write.parquet(f"{store.folder}/{name}/batch_id={batch}")


def test_merged_parts_hold_what_the_batches_held(spark):
    store = Snapshots(spark, shared_folder(spark, "store"), TABLES, merge_after=3)
    assert store.read(store.latest(), "sums").count() == 0
    seen = []
    for batch in range(20):
        for name in ("sums", "versions"):
            add(spark, store, name, batch)
        seen.append(store.publish())
    last = store.latest()
    assert (last.number, last.of("sums")["upto"]) == (20, 19)
    # Two parts a level at most, and levels grow with the logarithm of the batches.
    assert max(store.files_of(view, "sums") for view in seen) <= 6
    assert store.files_of(last, "versions") <= 6
    sums = {r.k: r.n for r in TABLES["sums"].reduced(store.read(last, "sums")).collect()}
    assert sums == {0: 63, 1: 70, 2: 57, 7: 20}
    newest = TABLES["versions"].reduced(store.read(last, "versions"))
    assert sorted((r.k, r.v, r.batch_id) for r in newest.collect()) == [
        (k, 16 + k, 16 + k) for k in range(4)]
    days = {n for part in files.names(spark, f"{store.folder}/versions.merged")
            for n in files.names(spark, f"{store.folder}/versions.merged/{part}")}
    assert {f"day=2024-01-0{d}" for d in range(1, 5)} <= days
    # An older view still reads what it read.
    old = {r.k: r.n for r in TABLES["sums"].reduced(store.read(seen[4], "sums")).collect()}
    assert old == {0: 3, 1: 5, 2: 2, 7: 5}


def test_batches_that_are_not_published_are_not_read(spark):
    store = Snapshots(spark, shared_folder(spark, "store"), TABLES)
    add(spark, store, "sums", 0)
    first = store.publish()
    add(spark, store, "sums", 1)
    # A batch that is being written has no mark of completion yet.
    spark.range(1).selectExpr("5L AS k", "5L AS n").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{store.folder}/sums/batch_id=2")
    assert store.read(store.latest(), "sums").count() == 2
    assert store.read(store.now(), "sums").count() == 4
    assert store.read(first, "never").count() == 0


def test_a_thousand_batches_are_few_parts(spark):
    """The parts that a read lists, by the manifest alone."""
    store = Snapshots(spark, shared_folder(spark, "store"), TABLES)
    parts = []

    class Reduced:
        def __init__(self):
            self.write = self

        def parquet(self, path):
            pass

    store._read_parts = lambda name, due: Reduced()
    store.tables = {"sums": Kept("k BIGINT", lambda rows: rows)}
    most = 0
    for batch in range(1000):
        parts = store._merged("sums", parts + [{"path": f"sums/batch_id={batch}", "level": 0}])
        most = max(most, len(parts))
    assert most <= 15 * 3 and json.dumps(parts)


def test_splits_grow_with_the_files(spark, tmp_path):
    """Small files have several splits, large ones not thousands."""
    from catalog import queries
    from touchline.sources.bridge import Bridge

    (tmp_path / "a.txt").write_text("x" * 99 + "\n")
    (tmp_path / "b.txt").write_text(("x" * 99 + "\n") * 100_000)
    with queries.small_splits(Bridge(spark, ""), str(tmp_path)):
        assert 8 < spark.read.text(str(tmp_path)).rdd.getNumPartitions() <= 2 * queries.SPLITS
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "16384"
