"""Consistent views of several tables that streams add to batch by batch.

Every table has a folder for each batch. A *manifest* names the parts of all tables that belong
together; it is a small file that appears by an atomic rename, numbered one higher than the one before.
Whoever reads through a manifest sees the same parts however many batches are added meanwhile.

Parts are merged in tiers: as soon as a table has ``merge_after`` parts of a level, they are read, reduced
by the rule of the table (for example to the newest version of each key), written day by day as one
part of the next level, and replaced in the next manifest. A row is written once for each level, and
a read lists at most ``merge_after`` parts a level, so a logarithm of the number of batches. Parts
that have been replaced stay where they are for those who still read an older manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.sources import files

#: Digits of a manifest's number, so that names sort by number.
DIGITS = 12


@dataclass(frozen=True)
class Kept:
    """A table: its columns, how parts are reduced when merged, and (SQL) the day of its rows."""

    schema: str
    reduced: Callable[[DataFrame], DataFrame] = lambda rows: rows
    day: str | None = None

    @property
    def columns(self) -> StructType:
        return StructType.fromDDL(self.schema)


@dataclass
class Snapshot:
    """What a manifest says: its number, and for each table its parts (path, level) and the batches
    they hold: all from 0 to ``upto``, and those in ``extra``."""

    number: int = 0
    tables: dict[str, dict] = field(default_factory=dict)

    def of(self, name: str) -> dict:
        return self.tables.get(name, {"parts": [], "upto": -1, "extra": []})


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, Kept],
                 merge_after: int = 16):
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), tables
        self.merge_after = merge_after

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/_manifests/{number:0{DIGITS}d}.json"

    def latest(self) -> Snapshot:
        numbers = [int(n[:DIGITS]) for n in files.names(self.spark, f"{self.folder}/_manifests")
                   if n.endswith(".json") and n[:DIGITS].isdigit()]
        return self.numbered(max(numbers)) if numbers else Snapshot()

    def numbered(self, number: int) -> Snapshot:
        if number == 0:
            return Snapshot()
        return Snapshot(number, json.loads(files.read_text(self.spark, self._manifest(number))))

    def _batches(self, name: str) -> list[int]:
        """Ids of all batches that have a folder."""
        return sorted(int(n.removeprefix("batch_id="))
                      for n in files.names(self.spark, f"{self.folder}/{name}")
                      if n.startswith("batch_id="))

    def now(self) -> Snapshot:
        """The latest manifest and all batches written since, for the steps that make the tables."""
        last = self.latest()
        return Snapshot(last.number, {name: self._grown(name, last.of(name)) for name in self.tables})

    def _grown(self, name: str, known: dict) -> dict:
        # Only of batches that no manifest holds yet it is asked whether they are written whole.
        new = [i for i in self._batches(name)
               if (i > known["upto"] or (i < 0 and i not in known["extra"]))
               and files.is_complete(self.spark, f"{self.folder}/{name}/batch_id={i}")]
        parts = [{"path": f"{name}/batch_id={i}", "level": 0} for i in new]
        return {"parts": known["parts"] + parts, "upto": max([known["upto"], *new]),
                "extra": known["extra"] + [i for i in new if i < 0]}

    def publish(self) -> Snapshot:
        """Make all that has been written whole one consistent view, merging parts where due."""
        found = self.now()
        for name, table in found.tables.items():
            table["parts"] = self._merged(name, table["parts"])
        found.number += 1
        files.write_new(self.spark, self._manifest(found.number), json.dumps(found.tables))
        return found

    def _merged(self, name: str, parts: list[dict]) -> list[dict]:
        level = 0
        while any(p["level"] >= level for p in parts):
            due = [p for p in parts if p["level"] == level]
            if len(due) >= self.merge_after:
                path = f"{name}.merged/part={level + 1}-{uuid.uuid4().hex}"
                kept = self.tables[name]
                rows = kept.reduced(self._read_parts(name, due))
                writer = rows.write
                if kept.day is not None:
                    # Days are dealt to files by size, so that a large day is not one task.
                    rows = rows.withColumn("day", F.expr(kept.day))
                    writer = rows.hint("rebalance", "day").write.partitionBy("day")
                writer.parquet(f"{self.folder}/{path}")
                parts = [p for p in parts if p["level"] != level] + [
                    {"path": path, "level": level + 1}]
            level += 1
        return parts

    def _read_parts(self, name: str, parts: list[dict]) -> DataFrame:
        schema = self.tables[name].columns
        found = self.spark.createDataFrame([], schema)
        for is_batch in (True, False):
            paths = [f"{self.folder}/{p['path']}" for p in parts if (p["level"] == 0) == is_batch]
            if paths:
                base = f"{self.folder}/{name}" + ("" if is_batch else ".merged")
                rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
                found = found.unionByName(rows.select(schema.names))
        return found

    def read(self, snapshot: Snapshot, name: str) -> DataFrame:
        return self._read_parts(name, snapshot.of(name)["parts"])

    def files_of(self, snapshot: Snapshot, name: str) -> int:
        """How many parts a read of the table lists."""
        return len(snapshot.of(name)["parts"])
