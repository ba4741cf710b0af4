"""K-means whose result can be checked: the same centers on any number of partitions.

Features are whole numbers (thousandths), centers too, so the sums that make a center are exact in whatever
order rows are added up, and a distance is computed from one row alone. The first center is the
row with the least id, each further one the row farthest from all centers so far (ties: least id). Then
Lloyd's rounds follow, each one grouped aggregation over all rows, until no center moves or
``MAX_ROUNDS`` are done. A row belongs to the nearest center, the first one if several are. A center
without rows stays where it is. Only the centers, a handful of numbers, come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.sources.sinks import materialise

SCALE = 1000
MAX_ROUNDS = 20
#: Half, and a little more, so that a value on a tie doesn't depend on its last bit.
HALF = 0.5000001


def points(rows: DataFrame, features: list[str]) -> DataFrame:
    """``Id`` and the features ``x`` in thousandths; rows lacking a feature are left out."""
    whole = [F.floor(F.col(f).cast("double") * SCALE + HALF).cast("bigint") for f in features]
    return rows.where(F.col("Id").isNotNull()).select("Id", F.array(*whole).alias("x")).where(
        ~F.exists("x", lambda v: v.isNull()))


def _literal(centers: list[list[int]]) -> Column:
    # Held beside the compiled code, not in it, so that all rounds share what is compiled.
    return F.array(*[F.array(*[F.lit(v).cast("bigint") for v in c]) for c in centers])


def _distances(centers: list[list[int]]) -> Column:
    """Squared distances to all centers, added up feature by feature."""
    def distance(c: Column) -> Column:
        parts = F.zip_with("x", c, lambda a, b: (a - b).cast("double") * (a - b).cast("double"))
        return F.aggregate(parts, F.lit(0.0), lambda s, d: s + d)

    return F.transform(_literal(centers), distance)


def nearest(centers: list[list[int]]) -> Column:
    bound = F.transform(F.array(_distances(centers)), lambda d: F.array_position(d, F.array_min(d)))
    return (bound[0] - 1).cast("int")


def first_centers(rows: DataFrame, k: int) -> list[list[int]]:
    first = rows.agg(F.min_by("x", "Id")).first()[0]
    centers = [] if first is None else [first]
    while centers and len(centers) < k:
        apart = F.array_min(_distances(centers))
        centers.append(rows.agg(F.max_by("x", F.struct(apart, -F.col("Id")))).first()[0])
    return centers


def moved_centers(rows: DataFrame, centers: list[list[int]]) -> list[list[int]]:
    """The means of the rows nearest to each center, rounded down."""
    sums = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}")
            for i in range(len(centers[0]))]
    found = rows.groupBy(nearest(centers).alias("cluster")).agg(F.count("*").alias("n"), *sums)
    moved = list(centers)
    for row in found.collect():  # one row for each center
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(len(sums))]
    return moved


def fitted_centers(rows: DataFrame, k: int) -> list[list[int]]:
    centers = first_centers(rows, k)
    for _ in range(MAX_ROUNDS if centers else 0):
        before, centers = centers, moved_centers(rows, centers)
        if centers == before:
            break
    return centers


def clusters(rows: DataFrame, features: list[str], k: int) -> DataFrame:
    """(Id, prediction) of all rows that have every feature."""
    # Dealt to all cores: the rows are small, and as files come they are read by one or two tasks.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    known = materialise(points(rows, features).repartition(cores, "Id"), "points")
    centers = fitted_centers(known, k)
    if not centers:
        return known.select("Id", F.lit(0).alias("prediction"))
    return known.select("Id", nearest(centers).alias("prediction"))
