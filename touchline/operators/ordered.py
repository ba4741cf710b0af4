"""Running state in match order without gathering a whole key in one task.

Rows of a key are split into calendar blocks. The work over rows happens per (key, block);
only one small summary row per block is ever brought together per key, and the number of
blocks is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BlockOf = Callable[[Column], Column]


def calendar_year(match_date: Column) -> Column:
    return F.date_trunc("year", match_date).cast("date")


def running_totals(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    block_of: BlockOf = calendar_year,
) -> DataFrame:
    """``rows`` plus a running sum per entry of ``totals``, up to and including each row.

    ``order`` starts with the date the blocks are cut from.
    """
    blocked = rows.withColumn("_block", block_of(F.col(order[0])))
    inside = (Window.partitionBy(*keys, "_block").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = (Window.partitionBy(*keys).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = blocked.groupBy(*keys, "_block").agg(*[F.sum(v).alias(n) for n, v in totals.items()])
    offsets = sums.select(
        *keys, "_block", *[F.sum(n).over(before).alias(f"_{n}") for n in totals])
    local = blocked.withColumns({n: F.sum(v).over(inside) for n, v in totals.items()})
    joined = local.join(offsets, [*keys, "_block"])
    return joined.select(*rows.columns, *[
        (F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in totals])
