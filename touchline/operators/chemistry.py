"""Pairwise chemistry.

Chemistry is kept sparse: a pair that never shared a pitch has the initial value and no row.
Each match contributes one signed change per pair of its participants. They are gathered by match
and paired inside the row; all of them come from one match record, which bounds the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import codes, formulas

PAIR = ["player1", "player2"]
#: Ids of a block of dense pairs.
BLOCK_ROWS = 256


def participants(history: DataFrame) -> DataFrame:
    """Who was on the pitch at the end or came on, and how far their rating moved."""
    return history.where("in_chemistry").select(
        "matchId", "match_date", "teamId", "playerId",
        (F.col("rating") - F.col("previous_rating")).alias("move"))


def match_pairs(people: DataFrame) -> DataFrame:
    """Unordered pairs of one match, lower id first, with both moves.

    The participants of a match are gathered once; a match record bounds how many there are.
    """
    matches = people.where("matchId IS NOT NULL").groupBy("matchId", "match_date").agg(F.expr(
        "array_sort(collect_list(struct(playerId, teamId, move))) AS people"))
    pairs = """inline(flatten(transform(people, (p, i) -> transform(
        slice(people, i + 2, size(people)), q -> struct(
            p.playerId AS player1, q.playerId AS player2, p.teamId AS team1, q.teamId AS team2,
            p.move AS move1, q.move AS move2)))))"""
    return matches.selectExpr("matchId", "match_date", pairs).where("player1 < player2").withColumn(
        "same_team", F.col("team1") == F.col("team2"))


def chemistry_deltas(history: DataFrame) -> DataFrame:
    """Signed change of every pair in every match."""
    change = formulas.chemistry_change(F.col("move1"), F.col("move2"), F.col("same_team"))
    return match_pairs(participants(history)).select(
        *PAIR, "matchId", "match_date", "same_team", change.alias("delta"))


def chemistry_table(deltas: DataFrame) -> DataFrame:
    """Current value of every pair that has shared a pitch."""
    value = F.lit(codes.INITIAL_CHEMISTRY) + F.sum("delta")
    return deltas.groupBy(*PAIR).agg(value.alias("chemistry"))


def chemistry_as_of(deltas: DataFrame) -> DataFrame:
    """Value of every pair right after each match they shared.

    A pair has one row per shared match, beside those of all other pairs of that match, so no
    pair can hold a large share of the rows and one window over the pair is enough.
    """
    so_far = (Window.partitionBy(*PAIR).orderBy("match_date", "matchId")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.lit(codes.INITIAL_CHEMISTRY) + F.sum("delta").over(so_far)
    return deltas.withColumn("chemistry", value)


def pair_key(id1: Column, id2: Column) -> list[Column]:
    return [F.least(id1, id2).alias("player1"), F.greatest(id1, id2).alias("player2")]


def lookup(pairs: DataFrame, chemistry: DataFrame) -> DataFrame:
    """Chemistry of given pairs, the initial value for those without a row."""
    value = F.coalesce("chemistry", F.lit(codes.INITIAL_CHEMISTRY))
    return pairs.join(chemistry, PAIR, "left").withColumn("chemistry", value)


def dense_pairs(ids: DataFrame, group: list[str] | None = None, block_rows: int = BLOCK_ROWS
                ) -> DataFrame:
    """All unordered pairs of the ids (column ``playerId``) of each group, lower id first.

    Ids are dealt to blocks of about ``block_rows``, and only pairs of blocks are made, each with its
    place in the upper triangle as a key: a task holds two blocks at a time, however many ids
    there are, and an id is copied once for each block, not for each partner.
    """
    group = group or []
    known = ids.select(*group, "playerId").where("playerId IS NOT NULL").distinct()
    sizes = known.groupBy(*group).agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    if group:
        sizes = sizes.withColumnsRenamed({g: f"{g}_2" for g in group})
        same = [F.col(g).eqNullSafe(F.col(f"{g}_2")) for g in group]
        dealt = known.join(sizes, same).select(*group, "playerId", "blocks")
    else:
        dealt = known.join(F.broadcast(sizes))  # one row
    block = F.pmod(F.xxhash64("playerId"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("block", block)
    upper = dealt.select(*group, F.col("playerId").alias("id1"), F.col("block").alias("row"),
                         F.explode(F.sequence("block", F.col("blocks") - 1)).alias("col"))
    lower = dealt.select(*[F.col(g).alias(f"{g}_2") for g in group], F.col("playerId").alias("id2"),
                         F.explode(F.sequence(F.lit(0), F.col("block"))).alias("row_2"),
                         F.col("block").alias("col_2"))
    met = [F.col(g).eqNullSafe(F.col(f"{g}_2")) for g in group]
    pairs = upper.join(lower, [*met, F.col("row") == F.col("row_2"), F.col("col") == F.col("col_2")])
    # In a block with itself every pair comes twice.
    once = pairs.where((F.col("row") < F.col("col")) | (F.col("id1") < F.col("id2")))
    return once.select(*group, *pair_key(F.col("id1"), F.col("id2")))


def dense_chemistry(ids: DataFrame, chemistry: DataFrame, group: list[str] | None = None
                    ) -> DataFrame:
    """Chemistry of all pairs of the given ids, those included that never shared a pitch."""
    return lookup(dense_pairs(ids, group), chemistry)
