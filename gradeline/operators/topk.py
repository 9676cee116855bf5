"""Best rows per group, for one date or as of many dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The first date there is; the days up to the last one, 9999-12-31, are fewer than 2**22
CALENDAR_START = "0001-01-01"
CALENDAR_LEVELS = 22


def top_k(
    df: DataFrame,
    group: Sequence[str],
    best_first: Sequence[Column],
    k: int,
    rank: str = "rank",
    spread_by: str | None = None,
    spread: int = 64,
) -> DataFrame:
    """The ``k`` best rows of every group with their rank.

    Spark applies the limit before the shuffle too, so a group costs at most ``k`` rows per input
    partition. With ``spread_by`` the groups are first reduced in ``spread`` parts each, for inputs
    of so many partitions that even those rows are too many for one task.
    """
    if spread_by is not None:
        part = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(spread))
        window = Window.partitionBy(*group, "_part").orderBy(*best_first)
        df = (
            df.withColumn("_part", part)
            .withColumn("_rn", F.row_number().over(window))
            .where(F.col("_rn") <= k)
            .drop("_rn", "_part")
        )
    window = Window.partitionBy(*group).orderBy(*best_first)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def as_of_top_k(
    candidates: DataFrame,
    requests: DataFrame,
    group: str,
    day: str,
    as_of: str,
    best_first: Sequence[Column],
    k: int,
    rank: str = "rank",
) -> DataFrame:
    """The ``k`` best candidates dated on or before every requested date, exactly.

    Candidates are cut to ``k`` per group and day, which can lose none of the answer. Each then
    enters the calendar blocks (of 1, 2, 4, ... days) around its day, blocks are cut to ``k``, and a
    request reads the few blocks that make up all days up to its date. Every join is an equality;
    no request meets every earlier day.
    """
    start = F.lit(CALENDAR_START).cast("date")
    daily = top_k(candidates, [group, day], best_first, k, rank="_rn").drop("_rn")
    # Only even-numbered blocks are ever read: they sit to the left of a set bit of the request.
    blocks = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(CALENDAR_LEVELS - 1)),
            lambda level: F.struct(
                level.alias("level"),
                F.call_function("shiftright", F.datediff(F.col(day), start), level).alias("block"),
            ),
        ),
        lambda b: b["block"] % 2 == 0,
    )
    placed = daily.select("*", F.explode(blocks).alias("_b")).select("*", "_b.*").drop("_b")
    block_best = top_k(placed, [group, "level", "block"], best_first, k, rank="_rn").drop("_rn")

    after = F.datediff(F.col(as_of), start) + 1
    needed = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(CALENDAR_LEVELS - 1)),
            lambda level: F.struct(
                level.alias("level"), (F.call_function("shiftright", after, level) - 1).alias("block")
            ),
        ),
        lambda b: b["block"] % 2 == 0,
    )
    wanted = (
        requests.select(group, as_of).distinct()
        .select("*", F.explode(needed).alias("_b")).select(group, as_of, "_b.*")
    )
    found = wanted.join(block_best, [group, "level", "block"]).drop("level", "block")
    return top_k(found, [group, as_of], best_first, k, rank)
