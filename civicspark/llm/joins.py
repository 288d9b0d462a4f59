"""Joins of many rows with one row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a few numbers each that are broadcast, some 2 MB, so that the rows that meet them are not shuffled.
FEW = 100_000


def looked_up(table: DataFrame) -> DataFrame:
    """A written table of narrow rows as the side of a join that is looked up: broadcast, unless it has more than FEW rows."""
    return F.broadcast(table) if table.count() <= FEW else table


def spread_join(many: DataFrame, one: DataFrame, on: list[str], sizes: DataFrame, by: list[str], most_hot: int = 2000, how: str = "inner", total: int | None = None) -> DataFrame:
    """many.join(one, on), where the rows of a hot key are dealt over several parts, each of which meets a copy of its row of `one`.

    `sizes` has (*on, n), the number of rows of `many` for each key. Keys with at least 1 / `most_hot` of all rows are
    hot: there are at most `most_hot` of them, so their list is broadcast. Parts are taken by a hash of the columns `by`.
    `total`, the number of all rows of `many`, is summed from `sizes` unless it is given.
    """
    total = (sizes.agg(F.sum("n")).first()[0] or 0) if total is None else total
    floor = max(1000, total // most_hot)
    hot = F.broadcast(sizes.where(F.col("n") > floor).select(*on, F.ceil(F.col("n") / floor).cast("int").alias("__parts")))
    parts = F.coalesce("__parts", F.lit(1))
    dealt = many.join(hot, on, "left").withColumn("__part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("__parts")
    copies = one.join(hot, on, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt.join(copies, [*on, "__part"], how).drop("__part")
