"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.joins import FEW
from civicspark.session import cut, drop_cut


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that can be reached.

    Each round is a few joins and partial aggregates over the edges, never a group in one task's memory, and ends in
    a table in the shared folder. They end when each node has one edge to a smaller one that has none itself, or when
    nothing changes, after about log2(longest path) rounds. Null ends and loops are ignored; no edges give no rows.
    """
    pair = lambda a, b: (F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    now = cut(edges.where(F.col(left) != F.col(right)).select(*pair(left, right)).distinct())
    seen = _sum(now)
    while True:
        few = lambda table: F.broadcast(table) if seen[0] <= FEW else table  # noqa: B023, E731
        both = now.selectExpr("hi u", "lo v").union(now.selectExpr("lo u", "hi v"))
        least = few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").selectExpr("v hi", "m lo").where("hi > lo")
        low = cut(large.groupBy("hi").agg(F.min("lo").alias("m")))
        hooked = large.join(few(low), "hi").selectExpr("m", "explode(array(hi, lo)) hi").selectExpr("hi", "m lo")
        then = cut(hooked.where("hi > lo").distinct())
        drop_cut(now)
        total, now = _sum(then), then
        single = total == _sum(low.selectExpr("hi", "m lo"))
        drop_cut(low)
        inner = now.selectExpr("lo hi")
        if total == seen or single and now.join(few(inner), "hi", "left_semi").isEmpty():
            out = cut(now.selectExpr("hi node", "lo component").union(now.selectExpr("lo node", "lo component").distinct()))
            drop_cut(now)
            return out
        seen = total


def _sum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
    return tuple(row)
