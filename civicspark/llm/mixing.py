"""Mixing sources: shares are tempered by an exponent, and the weights realised as budgeted block permutations. Native."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.joins import spread_join
from civicspark.session import cut, reading

_EXACT = "decimal(38,24)"  # sums of these are the same in any order


def estimated_tokens(text: Column) -> Column:
    """A quarter of the text's bytes, and one token for the end."""
    return (F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4) + 1).cast("long")


def _moments(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent a: (sum of p^a, sum of p^a ln p) over the sources."""
    p = F.col("share")
    sums = []
    for a in exponents:
        power = F.pow(p, F.lit(a))
        sums += [F.sum(power.cast(_EXACT)), F.sum((power * F.ln(p)).cast(_EXACT))]
    row = [float(x) for x in sources.agg(*sums).first()]
    return list(zip(row[::2], row[1::2], strict=True))


def find_exponent(sources: DataFrame, budget_share: float, entropy: float, most_repeats: float, rounds: int = 4, parts: int = 32) -> float:
    """The largest exponent in [0, 1] whose weights reach `entropy` (as a share of ln n), unless that repeats a source
    more than `most_repeats` times: then the smallest exponent that doesn't.

    Entropy falls and repetition falls as the exponent grows, so the bracket is bisected; each round takes five
    bisections with one aggregate over the sources, which looks at all the points that they may come to (`parts`).
    """
    n, least = sources.agg(F.count("*"), F.min("share")).first()
    if not n or n == 1:
        return 1.0
    target = entropy * math.log(n)

    def spread_enough(a: float, z: float, s: float) -> bool:
        return math.log(z) - a * s / z >= target - 1e-12

    def few_repeats(a: float, z: float, s: float) -> bool:
        return budget_share * least ** (a - 1) / z <= most_repeats + 1e-12

    def edge(good, from_top: bool) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(rounds):
            grid = [lo + (hi - lo) * k / parts for k in range(parts + 1)]
            ok = [good(a, *m) for a, m in zip(grid, _moments(sources, grid), strict=True)]
            if from_top:  # good up to a point
                k = max((i for i, x in enumerate(ok) if x), default=None)
                if k is None or k == parts:
                    return lo if k is None else hi
                lo, hi = grid[k], grid[k + 1]
            else:  # good from a point on
                k = min((i for i, x in enumerate(ok) if x), default=None)
                if k is None or k == 0:
                    return hi if k is None else lo
                lo, hi = grid[k - 1], grid[k]
        return lo if from_top else hi

    return max(edge(spread_enough, True), edge(few_repeats, False))


def _placed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", budget_share: float = 1.0, entropy: float = 0.98, most_repeats: float = 2.0, block_tokens: int = 200_000, schedule_blocks: int | None = None, seed: int = 17) -> tuple[DataFrame, int]:
    """(row: struct of all columns, tokens, weight, epochs, position, copies: array of (copy, block, order)), and the number of blocks."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("src"),
        F.col(f"`{source_col}`").isNull().alias("none"),
        estimated_tokens(F.col(f"`{text_col}`")).alias("tokens"),
        F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("key"),
    )
    of = ["src", "none"]
    narrow = cut(rows.groupBy(*of, "key", "tokens").agg(F.count("*").alias("n")))
    by_source = cut(narrow.groupBy(*of).agg(F.sum(F.col("tokens") * F.col("n")).alias("total"), F.count("*").alias("keys"), F.sum("n").alias("n")))
    everything = by_source.agg(F.sum("total")).first()[0] or 1
    blocks = schedule_blocks or max(1000, int(everything * budget_share / 2_000_000))
    sources = by_source.withColumn("share", F.col("total") / F.lit(float(everything)))
    a = find_exponent(sources, budget_share, entropy, most_repeats)
    z = _moments(sources, [a])[0][0] if not by_source.isEmpty() else 1.0
    weight = F.pow("share", F.lit(a)) / F.lit(z)
    plan = cut(
        sources.select(
            *of, "total", weight.alias("weight"), (weight * F.lit(budget_share * everything) / F.col("total")).alias("epochs"),
            F.greatest(F.lit(1), F.ceil(F.col("total") / block_tokens)).alias("parts"),
        )
    )
    dealt = spread_join(narrow, plan, of, by_source.select(*of, F.col("keys").alias("n")), ["key"]).withColumn("part", F.pmod(F.xxhash64("key", F.lit(seed)), "parts"))
    sums = dealt.groupBy(*of, "part").agg(F.sum(F.col("tokens") * F.col("n")).alias("size"))
    before = Window.partitionBy(*of).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*of, "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*of, "part").orderBy(F.xxhash64("key", F.lit(seed + 1)), "key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum(F.col("tokens") * F.col("n")).over(inside), F.lit(0))
    placed = dealt.withColumn("ahead", ahead).join(starts, [*of, "part"]).withColumn("position", (F.col("start") + F.col("ahead")).cast("long"))
    more = F.col("position") + F.col("tokens") / 2 <= (F.col("epochs") - F.floor("epochs")) * F.col("total")
    times = (F.floor("epochs") + F.when(more, 1).otherwise(0)).cast("int")
    at = lambda copy: (copy + F.col("position") / F.col("total")) / F.greatest(F.col("epochs"), F.lit(1e-12))
    copy = lambda c: F.struct(c.alias("copy"), F.least(F.floor(at(c) * blocks), F.lit(blocks - 1)).cast("int").alias("block"), F.xxhash64("key", c, F.lit(seed + 2)).alias("order"))
    copies = F.when(times > 0, F.transform(F.sequence(F.lit(0), times - 1), copy)).otherwise(F.array().cast("array<struct<copy:int,block:int,order:bigint>>"))
    known = placed.select(*of, "key", "weight", "epochs", "position", copies.alias("copies"))
    out = rows.join(known, [*of, "key"])
    return reading(out.drop(*of, "key"), narrow, by_source, plan), blocks


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """Every row of docs with a struct column `mix`: (tokens, weight, epochs, copies, position, block, blocks).

    Weight of a source: its token share to the found exponent, normalised; its budget is weight * budget_share * all
    tokens, which is `epochs` times its own tokens. Documents are dealt into blocks of about `block_tokens` by a
    seeded hash, blocks follow one another, and within a block rows are ordered by a second hash: a permutation of the
    source, in which a document stands at `position`, counted in tokens. The source is read along it `epochs` times:
    a document is taken floor(epochs) times, and once more if the middle of it lies within the rest of the budget.
    All copies have a place in a schedule of `schedule_blocks` equal blocks (unless given, of 2 000 000 tokens, and 1000 at
    least), each with the target weights: `blocks` has the block of each copy, `block` the first (null without copies).

    Options: id_col, source_col, text_col, budget_share, entropy, most_repeats, block_tokens, schedule_blocks, seed.
    Ranks are taken on (source, hash of id and text, tokens); texts are shuffled once. Null source: a source of its
    own. Null or empty text: one token. Repeated rows share a position and count each; null ids count as rows. Texts
    may be of any length. An empty table gives none. Columns of docs keep their names and values; one named `mix` is
    replaced.
    """
    out, _ = _placed(docs, **options)
    blocks = F.transform("copies", lambda c: c["block"])
    mix = F.struct("tokens", "weight", "epochs", F.size("copies").alias("copies"), "position", F.get(blocks, F.lit(0)).alias("block"), blocks.alias("blocks"))
    return reading(out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != "mix"], mix.alias("mix")), out)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs as they are to be read: a row for each copy, none for 0 copies, in the schedule's order: read one
    after the other, the partitions hold the blocks in order, with the copies in a block in the order of a seeded hash.

    Same columns, whatever they are called. Options, nulls, repeats and empty tables as for mix_sources.
    """
    out, blocks = _placed(docs, **options)
    each = out.select("row", F.explode("copies").alias("copy")).select("row", "copy.block", "copy.order")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = each.repartitionById(n, F.floor(F.col("block") * n / blocks).cast("int"))
    return reading(dealt.sortWithinPartitions("block", "order").select("row.*"), out)
