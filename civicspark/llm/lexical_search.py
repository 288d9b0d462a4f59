"""Ranked lexical search without an index: an Aho-Corasick automaton of all item terms reads the texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.words import text_blocks
from civicspark.session import cut, drop_cut

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Each byte of a text as the automaton reads it: A-Z lower-cased, what is in no term a space.
_READ = bytes((c + 32 if 65 <= c <= 90 else c) if _TERM.fullmatch(bytes([c])) else 32 for c in range(256))
_INSIDE = np.frombuffer(_READ, np.uint8) != 32


def terms_of(text: str | None) -> set[bytes]:
    return set((text or "").encode().translate(_READ).split())


def automaton(terms: list[bytes]):
    """Finds the terms by number; each stands between two spaces, so that it matches whole words alone."""
    import ahocorasick

    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, term in enumerate(terms):
        out.add_word(f" {term.decode('latin-1')} ", k)
    out.make_automaton()
    return out


def _counted(shared):
    """For each text its number of terms, and which of the items' terms it holds how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        find = automaton(terms) if terms else None
        for batch in batches:
            for first, data, offsets in text_blocks(batch.column(1)):
                inside = _INSIDE[data]
                before = np.r_[False, inside[:-1]] if len(inside) else inside
                before[offsets[:-1][offsets[:-1] < len(inside)]] = False
                starts = np.flatnonzero(inside & ~before)
                n = np.diff(np.searchsorted(starts, offsets))
                read, ends, held, often = data.tobytes().translate(_READ).decode("latin-1"), [0], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    found = np.fromiter((v for _, v in find.iter(f" {read[a:b]} ")), np.int32) if find else np.zeros(0, np.int32)
                    which, times = np.unique(found, return_counts=True)
                    held.append(which)
                    often.append(times)
                    ends.append(ends[-1] + len(which))
                list_of = lambda parts, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(kind)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n.astype(np.int64)), list_of(held, np.int32), list_of(often, np.int64)], names=["doc_id", "n", "terms", "times"])

    return run


class Best:
    """The k best (score, id) of each slot so far: highest score, then smallest id."""

    def __init__(self, slots: int, k: int):
        self.k, self.floor = k, np.full(slots, -np.inf)
        self.slot, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, id_ = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.id, id_]
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], id_[keep]
        full = place == self.k - 1
        self.floor[slot[full]] = score[full]


def _ranked(shared, total_docs: int, total_terms: int, k: int, most: int = 2_000_000):
    """The k best documents of each item among the rows of this task, by integer arithmetic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, items, n_items = shared.value
        best = Best(n_items, k)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            n = batch.column(1).to_numpy()
            ends = np.cumsum(np.r_[0, batch.column(2).value_lengths().to_numpy()])
            term, times = (batch.column(c).flatten().to_numpy() for c in (2, 3))
            m = np.repeat(50 + (50 * n * total_docs) // max(1, total_terms), np.diff(ends))
            part = weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m))
            work = np.cumsum(np.r_[0, (first[term + 1] - first[term])])[ends]
            a = 0
            while a < len(ids):
                b = max(a + 1, min(int(np.searchsorted(work, work[a] + most, "right")) - 1, a + max(1, most // max(1, n_items))))
                of = slice(ends[a], ends[b])
                count = first[term[of] + 1] - first[term[of]]
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[term[of]], count)
                doc = np.repeat(np.repeat(np.arange(b - a), np.diff(ends[a : b + 1])), count)
                score = np.bincount(doc * n_items + items[at], np.repeat(part[of], count).astype(np.float64), (b - a) * n_items).reshape(b - a, n_items)
                doc, item = np.nonzero((score > 0) & (score >= best.floor))
                best.add(item, score[doc, item], ids[a:b][doc])
                a = b
        yield pa.RecordBatch.from_arrays([pa.array(best.slot.astype(np.int32)), pa.array(best.id), pa.array(best.score.astype(np.int64))], names=["item", "doc_id", "score"])

    return run


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 50, block_items: int = 4096, block_chars: int = 8_000_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for each item, by term weights and saturated term counts.

    Terms are runs of 0-9, A-Z (lower-cased), a-z and all code points from 0x80. With N documents that have terms, L
    terms in them, n terms in a document, df documents that hold a term and tf times in one, a document's score is the
    sum over the item's distinct terms of w * ((10^9 tf) div (1000 tf + 20 m)), w = floor(1000 ln((2N+2)/(2df+1))), m =
    50 + (50 n N) div L. Only scores above 0 are ranked, ties to the smaller doc_id.

    Items are dealt into blocks of about `block_items` rows and `block_chars` characters, which bounds what is broadcast:
    the block's terms, then which item has which. For each block one pass over the texts counts with the automaton; the
    counts are written, sums over them give N, L and df, and a second pass over the counts keeps the k best of each item
    in each task. The few rows left are ranked in two steps, so that no task holds an item's rows of all tasks.

    Rows with a null text have no terms. Documents with a null id count in N, L and df but aren't returned; items with
    a null id or no terms have no rows. Each document row counts for itself, also if rows or ids repeat; item rows that
    share an id are one item with the terms of all. A very long text is read whole. Other columns are not used.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where("item_id is not null and text is not null").distinct()
    size = asked.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size.n // block_items), -(-(size.chars or 0) // block_chars))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        own: dict[int, set[bytes]] = {}
        for row in asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect():
            own.setdefault(row.item_id, set()).update(terms_of(row.text))
        own = {i: t for i, t in sorted(own.items()) if t}
        if own:
            out = out.union(_block(texts, own, k))
    return out


def _block(texts: DataFrame, own: dict[int, set[bytes]], k: int) -> DataFrame:
    spark = texts.sparkSession
    terms = sorted(set().union(*own.values()))
    number = {t: i for i, t in enumerate(terms)}
    sent = spark.sparkContext.broadcast(terms)
    counted = cut(texts.mapInArrow(_counted(sent), "doc_id long, n long, terms array<int>, times array<long>"))
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = F.floor(1000 * F.log((F.lit(2 * total.docs + 2).cast("double")) / (2 * F.count("*") + 1))).cast("long")
    weights = np.zeros(len(terms), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(weight.alias("w")).collect():
        weights[row.term] = row.w
    held: list[list[int]] = [[] for _ in terms]
    for item, mine in enumerate(own.values()):
        for t in mine:
            held[number[t]].append(item)
    first = np.cumsum([0, *map(len, held)])
    shared = spark.sparkContext.broadcast((weights, first, np.array([i for x in held for i in x], np.int64), len(own)))
    named = spark.createDataFrame(list(enumerate(own)), "item int, item_id long")
    found = counted.where("doc_id is not null").mapInArrow(_ranked(shared, total.docs, total.terms, k), "item int, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id")]
    near = Window.partitionBy("item", "part").orderBy(*order)
    some = found.withColumn("part", F.floor(F.spark_partition_id() / 64)).withColumn("place", F.row_number().over(near)).where(F.col("place") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    out = cut(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    drop_cut(counted)
    sent.unpersist()
    shared.unpersist()
    return out
