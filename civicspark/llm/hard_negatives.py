"""Hard negatives by segment summaries: means and deviations of vector segments bound scores before they are computed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.lexical_search import Best
from civicspark.session import cut, drop_cut

#: Segments per level, coarse to fine; each level's segments are cut from those of the one before.
LEVELS = (1, 4, 16)
_MOST = 2.0**26


def summaries(x: np.ndarray, segments: int) -> np.ndarray:
    """[vectors, 2 * segments]: mean and deviation of each segment, both times the root of its length.

    The product of two vectors over a segment of length l lies within l * (means' product +- deviations' product).
    """
    bounds = np.unique(np.arange(segments) * x.shape[1] // segments)
    length = np.diff(np.r_[bounds, x.shape[1]])
    mean = np.add.reduceat(x, bounds, axis=1) / length
    rest = np.maximum(np.add.reduceat((x - np.repeat(mean, length, axis=1)) ** 2, bounds, axis=1), 0)
    return np.concatenate([mean * np.sqrt(length), np.sqrt(rest)], axis=1)


def _indexed(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(part.num_rows, -1)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
                sums = [summaries(x.astype(np.float64), s).tobytes() for s in LEVELS]
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.binary()) for y in (ids.tobytes(), labels.tobytes(), x.tobytes())] + [pa.array([sums], pa.list_(pa.binary()))], names=["ids", "labels", "vectors", "sums"])

    return run


def _scores(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 65_536) -> np.ndarray:
    """Exact integer products of the pairs (a, b): in doubles while they hold them, else in 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    kind = np.float64 if most < 2.0**53 else np.int64
    q, x = q.astype(kind), x.astype(kind)
    return np.concatenate([np.zeros(0, kind), *(np.einsum("ij,ij->i", q[a[i : i + at_once]], x[b[i : i + at_once]]) for i in range(0, len(a), at_once))])


def _within(q_sums: list[np.ndarray], x_sums: list[np.ndarray], may: np.ndarray, low: np.ndarray, high: np.ndarray, at_once: int = 65_536) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) among `may` whose bounds on every level meet [low[a], high[a]]: all pairs on the coarsest level,
    on each finer one those that are left."""
    means, devs = (part @ other.T for part, other in zip(np.split(q_sums[0], 2, 1), np.split(x_sums[0], 2, 1), strict=True))
    slack = 1e-6 + 1e-9 * (np.abs(means) + devs)
    a, b = np.nonzero(may & (means + devs + slack >= low[:, None]) & (means - devs - slack <= high[:, None]))
    for qs, xs in zip(q_sums[1:], x_sums[1:], strict=True):
        keep = np.zeros(len(a), bool)
        half = qs.shape[1] // 2
        for i in range(0, len(a), at_once):
            u, v = a[i : i + at_once], b[i : i + at_once]
            each = qs[u] * xs[v]
            mean, dev = each[:, :half].sum(1), each[:, half:].sum(1)
            slack = 1e-6 + 1e-9 * (np.abs(mean) + dev)
            keep[i : i + at_once] = (mean + dev + slack >= low[u]) & (mean - dev - slack <= high[u])
        a, b = a[keep], b[keep]
    return a, b


def _chunks(batches: Iterator[pa.RecordBatch], dim: int):
    for batch in batches:
        for row in range(batch.num_rows):
            ids, labels = (np.frombuffer(batch.column(c)[row].as_py(), np.int64) for c in (0, 1))
            sums = [np.frombuffer(y).reshape(len(ids), -1) for y in batch.column(3)[row].as_py()]
            yield ids, labels, np.frombuffer(batch.column(2)[row].as_py(), np.int32).reshape(len(ids), dim), sums


def _rows(best: Best) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.id), pa.array(best.score.astype(np.int64))], names=["slot", "vec_id", "score"])


def _positives(shared, k: int, at_once: int = 256):
    """The k best other vectors of the same label for each anchor, among this task's chunks; slots are anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, labels, q = shared.value
        sums = [summaries(q.astype(np.float64), s) for s in LEVELS]
        best, top = Best(len(own), k), np.full(len(own), np.inf)
        for ids, kinds, x, x_sums in _chunks(batches, q.shape[1]):
            for i in range(0, len(own), at_once):
                of = slice(i, i + at_once)
                may = (labels[of, None] == kinds) & (own[of, None] != ids)
                a, b = _within([s[of] for s in sums], x_sums, may, best.floor[of], top[of])
                best.add(a + i, _scores(q[of], x, a, b), ids[b])
        yield _rows(best)

    return run


def _negatives(shared, low: np.ndarray, high: np.ndarray, k: int, at_once: int = 256):
    """The k best vectors of other labels in each anchor's score windows [low, high] (one per positive), among this
    task's chunks; slots are anchor * windows + window. A window without a positive is empty: low above high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, labels, q = shared.value
        sums = [summaries(q.astype(np.float64), s) for s in LEVELS]
        windows = low.shape[1]
        best = Best(len(own) * windows, k)
        for ids, kinds, x, x_sums in _chunks(batches, q.shape[1]):
            for i in range(0, len(own), at_once):
                of = slice(i, i + at_once)
                floor = np.where(low[of] > high[of], np.inf, np.maximum(low[of], best.floor.reshape(-1, windows)[of]))
                a, b = _within([s[of] for s in sums], x_sums, labels[of, None] != kinds, floor.min(1), high[of].max(1))
                score = _scores(q[of], x, a, b)
                for j in range(windows):
                    fits = (score >= floor[a, j]) & (score <= high[of][a, j])
                    best.add((a[fits] + i) * windows + j, score[fits], ids[b[fits]])
        yield _rows(best)

    return run


def _best_of(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def scaled_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, x): x = floor(256 * component) as integers; rows that take part only."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * 256 >= _MOST))
    return rows.where("id is not null and label is not null and size(v) > 0").where(~bad).select("id", "label", F.transform("v", lambda x: F.floor(x * 256).cast("int")).alias("x"))


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, every: int = 100, positives: int = 5, k: int = 10, least: int = 30, most: int = 90, chunk: int = 1024, anchor_block: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row whose id is divisible
    by `every` (anchors) and each of its `positives` best rows of the same label, the k best rows of other labels whose
    score s fulfils least * p <= 100 * s <= most * p, p being the positive's score.

    A score is the inner product of vectors whose components are floor(256 * x), an integer; ties go to smaller ids.
    `label` is a column, by default `label`.

    Every vector is packed into chunks together with its segments' means and deviations on three levels (1, 4 and 16
    segments); chunks are written once and stay in place. Anchors are dealt into blocks of about `anchor_block`, which
    bounds what is broadcast. A block passes over the chunks twice: for the positives, then for the negatives in the
    windows that the positives set. A pair's score lies within the sum over segments of length * (product of means +-
    product of deviations); pairs whose bounds can't reach the window or the task's k-th best so far are left out level
    by level, and only the rest are scored, exactly. So results don't depend on the bounds. Each task gives the k best of
    its chunks and the k best over all tasks are ranked. Work grows with anchors times vectors at worst.

    Rows with a null id, label or vector, an empty vector, or a null, non-finite or extreme component (256 * |x| of 2^26
    or more, whose products could leave 64 bits) take no part, nor do vectors that differ from the most common
    dimension. A zero vector takes part. Equal rows count once; of equal vectors with equal label the max(positives, k) +
    1 smallest ids are candidates, all that a list can hold, so that a hot vector costs no more; all are anchors. An
    id with several vectors is an anchor with each, and never its own positive. Other columns are not used.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = scaled_vectors(vectors, id_col, vector_col, F.col("label") if label is None else label)
    dims = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0].d
    rows = cut(rows.where(F.size("x") == dim).distinct())
    place = F.row_number().over(Window.partitionBy("label", "x").orderBy("id"))
    entries = rows.withColumn("place", place).where(F.col("place") <= max(positives, k) + 1).select("id", "label", "x")
    index = cut(entries.mapInArrow(_indexed(chunk), "ids binary, labels binary, vectors binary, sums array<binary>"))
    asked = rows.where(F.col("id") % every == 0)
    blocks = max(1, -(-asked.count() // anchor_block))
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if not len(own):
            continue
        ids, labels = own["id"].to_numpy(), own["label"].to_numpy()
        q = np.array(own["x"].to_pylist(), np.int32).reshape(len(own), dim)
        shared = spark.sparkContext.broadcast((ids, labels, q))
        found = "slot long, vec_id long, score long"
        best = _best_of(index.mapInArrow(_positives(shared, positives), found), positives).toArrow()
        slot, rank, score = (best[c].to_numpy() for c in ("slot", "rank", "score"))
        low, high = np.full((len(own), positives), np.inf), np.full((len(own), positives), -np.inf)
        low[slot, rank - 1], high[slot, rank - 1] = -(-least * score // 100), most * score // 100
        chosen = spark.createDataFrame(best.select(["slot", "rank", "vec_id", "score"]).append_column("anchor_id", pa.array(ids[slot])))
        windows = chosen.select((F.col("slot") * positives + F.col("rank") - 1).alias("slot"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        ranked = _best_of(index.mapInArrow(_negatives(shared, low, high, k), found), k)
        out = out.union(cut(ranked.join(F.broadcast(windows), "slot").selectExpr("anchor_id", "positive_id", "rank", "vec_id negative_id", "positive_score", "score negative_score")))
        shared.unpersist()
    drop_cut(rows)
    drop_cut(index)
    return out
