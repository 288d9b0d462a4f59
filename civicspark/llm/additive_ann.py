"""Nearest neighbours by additive quantisation: beam-searched codes, stored norms, table lookups, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicspark.session import cut, drop_cut


def train_codebooks(sample: np.ndarray, books: int, words: int, rounds: int = 8) -> np.ndarray:
    """[books, words, dimensions]: each codebook is a k-means of what the ones before leave over, of full dimension."""
    rest = sample.astype(np.float64)
    out = np.zeros((books, words, sample.shape[1]))
    random = np.random.default_rng(5)
    for b in range(books):
        centre = rest[random.choice(len(rest), words, replace=len(rest) < words)]
        for _ in range(rounds):
            near = _nearest(rest, centre)
            count = np.bincount(near, minlength=words)
            total = np.zeros_like(centre)
            np.add.at(total, near, rest)
            centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
        out[b] = centre
        rest = rest - centre[_nearest(rest, centre)]
    return out


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre**2).sum(1) - 2 * x @ centre.T, axis=1)


def encode(x: np.ndarray, books: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes [n, books] of the best sum of one word per codebook that a beam search finds; squared norms of the sums."""
    n, dim = x.shape
    rest = x[:, None, :].astype(np.float64)
    codes = np.zeros((n, 1, 0), np.uint8)
    for book in books:
        score = (book**2).sum(1) - 2 * rest @ book.T + (rest**2).sum(2, keepdims=True)
        flat = score.reshape(n, -1)
        take = min(beam, flat.shape[1])
        best = np.argpartition(flat, take - 1, axis=1)[:, :take]
        source, word = best // len(book), best % len(book)
        rest = np.take_along_axis(rest, source[:, :, None], 1) - book[word]
        codes = np.concatenate([np.take_along_axis(codes, source[:, :, None], 1), word[:, :, None].astype(np.uint8)], axis=2)
    best = np.argmin((rest**2).sum(2), axis=1)
    pick = np.arange(n)
    return codes[pick, best], ((x - rest[pick, best]) ** 2).sum(1)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): v as doubles; without null ids and vectors that are null, zero or hold null or non-finite numbers."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


def _indexed(books: np.ndarray, beam: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                codes, norms = encode(x, books, beam)
                ids = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([y.tobytes()], pa.binary()) for y in (x, codes, norms, ids)], names=["vectors", "codes", "norms", "ids"])

    return run


def _nearer(best: tuple[np.ndarray, np.ndarray], gap: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the k nearest of those so far and the new ones, ties to the smaller id."""
    gap, ids = np.concatenate([best[0], gap], 1), np.concatenate([best[1], ids], 1)
    order = np.lexsort((ids, gap), axis=-1)[:, :k]
    return np.take_along_axis(gap, order, 1), np.take_along_axis(ids, order, 1)


def _searched(books: np.ndarray, shared, k: int, rerank: int, at_once: int = 256):
    """The k nearest to each query of the block among the index entries of this task, held as two small arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, asked = shared.value
        best = (np.full((len(own), k), np.inf), np.full((len(own), k), -1, np.int64))
        for batch in batches:
            for row in range(batch.num_rows):
                vectors, codes, norms, ids = (batch.column(c)[row].as_py() for c in ("vectors", "codes", "norms", "ids"))
                norms, ids = np.frombuffer(norms), np.frombuffer(ids, np.int64)
                x = np.frombuffer(vectors).reshape(len(ids), -1)
                codes = np.frombuffer(codes, np.uint8).reshape(len(ids), -1)
                take = min(rerank, len(ids))
                for a in range(0, len(own), at_once):
                    q, me = asked[a : a + at_once], own[a : a + at_once]
                    near = np.repeat(norms[None, :], len(q), axis=0)
                    for b, book in enumerate(books):
                        near -= 2 * (q @ book.T)[:, codes[:, b]]
                    found = np.argpartition(near, take - 1, axis=1)[:, :take]
                    gap = np.sqrt(((x[found] - q[:, None, :]) ** 2).sum(2))
                    gap[ids[found] == me[:, None]] = np.inf
                    part = _nearer((best[0][a : a + at_once], best[1][a : a + at_once]), gap, ids[found], k)
                    best[0][a : a + at_once], best[1][a : a + at_once] = part
        query, place = np.nonzero(np.isfinite(best[0]))
        for a in range(0, len(query), 100_000):
            some = query[a : a + 100_000], place[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own[some[0]]), pa.array(best[1][some]), pa.array(best[0][some])], names=["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, k: int = 10, books: int = 24, words: int = 128, beam: int = 4, sample: int = 8192, chunk: int = 4096, rerank: int = 64, query_block: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id is divisible by `every` its k nearest other rows.

    Codebooks are fitted on at most `sample` vectors, taken by hash of the id; every row is indexed. Of equal vectors
    the k + 1 smallest distinct ids are entries, all that a list of k can hold, so a hot vector costs no more than that.
    Entries are packed into chunks of `chunk` and stay where they are. Queries are dealt into blocks of about
    `query_block`, which bounds what is broadcast; each block is one pass over the index, in which a task scores its
    chunks by lookup tables over the codes and stored norms, ranks the `rerank` best of each chunk by exact
    double-precision distances on the original vectors, and gives the k best of all its chunks. The k best over all
    tasks are ranked, ties to smaller ids.

    Null ids, vectors null, empty, zero, or with null or non-finite numbers take no part, nor do vectors that differ
    from the most common dimension. An id that repeats counts with each of its distinct vectors as candidate and as
    query; its own rows are not its candidates. Without valid rows: no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = valid_vectors(vectors, id_col, vector_col)
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    dim = dims[0].d
    rows = rows.where(F.size("v") == dim)
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    learned = train_codebooks(np.unique(np.array(drawn["v"].to_pylist()), axis=0), books, words)
    first = Window.partitionBy("v").orderBy("id")
    entries = rows.withColumns({"at": F.dense_rank().over(first), "before": F.lag("id").over(first)}).where((F.col("at") <= k + 1) & (F.col("before").isNull() | (F.col("before") != F.col("id"))))
    index = cut(entries.select("v", "id").mapInArrow(_indexed(learned, beam, chunk), "vectors binary, codes binary, norms binary, ids binary"))
    asked = rows.where(F.pmod("id", F.lit(every)) == 0).select("id", "v").distinct()
    blocks = max(1, -(-asked.count() // query_block))
    asked = cut(asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = None
    for block in range(blocks):
        own = asked.where(F.col("block") == block).select("id", "v").toArrow()
        shared = spark.sparkContext.broadcast((own["id"].to_numpy(), np.array(own["v"].to_pylist(), np.float64).reshape(len(own), dim)))
        found = index.mapInArrow(_searched(learned, shared, k, rerank), "query_id long, vec_id long, score double").distinct()
        ranked = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        shared.unpersist()
        out = ranked if out is None else out.union(ranked)
    drop_cut(asked)
    drop_cut(index)
    return out
