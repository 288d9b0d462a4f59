"""LM scoring by a probabilistic suffix tree over the bytes of the tokens, beside a word unigram base score."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.words import _LOWER, _SPACE, mix, text_blocks, word_hashes, word_spans
from civicspark.session import cut

DEPTH = 6
_END = mix(np.array([0x656E64], np.uint64))  # the end token's key
END_KEY = int(_END.view(np.int64)[0])
_FLUSH = 800_000  # keys that a task holds of each kind
_SLICE = 100_000
_NEWLINE = 10
_LN10 = float(np.log(10))
_HALF = float(np.log10(0.5))


def token_bytes(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text as its lower-cased words, each with a blank after it, and a newline at the end; and the offsets.

    So no token's spelling starts another's: the probabilities of all tokens that can come next sum to at most 1."""
    counts = np.diff(first)
    total = np.r_[0, np.cumsum(ends - starts + 1)]
    out_offsets = np.r_[0, np.cumsum(total[first[1:]] - total[first[:-1]] + 1)]
    out = np.full(out_offsets[-1], 32, np.uint8)
    inside = np.ones(len(out), bool)
    inside[total[1:] - 1 + np.repeat(np.arange(len(counts)), counts)] = False  # the blank after each word
    inside[out_offsets[1:] - 1] = False
    out[inside] = _LOWER[data[~_SPACE[data]]]
    out[out_offsets[1:] - 1] = _NEWLINE
    return out, out_offsets


def gram_keys(stream: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte: the byte, and above it the `depth` bytes before it, nearest first; 0 before a text's start."""
    keys = stream.astype(np.uint64)
    place = np.arange(len(stream)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(1, depth + 1):
        past = np.zeros(len(stream), np.uint64)
        past[k:] = stream[:-k] if k <= len(stream) else 0
        past[place < k] = 0
        keys |= past << np.uint64(8 * k)
    return keys


class _Counts:
    """Counts of keys, merged as they come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.size += len(self.parts[-1][0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in self.parts]), len(keys)).astype(np.int64)
        self.parts, self.size = [(keys, counts)], len(keys)
        return keys, counts


def _count(depth: int):
    def rows(kind: int, counts: _Counts) -> Iterator[pa.RecordBatch]:
        keys, n = counts.merge()
        for a in range(0, max(1, len(keys)), _SLICE):
            part = keys[a : a + _SLICE].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(n[a : a + _SLICE])], names=["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [_Counts(), _Counts()]
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0)):
                starts, ends, first = word_spans(data, offsets)
                kept[0].add(word_hashes(data, starts, ends))
                kept[0].parts.append((_END, np.array([len(offsets) - 1])))
                kept[1].add(gram_keys(*token_bytes(data, offsets, starts, ends, first), depth))
                for k in (0, 1):
                    if kept[k].size > _FLUSH:
                        kept[k].merge()
                    if len(kept[k].parts) == 1 and kept[k].size > _FLUSH // 2:
                        yield from rows(k, kept[k])
                        kept[k] = _Counts()
        for k in (0, 1):
            yield from rows(k, kept[k])

    return run


@dataclass
class SuffixTree:
    """The tree as an automaton: a state for each kept context, which is the longest one that ends the bytes read."""

    symbols: np.ndarray  # byte -> symbol; bytes that training lacks share the last one
    log10: np.ndarray  # [state * n + symbol]
    step: np.ndarray  # [state * n + symbol]
    n: int
    start: int
    depth: int
    states: int

    @classmethod
    def build(cls, length: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, kept: np.ndarray, depth: int, strength: float) -> SuffixTree:
        """Rows are (context, next byte, count), a context's `length` bytes as an integer, nearest byte lowest; `kept`
        marks the contexts that passed the divergence test. States are filled length by length, as arrays."""
        order = np.lexsort((context, length))
        length, context, symbol, n, kept = length[order], context[order], symbol[order], n[order], kept[order]
        new = np.ones(len(n), bool)
        new[1:] = (length[1:] != length[:-1]) | (context[1:] != context[:-1])
        first = np.flatnonzero(new)
        names = [int(c).to_bytes(8, "little")[:d][::-1] for c, d in zip(context[first], length[first], strict=True)]
        known = {name: k for k, name in enumerate(names)}
        wanted = {b""}
        for k in np.flatnonzero(kept[first]):  # with a context go its suffixes and prefixes, so that one step leads from state to state
            c = names[k]
            wanted |= {c[a:b] for a in range(len(c)) for b in range(a + 1, len(c) + 1)}
        states = sorted((c for c in wanted if not c or c in known), key=lambda c: (len(c), c))
        number = {c: k for k, c in enumerate(states)}
        seen = np.unique(symbol)
        symbols = np.full(256, len(seen), np.int64)
        symbols[seen] = np.arange(len(seen))
        width = len(seen) + 1
        p = np.full((len(states), width), 0.5, np.float32)
        step = np.zeros((len(states), width), np.int32)
        row_state = np.array([number.get(c, -1) for c in names], np.int64)[np.cumsum(new) - 1] if len(n) else np.zeros(0, np.int64)
        sizes = np.array([len(c) for c in states])
        shorter = np.array([number[c[1:]] for c in states])
        for d in range(depth + 1):
            level = np.flatnonzero(sizes == d)
            if not len(level):
                continue
            prior = 0.5 * 256 if d == 0 else strength
            if d:
                p[level] = strength * p[shorter[level]]
                step[level] = step[shorter[level]]
            rows = np.flatnonzero((row_state >= 0) & (length == d))
            at = row_state[rows]
            p[at, symbols[symbol[rows]]] += n[rows]
            total = np.zeros(len(states))
            np.add.at(total, at, n[rows])
            p[level] /= (total[level] + prior)[:, None].astype(np.float32)
            longer = np.flatnonzero(sizes == d + 1)
            if len(longer):
                step[[number[states[k][:-1]] for k in longer], symbols[[states[k][-1] for k in longer]]] = longer
        start = bytes(depth)
        while start not in number:
            start = start[1:]
        np.log10(p, out=p)
        step *= width
        return cls(symbols, p.ravel(), step.ravel(), width, number[start] * width, depth, len(states))

    def arrays(self) -> tuple:
        """The tree as plain arrays and numbers, which executors can read without this package."""
        return self.symbols, self.log10, self.step, self.start, self.depth

    def score(self, stream: np.ndarray, offsets: np.ndarray, segment: int = 512) -> np.ndarray:
        """log10 probability of each text."""
        return np.add.reduceat(np.r_[byte_scores(self.arrays(), stream, offsets, segment), 0.0], offsets[:-1])


def byte_scores(tree: tuple, stream: np.ndarray, offsets: np.ndarray, segment: int = 512) -> np.ndarray:
    """log10 probability of each byte after those before it in its text. Texts are cut into segments that all advance
    together; one that isn't at a text's start reads the `depth` bytes before it first, which settles its state."""
    symbol_of, log10, step, begin, depth = tree
    sizes = np.diff(offsets)
    per = -(-sizes // segment)
    text = np.repeat(np.arange(len(sizes)), per)
    at = offsets[:-1][text] + (np.arange(len(text)) - np.repeat(np.r_[0, np.cumsum(per)][:-1], per)) * segment
    stop = np.minimum(at + segment, offsets[1:][text])
    order = np.argsort(at - stop, kind="stable")
    text, at, stop = text[order], at[order], stop[order]
    symbols = symbol_of[stream]
    state = np.where(at == offsets[:-1][text], begin, 0)
    for k in range(depth, 0, -1):
        reads = np.flatnonzero(at - offsets[:-1][text] >= segment)
        state[reads] = step[state[reads] + symbols[at[reads] - k]]
    out = np.zeros(len(stream), np.float64)
    alive = np.searchsorted(at - stop, -np.arange(1, segment + 1), "right")
    for k, m in enumerate(alive):
        if not m:
            break
        now = state[:m] + symbols[at[:m] + k]
        out[at[:m] + k] = log10[now]
        state[:m] = step[now]
    return out


def _tree(grams: DataFrame, depth: int, least_share: float, least_gain: float, strength: float) -> SuffixTree:
    """Keeps contexts by aggregates and joins; at most 1 / least_share contexts of each length come to the driver."""
    levels = grams.select(F.explode(F.array(*[F.lit(d) for d in range(depth + 1)])).alias("d"), "key", "n")
    # the key's lowest byte is the symbol, those above it the context, nearest byte first
    masks = F.element_at(F.array(*[F.lit((1 << (8 * (d + 1))) - 1) for d in range(depth + 1)]), F.col("d") + 1)
    counted = levels.groupBy("d", F.col("key").bitwiseAND(masks).alias("key")).agg(F.sum("n").alias("n"))
    split = counted.select("d", F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(F.lit(255)).alias("symbol"), "n")
    total = grams.agg(F.sum("n")).first()[0] or 0
    common = split.groupBy("d", "context").agg(F.sum("n").alias("seen")).where(F.col("seen") >= F.lit(least_share * total))
    table = cut(split.join(common, ["d", "context"]))
    parent = table.select((F.col("d") + 1).alias("d"), F.col("context").alias("shorter"), "symbol", (F.col("n") / F.col("seen")).alias("q"))
    own = table.withColumn("shorter", F.col("context").bitwiseAND(F.element_at(F.array(F.lit(0), *[F.lit((1 << (8 * d)) - 1) for d in range(depth)]), F.col("d") + 1)))
    gain = own.join(parent, ["d", "shorter", "symbol"]).groupBy("d", "context").agg(F.sum(F.col("n") * F.log2(F.col("n") / F.col("seen") / F.col("q"))).alias("bits"))
    passed = gain.where(F.col("bits") >= least_gain).select("d", "context", F.lit(True).alias("kept"))
    rows = table.join(passed, ["d", "context"], "left").select("d", "context", "symbol", "n", F.coalesce("kept", F.lit(False)).alias("kept")).toArrow()
    return SuffixTree.build(*[rows[c].to_numpy() for c in ("d", "context", "symbol", "n", "kept")], depth, strength)


def suffix_tree_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1, depth: int = DEPTH, least_share: float = 1e-5, least_gain: float = 20.0, strength: float = 4.0, head_tokens: int = 1_000_000) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the documents whose crc32(id as text) mod `folds` is not `held_out`. score: the sum over tokens of the
    log10 of half the token's spelled probability and half its probability as a whole word, which is that of the base
    score for words that training has; the base score's class of unknown words shares its probability out by their
    spelling. So every word of the training documents, however rare, is part of the model, and the probabilities of all
    texts sum to at most 1. A token is spelled as the bytes of its lower-cased letters and a blank, the end as a newline,
    under a suffix tree: contexts of up to `depth` bytes
    that make up `least_share` of all places and whose next byte differs from that after the shorter context by
    `least_gain` bits over the corpus (count-weighted KL divergence). These contexts, their prefixes and their suffixes
    are the states; next-byte distributions are smoothed with the shorter context's as `strength` more observations,
    and each byte is predicted by the longest state that ends the bytes before it. base_score: the word unigram score
    of the contract.

    Counts of words and contexts over all training documents are summed in the tasks, then shuffled. `least_share`
    bounds the tree, which is broadcast, to 1 / least_share contexts of each length; the table of words grows with the
    corpus. Counts of at most `head_tokens` frequent words are broadcast too; all other words of each document meet
    their counts in a join, so any vocabulary works. Executors need no copy of this package.

    Null or empty text: one end token. Null id: trained on, not held out. Rows that repeat id and text each get the
    same, right scores. Texts are read whole, one at a time; a task needs some 30 times a text's bytes. Without training documents all counts are zero. Other columns are not read.
    """
    spark = docs.sparkSession
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == held_out, F.lit(False))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), fold.alias("out"))
    counted = cut(texts.where("not out").select("text").mapInArrow(_count(depth), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = counted.where("kind = 0").select("key", "n")
    n_train, v_train = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tree = _tree(counted.where("kind = 1"), depth, least_share, least_gain, strength)

    sizes = {r.b: r.m for r in words.groupBy(F.floor(F.log2("n")).alias("b")).agg(F.count("*").alias("m")).collect()}
    floor, room = max(sizes, default=0) + 1, head_tokens
    while floor > 0 and sizes.get(floor - 1, 0) <= room:
        floor -= 1
        room -= sizes.get(floor, 0)
    head = words.where((F.col("n") >= F.lit(1 << floor)) & (F.col("key") != END_KEY)).toArrow().sort_by("key")
    below = n_train + 0.5 * (v_train + 1)
    n_end = words.where(F.col("key") == END_KEY).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    end = float(np.log10((n_end + 0.5) / below))
    new = float(np.log10((1 + 0.5 / below) / 2))  # of a token that training lacks, besides its spelling
    shared = spark.sparkContext.broadcast((tree.arrays(), head["key"].to_numpy(), head["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, counts = shared.value
        logs = np.log10((counts + 0.5) / below)
        for batch in batches:
            ids, out = batch.column(0), batch.column(2)
            for row, data, offsets in text_blocks(batch.column(1)):
                starts, ends, first = word_spans(data, offsets)
                docs = len(offsets) - 1
                hashes = word_hashes(data, starts, ends).view(np.int64)
                doc = np.repeat(np.arange(docs), np.diff(first))
                stream, edges = token_bytes(data, offsets, starts, ends, first)
                bytes_ = byte_scores(tree, stream, edges)
                sums = np.r_[0, np.cumsum(bytes_)]
                sizes = ends - starts + 1
                at = np.cumsum(sizes) - sizes + doc
                spelled = sums[at + sizes] - sums[at]  # of each word with the blank that ends it
                each, at = np.unique(hashes, return_inverse=True)
                place = np.minimum(np.searchsorted(keys, each), max(0, len(keys) - 1))
                hit = keys[place] == each if len(keys) else np.zeros(len(each), bool)
                known = hit[at]
                log = logs[place[at[known]]] if len(logs) else np.zeros(0)
                base = np.bincount(doc[known], log, docs).astype(np.float64)
                score = np.bincount(doc[known], np.logaddexp(log * _LN10, spelled[known] * _LN10) / _LN10 + _HALF, docs).astype(np.float64)
                newline = bytes_[edges[1:] - 1]
                score += np.logaddexp(end * _LN10, newline * _LN10) / _LN10 + _HALF if n_end else newline + new
                n_known = np.bincount(doc[known], minlength=docs)
                lists = np.r_[0, np.cumsum(np.bincount(doc[~known], minlength=docs))].astype(np.int32)
                tag = [_digest(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, docs), out.slice(row, docs), pa.array(tag, pa.int64()), pa.array(np.diff(first) + 1), pa.array(n_known), pa.array(base), pa.array(score),
                     pa.ListArray.from_arrays(lists, pa.array(hashes[~known])), pa.ListArray.from_arrays(lists, pa.array(spelled[~known]))],
                    names=["id", "held_out", "tag", "n_tokens", "known", "base", "score", "rest", "spelled"],
                )

    scored = cut(texts.select("id", "text", "out").mapInArrow(run, "id long, held_out boolean, tag long, n_tokens long, known long, base double, score double, rest array<long>, spelled array<double>"))
    rest = scored.select("id", "tag", F.inline(F.arrays_zip("rest", "spelled"))).withColumnRenamed("rest", "key")
    share = (F.coalesce("n", F.lit(0)) + 0.5) / F.lit(float(below))
    known = F.log10((share + F.pow(F.lit(10.0), F.greatest("spelled", F.lit(-300.0)))) / 2)
    exact = lambda x: F.sum(x.cast("decimal(38,18)")).cast("double")
    sums = (
        rest.join(words, "key", "left").groupBy("id", "tag")
        .agg(
            exact(F.log10(share)).alias("more"),
            exact(F.when(F.col("n") > 0, known).otherwise(F.col("spelled") + F.lit(new))).alias("more_score"),
            F.count(F.when(F.col("n") > 0, 1)).alias("found"),
        )
    )
    rows = scored.groupBy("id", "tag").agg(F.count("*").alias("copies"))
    sums = sums.join(rows.where("copies > 1").selectExpr("id i", "tag t", "copies"), F.col("id").eqNullSafe(F.col("i")) & (F.col("tag") == F.col("t")), "left")
    part = lambda c: (F.col(c) / F.coalesce("copies", F.lit(1))).alias(c)
    sums = sums.select(F.col("id").alias("i"), F.col("tag").alias("t"), part("more"), part("more_score"), part("found"))
    joined = scored.drop("rest", "spelled").join(sums, F.col("id").eqNullSafe(F.col("i")) & (F.col("tag") == F.col("t")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce(F.col("found").cast("long"), F.lit(0)) + F.lit(int(n_end > 0))).cast("long").alias("n_known"),
        F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _digest(data: np.ndarray) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little", signed=True)
