"""Packing: documents as tokens into fixed windows, best fit decreasing over a segment tree of remaining capacity."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encoder(vocabulary: str):
    """Text to ids by a byte-level BPE file of `tiktoken` ranks; <|endoftext|> in a text is its own id.

    The ids are those that `tokenizers` gives for the same vocabulary's JSON file (tests compare them); this reader
    takes a quarter of the time.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tool = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: tool.encode(text, allowed_special="all")


class Windows:
    """Open windows by remaining capacity; a segment tree finds the least capacity that still takes a piece."""

    def __init__(self, size: int):
        self.size = size
        self.leaves = 1 << size.bit_length()
        self.filled = np.zeros(2 * self.leaves, np.int64).tolist()  # windows below each node
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.filled[node] += by
            node >>= 1

    def _tightest(self, need: int) -> int | None:
        """The least capacity of at least `need` with an open window."""
        node = self.leaves + need
        if self.filled[node]:
            return need
        while node > 1:
            if not node & 1 and self.filled[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, need: int) -> tuple[int, int]:
        """Places a piece of `need` tokens: (window, offset in it)."""
        room = self._tightest(need)
        if room is None:
            window, room = self.made, self.size
            self.made += 1
        else:
            window = self.open[room].pop()
            self._add(room, -1)
        if room > need:
            self.open[room - need].append(window)
            self._add(room - need, 1)
        return window, self.size - room


def _pieces(vocabulary: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(end)
                raw, n = np.array(ids, "<u4").tobytes(), len(ids)
                for a in range(0, n, size):
                    b = min(n, a + size)
                    for to, x in zip(out, (doc, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), n), strict=True):
                        to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def _packed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, windows = None, Windows(size)
        for batch in batches:
            numbers, offsets = [], []
            for g, n in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if g != group:
                    group, windows = g, Windows(size)
                window, offset = windows.put(n)
                numbers.append((g << 32) + window)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())], names=[*batch.schema.names[1:], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, size: int = 1024, end: int = 0, group_pieces: int = 100_000) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is its ids and the end id. Documents of more than `size` ids are cut into full windows and a rest;
    rests and short documents are placed in order of falling length into the open window with the least room that
    takes them. Pieces are dealt by hash into groups of about `group_pieces`, each packed as one sorted stream: a task
    holds only its group's open windows, and a group has one window that stays loose at most per size.

    sequence_id is the group * 2^32 + a number in it; offsets have no gaps. Null or empty text: the end id alone. Null
    ids, repeated rows: packed as rows of their own. An empty table gives none. Other columns are not read.
    """
    import public_tokenizers

    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    total = docs.agg(F.count("*"), F.sum(F.octet_length(F.col(text_col)))).first()
    groups = max(1, round((total[0] + (total[1] or 0) / (3 * size)) / group_pieces))
    kinds = "doc long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = texts.mapInArrow(_pieces(vocabulary, size, end), kinds)
    dealt = pieces.select(F.pmod(F.xxhash64("doc", "start", "ids_crc32"), F.lit(groups)).alias("group"), "*")
    sorted_ = dealt.repartition(groups, "group").sortWithinPartitions("group", F.desc("length"), "doc", "start", "ids_crc32")
    out = sorted_.mapInArrow(_packed(size), kinds + ", sequence_id long, offset long")
    return out.withColumnRenamed("doc", id_col)
