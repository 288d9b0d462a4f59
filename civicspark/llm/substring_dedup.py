"""Substring dedup: paragraphs that repeat across documents, by MinHash bands tuned for recall and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.joins import spread_join
from civicspark.llm.near_dedup import densifying_order, distinct_sets, fingerprints, with_components
from civicspark.llm.passages import repeated_passages, with_texts
from civicspark.llm.words import mix, shingle_hashes, text_blocks, word_hashes, word_spans
from civicspark.session import cut, drop_cut, reading

WORDS = r"[^\x20\x09-\x0D]+"


def tune_bands(similarity: float, recall: float, most_keys: int = 16) -> tuple[int, int]:
    """The most selective (bands, rows) of at most `most_keys` bands whose recall at `similarity` is reached."""
    fits = [(b, r) for r in range(1, 9) for b in range(1, most_keys + 1) if 1 - (1 - similarity**r) ** b >= recall]
    if not fits:
        raise ValueError("no banding reaches that recall")
    rows = max(r for _, r in fits)
    return min(b for b, r in fits if r == rows), rows


def _lines(texts: pa.Array, least: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of \\n-split lines of at least `least` words: (row of the text, line number, distinct shingles, offsets)."""
    for row, data, offsets in text_blocks(texts):
        starts = np.unique(np.r_[offsets, np.flatnonzero(data == 10) + 1])
        text = np.searchsorted(offsets, starts[:-1], "right") - 1
        number = np.arange(len(text)) - np.searchsorted(starts, offsets)[text]
        begins, ends, first = word_spans(data, starts)
        sizes = np.diff(first)
        enough = sizes >= least
        words = word_hashes(data, begins, ends)[np.repeat(enough, sizes)]
        first = np.r_[0, np.cumsum(sizes[enough])]
        yield row + text[enough], number[enough], *distinct_sets(*shingle_hashes(words, first, width))


def _line_prints(least: int, width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = densifying_order(bands * rows)
        for batch in batches:
            doc, version = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            for text, number, sets, offsets in _lines(batch.column(2), least, width):
                ids = mix(mix(mix(doc[text] + np.uint64(1)) ^ version[text]) + number.astype(np.uint64))
                places = {"doc": batch.column(0).take(pa.array(text)), "version": batch.column(1).take(pa.array(text)), "paragraph": pa.array(number.astype(np.int32))}
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids.view(np.int64)), **places, **fingerprints(sets, offsets, bands, rows, order)})

    return run


def _line_sets(least: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = [{w["paragraph"]: w["id"] for w in own} for own in batch.column(3).to_pylist()]
            for text, number, sets, offsets in _lines(batch.column(2), least, width):
                ids = [wanted[t].get(n) for t, n in zip(text.tolist(), number.tolist(), strict=True)]
                keep = np.flatnonzero([i is not None for i in ids])
                if len(keep):
                    ends = np.r_[0, np.cumsum(np.diff(offsets)[keep])].astype(np.int32)
                    own = np.concatenate([sets[offsets[k] : offsets[k + 1]] for k in keep]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([ids[k] for k in keep], pa.int64()), pa.ListArray.from_arrays(ends, own)], names=["id", "shingles"])

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(text).alias("version"), text.alias("text")).where("doc is not null")


def _repeated_lines(texts: DataFrame, least_words: int, width: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(doc, paragraph, version, group, first: struct of places, kept) of the lines that another one repeats."""
    found = cut(texts.mapInArrow(_line_prints(least_words, width, bands, rows), "id long, doc long, version long, paragraph int, n_shingles long, one long, two long, bands array<long>"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        lists = found.join(wanted, "id", "left_semi").groupBy("doc", "version").agg(F.collect_list(F.struct("paragraph", "id")).alias("lines"))
        return with_texts(lists, texts, "lines").mapInArrow(_line_sets(least_words, width), "id long, shingles array<long>")

    near = with_components(found, sets_of, percent, shared_only=True)
    place = F.struct("doc", "paragraph", "version")
    members = cut(near.select("doc", "paragraph", "version", F.col("component").alias("group")).distinct())
    drop_cut(near)
    groups = cut(members.groupBy("group").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"))
    out = spread_join(members, groups.select("group", "first"), ["group"], groups.select("group", "n"), ["doc", "paragraph"])
    return reading(out.select("doc", "paragraph", "version", "group", "first", (place == F.col("first")).alias("kept")), members, groups)


def _without(docs: DataFrame, id_col: str, text_col: str, lists: DataFrame, left) -> DataFrame:
    """docs with the text `left(text, gone)` where `lists` (doc, version, gone) has a row; a document of which no word is
    left then goes. Columns may have any names."""
    text = F.col("row").getField(text_col).cast("string")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("version"))
    out = rows.join(lists, ["doc", "version"], "left").select("row", "gone", F.when(F.col("gone").isNotNull(), left(text, F.col("gone"))).alias("left"))
    out = out.where(F.col("gone").isNull() | F.col("left").rlike(WORDS))
    types = {f.name: f.dataType for f in docs.schema}
    new = {text_col: F.col("left").cast(types[text_col])} | ({"n_chars": F.length("left").cast(types["n_chars"])} if "n_chars" in types else {})
    return out.select(*[F.when(F.col("gone").isNotNull(), new[c]).otherwise(F.col("row").getField(c)).alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def _without_lines(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    def left(text: Column, gone: Column) -> Column:
        return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(gone, i)), "\n")

    return _without(docs, id_col, text_col, found.where(~F.col("kept")).groupBy("doc", "version").agg(F.collect_set("paragraph").alias("gone")), left)


def _without_passages(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    own = Window.partitionBy("doc", "version").orderBy("start", "stop")
    new = F.coalesce(F.col("start") > F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    apart = found.where(~F.col("kept")).withColumn("new", new).withColumn("part", F.sum("new").over(own))
    apart = apart.groupBy("doc", "version", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    lists = apart.groupBy("doc", "version").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("gone"))

    def left(text: Column, gone: Column) -> Column:
        edge = lambda i: F.when(i == 0, F.lit(0)).otherwise(gone[F.greatest(i - 1, F.lit(0))]["stop"])
        last = lambda i: F.when(i == F.size(gone), F.length(text)).otherwise(gone[F.least(i, F.size(gone) - 1)]["start"])
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.substring(text, edge(i) + 1, last(i) - edge(i))), "")

    return _without(docs, id_col, text_col, lists, left)


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 20, width: int = 5, percent: int = 80, recall: float = 0.9995) -> DataFrame:
    """One row for each paragraph that another one repeats: (id, paragraph, start, stop, group, first_doc, kept).

    First, paragraphs are \\n-split lines of at least `least_words` words (`paragraph` is the line's number, start and
    stop are null), compared as sets of `width`-word shingles; linked at similarity percent / 100 or more, confirmed
    exactly, and grouped by connected components. In each group the paragraph with the smallest (id, place) is kept,
    all others are to be removed; lines repeated inside one document count too. Bands are tuned so that a link at the
    threshold shares a bucket with probability `recall`; a bucket's star is completed by the exact search of
    near_duplicates, so that hot passages make no pairs among themselves.

    Then, in the texts without the repeats among these, they are passages of as many words or more that stand
    elsewhere too, in other documents or the same, wherever in their lines (`paragraph` is null; start and stop count
    characters of that text): see repeated_passages.

    Null text, empty text or text without as many words: no rows; an empty table gives none. Null ids: their paragraphs
    take no part. Rows that repeat an id count as one document for each text they have. Texts of any length are read
    whole, one at a time; a task needs some 30 times a text's bytes. Other columns are not read.
    """
    texts = _texts(docs, id_col, text_col)
    lines = cut(_repeated_lines_of(texts, least_words, width, percent, recall))
    left = cut(_without_lines(texts.drop("version"), "doc", "text", lines))
    passages = repeated_passages(_texts(left, "doc", "text"), least_words, width, percent)
    drop_cut(left)
    row = lambda paragraph, start, stop, first: (F.col("doc").alias(id_col), F.expr(paragraph).cast("int").alias("paragraph"), F.expr(start).cast("int").alias("start"), F.expr(stop).cast("int").alias("stop"), "group", F.col(first).alias("first_doc"), "kept")
    out = lines.select(*row("paragraph", "null", "null", "first.doc")).union(passages.select(*row("null", "start", "stop", "first_doc")))
    return reading(out, lines, passages)


def _repeated_lines_of(texts: DataFrame, least_words: int, width: int, percent: int, recall: float) -> DataFrame:
    return _repeated_lines(texts, least_words, width, percent, *tune_bands(percent / 100, recall))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 20, width: int = 5, percent: int = 80, recall: float = 0.9995) -> DataFrame:
    """docs without the paragraphs that repeated_paragraphs would remove; a document of which no word is left then goes.

    Same columns, whatever they are called; n_chars follows. Null ids, null and empty texts stay as they are; rows that
    repeat an id and a text lose the same paragraphs. An empty table gives none.
    """
    lines = _repeated_lines_of(_texts(docs, id_col, text_col), least_words, width, percent, recall)
    left = cut(_without_lines(docs, id_col, text_col, lines))
    drop_cut(lines)
    passages = repeated_passages(_texts(left, id_col, text_col), least_words, width, percent)
    return reading(_without_passages(left, id_col, text_col, passages), left, passages)
