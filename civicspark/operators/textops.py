"""Chunking, splitting, scanning and searching long texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cuts(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(start, end) of chunks: at most `size` characters, cut back to the last newline in the last `overlap`, the next
    one starting `overlap` before the end."""
    start = 0
    while True:
        end = min(start + size, len(text))
        if end < len(text):
            line = text.rfind("\n", start + size - overlap, end)
            end = line + 1 if line > start else end
        yield start, end
        if end >= len(text):
            return
        start = end - overlap


def chunks(docs: DataFrame, id_col: str, text_col: str, size: int = 60_000, overlap: int = 2_000) -> DataFrame:
    """(id, chunk_no, start, end, text); a null or empty text has one empty chunk."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(i, k, a, b, (x or "")[a:b]) for i, x in zip(f["id"], f["text"], strict=True) for k, (a, b) in enumerate(cuts(x or "", size, overlap))]
            yield pd.DataFrame(rows, columns=["id", "chunk_no", "start", "end", "text"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(run, "id long, chunk_no int, start int, end int, text string").withColumnRenamed("id", id_col)


# Section headings of long packets.
HEADINGS = r"^(STAFF REPORT|AGENDA ITEM|ITEM NO\.?|PUBLIC HEARING|RESOLUTION NO\.?|ORDINANCE NO\.?)"


def split_oversized(docs: DataFrame, id_col: str, text_col: str, target: int = 500_000, least: int = 100, headings: str = HEADINGS) -> DataFrame:
    """(id, part, text): texts over `target` characters in parts that start at headings where there are any, else at
    lines; parts under `least` characters are dropped. Python is given rows in small batches and holds one text's parts."""
    heading = re.compile(headings)

    def parts(text: str) -> list[str]:
        if len(text) <= target:
            return [text]
        out, now, size = [], [], 0
        for line in text.splitlines(keepends=True):
            full = size >= target or size + len(line) > 1.2 * target
            if now and (full or (heading.match(line) and size > target / 2)):
                out.append("".join(now))
                now, size = [], 0
            now.append(line)
            size += len(line)
        out.append("".join(now))
        return [p[k : k + 2 * target] for p in out for k in range(0, len(p), 2 * target)]

    kept = F.udf(lambda text: [p for p in parts(text or "") if len(p) >= least], "array<string>", useArrow=False)
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.posexplode(kept(F.col(text_col))).alias("part", "text"))


def packet_items(docs: DataFrame, id_col: str, text_col: str, page: str = "\f", marker: str = r"(?i)item:? *(\d+)", least_pages: int = 3, least_items: int = 2) -> DataFrame:
    """(id, item, pages, text) of packets: pages carry the item named last, those before the first are dropped.
    Packets with fewer pages or items have no rows."""
    pages = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), page)).alias("page", "text"))
    own = Window.partitionBy("id")
    found = F.when(F.col("text").rlike(marker), F.regexp_extract("text", marker, 1).cast("int"))
    placed = pages.withColumn("item", F.last(found, ignorenulls=True).over(own.orderBy("page"))).withColumn("n_pages", F.count("*").over(own))
    items = placed.where(F.col("item").isNotNull() & (F.col("n_pages") >= least_pages))
    joined = items.groupBy("id", "item").agg(F.count("*").alias("pages"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), page).alias("text"))
    return joined.withColumn("n", F.count("*").over(own)).where(F.col("n") >= least_items).drop("n").withColumnRenamed("id", id_col)


def keyword_lines(docs: DataFrame, id_col: str, text_col: str, keywords: list[str], most: int = 200) -> DataFrame:
    """(id, keyword, line_no, line): for each keyword the first line that has it, trimmed and cut."""
    lines = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    hits = lines.select("id", "line_no", "line", F.explode(F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.lower("line"), k))).alias("keyword"))
    first = hits.groupBy("id", "keyword").agg(F.min("line_no").alias("line_no"), F.min_by("line", "line_no").alias("line"))
    return first.select(F.col("id").alias(id_col), "keyword", "line_no", F.left(F.trim("line"), F.lit(most)).alias("line"))


class _Page(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, row, cells) of every table row of landed pages."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for i, html in zip(f["id"], f["html"], strict=True):
                page = _Page()
                page.feed(html or "")
                rows += [(i, k, r) for k, r in enumerate(page.rows)]
            yield pd.DataFrame(rows, columns=["id", "row", "cells"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInPandas(run, "id long, row int, cells array<string>").withColumnRenamed("id", id_col)


# Hooks: registries of functions that a user adds.
SPLITTERS: dict[str, Callable[[str], list[str]]] = {"pages": lambda text: text.split("\f"), "lines": lambda text: text.split("\n")}


def split_with(docs: DataFrame, splitter: str, id_col: str, text_col: str) -> DataFrame:
    """(id, part, text) by a registered splitter."""
    cut = SPLITTERS[splitter]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(i, k, p) for i, x in zip(f["id"], f["text"], strict=True) for k, p in enumerate(cut(x or ""))], columns=["id", "part", "text"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id long, part int, text string").withColumnRenamed("id", id_col)


def score_items(items: DataFrame, text_col: str, scorer: Callable[[pd.Series], pd.DataFrame] | None = None) -> DataFrame:
    """items with a struct `verdict` (relevant, score, reason) from a user's scorer over batches of texts; the default
    scores by length."""

    def by_length(texts: pd.Series) -> pd.DataFrame:
        n = texts.fillna("").str.len()
        return pd.DataFrame({"relevant": n > 8, "score": n.clip(upper=10), "reason": "length " + n.astype(str)})

    chosen = scorer or by_length

    def run(texts: pd.Series) -> pd.DataFrame:
        return chosen(texts)

    judge = F.pandas_udf(run, "relevant boolean, score long, reason string")
    return items.withColumn("verdict", judge(F.col(text_col)))


def extract_records(parts: DataFrame, id_col: str, text_col: str, extractor: Callable[[str], str], schema: str) -> DataFrame:
    """(id, record, error): a user's extractor gives text per part; the JSON object in it is read tolerantly."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for i, x in zip(f["id"], f["text"], strict=True):
                try:
                    rows.append((i, extractor(x or ""), None))
                except Exception as e:  # a user's failure is a category, not the job's end
                    rows.append((i, None, type(e).__name__))
            yield pd.DataFrame(rows, columns=["id", "said", "failed"])

    said = parts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id long, said string, failed string")
    found = F.nullif(F.regexp_extract("said", r"(?s)(\{.*\})", 1), F.lit(""))
    record = F.from_json(found, schema)
    error = F.coalesce("failed", F.when(found.isNull(), "no_json"))
    return said.select(F.col("id").alias(id_col), record.alias("record"), error.alias("error"))
