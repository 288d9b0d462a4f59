"""Line dedup across documents: levelled sorted runs of line hashes that each batch of documents is merged with."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm.joins import spread_join
from civicspark.session import cut, drop_cut, reading, shared_folder

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h", "g"]


def line_key(line: Column) -> Column:
    """The line without 0x20 and 0x09-0x0D at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _hashes(line: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds: 128 bits that stand for the key."""
    return F.xxhash64(line_key(line)).alias("h"), F.xxhash64(F.lit(1), line_key(line)).alias("g")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Line hashes of all batches so far, as sorted runs on levels.

    A run is a table (h, g, docs, last), one row per key, bucketed and sorted by the key, so that joins with it neither
    shuffle nor hold it. `docs` counts the documents of the run's batches that hold the key; `last` is the largest id
    among them, null unless the key was new when its batch came. `fanout` runs of one level are merged into one of the
    next, so a batch meets at most fanout - 1 runs for each of the logarithmically many levels.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def new_keys(self, entries: DataFrame) -> DataFrame:
        """The rows of entries whose key is in no run: one merge anti-join after the other."""
        for run in self.runs():
            entries = entries.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        return entries

    def add(self, entries: DataFrame) -> None:
        """Adds a batch's keys (h, g, docs, last) as a run: all of them with their counts, `last` for new keys alone."""
        opened = self.new_keys(entries).select(*KEY, F.col("last").alias("opened")).hint("merge")
        self._put(entries.join(opened, KEY, "left").select(*KEY, "docs", F.col("opened").alias("last")), 0)

    def merged(self) -> DataFrame:
        """(h, g, docs, last) of all keys."""
        return self._merge(self.runs())

    def drop(self) -> None:
        for level in self.levels:
            while level:
                self._drop(level.pop())

    def _put(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{shared_folder(self.spark)}/tables/{name}"
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full = self.levels[level]
            self._put(self._merge([self.spark.table(run) for run in full]), level + 1)
            self.levels[level] = []
            for run in full:
                self._drop(run)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        """One row per key of all runs, by merge joins: a union of bucketed tables loses how they are dealt in Spark 4.1,
        and a sum by key over it then stays in parts."""
        rows = runs[0]
        for run in runs[1:]:
            other = run.select(*KEY, F.col("docs").alias("docs_2"), F.col("last").alias("last_2")).hint("merge")
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("docs_2", F.lit(0))
            rows = rows.join(other, KEY, "full_outer").select(*KEY, docs.alias("docs"), F.coalesce("last", "last_2").alias("last"))
        return rows

    def _drop(self, name: str) -> None:
        table = self.spark.table(name)
        table._cut_path = f"{shared_folder(self.spark)}/tables/{name}"
        self.spark.sql(f"DROP TABLE {name}")
        drop_cut(table)


def repeated_line_keys(docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_docs: int, batches: int, fanout: int) -> DataFrame:
    """(id, drop): for each document with lines to drop the keys of these lines, as structs (h, g)."""
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    cuts = sorted(set(ids.select("id").approxQuantile("id", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    batch = sum((F.when(F.col("id") <= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    lines = ids.select("id", F.explode(_lines(F.col("text"))).alias("line")).where(F.char_length(F.btrim("line", F.lit(_SPACE))) >= least_chars)
    pairs = cut(lines.select("id", *_hashes(F.col("line"))).distinct().withColumn("batch", batch.cast("int")), "batch")
    runs = LineRuns(spark, fanout)
    for k in range(len(cuts) + 1):  # from the largest ids down, so that a key is new in the batch of its largest id
        entries = cut(pairs.where(F.col("batch") == k).groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("id").alias("last")))
        runs.add(entries)  # from a table: else Spark joins before it counts, and a hot key's rows meet in one task
        drop_cut(entries)
    often = cut(runs.merged().where(F.col("docs") >= least_docs))
    runs.drop()
    met = spread_join(pairs.select("id", *KEY), often.select(*KEY, "last"), KEY, often.select(*KEY, F.col("docs").alias("n")), ["id"])
    found = cut(met.where("id <> last").groupBy("id").agg(F.collect_set(F.struct(*KEY)).alias("drop")))
    drop_cut(pairs)
    drop_cut(often)
    return found


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5, batches: int = 4, fanout: int = 4) -> DataFrame:
    """All columns of docs and a struct `lines` (n_lines, n_dropped, kept): the text without its repeated lines.

    A text is split at \\n; a null or empty text is one empty line. A line's key is the line without 0x20 and 0x09-0x0D
    at both ends, with A-Z lower-cased. Lines whose key has at least `least_chars` code points and stands in at least
    `least_docs` documents go, except in the largest id that holds the key; others stay, joined by \\n.

    Documents come in `batches` ranges of ids, from the largest ids down. A batch's keys are merge-anti-joined with the
    sorted runs of the batches before; what is new opens a key, and all of the batch's keys become a run (LineRuns). The
    counts and openers of the merged runs then decide over all documents at once. A key that a third of all lines share
    is one row in a run, since documents are counted before; the rows of hot keys are dealt over several tasks
    when they meet the decision. Everything is DataFrame functions; keys are compared by 128 bits.

    Documents with a null id count for nothing and lose nothing. Rows that share an id are one document: they count once
    for a key and lose the same keys. Equal rows stay. Very long texts are cut into lines in one row's expression.
    Extra columns of any name but `lines` stay as they are; an empty table gives no rows.
    """
    found = repeated_line_keys(docs, id_col, text_col, least_chars, least_docs, batches, fanout)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    gone = lambda x: F.array_contains("drop", F.struct(*_hashes(x)))
    each = rows.join(found.hint("merge"), "id", "left").withColumn("left", F.when(F.col("drop").isNotNull(), F.filter(_lines(F.col("text")), lambda x: ~gone(x))))
    n_lines = F.size(_lines(F.col("text"))).cast("long")
    dropped = F.when(F.col("left").isNotNull(), n_lines - F.size("left")).otherwise(F.lit(0)).cast("long")
    kept = F.when(F.col("left").isNotNull(), F.array_join("left", "\n")).otherwise(F.col("text"))
    lines = F.struct(n_lines.alias("n_lines"), dropped.alias("n_dropped"), kept.alias("kept"))
    return reading(each.select("row.*", lines.alias("lines")), found)
