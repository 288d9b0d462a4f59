"""Streams: items seen once, page changes, health states, daily volume, hand-off of new files, late sources."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState


def new_items(stream: DataFrame, key: str = "hash", time: str | None = None, delay: str = "30 days") -> DataFrame:
    """Each key once; with a time column the state is bounded by the watermark."""
    if time:
        return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def _changes(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of a url whose hash differs from the one before; the first counts as new. Rows of a micro-batch are taken in
    the order of at, those of a later one after them. A task holds a url's rows of one micro-batch; the trigger bounds it."""
    last = state.get[0] if state.exists else None
    all_ = sorted((r for part in rows for r in zip(part["at"].tolist(), part["hash"].tolist(), strict=True)), key=lambda r: r[0])
    changed = []
    for _, hash_ in all_:
        changed.append(last is None or hash_ is None or hash_ != last)
        last = hash_
    state.update((last,))
    yield pd.DataFrame({"event_id": [at for at, _ in all_], "url": [key[0]] * len(all_), "changed": changed})


class Health(StatefulProcessor):
    """Consecutive failures per agency; at `limit` it is quarantined, and frozen until a release sets it to 0 again."""

    def __init__(self, limit: int = 3):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "failures int, quarantined boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        state = self.state.get()
        failures, held = (state[0], state[1]) if state else (0, False)
        all_ = pd.concat(list(rows)).sort_values(["at", "release"])
        after = []
        for ok, release in zip(all_["ok"].tolist(), all_["release"].tolist(), strict=True):
            if release:
                failures, held = (0, False) if held else (failures, held)
            elif not held:
                failures = 0 if ok else failures + 1
                held = failures >= self.limit
            after.append((failures, held))
        self.state.update((failures, held))
        out = pd.DataFrame(after, columns=["failures", "quarantined"]).assign(event_id=all_["at"].to_numpy(), agency=key[0])
        yield out.loc[~all_["release"].to_numpy(), ["event_id", "agency", "failures", "quarantined"]]


def page_changes(stream: DataFrame) -> DataFrame:
    """The state of a url travels with its rows: a call of the state store for each url took most of the time."""
    return stream.groupBy("url").applyInPandasWithState(_changes, "event_id long, url string, changed boolean", "hash string", "append", "NoTimeout")


def health(probes: DataFrame, releases: DataFrame | None = None, limit: int = 3) -> DataFrame:
    """(event_id, agency, failures, quarantined) after each probe of a stream (at, agency, ok). A second stream (at,
    agency) releases agencies from quarantine; a release of an agency that isn't quarantined changes nothing. Rows of one
    micro-batch are taken in the order of at, a release after a probe of the same at."""
    all_ = probes.select("at", "agency", "ok", F.lit(False).alias("release"))
    if releases is not None:
        all_ = all_.unionByName(releases.select("at", "agency", F.lit(True).alias("ok"), F.lit(True).alias("release")))
    return all_.groupBy("agency").transformWithStateInPandas(Health(limit), "event_id long, agency string, failures int, quarantined boolean", "Append", "None")


def daily_volume(stream: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Rows per day and agency. In append mode a day comes once, when the watermark has passed its end, and rows that are
    later than `delay` behind the newest one before their micro-batch are left out; in complete mode all rows count."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    days = timed.groupBy(F.window(time, "1 day").alias("w"), "agency").agg(F.count("*").alias("n"))
    return days.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "agency", "n")


def run_available(spark: SparkSession, stream: DataFrame, to: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that has come since the last run, then ends."""
    stateful = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        if mode == "append":
            q = stream.writeStream.outputMode(mode).format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        else:
            q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(to)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        if stateful is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", stateful)


def changed_keys(new: DataFrame, old: DataFrame | None, key: str, print_col: str) -> DataFrame:
    """Keys whose fingerprint is new or differs from the published one."""
    if old is None:
        return new.select(key)
    was = old.select(key, F.col(print_col).alias("__was"))
    return new.join(was, key, "left").where(~F.col(print_col).eqNullSafe(F.col("__was"))).select(key)


def merge_late(stream: DataFrame, key: str, row_id: list[str], table: str, checkpoint: str, rebuild: Callable[[DataFrame], DataFrame], published: str, buckets: int = 64) -> None:
    """Adds what arrives to `table` and rebuilds the published groups that it belongs to from the whole table: a late
    source changes its meeting as an early one would.

    Both tables are dealt into `buckets` folders by a hash of the key, so that a batch reads and rewrites only the
    buckets it touches, however many keys and batches there are. A batch is a folder of its own, named by the query's run
    id and its number: a repeated batch overwrites itself, and a query that starts anew with another checkpoint can't
    overwrite what an earlier one has added. Rows that come again are known by `row_id` and count once.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        placed = df.withColumns({"_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"), "_batch": F.lit(f"{run}-{number}")})
        placed.write.mode("overwrite").partitionBy("_bucket", "_batch").option("partitionOverwriteMode", "dynamic").parquet(table)
        schema = placed.schema
        touched = [r._bucket for r in spark.read.schema(schema).parquet(table).where(F.col("_batch") == f"{run}-{number}").select("_bucket").distinct().collect()]
        if touched:
            rows = spark.read.schema(schema).parquet(table).where(F.col("_bucket").isin(touched)).dropDuplicates(row_id).drop("_bucket", "_batch")
            out = rebuild(rows).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            out.write.mode("overwrite").partitionBy("_bucket").option("partitionOverwriteMode", "dynamic").parquet(published)

    run = _run_of(stream.sparkSession, checkpoint)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to, made when the checkpoint is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/merge-run")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        return spark.read.text(f"{checkpoint}/merge-run").first()[0]
    run = uuid.uuid4().hex[:12]
    out = files.create(path)
    out.write(bytearray(run.encode()))
    out.close()
    return run
