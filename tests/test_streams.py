"""Streams over several micro-batches: carried state, releases, late rows, replays and restarts."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from civicspark.streaming import jobs


@pytest.fixture
def feed(spark, tmp_path):
    """put(rows) adds a file; stream() reads a file per micro-batch."""

    class Feed:
        def __init__(self, name, schema):
            self.path, self.schema = str(tmp_path / name), schema

        def put(self, rows):
            spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)
            return self

        def stream(self):
            return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    return Feed


def test_health_carries_failures_and_takes_releases(spark, tmp_path, feed):
    probes = feed("probes", "at long, agency string, ok boolean")
    releases = feed("releases", "at long, agency string")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: jobs.run_available(spark, jobs.health(probes.stream(), releases.stream()), out, checkpoint)
    for batch in range(4):  # four batches of one probe each: the third failure quarantines, the fourth is frozen
        probes.put([(batch, "a", False), (batch, "b", batch == 2)])
    releases.put([(0, "c")])
    run()
    state = lambda agency: [(r.event_id, r.failures, r.quarantined) for r in spark.read.parquet(out).where(F.col("agency") == agency).orderBy("event_id").collect()]
    assert state("a") == [(0, 1, False), (1, 2, False), (2, 3, True), (3, 3, True)]
    assert state("b") == [(0, 1, False), (1, 2, False), (2, 0, False), (3, 1, False)]
    releases.put([(10, "a"), (10, "b")])  # b isn't quarantined: its failure stays
    probes.put([(11, "a", False), (11, "b", False)])
    run()  # a restart from the checkpoint
    assert state("a")[4:] == [(11, 1, False)] and state("b")[4:] == [(11, 2, False)]
    run()
    assert spark.read.parquet(out).count() == 10


def test_page_changes_over_batches_equal_one_pass(spark, tmp_path, feed):
    rng = random.Random(1)
    rows = [(i, f"u{rng.randrange(4)}", rng.choice("xyz")) for i in range(200)]
    pages = feed("pages", "at long, url string, hash string")
    for k in range(4):
        pages.put(rows[50 * k : 50 * k + 50])
    jobs.run_available(spark, jobs.page_changes(pages.stream()), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    last, want = {}, {}
    for at, url, h in rows:
        want[at], last[url] = last.get(url) != h, h
    assert {r.event_id: r.changed for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_days_close_with_the_watermark_and_later_rows_are_left_out(spark, tmp_path, feed):
    rows = feed("rows", "ts timestamp, agency string")
    at = lambda day, hour: spark.sql(f"select timestamp'2026-01-0{day} {hour:02d}:00:00' t").first().t
    rows.put([(at(1, 10), "a"), (at(1, 11), "a")]).put([(at(2, 0), "a"), (at(1, 23), "a")]).put([(at(2, 5), "b")]).put([(at(2, 6), "b")])
    rows.put([(at(1, 12), "a"), (at(2, 4), "b"), (at(4, 0), "a")])  # the first is a day late: left out
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.run_available(spark, jobs.daily_volume(rows.stream(), delay="2 hours"), out, checkpoint)
    days = lambda: {(r.day, r.agency): r.n for r in spark.read.parquet(out).collect()}
    assert days() == {("2026-01-01", "a"): 3, ("2026-01-02", "a"): 1, ("2026-01-02", "b"): 3}
    rows.put([(at(6, 0), "a")])
    jobs.run_available(spark, jobs.daily_volume(rows.stream(), delay="2 hours"), out, checkpoint)  # a restart
    assert days()[("2026-01-04", "a")] == 1 and spark.read.parquet(out).count() == 4


def test_late_sources_replays_and_new_checkpoints(spark, tmp_path, feed):
    sources = feed("sources", "meeting_id string, doc_id long")
    table, published, checkpoint = (str(tmp_path / x) for x in ("table", "published", "checkpoint"))
    rebuild = lambda rows: rows.groupBy("meeting_id").agg(F.sort_array(F.collect_list("doc_id")).alias("docs"))
    run = lambda: jobs.merge_late(sources.stream(), "meeting_id", ["doc_id"], table, checkpoint, rebuild, published, buckets=3)
    meetings = lambda: {r.meeting_id: r.docs for r in spark.read.parquet(published).collect()}
    for k in range(4):
        sources.put([(f"m{(k + j) % 5}", 10 * k + j) for j in range(3)])
    run()
    want = {}
    for k in range(4):
        for j in range(3):
            want.setdefault(f"m{(k + j) % 5}", []).append(10 * k + j)
    assert meetings() == want
    before = spark.read.parquet(table).count()
    run()  # nothing new
    assert meetings() == want and spark.read.parquet(table).count() == before
    sources.put([("m0", 99)])  # weeks later
    run()
    want["m0"] = [*want["m0"], 99]
    assert meetings() == want
    shutil.rmtree(checkpoint)  # a lost checkpoint: everything comes again, and nothing is lost or counted twice
    sources.put([("m1", 100), ("m9", 101)])
    run()
    want["m1"], want["m9"] = [*want["m1"], 100], [101]
    assert meetings() == want
    assert spark.read.parquet(table).select("_bucket").distinct().count() <= 3
