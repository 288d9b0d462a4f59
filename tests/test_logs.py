"""Log operators and number gaps against loops over the lines."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from civicspark.operators.logs import ERROR_RULES, HEALTH_RULES, attributed_errors, blocking_files, gap_stops, health_report, phase_durations, run_durations

LINES = "log string, n long, line string"


def table(spark, lines, log="a"):
    return spark.createDataFrame([(log, n, line) for n, line in enumerate(lines)], LINES)


def some_lines(seed):
    rng, at = random.Random(seed), datetime(2026, 1, 1)
    said = ["Starting the pipeline", "Pipeline complete", "Fetching minutes...", "Fetching permits... done", "minutes fetch done", "permits done", "done", "noise"]
    out = []
    for _ in range(200):
        at += timedelta(seconds=rng.choice([0, 5, 900, 1300]))
        stamp = rng.choice([f"[{at:%Y-%m-%d %H:%M:%S}] ", f"[{at:%Y-%m-%d %H:%M:%S}] [full] ", "", "[2026-13-45 00:00:00] "])
        out.append("  " * rng.randrange(2) + stamp + rng.choice(said))
    return out


def stamp(line):
    m = re.match(r"\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\]", line.strip())
    try:
        return m and datetime.strptime(m[1], "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def phases_by_hand(lines):
    out, opened = [], None
    for n, line in enumerate(lines):
        ts = stamp(line)
        if not ts:
            continue
        m = re.search(r"Fetching (.+?)\.\.\.", line)
        if m:
            if opened:
                out.append((opened[0], opened[1], int((ts - opened[2]).total_seconds()), "next"))
            opened = (n, m[1], ts)
        if opened and re.search(r".+? done", line):
            out.append((opened[0], opened[1], int((ts - opened[2]).total_seconds()), "done"))
            opened = None
    return out + ([(opened[0], opened[1], None, None)] if opened else [])


def runs_by_hand(lines):
    out, last, complete = [], None, True
    for n, line in enumerate(lines):
        ts = stamp(line)
        if ts and "Starting" in line:
            out.append([n, None, last is not None and not complete])
            last, complete = ts, False
        if ts and "Pipeline complete" in line:
            if last and not complete:
                out[-1][1] = int((ts - last).total_seconds())
            complete = True
    return [tuple(x) for x in out]


@pytest.mark.parametrize("seed", range(4))
def test_phases_and_runs_equal_a_loop(spark, seed):
    lines = some_lines(seed)
    both = table(spark, lines).union(table(spark, lines[::-1], "b")).repartition(3)
    got = phase_durations(both).where("log = 'a'").orderBy("n").collect()
    assert [(r.n, r.phase, r.seconds, r.ended_by) for r in got] == phases_by_hand(lines)
    assert all(r.slow == (r.seconds is not None and r.seconds > 1200) for r in got)
    assert [(r.n, r.seconds, r.overlapped) for r in run_durations(both).where("log = 'a'").orderBy("n").collect()] == runs_by_hand(lines)


def test_errors_name_the_first_file_in_their_frame(spark):
    rng = random.Random(8)
    said = ["[1/9] a-1.txt", "  [2/9] b.txt", "[3/9] c d.txt more.txt x", "Chunking: 3", "Auth error", "Rate limit", "it timed out", "JSON parse error: Auth error", "FAILED", " FAILED (x)", "not FAILED", "Circuit breaker", "hit your Session Limit", "Terminated", "noise"]
    lines = [rng.choice(said) for _ in range(400)]
    want, blocked = [], {}
    for n, line in enumerate(lines):
        rule = next((r for r in ERROR_RULES if re.search(r[1], line.strip())), None)
        if rule:
            named = [m[1] for j in range(max(0, n - rule[2]), n) if (m := re.search(r"\] (.+\.txt)", lines[j]))]
            if not rule[2] or named:
                want.append((n, rule[0], named[0] if rule[2] else None))
        if "Auth error" in line:
            before = lines[max(0, n - 8) : n]
            named = [m[1] for x in before if (m := re.search(r"\] (.+\.txt)", x))]
            if named and any("Chunking:" in x for x in before):
                blocked[named[-1]] = blocked.get(named[-1], 0) + 1
    df = table(spark, lines).repartition(4)
    assert [(r.n, r.kind, r.file) for r in attributed_errors(df).orderBy("n").collect()] == want
    assert {r.file: r.n for r in blocking_files(df).collect()} == {f: n for f, n in blocked.items() if n >= 2}
    assert attributed_errors(table(spark, [None, "x"])).count() == 0


def test_health_rules(spark):
    pipeline = ["[2026-01-01 00:00:00] Starting the pipeline", "[2026-01-01 00:10:00] Starting the pipeline", "No new extractions"] * 3 + ["[2026-01-01 01:00:00] Fetching x...", "[2026-01-01 02:00:00] x done"]
    extraction = ["[2026-01-01 00:00:00] go", "Extracting structured data: 100 sources", "[2026-01-01 02:00:00] end", "4 extracted, 1 failed"]
    failures = spark.createDataFrame([("a", 3), ("b", 1)], "file string, fail_count int")
    records = spark.createDataFrame([("2026-01-01-a", None), ("x", None), ("y", "2026-01-02")], "file string, date string")
    got = {r.rule: (r.hit, r.n) for r in health_report(table(spark, pipeline), table(spark, extraction), failures, records).collect()}
    hit = {"failing_extractions": 1.0, "skipped_next_run": 1.0, "overlapping_runs": 5.0, "slow_phases": 1.0, "null_dates": 2.0, "null_dates_to_mend": 1.0, "low_throughput": 4.0, "stalled": 3.0}
    assert {k: n for k, (h, n) in got.items() if h} == hit and set(got) == {r for r, _, _ in HEALTH_RULES}
    empty = table(spark, ["x"]).limit(0)
    none = health_report(empty, empty, failures.limit(0), records.limit(0)).collect()
    assert len(none) == len(HEALTH_RULES) and not any(r.hit for r in none)


def scan(numbers, most, start, grace, last):
    misses, reached = 0, None
    for i in range(start, last + 1):
        if i in numbers:
            misses, reached = 0, i
        else:
            misses += 1
            if misses > most and i > start + grace:
                return i, reached
    return None, reached


def test_gaps_stop_where_a_scan_stops(spark):
    rng = random.Random(3)
    series = {k: sorted({rng.randrange(1, rng.choice([60, 300, 900])) for _ in range(rng.randrange(1, 60))}) for k in range(25)} | {90: [1], 91: [200], 92: list(range(1, 100))}
    rows = [(k, str(i)) for k, own in series.items() for i in own + own[:2]] + [(90, "x"), (90, None), (90, "0")]
    for most, start, grace in ((20, 1, 50), (5, 1, 0), (20, 30, 50)):
        got = gap_stops(spark.createDataFrame(rows, "k int, i string"), ["k"], "i", most, start, grace, last=1000).collect()
        for r in got:
            own = [i for i in series[r.k] if i >= start]
            assert (r.high, r.next_start) == (max(own), max(own) + 1)
            assert (r.stop, r.reached) == scan(set(own), most, start, grace, 1000), (r.k, most, start)
        assert {r.k for r in got} == {k for k, own in series.items() if max(own) >= start}
    assert gap_stops(spark.createDataFrame(rows, "k int, i string").where(F.lit(False)), ["k"], "i", 3).count() == 0
