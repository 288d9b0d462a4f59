"""Operators over log lines (log, n, line): error attribution, runs and phases, health rules; and gaps in number series.

A log's order is its line number n. Windows run over one log each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a line of an extraction log says, in order of precedence: (kind, pattern, lines looked back for the
# file that was named, 0 for none). A kind with a look-back counts only where a file is found.
ERROR_RULES = [
    ("auth_errors", r"Auth error", 5),
    ("rate_limits", r"[Rr]ate limit", 0),
    ("timeouts", r"timed out", 3),
    ("json_parse", r"JSON parse error", 3),
    ("failures", r"^FAILED", 3),
    ("circuit_breakers", r"Circuit breaker", 0),
    ("terminated", r"Terminated", 0),
    ("session_limit_hits", r"(?i)session limit", 8),
]
NAMED_FILE = r"\] (.+\.txt)"
RUN_START, RUN_DONE = r"Starting .*pipeline", r"Pipeline complete"
PHASE_START, PHASE_DONE = r"Fetching (.+?)\.\.\.", r"(.+?) (?:fetch )?done"
SLOW_SECONDS = 1200


def stamped(lines: DataFrame) -> DataFrame:
    """Lines, stripped, with `ts`: the time in brackets at their start, else null."""
    bare = F.btrim("line", F.lit(" \t\n\x0b\f\r"))
    ts = F.try_to_timestamp(F.regexp_extract(bare, r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\]", 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    return lines.withColumn("line", bare).withColumn("ts", ts)


def attributed_errors(lines: DataFrame, rules: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """(log, n, kind, file) of lines that a rule of (kind, pattern, look-back) fits, the first rule that does; with a
    look-back the first file named in so many lines before, and no row without one."""
    rules = rules or ERROR_RULES
    order = Window.partitionBy("log").orderBy("n")
    bare = F.btrim("line", F.lit(" \t\n\x0b\f\r"))
    kind, back = F.lit(None).cast("string"), F.lit(0)
    for name, pattern, look in reversed(rules):
        kind, back = F.when(bare.rlike(pattern), name).otherwise(kind), F.when(bare.rlike(pattern), look).otherwise(back)
    frames = sorted({look for _, _, look in rules if look})
    named = lines.select("log", "n", kind.alias("kind"), back.alias("back"), F.nullif(F.regexp_extract("line", NAMED_FILE, 1), F.lit("")).alias("named"))
    seen = named.withColumns({f"__{k}": F.first("named", ignorenulls=True).over(order.rowsBetween(-k, -1)) for k in frames})
    file = F.lit(None).cast("string")
    for k in frames:
        file = F.when(F.col("back") == k, F.col(f"__{k}")).otherwise(file)
    return seen.where("kind is not null").select("log", "n", "kind", file.alias("file"), "back").where("back = 0 or file is not null").drop("back")


def blocking_files(lines: DataFrame, least: int = 2, look_back: int = 8, pattern: str = "Auth error", flag: str = "Chunking:") -> DataFrame:
    """(file, n): files that were being cut into chunks when `least` or more authorization errors came: the last file
    named in the lines before the error, if one of these lines has the flag too."""
    frame = Window.partitionBy("log").orderBy("n").rowsBetween(-look_back, -1)
    named = F.nullif(F.regexp_extract("line", NAMED_FILE, 1), F.lit(""))
    seen = lines.select(F.contains("line", F.lit(pattern)).alias("hit"), F.last(named, ignorenulls=True).over(frame).alias("file"), F.max(F.contains("line", F.lit(flag))).over(frame).alias("flagged"))
    return seen.where("hit and flagged and file is not null").groupBy("file").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def run_durations(lines: DataFrame, start: str = RUN_START, done: str = RUN_DONE) -> DataFrame:
    """(log, n, started, completed, seconds, overlapped) of each run: completed by the first such line before the next
    start, else null; overlapped if the run before it had not completed when it started."""
    order = Window.partitionBy("log").orderBy("n", "done")
    marks = stamped(lines).where("ts is not null").select("log", "n", "ts", F.explode(F.filter(F.array(F.when(F.col("line").rlike(start), F.lit(0)), F.when(F.col("line").rlike(done), F.lit(1))), lambda x: x.isNotNull())).alias("done"))
    paired = marks.withColumns({"before": F.lag("done").over(order), "after": F.lead("done").over(order), "next": F.lead("ts").over(order)})
    completed = F.when(F.col("after") == 1, F.col("next"))
    runs = paired.where("done = 0").select("log", "n", F.col("ts").alias("started"), completed.alias("completed"), F.coalesce(F.col("before") == 0, F.lit(False)).alias("overlapped"))
    return runs.select("log", "n", "started", "completed", (F.unix_timestamp("completed") - F.unix_timestamp("started")).alias("seconds"), "overlapped")


def phase_durations(lines: DataFrame, start: str = PHASE_START, done: str = PHASE_DONE, slow: int = SLOW_SECONDS) -> DataFrame:
    """(log, n, phase, started, seconds, ended_by, slow) of each phase: it ends at the next done line or at the next
    phase's start, whichever comes first (`ended_by`: done, next, or null if it never ends). A line that starts a phase
    and is done with it has a phase of 0 seconds; done lines without an open phase are passed over."""
    order = Window.partitionBy("log").orderBy("n", "done")
    named = F.regexp_extract("line", start, 1)
    marks = stamped(lines).where("ts is not null").select("log", "n", "ts", named.alias("phase"), F.explode(F.filter(F.array(F.when(named != "", F.lit(0)), F.when(F.col("line").rlike(done), F.lit(1))), lambda x: x.isNotNull())).alias("done"))
    paired = marks.withColumns({"after": F.lead("done").over(order), "next": F.lead("ts").over(order)}).where("done = 0")
    seconds = F.unix_timestamp("next") - F.unix_timestamp("ts")
    ended = F.when(F.col("after") == 1, "done").when(F.col("after") == 0, "next")
    return paired.select("log", "n", "phase", F.col("ts").alias("started"), seconds.alias("seconds"), ended.alias("ended_by"), F.coalesce(seconds > slow, F.lit(False)).alias("slow"))


# Measures as (name, table, aggregate) and rules as (rule, condition over the measures, what it counts).
MEASURES = [
    ("json_parse", "errors", "count_if(kind = 'json_parse')"),
    ("session_hits", "errors", "count_if(kind = 'session_limit_hits')"),
    ("blocking", "blockers", "count(*)"),
    ("timed_out", "pipeline", "count_if(line like '%timed out%')"),
    ("not_found", "pipeline", "count_if(line like '%command not found%')"),
    ("killed", "pipeline", "count_if(line like '%Terminated%')"),
    ("zero_runs", "pipeline", "count_if(line like '%No new extractions%')"),
    ("overlapping", "runs", "count_if(overlapped)"),
    ("slow_phases", "phases", "count_if(slow)"),
    ("crashes", "extraction", "count_if(line rlike 'Traceback|Error:')"),
    ("queued", "extraction", "max_by(cast(nullif(regexp_extract(line, '^Extracting structured data: (\\\\d+) sources', 1), '') as double), n) filter (where line rlike '^Extracting structured data: \\\\d+ sources')"),
    ("minutes", "extraction", "(unix_timestamp(max_by(ts, n) filter (where ts is not null)) - unix_timestamp(min_by(ts, n) filter (where ts is not null))) / 60"),
    ("extracted", "extraction", "min_by(cast(regexp_extract(line, '(\\\\d+) extracted', 1) as double), n) filter (where from_end <= 5 and line rlike '\\\\d+ extracted')"),
    ("failing", "failures", "count_if(fail_count >= 2)"),
    ("given_up", "failures", "count_if(fail_count >= 3)"),
    ("null_dates", "records", "count_if(date is null)"),
    ("dated_names", "records", "count_if(date is null and file rlike '\\\\d{4}-\\\\d{2}-\\\\d{2}')"),
]
HEALTH_RULES = [
    ("blocking_files", "blocking > 0", "blocking"),
    ("json_parse_rate", "json_parse > 5", "json_parse"),
    ("failing_extractions", "failing > 0", "failing"),
    ("skipped_next_run", "given_up > 0", "given_up"),
    ("session_limit", "session_hits > 0", "session_hits"),
    ("timed_out_phases", "timed_out > 0", "timed_out"),
    ("command_not_found", "not_found > 0", "not_found"),
    ("overlapping_runs", "overlapping > 0", "overlapping"),
    ("slow_phases", "slow_phases > 0", "slow_phases"),
    ("extraction_crash", "crashes > 0", "crashes"),
    ("null_dates", "null_dates > 0", "null_dates"),
    ("null_dates_to_mend", "null_dates > dated_names", "null_dates - dated_names"),
    ("low_throughput", "queued > 10 and minutes > 30 and coalesce(extracted, 0) < greatest(3, queued * 0.05)", "coalesce(extracted, 0)"),
    ("stalled", "zero_runs >= 3", "zero_runs"),
    ("terminated", "killed > 0", "killed"),
]


def health_report(pipeline: DataFrame, extraction: DataFrame, failures: DataFrame, records: DataFrame, measures: list[tuple[str, str, str]] | None = None, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(rule, hit, n) for each rule over two logs, failures (file, fail_count) and records (file, date).

    Measures are aggregates of the tables named in them: pipeline and extraction (lines with ts; of extraction also
    from_end, the line's number from the end), errors, blockers, runs and phases (the operators above), failures and
    records. Each table is aggregated once; the figures meet in one row, and all rules are one `stack` over it.
    """
    measures, rules = measures or MEASURES, rules or HEALTH_RULES
    from_end = F.row_number().over(Window.partitionBy("log").orderBy(F.desc("n")))
    tables = {
        "pipeline": stamped(pipeline), "extraction": stamped(extraction).withColumn("from_end", from_end), "errors": attributed_errors(extraction), "blockers": blocking_files(extraction),
        "runs": run_durations(pipeline), "phases": phase_durations(pipeline), "failures": failures, "records": records,
    }
    figures = None
    for table in dict.fromkeys(t for _, t, _ in measures):
        own = [(name, what) for name, t, what in measures if t == table]
        row = tables[table].agg(*[F.expr(what).cast("double").alias(name) for name, what in own])
        named = row.select(F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name, _ in own])))
        figures = named if figures is None else figures.unionByName(named)
    one = figures.agg(*[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name, _, _ in measures])
    listed = ", ".join(f"'{rule}', coalesce({condition}, false), cast({count} as double)" for rule, condition, count in rules)
    return one.selectExpr(f"stack({len(rules)}, {listed}) as (rule, hit, n)")


def gap_stops(numbers: DataFrame, keys: list[str], number: str, most_misses: int, start: int = 1, grace: int = 50, last: int | None = None) -> DataFrame:
    """(*keys, high, next_start, stop, reached) of series of numbers: the highest and the one after it; where a scan
    upwards from `start` stops, namely at the first number that is more than `grace` beyond the start and the last of
    more than `most_misses` missing ones in a row (null if it gets to `last` before); and the highest number it sees.
    """
    series: Column = F.col(number).try_cast("long")
    own = numbers.select(*keys, series.alias("__i")).where(F.col("__i") >= start).distinct()
    before = F.coalesce(F.lag("__i").over(Window.partitionBy(*keys).orderBy("__i")), F.lit(start - 1))
    gaps = own.select(*keys, "__i", before.alias("__before"))
    point = lambda c: F.greatest(c + most_misses + 1, F.lit(start + grace + 1))
    found = gaps.groupBy(*keys).agg(F.max("__i").alias("high"), F.min(F.when(point(F.col("__before")) < F.col("__i"), point(F.col("__before")))).alias("inner"))
    stop = F.coalesce("inner", point(F.col("high")))
    if last is not None:
        stop = F.when(stop <= last, stop)
    ended = found.withColumn("stop", stop)
    seen = gaps.join(ended.select(*keys, "stop"), keys).where("stop is null or __i < stop").groupBy(*keys).agg(F.max("__i").alias("reached"))
    return ended.join(seen, keys, "left").select(*keys, "high", (F.col("high") + 1).alias("next_start"), "stop", "reached")
