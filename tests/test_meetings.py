"""Golden rows of merged meetings and monthly digests."""

import pytest
from pyspark.sql import functions as F

from civicspark.operators.digest import monthly_digests, rebuild_changed
from civicspark.operators.meetings import merged_meetings

RECORDS = """meeting_id string, date string, body string, agency string, doc_type string, procedural_only boolean, _file string,
    votes array<struct<item_id: string, item: string>>, council_positions array<struct<member: string>>, key_quotes array<string>,
    housing_items array<struct<description: string>>, fiscal_items array<struct<description: string>>, legal_flags array<string>, public_comments array<string>"""


def record(file, date="2026-03-01", meeting="m", procedural=False, vote=None, kind="minutes", body="Council", agency="a", lists=True):
    name = file.split("-")[2]
    each = [(f"h {name}",)], [(f"f {name}",)], [f"l {name}"], [f"c {name}"]
    return (meeting, date, body, agency, kind, procedural, file + ".json", [vote or (f"v {name}", "x")], [(f"p {name}",)], [f"q {name}"], *(each if lists else (None, None, None, None)))


def merge(spark, rows, dates=()):
    df = spark.createDataFrame(rows, RECORDS).repartition(3)
    return {r.meeting_id: r for r in merged_meetings(df, spark.createDataFrame(list(dates), "stem string, text_date string")).collect()}


@pytest.mark.parametrize("signal", ["date", "name", "text"])
def test_historical_records_keep_all_but_votes_positions_and_quotes(spark, signal):
    old = {"date": record("1-2-old", date="2020-01-01"), "name": record("1-2-2019_01_02_old"), "text": record("1-2-old")}[signal]
    rows = [record("1-1-now"), record("1-3-later"), old]
    dates = [("1-2-old", "2018-05-05")] if signal == "text" else [("1-1-now", "2026-09-09")]
    m = merge(spark, rows, dates)["m"]
    name = old[6].split("-")[2][:-5]
    assert m.date == "2026-03-01" and m.source_count == 3
    assert [s.date_match for s in m.sources] == [True, False, True]
    assert [v.item_id for v in m.votes] == ["v now", "v later"] and [p.member for p in m.council_positions] == ["p now", "p later"] and m.key_quotes == ["q now", "q later"]
    assert [h.description for h in m.housing_items] == ["h now", f"h {name}", "h later"]
    assert m.legal_flags == ["l now", f"l {name}", "l later"] and m.public_comments == ["c now", f"c {name}", "c later"] and len(m.fiscal_items) == 3


def test_undated_and_procedural_records(spark):
    rows = [record("1-1-a", date=None), record("1-2-b", date=""), record("1-3-c", procedural=True, kind="agenda"), record("1-4-d", kind="exhibit", date="2020-01-01"), record("1-5-e")]
    m = merge(spark, rows)["m"]  # 2020 and 2026 tie among all records with the procedural one gone from the second count only
    assert m.date == "2020-01-01" and m.source_count == 5 and len(m.sources) == 4 and m.doc_types == ["exhibit", "minutes"]
    assert [s.date_match for s in m.sources] == [True, True, False, True]
    lone = merge(spark, [record("1-1-a", procedural=True, meeting="n"), record("1-1-a", procedural=True, meeting="o"), record("1-2-b", procedural=True, meeting="o")])
    assert len(lone["n"].votes) == 1 and (lone["o"].votes, lone["o"].source_count, lone["o"].body, lone["o"].date, lone["o"].procedural_only) == ([], 2, "Unknown", "", True)


def test_vote_keys_ties_and_missing_lists(spark):
    rows = [record("1-1-a", vote=("", " Motion X ")), record("1-2-b", vote=(None, "motion x")), record("1-3-c", vote=("", "")), record("1-4-d", vote=(None, None), lists=False), record("1-5-e", vote=("7", "y"), agency="b"), record("1-6-f", vote=("7", "z"), agency="b", body="Board")]
    m = merge(spark, rows)["m"]
    assert [(v.item_id, v.item) for v in m.votes] == [("", " Motion X "), ("", ""), (None, None), ("7", "y")]
    assert (m.agency, m.body, len(m.housing_items)) == ("a", "Board", 5)
    assert merge(spark, []) == {}


# ---- digests

PERMITS = "ord int, permit_no string, type string, status string, description string, applied string, approved string, issued string"
PROJECTS = "ord int, project_id string, project_name string, estimated_units int, owner string, source string, permits array<string>"


def sources(spark):
    meetings = merged_meetings(spark.createDataFrame([record("1-1-a"), record("1-1-b", meeting="m2", body="Board"), record("1-1-p", meeting="m3", date="2026-04-02", procedural=True)], RECORDS))
    meetings = meetings.withColumn("legal_flags", F.when(F.col("meeting_id") == "m2", F.array(F.lit(" L A "), F.lit("new"))).otherwise(F.col("legal_flags")))
    permits = [(1, "P1", "SFD", "ISSUED", "24 UNIT", "3/5/2026", "2026-04-01", None), (2, "P2", "MF", "ISSUED", "4-PLEX", "2026-03-09", None, ""), (3, "P3", "MF", "OLD", None, "3/1/2026", None, "5/1/2026"), (4, "P4", None, None, "x", None, None, None)]
    intel = [(1, "2026-03", "s", "t", "u", None), (2, None, "s", "t", "u", 5)]
    planning = [(1, "D1", "PLAN", "x" * 120, "2026-03-02", "1 A ST")]
    return (
        meetings, spark.createDataFrame(permits, PERMITS), spark.createDataFrame(intel, "ord int, month string, source string, title string, url string, relevance_score int"),
        spark.createDataFrame(planning, "ord int, project_no string, type string, description string, applied string, address string"),
    )


def test_each_section_of_a_digest(spark):
    projects = [(1, "A", "Alpha", 9, "me", "named", ["P1", "P2"]), (2, "B", "Beta", 3, "you", "type_aggregate", ["P2", "P3"]), (3, "C", "Gamma", 1, "", "named", [])]
    got = {r.month: r for r in monthly_digests(*sources(spark), spark.createDataFrame(projects, PROJECTS)).collect()}
    assert set(got) == {"2026-03", "2026-04", "2026-05"}
    march = got["2026-03"]
    assert (march.meeting_count, march.substantive_count, march.bodies, march.agencies) == (2, 2, ["Board", "Council"], ["a"])
    assert march.activity_summary.asDict() == {"meetings_with_votes": 2, "meetings_with_housing": 2, "total_votes": 2, "total_housing_items": 2, "total_legal_flags": 3}
    assert march.legal_flags == ["l a", "new"] and [h.description for h in march.housing_items] == ["h a", "h b"]
    assert (march.permits.total, march.permits.estimated_units, march.permits.by_type) == (3, 26, {"MF": 2, "SFD": 1})
    assert [tuple(p) for p in march.permits.projects] == [("Beta", 3, 2, None), ("Alpha", 9, 1, "me")]
    assert march.permits_approved is None and got["2026-04"].permits_approved.total == 1 and got["2026-05"].permits_issued.total == 1
    assert [tuple(i) for i in march.intel] == [("s", "t", "u", 0)] and got["2026-04"].intel is None
    assert march.planning_projects.total == 1 and len(march.planning_projects.projects[0].description) == 100 and got["2026-05"].planning_projects is None
    april = got["2026-04"]
    assert (april.meeting_count, april.substantive_count, april.permits) == (1, 1, None) and got["2026-05"].meeting_count == 0


def test_only_changed_months_are_rebuilt(spark, tmp_path):
    path = str(tmp_path / "digests")
    meetings, permits, intel, planning = sources(spark)
    assert rebuild_changed(spark, path, meetings, permits, intel, planning).count() == 3
    assert rebuild_changed(spark, path, meetings, permits, intel, planning).count() == 0
    edited = meetings.withColumn("key_quotes", F.when(F.col("meeting_id") == "m3", F.array(F.lit("edited"))).otherwise(F.col("key_quotes")))  # counts stay
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "digests").glob("month=2026-03/*.parquet")}
    assert [r.month for r in rebuild_changed(spark, path, edited, permits, intel, planning).collect()] == ["2026-04"]
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "digests").glob("month=2026-03/*.parquet")} == before
    full = monthly_digests(edited, permits, intel, planning)
    assert {r.month: r.asDict(True) for r in spark.read.parquet(path).select(full.columns).collect()} == {r.month: r.asDict(True) for r in full.collect()}
