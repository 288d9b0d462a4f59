"""Golden rows of published tables, volume reports, zone lookups and videos."""

from pyspark.sql import functions as F

from civicspark.operators.linkage import meeting_videos
from civicspark.operators.publish import columns_of, filings_table, housing_table, licenses_table, permits_table, planning_table
from civicspark.operators.reports import fallback_zones, volume_report

PARCELS = "apn string, address string, street string"
ZONING = "apn string, zone_code string, zone_category string, density string, height string"


def places(spark):
    parcels = spark.createDataFrame([("1", "10", "ELM ST"), ("2", "", "OAK"), (None, "1", "X"), ("3", "7", "PINE")], PARCELS)
    zoning = spark.createDataFrame([("1", "R-1", "res", "29 du/acre", "35 FT"), ("3", "D-2", None, "n/a", "NaN")], ZONING)
    return parcels, zoning


def test_permits_in_their_layout(spark):
    schema = "permit_no string, year int, agency string, type string, subtype string, description string, status string, applied string, approved string, issued string, apn string, owner string, address string, zone_code string, is_downtown boolean"
    rows = [("P1", 2025, "a", "SFD", None, "d", "x", "1/5/2025", "", "soon", "1", None, "", "", None), ("P2", None, None, None, "s", None, None, "2025-01-05", None, None, "1", "me", "own", "OWN", True), ("P3", 2025, "a", "t", "", "", "", "", "", "", "", "", "", "", False)]
    projects = spark.createDataFrame([(1, "A", ["P1"]), (2, "B", ["P1", "P9"])], "ord int, project_id string, permits array<string>")
    got = {r.permit_no: r for r in permits_table(spark.createDataFrame(rows, schema), projects, *places(spark)).collect()}
    one, two, three = got["P1"], got["P2"], got["P3"]
    assert list(one.asDict()) == list(columns_of("permits")) and len(columns_of("permits")) == 19
    assert (one.applied, one.approved, one.issued, one.address, one.zone_code, one.zone_category, one.max_density, one.max_height, one.is_downtown, one.project_id, one.subtype) == ("2025-01-05", None, None, "10 ELM ST", "R-1", "res", 29.0, "35 FT", False, "B", "")
    assert (two.year, two.agency, two.address, two.zone_code, two.zone_category, two.project_id) == (0, "", "own", "OWN", "res", "")
    assert (three.apn, three.address, three.max_density, three.max_height) == ("", "", None, "")


def test_housing_is_flattened(spark):
    one = """named_struct('permit_project', named_struct('project_id', 'P', 'permit_count', 3), 'planning_projects', array(named_struct('project_no', 'D1'), named_struct('project_no', 'D2')),
        'apr_filings', array(named_struct('tracking_id', 'T1')), 'meeting_mentions', array(named_struct('date', '2025-01-01', 'outcome', 'a'), named_struct('date', '2025-02-01', 'outcome', 'b'), named_struct('date', '2025-02-01', 'outcome', 'c'), named_struct('date', '', 'outcome', 'd')))"""
    row = f"""SELECT 'HP' project_id, 'n' project_name, 'a' agency, '' address, '3' apn, CAST(NULL AS DOUBLE) latitude, -117.5 longitude, true is_downtown, named_struct('best', 5L, 'best_source', 'apr', 'apr_proposed', 5L, 'apr_approved', CAST(NULL AS BIGINT), 'permit_estimated', 2L, 'planning_units', 1L) units,
        named_struct('very_low', 1L, 'low', 2L, 'moderate', 3L, 'above_moderate', 4L) income_tiers, 'built' status, true density_bonus, CAST(NULL AS BOOLEAN) sb35, CAST(NULL AS STRING) first_activity, '2025-02-01' last_activity, {one} sources"""
    r = housing_table(spark.sql(row), *places(spark)).first()
    assert list(r.asDict().items()) == [
        ("project_id", "HP"), ("project_name", "n"), ("agency", "a"), ("address", "7 PINE"), ("apn", "3"), ("latitude", 0.0), ("longitude", -117.5), ("is_downtown", True), ("zone_code", "D-2"), ("zone_category", ""), ("max_density", None), ("max_height", ""),
        ("units_best", 5), ("units_source", "apr"), ("units_apr_proposed", 5), ("units_apr_approved", 0), ("units_permit_estimated", 2), ("income_very_low", 1), ("income_low", 2), ("income_moderate", 3), ("income_above_moderate", 4), ("status", "built"),
        ("density_bonus", True), ("sb35", False), ("first_activity", ""), ("last_activity", "2025-02-01"), ("permit_count", 3), ("planning_refs", "D1,D2"), ("apr_tracking_ids", "T1"), ("meeting_mention_count", 4), ("latest_meeting_outcome", "b"), ("latest_meeting_date", "2025-02-01"),
    ]


def test_other_layouts_fill_what_is_missing(spark):
    text = lambda names: [F.lit(None).cast("string").alias(c) for c in names]
    one = spark.range(1)
    plans = one.select(*text([c for c in columns_of("planning_projects") if c not in ("zone_code", "max_density", "max_height", "apn")]), F.lit("1").alias("apn"))
    r = planning_table(plans, *places(spark)).first()
    assert (r.address, r.zone_code, r.max_density, r.max_height, r.year, r.applied) == ("10 ELM ST", "R-1", 29.0, "35 FT", 0, "")
    raw = {"tracking_id": "jurs_tracking_id", "density_bonus": "density_bonus_received", "sb35": "app_submitted_sb35"}
    filings = one.select(*text([raw.get(c, c) for c in columns_of("apr_filings") if c != "zones"]), F.lit("S").alias("std_address"), F.array(F.lit("a"), F.lit("b")).alias("zones"))
    r = filings_table(filings).first()
    assert (r.street_address, r.zones, r.latitude, r.is_downtown, r.year, r.match_method) == ("S", "a,b", 0.0, False, 0, "")
    assert licenses_table(one.select(*text(columns_of("str_licenses")))).first().asDict() == {"account": 0, "latitude": 0.0, "longitude": 0.0, **{c: "" for c in ("business", "license_status", "business_area", "rental_type", "address", "apn", "property_manager")}}
    assert [len(columns_of(n)) for n in ("permits", "permit_projects", "apr_filings", "housing_projects", "planning_projects", "str_licenses")] == [19, 11, 23, 32, 15, 10]


def test_volume_report(spark):
    docs = spark.createDataFrame([("a", "2026-01-05"), ("a", "2026-01-05"), ("a", "2026-01-07"), ("b", "2026-01-07"), ("c", "2026-01-07"), ("x", "2026-01-07"), ("d", "2025-12-01"), ("a", None)], "agency string, day string")
    agencies = spark.createDataFrame([("a", False, False), ("b", None, True), ("c", True, True), ("d", None, None), ("e", True, None), ("f", False, True)], "agency string, tally_only boolean, forward_only boolean")
    got = {(r.block, r.name): (r.tier, r.docs, r.per_day, r.per_month, r.last_day) for r in volume_report(docs, agencies, "2026-01-01").collect()}
    assert got == {
        ("agency", "a"): ("FULL", 3, 1.5, None, None), ("agency", "b"): ("FORWARD", 1, 0.5, None, None), ("agency", "c"): ("TALLY", 1, 0.5, None, None), ("agency", "x"): ("?", 1, 0.5, None, None), ("total", "TOTAL"): (None, 6, 3.0, None, None),
        ("tier", "FULL"): ("FULL", 3, 1.5, None, None), ("tier", "FORWARD"): ("FORWARD", 1, 0.5, None, None), ("tier", "TALLY"): ("TALLY", 1, 0.5, None, None), ("scenario", "Current (FULL only)"): ("FULL", 3, 1.5, 45.0, None),
        ("scenario", "+ FORWARD agencies"): ("FORWARD", 4, 2.0, 60.0, None), ("scenario", "+ TALLY -> FORWARD"): ("TALLY", 5, 2.5, 75.0, None), ("zero", "d"): ("FULL", 0, None, None, "2025-12-01"), ("zero", "f"): ("FORWARD", 0, None, None, None),
    }
    assert {r.block for r in volume_report(docs.limit(0), agencies, "2026-01-01").collect()} == {"zero"}


def test_zones_by_parcel_then_point(spark):
    asked = spark.createDataFrame([(1, "1", 33.1, -117.0), (2, "9", 33.1000001, -117.0), (3, "2", 33.1, -117.0), (4, "2", None, None), (5, "", 33.1, 0.0), (6, None, 33.2, -117.0), (7, "9", None, -117.0)], "ord int, apn string, latitude double, longitude double")
    parcels = spark.createDataFrame([("1", ["R-1"], False, None), ("2", ["old"], True, "parcel_not_found")], "apn string, zones array<string>, is_downtown boolean, error string")
    points = spark.createDataFrame([(2, 33.1, -117.0, ["late"], False), (1, 33.1000003, -117.0, ["D-1"], True), (3, 0.0, -117.0, ["x"], True)], "ord int, latitude double, longitude double, zones array<string>, is_downtown boolean")
    got = {r.ord: (r.zones, r.is_downtown, r.step) for r in fallback_zones(asked, parcels, points).collect()}
    assert got == {1: (["R-1"], False, "apn"), 2: (["D-1"], True, "point"), 3: (["D-1"], True, "point"), 4: (["old"], True, "apn"), 5: ([], False, "none"), 6: ([], False, "none"), 7: ([], False, "none")}


def test_each_meeting_keeps_its_first_video(spark):
    videos = spark.sql("select * from values (1, 'x', date'2026-01-05'), (2, 'x', date'2026-01-05'), (3, 'x', date'2026-01-07'), (4, 'y', date'2026-01-05') t(v, k, d)")
    meetings = spark.sql("select * from values (7, 'x', date'2026-01-05'), (8, 'x', date'2026-01-08') t(m, k, d)")
    assert sorted(map(tuple, meeting_videos(videos, meetings, "k", "d", "v", "m").collect())) == [(1, 7, 0), (3, 8, 1)]
