"""Golden rows and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicspark.functions import dates as D
from civicspark.functions import text as X
from civicspark.operators.linkage import longest_prefix, meeting_links, nearest_day, planning_links, scored_links
from civicspark.operators.projects import group_permits, islands
from civicspark.operators.textops import cuts, extract_records, packet_items, table_rows
from civicspark.plans import catalog, text_queries
from civicspark.streaming.jobs import changed_keys
from tests.oracle import SF_DIR, compare


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("1/5/2025", "2025-01-05"), ("2025-02-01", "2025-02-01"), ("13/45/2025", "2025-13-45"), ("a/b/c", ""), ("", ""), (None, "")])
def test_lenient_date(spark, text, want):
    assert one(spark, D.lenient_date(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("name", "want"), [("1-2-Ordinance_No__21_OR", 2021), ("1-2-No__45_D", 1945), ("1-2-2023_10_04_Minutes", 2023), ("1-2-10_4_2022_x", 2022), ("plain", None)])
def test_filename_year(spark, name, want):
    assert one(spark, D.filename_year(F.lit(name))) == want


@pytest.mark.parametrize(("text", "want"), [("4-PLEX", 4), ("TRIPLEX", 3), ("2 DUPLEX", 2), ("NEW DUPLEX", 2), ("NEW 24 UNIT APT", 24), ("NEW HOUSE", 1)])
def test_units(spark, text, want):
    assert one(spark, X.estimated_units(F.lit(text))) == want


def test_address(spark):
    assert one(spark, X.normalized_address(F.lit(" 101  North Elm Street, #4"))) == "101 N ELM ST 4"
    assert one(spark, X.addresses_match(F.lit("101 N ELM ST"), F.lit("101 ELM AVE")))
    assert not one(spark, X.addresses_match(F.lit("101 N ST"), F.lit("101 N ST")))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n", max_size=400))
def test_chunks_cover_the_text(text):
    got = list(cuts(text, 50, 10))
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (a, b), (c, d) in zip(got, got[1:], strict=False):
        assert c == b - 10 and a < c <= d and b - a <= 50


def test_islands_and_groups_partition_the_permits(spark):
    rows = [(k, "a", 2025, f"BLDG25-{k:04d}", "BLD SFD OR DUPLEX", "ISSUED", "1/1/2025", f"NEW SFD {k} ELM", "", None) for k in (10, 12, 15, 30, 32)]
    rows.append((40, "a", 2025, "BLDG25-0040", "BLD ACCESSORY DWELLING", "ISSUED", "", "ADU 1 BED", "", None))
    rows.append((50, "a", 2025, "BLDG25-0050", "BLD MULTI FAMILY", "ISSUED", "", "24 UNIT", "", "BLDG24-0900"))
    rows.append((60, "a", 2025, "BLDG25-0060", "BLD DEMOLITION", "ISSUED", "", "GARAGE", "", None))
    permits = spark.createDataFrame(rows, "seq long, agency string, year int, permit_no string, type string, status string, applied string, description string, apn string, linked_parent string")
    assert [r.island_size for r in islands(permits.where("type like '%SFD%'"), ["agency", "year"]).orderBy("seq").collect()] == [3, 3, 3, 2, 2]
    got = {r.seq: (r.project, r.source) for r in group_permits(permits).collect()}
    assert set(got) == {10, 12, 15, 30, 32, 40, 50}
    assert got[10] == got[15] == ("NEW SFD 1", "adjacency") and got[30][1] == "singleton"
    assert got[40] == ("ADU (individual permits)", "type_aggregate") and got[50] == ("24 UNIT", "linked_parent")


def test_links(spark):
    left = spark.createDataFrame([("l", "HARBOR VIEW", "101 N ELM ST"), ("m", "X", "7 OAK ST")], "id string, name string, address string")
    right = spark.createDataFrame([("r", "HARBOR VIEW 2", "101 N ELM ST"), ("s", "Y", "7 PINE AVE")], "id string, name string, address string")
    assert [tuple(r) for r in scored_links(left, right).collect()] == [("l", "r", 95.0)]


def test_overrides_win_over_scores(spark):
    left = spark.createDataFrame([("l", "HARBOR VIEW", "101 N ELM ST"), ("m", "HARBOR VIEW", "101 N ELM ST"), ("n", "X", "7 OAK ST")], "id string, name string, address string")
    right = spark.createDataFrame([("r", "HARBOR VIEW 2", "101 N ELM ST")], "id string, name string, address string")
    given = spark.createDataFrame([("m", "q"), ("n", "r"), ("o", "r")], "left_id string, right_id string")
    assert sorted(tuple(r) for r in scored_links(left, right, overrides=given).collect()) == [("l", "r", 95.0), ("m", "q", None), ("n", "r", None)]


def test_planning_and_meeting_links_by_all_methods(spark):
    projects = [(1, "11", ["D1"], "101 N Elm Street", "Harbor View"), (2, " ", [], "7 Oak Ave", "Sea"), (3, None, [], None, "North Harbor View Homes"), (4, "", None, "", None)]
    projects = spark.createDataFrame(projects, "id int, apn string, refs array<string>, address string, name string")
    plans = spark.createDataFrame([("D1", "11", "101 ELM ST", "HARBOR VIEW"), ("D2", "", "7 OAK AVE", "harbor plaza"), ("D3", "11", "", "view of harbor"), ("D4", " ", "101 PINE ST", None)], "project_no string, apn string, address string, description string")
    assert sorted(tuple(r) for r in planning_links(projects, plans).collect()) == [(1, "D1", "apn"), (1, "D3", "apn"), (2, "D2", "address"), (3, "D1", "name_fuzzy"), (3, "D3", "name_fuzzy")]
    assert (1, "D1", "entitlement_ref") in [tuple(r) for r in planning_links(projects.withColumn("apn", F.lit("")), plans).collect()]
    items = [("a", [" d1 "], "", "x"), ("b", ["D9"], "101 ELM ST", "y"), ("c", ["D9"], "", "Harborside views"), ("d", [], "", "Harbor View"), ("e", None, "7 oak avenue", None)]
    items = spark.createDataFrame(items, "meeting_id string, filing_numbers array<string>, address string, description string")
    got = sorted(tuple(r) for r in meeting_links(projects, items).collect())
    assert got == [(1, "a", "x", "project_ref"), (1, "b", "y", "address"), (1, "c", "Harborside views", "name_fuzzy"), (2, "e", "", "address"), (3, "c", "Harborside views", "name_fuzzy")]


def test_prefix_and_nearest_day(spark):
    names = spark.createDataFrame([("12-a-agenda.txt",), ("12-b",), ("9-x",)], "name string")
    ids = spark.createDataFrame([("12",), ("12-a",)], "id string")
    assert dict(longest_prefix(names, ids, "name", "id").collect()) == {"12-a-agenda.txt": "12-a", "12-b": "12", "9-x": None}
    a = spark.sql("select 1 v, 'x' k, date'2024-01-05' d")
    b = spark.sql("select 7 m, 'x' k, date'2024-01-06' d union all select 8, 'x', date'2024-01-05'")
    assert nearest_day(a, b, "k", "d", "v", "m").first().m == 8


def test_packets_tables_and_records(spark):
    docs = spark.createDataFrame([(1, "cover\fItem: 3 a\fmore\fItem: 4"), (2, "Item: 1\fx")], "id long, text string")
    assert [(r.item, r.pages) for r in packet_items(docs, "id", "text").orderBy("item").collect()] == [(3, 2), (4, 1)]
    page = spark.createDataFrame([(1, "<table><tr><td>a <b>b</b></td><td>c</td></tr></table>"), (2, None)], "id long, html string")
    assert [list(r.cells) for r in table_rows(page, "id", "html").collect()] == [["a b", "c"]]

    def extractor(text):
        if text == "x":
            raise ValueError
        return "no" if text == "n" else f'says {{"a": "{text}"}}'

    got = {r.id: r for r in extract_records(spark.createDataFrame([(1, "x"), (2, "n"), (3, "q")], "id long, text string"), "id", "text", extractor, "a string").collect()}
    assert (got[1].error, got[2].error, got[3].record.a) == ("ValueError", "no_json", "q")


def test_changed_keys(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, h string")
    old = spark.createDataFrame([("a", "1"), ("b", "9")], "k string, h string")
    assert sorted(r.k for r in changed_keys(new, old, "k", "h").collect()) == ["b", "c"]
    assert changed_keys(new, None, "k", "h").count() == 3


def test_no_whole_group_in_a_cell(spark):
    plan = lambda name: catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan("x11_transcript") and "<= 6" in plan("s11_tail")


def test_json_values_grow_in_number(spark, monkeypatch):
    whole = text_queries._shards
    assert whole(spark.range(95), 8, rows=10) == 10 and whole(spark.range(5), 8, rows=10) == 8
    asked = []
    monkeypatch.setattr(text_queries, "_shards", lambda df, least: asked.append(least) or whole(df, least, rows=10))
    for name in ("s3_array_union", "s9_lookup_object"):
        compare(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name])
    assert asked == [8, 16]
