"""Word overlap, contained keywords, and links of filings, entitlements and meetings, against plain loops over all pairs."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from civicspark.functions import text as X
from civicspark.operators.linkage import entitlement_links, filing_permits, meeting_links, planning_links
from civicspark.operators.overlap import contained_words, keyword_matches, overlap_pairs, token_pairs
from civicspark.plans import bindings, catalog
from tests.oracle import SF_DIR


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_overlap_equals_all_pairs(spark, least):
    rng = random.Random(least)
    pick = lambda: list({"HOT", *rng.choices("abcdefghijklmnop", k=rng.randrange(6))}) if rng.random() < 0.7 else rng.sample("abcdefgh", 3)
    a, b = ([(i, pick()) for i in range(n)] for n in (60, 80))
    a += [(60, []), (61, None), (62, a[3][1])]
    want = sorted(((i, j, len(set(x) & set(y))) for i, x in a for j, y in b if x and y and len(set(x) & set(y)) >= least), key=repr)
    left, right = spark.createDataFrame(a, "i int, u array<string>"), spark.createDataFrame(b, "j int, v array<string>")
    assert rows(overlap_pairs(left, right, "i", "j", "u", "v", least)) == want


def test_the_commonest_word_lists_no_set(spark):
    """Two words each, of which HARBOR stands in all: only equal rare words meet."""
    n = 400
    left = spark.createDataFrame([(i, f"HARBOR X{i:05d}") for i in range(n)], "i int, u string")
    right = left.select(F.col("i").alias("j"), F.col("u").alias("v"))
    assert token_pairs(left, right, "i", "j", "u", "v").count() == n
    met = token_pairs(left, right, "i", "j", "u", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in met


def test_keywords_equal_all_pairs(spark):
    rng = random.Random(5)
    words = ["PARK", "parkway", "HARBOR", "view", "OAK", "villa", "ñandu"]
    names = ["-".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(30)] + ["PARK PARK", "park-PARK side", "", "abc def"]
    texts = [(i, " ".join(rng.choices([*words, "the", "sideparks", "harborview"], k=rng.randrange(6)))) for i in range(50)] + [(90, ""), (91, None), (92, "Park"), (93, "park")]
    want = set()
    for name in set(names):
        spelled = [w for w in name.upper().replace("-", " ").split() if len(w) > 3]
        for i, t in texts:
            hits = sum(w in (t or "").upper() for w in spelled)
            if hits >= 2:
                want.add((name, i, hits))
    got = keyword_matches(spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame(texts, "i int, t string"), "n", "i", "t")
    assert rows(got) == sorted(want, key=repr) and ("PARK PARK", 92, 2) in want


def test_contained_words_by_their_rarest_gram(spark):
    words = spark.createDataFrame([("ABCD",), ("BCDE",), ("ABCDE",), ("XYZW",), ("abc",)], "word string")
    texts = spark.createDataFrame([("xABCDEx",), ("ABCD",), ("short",), ("",), (None,), ("BCD",)], "text string")
    assert rows(contained_words(words, texts)) == [("ABCD", "ABCD"), ("ABCD", "xABCDEx"), ("ABCDE", "xABCDEx"), ("BCDE", "xABCDEx")]


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_no_plan_has_a_nested_loop(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for name in ("j3_entitlement_match", "j4_planning_match", "j6_meeting_mentions", "j9_filing_crossref", "u3_word_overlap"):
            plan = catalog.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("name", "labels"), [
    ("j3_entitlement_match", {"apn", "name"}), ("j4_planning_match", {"apn", "entitlement_ref", "address", "name_fuzzy"}),
    ("j6_meeting_mentions", {"project_ref", "address", "name_fuzzy"}), ("j9_filing_crossref", {"apn", "addr_in_desc", "addr_fuzzy", "none"}),
])
def test_queries_show_every_label(spark, name, labels):
    assert {r.method for r in catalog.QUERIES[name](spark, SF_DIR).select("method").distinct().collect()} == labels


def test_entitlement_links(spark):
    projects = [(1, "harbor-view homes", ["9", "7"]), (2, "Harbor-View homes", []), (3, "sea", ["", None]), (4, "park park", None)]
    projects = spark.createDataFrame(projects, "id int, name string, apns array<string>")
    found = [(5, "E5", "", "HARBORSIDE VIEWS", "7", "a5"), (2, "E2", "HARBOR VIEW HOMES", "x", "3", "a2"), (1, "E1", "homes at harbor view", None, "9", "a1"), (4, "E4", "Old Park", None, None, "a4")]
    found = spark.createDataFrame(found, "ord int, project_no string, project_name string, description string, apn string, address string")
    assert rows(entitlement_links(projects, found)) == [(1, "E5", "a5", "7", "apn"), (2, "E1", "a1", "9", "name"), (4, "E4", "a4", None, "name")]


# ---- filings and permits


def normal(address):
    out = re.sub(r"\s+", " ", (address or "").upper().strip())
    for full, short in X.STREET_WORDS:
        out = re.sub(rf"\b{full}\b", short, out)
    return re.sub("[#,.]", "", out).strip()


def by_hand(filings, permits, most):
    at_street, parcels = {}, {}
    housing = lambda p: (p[2] or "").upper() in X.CROSSREF_TYPES or any(w in (p[3] or "").upper() for w in X.CROSSREF_WORDS)
    for p in permits:
        if p[1]:
            parcels.setdefault(p[1], []).append(p)
        for m in re.finditer(X.ADDRESS_IN_TEXT, (p[3] or "").upper()):
            at_street.setdefault(normal(m[0]), []).append(p)
    number = lambda s: re.match(r"\d*", s)[0]
    out = []
    for i, apn, address in filings:
        at, found, how = normal(address), [], None
        if apn in parcels:
            found, how = parcels[apn], "apn"
        elif number(at) and at in at_street:
            found, how = at_street[at], "addr_in_desc"
        elif number(at):
            like = next((s for s in at_street if number(s) == number(at) and len(set(s.split()) & set(at.split())) >= 2), None)
            found, how = at_street.get(like, []), "addr_fuzzy" if like else None
        some = [p for p in found if housing(p)] or found
        out.append((i, [p[0] for p in some[:most]], bool(found), how))
    return sorted(out, key=repr)


def test_filing_permits_equal_plain_loops(spark):
    rng = random.Random(9)
    streets, types = ["ELM ST", "Elm Street", "N ELM ST", "OAK AVE", "COAST HWY", "OAK PL", "S. PINE WAY"], ["BLD MULTI FAMILY", "SIGN", "bld condo", None]
    told = lambda: rng.choice(["new house", f"bldg {rng.randrange(10, 14)} {rng.choice(streets)} x", f"{rng.randrange(10, 14)} {rng.choice(streets)} 24 unit, {rng.randrange(10, 14)} {rng.choice(streets)}", None])
    permits = [(k, rng.choice(["", None, "1", "2", "3"]), rng.choice(types), told()) for k in range(120)]
    ask = lambda: rng.choice([f"{rng.randrange(9, 15)} {rng.choice(streets)}", f"{rng.randrange(10, 14)}-B {rng.choice(streets)}", f"{rng.randrange(10, 14)}", "", None, "ELM ST", "12 Unknown Rd"])
    filings = [(i, rng.choice(["", None, "2", "8", "9"]), ask()) for i in range(150)]
    left = spark.createDataFrame(filings, "ord int, apn string, address string")
    right = spark.createDataFrame([(*p, p[0]) for p in permits], "ord int, apn string, type string, description string, permit int").repartition(5)
    for most in (20, 3):
        want = by_hand(filings, permits, most)
        got = filing_permits(left, right, most).collect()
        assert sorted(((r.ord, r.permits, r.has_building_permit, r.match_method) for r in got), key=repr) == want
    assert {w[3] for w in want} == {"apn", "addr_in_desc", "addr_fuzzy", None}


def test_filings_without_permits_and_a_hot_parcel(spark):
    filings = spark.createDataFrame([(i, "7", "1 A ST") for i in range(300)], "ord int, apn string, address string")
    none = spark.createDataFrame([], "ord int, apn string, type string, description string, permit int")
    assert filing_permits(filings, none).where("match_method is null and size(permits) = 0").count() == 300
    many = spark.range(5000).selectExpr("cast(id as int) ord", "'7' apn", "'SIGN' type", "'100 MAIN ST' description", "cast(id as int) permit")
    got = filing_permits(filings, many).select("permits").distinct().collect()
    assert [r.permits for r in got] == [list(range(20))]
    assert Counter(r.match_method for r in filing_permits(filings.withColumn("apn", F.lit("")), many).collect()) == {None: 300}


def test_links_over_nulls_and_empty_tables(spark):
    projects = spark.createDataFrame([(1, None, None, None, None)], "id int, apn string, refs array<string>, address string, name string")
    items = spark.createDataFrame([(None, None, None, None)], "meeting_id string, filing_numbers array<string>, address string, description string")
    assert meeting_links(projects, items).count() == 0
    plans = spark.createDataFrame([], "project_no string, apn string, address string, description string")
    assert planning_links(projects, plans).count() == 0
    assert bindings.table(spark, SF_DIR, "mentions").where("description is null").count() == 0
