"""Copies and hot keys must not multiply rows or memory."""

import random

from pyspark.sql import functions as F

from civicspark.llm.near_dedup import texts_of
from civicspark.operators.digest import intel_entries, intel_section, planning_entries, planning_section
from civicspark.operators.linkage import address_pairs, meeting_links, meeting_videos, planning_links, scored_links
from civicspark.operators.meetings import merged_meetings
from civicspark.operators.overlap import best_keyword_match, met, overlap_pairs_within, signed, spread_pairs
from civicspark.operators.textops import split_oversized
from civicspark.plans import catalog, text_queries
from civicspark.streaming import jobs


def most_rows(df):
    """The rows of df, and the most rows that a step of its plan has put out."""
    rows, most = df.collect(), [0]

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        found = node.metrics().get("numOutputRows")
        if found.isDefined():
            most.append(found.get().value())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return rows, max(most)


def shuffled_rows(df):
    """The rows of df, and the rows that its plan has shuffled."""
    rows, sent = df.collect(), {}

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        found = node.metrics().get("shuffleRecordsWritten")
        if found.isDefined():
            sent[found.get().id()] = found.get().value()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return rows, sum(sent.values())


def test_whole_texts_are_small_files(spark, monkeypatch):
    most, read = [], text_queries.io.read_texts

    def watched(*args):
        texts = read(*args)
        most.append(texts.agg(F.max(F.size(F.split(F.rtrim("text", F.lit("\n")), "\n")))).first()[0])
        return texts

    monkeypatch.setattr(text_queries.io, "read_texts", watched)
    got = catalog.QUERIES["s7_whole_texts"](spark, "/root/testdata/sf0.01").first()
    assert got.docs == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count() > 200 >= most[0]


def test_long_texts_reach_python_in_small_batches(spark):
    docs = spark.createDataFrame([(1, "x" * 99), (2, "y" * 100), (3, "z\n" * 600), (4, None)], "id int, text string")
    parts = split_oversized(docs, "id", "text", 500)
    rows = sorted(parts.collect())
    assert [(r.id, r.part) for r in rows] == [(2, 0), (3, 0), (3, 1), (3, 2)] and "".join(r.text for r in rows if r.id == 3) == "z\n" * 600
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "MapInPandas" not in plan


def test_copies_of_addresses_make_no_pairs(spark):
    left = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.lit("HARBOR VIEW").alias("name"), F.lit("10 ELM ST").alias("address"))
    right = spark.range(3000).select(F.format_string("r%05d", "id").alias("id"), F.lit("HARBOR VIEW").alias("name"), F.lit("10 ELM ST").alias("address"))
    rows, most = most_rows(scored_links(left, right))
    assert len(rows) == 3000 and {tuple(r)[1:] for r in rows} == {("r00000", 95.0)} and most <= 10_000


def test_a_day_of_many_meetings_makes_no_pairs(spark):
    day = lambda name, first: spark.range(first, first + 3000).select(F.col("id").alias(name), F.lit("b").alias("body"), F.lit("2026-01-01").cast("date").alias("day"))
    rows, most = most_rows(meeting_videos(day("video", 0), day("meeting", 5000), "body", "day", "video", "meeting"))
    assert [tuple(r) for r in rows] == [(0, 5000, 0)] and most <= 10_000


def test_a_month_of_many_items_stays_a_small_row(spark):
    intel = spark.range(2000).selectExpr("id ord", "'2026-01' month", "'s' source", "concat('t', id) title", "'u' url", "0 relevance_score")
    planning = spark.range(2000).selectExpr("id ord", "concat('D', id) project_no", "'SIGN PERMIT' type", "'x' description", "'1 A ST' address", "'2026-01-02' applied")
    head = intel_section(intel, lists=False).first().intel
    assert (head.total, head.first.title) == (2000, "t0") and intel_entries(intel).count() == 2000 == len(intel_section(intel).first().intel)
    plans = planning_section(planning, lists=False).first().planning_projects
    assert (plans.total, plans.first.project_no, plans.by_type) == (2000, "D0", {"SIGN PERMIT": 2000}) and planning_entries(planning).count() == 2000


def test_hot_addresses_are_compared_once_and_dealt(spark):
    left = spark.range(2000).select(F.col("id").alias("ord"), F.lit("10 North Elm Street").alias("address"))
    right = spark.range(2000).select(F.col("id").alias("apn"), F.when(F.col("id") % 2 == 0, "10 ELM ST").otherwise("10 OAK ST").alias("address"))
    pairs = address_pairs(left, right)
    assert pairs.count() == pairs.distinct().count() == 2000 * 1000
    by_class = lambda df: df.withColumnRenamed("address", "class")
    met = spark.createDataFrame([("10 North Elm Street", "10 ELM ST")], "l string, r string")
    dealt = spread_pairs(met, by_class(left).withColumnRenamed("class", "l"), by_class(right).withColumnRenamed("class", "r"), "l", "r", most=100_000)
    assert dealt.count() == dealt.distinct().count() == 2000 * 1000
    assert "regexp_extract_all" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_the_best_text_of_a_name_by_plain_loops(spark):
    words = [f"WORD{k}" for k in range(12)]
    rng = random.Random(4)
    names = sorted({" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(200)})
    texts = [(k, " ".join(rng.choices(words[:6] + ["XWORD1X", "other"], k=rng.randrange(1, 6)))) for k in range(60)]
    want = {}
    for n in names:
        hits = [(-sum(w in x for w in n.split()), k) for k, x in texts]
        if min(hits)[0] <= -2:
            want[n] = (min(hits)[1], -min(hits)[0])
    got = best_keyword_match(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame(texts, "k int, text string"), "name", "k", "text")
    assert {r.name: (r.k, r.hits) for r in got.collect()} == want and {h for _, h in want.values()} > {2, 3}


def test_names_of_common_words_make_no_pairs_with_texts(spark):
    names = spark.range(1500).select(F.format_string("HARBOR N%05d harbor", "id").alias("name"))
    texts = spark.range(1500).select(F.col("id").alias("k"), F.format_string("T%05d of HARBOR", "id").alias("text"))
    rows, most = most_rows(best_keyword_match(names, texts, "name", "k", "text"))
    assert len(rows) == 1500 and {(r.k, r.hits) for r in rows} == {(0, 2)} and most <= 50_000


def test_few_texts_are_shuffled_for_their_sets(spark):
    texts = spark.range(20_000).select(F.col("id"), F.concat(F.lit("text "), "id").alias("text")).union(spark.sql("select cast(null as long), 'none'"))
    wanted = spark.range(0, 20_000, 40)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the ids are many
    try:
        rows, sent = shuffled_rows(texts_of(texts, wanted))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(tuple(r) for r in rows) == [(k, f"text {k}") for k in range(0, 20_000, 40)] and sent <= 20_000 / 16 + 4 * 500
    assert texts_of(texts, wanted.limit(0)).count() == 0


def test_page_states_travel_with_their_rows(spark, tmp_path):
    rows = [(1, "u", "x"), (2, "u", None), (3, "u", None), (4, "u", "x"), (5, "u", "x"), (6, "v", None)]
    spark.createDataFrame(rows, "at long, url string, hash string").coalesce(1).write.parquet(str(tmp_path / "in"))
    changes = jobs.page_changes(spark.readStream.schema("at long, url string, hash string").parquet(str(tmp_path / "in")))
    assert "FlatMapGroupsInPandasWithState" in changes._jdf.queryExecution().analyzed().toString()
    jobs.run_available(spark, changes, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = {r.event_id: r.changed for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False, 6: True}


def test_meetings_of_many_documents_are_dealt_over_tasks(spark):
    text = F.array(F.struct(F.concat(F.lit("x"), "id").alias("description")))
    records = spark.range(4000).select(
        F.concat(F.lit("m"), F.col("id") % 40).alias("meeting_id"), F.lit("2026-01-02").alias("date"), F.lit("b").alias("body"), F.lit("a").alias("agency"), F.lit("minutes").alias("doc_type"), F.lit(False).alias("procedural_only"),
        F.format_string("f%05d", "id").alias("_file"), F.array(F.struct(F.lit("").alias("item_id"), F.lit("motion").alias("item"))).alias("votes"), F.array(F.struct(F.lit("p").alias("member"))).alias("council_positions"), F.array(F.lit("q")).alias("key_quotes"),
        text.alias("housing_items"), text.alias("fiscal_items"), F.array(F.lit("l")).alias("legal_flags"), F.array(F.lit("c")).alias("public_comments"),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the rows are large
    try:
        rows = merged_meetings(records).select("meeting_id", F.size("housing_items").alias("n"), F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len({r.meeting_id for r in rows}) == len(rows) == 40 and {r.n for r in rows} == {100} and len({r.part for r in rows}) > 4


def test_linked_pairs_are_not_shuffled(spark):
    """Each project and plan share an address, a third a parcel too and half two words: a pair has its first method, once."""
    n = 400
    own = lambda key: spark.range(n).select(F.col("id").alias(key), (F.col("id") % 3).cast("string").alias("apn"), F.array(F.lit("none")).alias("refs"), F.lit("10 North Elm Street").alias("address"), F.concat(F.lit("HARBOR VIEW "), F.col("id") % 2).alias("name"))
    plans = own("project_no").withColumn("description", F.col("name")).withColumn("address", F.when(F.col("project_no") % 2 == 0, F.lit("10 ELM ST")))
    rows, sent = shuffled_rows(planning_links(own("id"), plans))
    want = {(a, b): "apn" if a % 3 == b % 3 else "address" if b % 2 == 0 else "name_fuzzy" for a in range(n) for b in range(n)}
    assert {(r.id, r.project_no): r.method for r in rows} == want and len(rows) == n * n > 20 * sent


def test_mentions_are_not_shuffled_as_pairs(spark):
    n = 400
    projects = spark.range(n).select("id", F.array(F.format_string("D24-%05d", "id")).alias("refs"), F.lit("10 Elm Street").alias("address"), F.lit("HARBOR harbor").alias("name"))
    items = spark.range(n).select(F.format_string("m%03d", "id").alias("meeting_id"), F.array(F.format_string("d24-%05d", "id")).alias("filing_numbers"), F.when(F.col("id") % 2 == 0, "10 ELM ST").alias("address"), F.lit("the harborside").alias("description"))
    rows, sent = shuffled_rows(meeting_links(projects, items))
    want = {(a, f"m{b:03d}"): "project_ref" if a == b else "address" if b % 2 == 0 else "name_fuzzy" for a in range(n) for b in range(n)}
    assert {(r.id, r.meeting_id): r.method for r in rows} == want and len(rows) == n * n > 20 * sent


def test_rows_meet_under_their_first_sign_in_any_parts(spark):
    rng = random.Random(7)
    some = lambda n: [(k, rng.randrange(3), f"s{rng.randrange(8)}") for k in range(n) for _ in range(rng.randrange(4))]
    a, b = some(120), some(150)
    want = {}
    for i, r, s in a:
        for j, q, t in b:
            if (r, s) == (q, t):
                want[i, j] = min(r, want.get((i, j), r))
    left, right = signed(spark.createDataFrame(a, "i int, rank int, sign string"), spark.createDataFrame(b, "j int, rank int, sign string"), ["i"], ["j"])
    for most in (1, 50, 4_000_000):
        got = met(left, right, most).collect()
        assert {(r.i, r.j): r["rank"] for r in got} == want and len(got) == len(want)


def test_rows_of_a_hot_class_are_copied_for_few_parts(spark):
    side = lambda key, c: spark.range(1000).select(F.col("id").alias(key), F.lit(c).alias(c))
    pairs = spark.createDataFrame([("l", "r")], "l string, r string")
    rows, sent = shuffled_rows(spread_pairs(pairs, side("i", "l"), side("j", "r"), "l", "r", most=2500))
    assert len(rows) == len({(r.i, r.j) for r in rows}) == 1_000_000 and sent <= 2 * 1000 * 20 + 10_000
    alone, sent = shuffled_rows(spread_pairs(pairs, side("i", "l"), side("j", "r").where("j < 5"), "l", "r", most=50))
    assert len(alone) == 5000 and sent <= 5 * 100 + 10_000


def test_each_two_rows_meet_once(spark):
    n = 1000
    rows = spark.range(n).select("id", F.array(F.lit("x"), F.lit("y"), F.concat(F.lit("z"), F.col("id") % 2)).alias("words"))
    found, most = most_rows(overlap_pairs_within(rows, "id", "words", "a", "b"))
    assert {(r.a, r.b, r.shared) for r in found} == {(a, b, 3 - (a - b) % 2) for a in range(n) for b in range(a + 1, n)} and len(found) == n * (n - 1) // 2
    assert most < 0.8 * n * n  # as pairs in both orders they were n * n
    sets = rows.where("id < 100").withColumnRenamed("words", "set")
    parted = spread_pairs(spark.createDataFrame([(["q"], ["q"], True)], "l array<string>, r array<string>, same boolean"), *[sets.select(F.col("id").alias(k), F.array(F.lit("q")).alias(c)) for k, c in (("i", "l"), ("j", "r"))], "l", "r", most=400, within="same").collect()
    assert len(parted) == len({frozenset((r.i, r.j)) for r in parted}) == 100 * 99 // 2


def test_links_of_a_hot_address_are_counted_where_they_meet(spark):
    from tests import test_housing as H

    n = 300
    projects = [(f"PRJ-{k}", "Sea", "a", "named", [f"P{k}"], 1, 1, [], "2025-03-01", "2025-03-02", [], "7 Oak Ave", "") for k in range(n)]
    plans = [(k, f"D25-{k:05d}", "SIGN PERMIT", "APPROVED" if k == 5 else "x", "sign", "4 UNITS", f"2025-01-{1 + k % 28:02d}", "", "7 Oak Avenue", "", "a") for k in range(n)]
    items = [(k, f"m{k}", f"2026-02-{1 + k % 28:02d}", "hearing", f"o{k}", [], "7 OAK AVE", "x") for k in range(n)]
    tables = [spark.createDataFrame(r, s) for r, s in ((projects, H.PROJECTS), (plans, H.PLANS), ([], H.FILINGS), (items, H.ITEMS))]
    rows, sent = shuffled_rows(H.housing_projects(*tables, lists={}))
    assert {(r.counts.planning_projects, r.counts.apr_filings, r.counts.meeting_mentions) for r in rows} == {(n, 0, n)} and len(rows) == n and sent < n * n / 2
    assert {(r.status, r.units.planning_units, r.first_activity, r.last_activity, tuple(r.latest_meeting)) for r in rows} == {("entitled", 4 * n, "2025-01-01", "2026-02-28", ("2026-02-28", "o27"))}
