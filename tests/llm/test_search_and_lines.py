"""Hard negatives, line dedup and lexical search against brute force, and on nulls, repeats, ties and clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import queries
from civicspark.llm.hard_negatives import LEVELS, _within, hard_negatives, summaries
from civicspark.llm.lexical_search import automaton, lexical_search, terms_of
from civicspark.llm.line_dedup import LineRuns, line_dedup
from tests.oracle import compare

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_line_dedup", "op13_lexical_search"])
def test_query_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


# ---- lines


def lines_by_hand(rows, least_chars, least_docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [i is not None and len(key(x)) >= least_chars and len(held[key(x)]) >= least_docs and i != max(held[key(x)]) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def some_texts(seed):
    rng = random.Random(seed)
    pool = [f"{'Line' if k % 2 else 'línea Ñ'} number {k} " + "x" * rng.randrange(30) for k in range(12)]
    rows = []
    for i in range(60):
        own = [rng.choice(pool) if rng.random() < 0.7 else f"own {i} {k}" for k in range(rng.randrange(6))]
        rows.append((i, "\n".join(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", "\r", "  "]) for x in own)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, pool[1] + "\n" + pool[2]), (None, None), rows[5], rows[5]]
    rows += [(80, "\n".join(pool * 300)), (3, pool[0])]  # very long; an id with a second text
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("batches", "fanout"), [(1, 4), (4, 4), (7, 2)])
def test_lines_equal_brute_force_for_any_batches(spark, batches, fanout):
    rows = some_texts(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit("kept"), "drop": F.lit(1), "a.b": F.lit(2), "left": F.lit(3), "id": F.lit(4)})
    got = line_dedup(docs, least_chars=15, least_docs=3, batches=batches, fanout=fanout)
    assert got.columns == [*docs.columns, "lines"]
    found = [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.select("doc_id", "lines.*").collect()]
    assert sorted(found, key=repr) == lines_by_hand(rows, 15, 3)
    assert got.where("h <> 'kept' or `a.b` <> 2").count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_lines_of_an_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_are_merged_by_levels(spark):
    runs, total = LineRuns(spark, 2), Counter()
    for batch in range(5):
        keys = [(k % 7, k % 3, 1, 100 - batch) for k in range(batch, batch + 6)]
        own = {(h, g): (docs, last) for h, g, docs, last in keys}
        fresh = {k for k in own if k not in total}
        entries = spark.createDataFrame([(*k, *v) for k, v in own.items()], "h long, g long, docs long, last long")
        assert {(r.h, r.g) for r in runs.new_keys(entries).collect()} == fresh
        runs.add(entries)
        total.update(own.keys())
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r.h, r.g): r.docs for r in runs.merged().collect()} == dict(total)
    runs.drop()


def test_anti_join_reads_runs_without_a_shuffle(spark):
    runs = LineRuns(spark, 4)
    entries = spark.createDataFrame([(1, 2, 3, 4)], "h long, g long, docs long, last long")
    runs.add(entries)
    plan = runs.new_keys(entries)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("Exchange") == 1
    runs.drop()


# ---- lexical search


def search_by_hand(docs, items, k):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, all_terms = sum(bool(c) for _, c in terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, mine in asked.items():
        scored = []
        for i, c in terms:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(1, all_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in mine if c[t])
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_search_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(40)] + ["Ñandú", "ñandú", "日本", "a", "the", "THE", "x1"]
    docs = [(i, rng.choice([" ", "-", "\x00", "'"]).join(rng.choices(vocabulary, k=rng.randrange(30)))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "!!"), (None, "the w1 w2"), docs[7], docs[7], (403, "the " * 50_000 + "w3"), (7, "w5 w5")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)))) for i in range(30)] + [(50, None), (51, ""), (None, "the"), (52, "the the"), (52, "w1"), (53, "absent"), (3, "w1"), (52, "the the")]
    spread = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "item_id": F.lit(2), "n": F.lit("x")}).repartition(5)
    for block in (4096, 7):
        got = lexical_search(spread, spark.createDataFrame(items, "item_id long, text string"), k=5, block_items=block)
        assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == search_by_hand(docs, items, 5)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert lexical_search(docs, items).count() == 0
    assert lexical_search(docs, spark.createDataFrame([(1, "a b")], items.schema)).count() == 0
    assert lexical_search(spark.createDataFrame([(1, "a b")], docs.schema), items).count() == 0


def test_automaton_matches_whole_terms_alone():
    terms = [b"a", b"ab", b"b a"[:1], b"abc"]
    find = automaton(sorted(set(terms)))
    assert Counter(v for _, v in find.iter(" a ab abc cab a ")) == Counter({0: 2, 1: 1, 2: 1})
    assert terms_of("A-b É9_É") == {b"a", b"b", "É9".encode(), "É".encode()}


# ---- hard negatives


def negatives_by_hand(rows, positives=5, k=10, every=100):
    good = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, label, v in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    dim = Counter(len(x) for _, _, x in good).most_common(1)[0][0]
    good = sorted(g for g in good if len(g[2]) == dim)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for i, label, x in good:
        if i % every:
            continue
        same = sorted((-dot(x, y), j) for j, other, y in good if other == label and j != i)[:positives]
        rest = sorted((-dot(x, y), j) for j, other, y in good if other != label)
        for p, j in same:
            fits = [(s, n) for s, n in rest if 30 * -p <= 100 * -s <= 90 * -p][:k]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 20))
    rows = [(i, int(i % 3), (centres[i % 4] + rng.normal(size=20) * rng.choice([0.05, 1.0])).tolist()) for i in range(700)]
    hot = centres[0].tolist()
    rows += [(1000 + i, 1, hot) for i in range(300)] + [(1300, 2, hot), (1400, None, hot), (1401, 1, None), (None, 1, hot), (1402, 1, []), (1403, 1, [1.0]), (1404, 0, [0.0] * 20)]
    rows += [(1405, 0, [float("nan")] * 20), (1406, 0, [None] + hot[1:]), (1407, 0, [float("inf")] + hot[1:]), (1500, 0, [0.0] * 20), rows[0], rows[100], (200, 1, hot), (1600, 9, hot)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"slot": F.lit(1), "score": F.lit("x"), "id": F.lit(3)}).repartition(4)
    for chunk, block in ((1024, 8192), (50, 4)):
        got = hard_negatives(df, chunk=chunk, anchor_block=block)
        assert sorted(map(tuple, got.collect())) == negatives_by_hand(rows)


def test_hard_negatives_of_tables_without_partners(spark):
    schema = "vec_id long, label int, embedding array<double>"
    assert hard_negatives(spark.createDataFrame([], schema)).count() == 0
    assert hard_negatives(spark.createDataFrame([(100, 1, [1.0, 2.0])], schema)).count() == 0
    assert hard_negatives(spark.createDataFrame([(100, 1, [1.0, 2.0]), (101, 1, [1.0, 2.0])], schema)).count() == 0


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(3)
    q, x = (np.floor(256 * (rng.normal(size=(n, 30)) * 0.1 + np.repeat(rng.choice([-1, 1], size=(n, 5)), 6, axis=1))) for n in (20, 300))
    exact = q @ x.T
    sums = [[summaries(y, s) for s in LEVELS] for y in (q, x)]
    for low, high in ((exact.max(1) * 0.8, np.full(20, np.inf)), (np.full(20, -1000.0), np.full(20, 1000.0))):
        a, b = _within(*sums, np.ones(exact.shape, bool), low, high)
        wanted = {(i, j) for i, j in np.argwhere((exact >= low[:, None]) & (exact <= high[:, None])).tolist()}
        assert wanted <= set(zip(a.tolist(), b.tolist(), strict=True))
        assert len(a) < exact.size / 2
