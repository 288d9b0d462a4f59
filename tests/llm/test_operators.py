"""The ten operators and the pipeline against brute force, and on nulls, empty tables, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.llm import queries
from civicspark.llm.additive_ann import nearest_neighbours
from civicspark.llm.chat_format import escape, format_chats, read_back, spans, unescape
from civicspark.llm.license_scan import BASE, NOTICES, license_scan
from civicspark.llm.mixing import mix_sources, mixed
from civicspark.llm.near_dedup import near_duplicates, one_of_each
from civicspark.llm.packing import Windows, encoder, pack
from civicspark.llm.quality_rules import good_documents, quality_rules
from civicspark.llm.substring_dedup import repeated_paragraphs, tune_bands, without_repeats
from civicspark.llm.suffix_tree_lm import suffix_tree_scores
from civicspark.llm.url_filter import ShiftAnd, filter_urls
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=""):
    rows = [(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for name in extra.split():
        df = df.withColumn(name, F.lit("kept"))
    return df


def words(text):
    return WORD.findall(text or "")


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(sets, percent):
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and common * 100 >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def copies(seed=3, groups=8):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        last = base
        for _ in range(rng.choice([5, 40])):
            w = list(base if rng.random() < 0.7 else last)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(300)}"
            last = w
            out.append((rng.randrange(10**9), " ".join(w)))
    return out


ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (-5, "x"), (-6, "X"), (-7, "x y"), (-8, "a b c " * 30_000), (-9, "é ü   ß " * 20)]


def test_near_duplicates_are_components(spark):
    texts = copies() + ODD
    got = {r.doc_id: r for r in near_duplicates(docs_of(spark, texts, "component key"), width=3, percent=85).collect()}
    sets = {i: shingles(t, 3) for i, t in texts}
    want = components(sets, 85)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == want[i]) for i, r in got.items())


def test_one_of_each_keeps_columns_and_null_ids(spark):
    texts = [(1, "a b c d e f g"), (2, "A B C D E F G"), (2, "A B C D E F G"), (None, "other words"), (3, "z")]
    out = one_of_each(docs_of(spark, texts, "id text_2"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "id", "text_2"]
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 3]


def test_license_scan_is_exact_on_base_and_bounded_on_notices(spark):
    texts = [(1, "x MIT-License, y mit license"), (2, "GNU Genral Public License"), (3, None), (4, "cc by cc by by"), (5, "released undr the mit licence"), (6, "apache licence"), (7, "submit license")]
    got = {r.doc_id: r for r in license_scan(docs_of(spark, texts)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].score) == (2, 1, 4, "mit", 1.0)
    assert (got[2].n_base, got[2].labels) == (0, "gpl") and 0.9 < got[2].score < 1
    assert (got[3].n_words, got[3].first_word, got[3].labels, got[3].score) == (0, None, "", 0.0)
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 0, 2)
    assert got[5].labels == "mit" and got[6].labels == "" and got[7].n_base == 0


def fuzzed_notices(n, seed=4):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        label, said, edits = rng.choice(NOTICES)
        said = list(said)
        for _ in range(rng.randrange(edits + 2)):
            at = rng.randrange(len(said))
            said[at : at + rng.randrange(2)] = rng.choice(["", "a", "g", " "])
        tail = list(rng.choice(NOTICES)[1])
        tail[rng.randrange(len(tail))] = "g"
        out.append((k, " ".join([*rng.choices(["x", "a", "the", "of"], k=rng.randrange(4)), "".join(said), *rng.choices(["all", "b"], k=rng.randrange(3)), "".join(tail)])))
    return out


def test_license_scan_loses_no_notice_to_its_seeds(spark):
    import regex

    patterns = [(label, regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(said, literal_spaces=True)}){{e<={edits}}}(?![^ ])")) for label, said, edits in NOTICES]
    texts = [*fuzzed_notices(3000), (-1, None), (-2, ""), (-3, "all rights reserved " + "x " * 100_000 + "all rights reservd"), (None, "mozilla public licence")]
    got = {r.doc_id: r for r in license_scan(docs_of(spark, texts, "labels score")).collect()}
    assert len(got) == len(texts) and license_scan(docs_of(spark, [])).count() == 0
    for i, text in texts:
        plain = " ".join(re.findall("[a-z0-9]+", (text or "").lower()))
        base = [(plain[: m.start()].count(" "), v) for k, v in BASE.items() for m in re.finditer(rf"(?<![^ ])(?={k}(?![^ ]))", plain)]
        labels = {v for _, v in base}
        r = got[i]
        assert (r.n_base, r.first_word, r.base_labels) == (len(base), min((a for a, _ in base), default=None), ",".join(sorted(labels)))
        if len(plain) < 1000:
            assert r.labels == ",".join(sorted(labels | {label for label, p in patterns if p.search(plain)})), text


def test_mixing_reaches_entropy_and_budget(spark):
    texts = [(k, "word " * (20 + k % 7)) for k in range(400)]
    df = docs_of(spark, texts, "weight").withColumn("source", F.when(F.col("doc_id") < 300, "big").when(F.col("doc_id") < 395, "mid").otherwise(F.lit(None).cast("string")))
    rows = mix_sources(df, entropy=0.8, block_tokens=300).collect()
    size, got, share = Counter(), Counter(), {}
    for r in rows:
        size[r.source] += r.mix.tokens
        got[r.source] += r.mix.tokens * r.mix.copies
        share[r.source] = r.mix.weight
    assert len(rows) == 400 and abs(sum(share.values()) - 1) < 1e-9
    assert max(r.mix.epochs for r in rows) <= 2.0001
    for s in size:
        assert abs(got[s] - share[s] * sum(size.values())) <= 40
    starts = sorted((r.mix.position, r.mix.tokens) for r in rows if r.source == "big")
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert mixed(df).columns == df.columns
    assert mixed(df.limit(0)).count() == 0


def bisected(total, entropy, most_repeats, steps=60):
    """Exponent, weight and epochs of each source, by plain bisection."""
    share = {s: n / sum(total.values()) for s, n in total.items()}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    def edge(good):
        lo, hi = 0.0, 1.0
        for _ in range(steps):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if good(weights(mid)) else (lo, mid)
        return lo

    spread = edge(lambda w: -sum(x * math.log(x) for x in w.values()) >= entropy * math.log(len(w)))
    repeats = edge(lambda w: max(w[s] / share[s] for s in w) > most_repeats)
    w = weights(max(spread, repeats))
    return {s: (w[s], w[s] / share[s]) for s in w}


def test_mixing_equals_plain_bisection_and_realises_all_copies(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 90)) if k % 50 else rng.choice([None, ""]), rng.choices("abcd", [60, 20, 3, 1])[0]) for k in range(600)]
    rows += [(None, "x y", "a"), (None, "x z", "a"), (7, "same", "b"), (7, "same", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("a.b", F.lit(1)).withColumn("mix", F.lit("own"))
    for entropy, most in ((0.9, 9.0), (0.999, 3.0)):
        got = mix_sources(df, entropy=entropy, most_repeats=most, block_tokens=200, schedule_blocks=10).collect()
        assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "source", "a.b", "mix"}
        total, times, in_block = Counter(), Counter(), Counter()
        for r in got:
            assert r.mix.tokens == -(-len(r.text or "") // 4) + 1
            total[r.source] += r.mix.tokens
            times[r.source] += r.mix.tokens * r.mix.copies
            for b in r.mix.blocks:
                in_block[b, r.source] += r.mix.tokens
        want = bisected(total, entropy, most)
        for r in got:
            assert abs(r.mix.weight - want[r.source][0]) < 1e-4 and abs(r.mix.epochs - want[r.source][1]) < 1e-3 and len(r.mix.blocks) == r.mix.copies
        everything = sum(total.values())
        for s, (weight, _) in want.items():
            assert abs(times[s] - weight * everything) <= 60
            assert all(abs(in_block[b, s] - weight * everything / 10) <= 60 for b in range(10))
        places = sorted((r.mix.position, r.mix.tokens) for r in got if r.source == "a")
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
        out = mixed(df, entropy=entropy, most_repeats=most, block_tokens=200, schedule_blocks=10)
        assert out.columns == df.columns
        block = {r.doc_id: r.mix.blocks[0] for r in got if r.mix.copies == 1 and r.doc_id not in (None, 7)}
        read = [block[r.doc_id] for r in out.collect() if r.doc_id in block]
        assert len(read) == len(block) and read == sorted(read) and len(set(read)) > 5
        assert Counter((r.doc_id, r.text, r.source) for r in out.collect() if r.mix == "own") == sum((Counter({(r.doc_id, r.text, r.source): r.mix.copies}) for r in got), Counter())


def test_quality_statistics_and_rules(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    docs = docs.union(docs_of(spark, ODD))
    got = {r.doc_id: r for r in quality_rules(docs, labels).collect()}
    for r in docs.collect():
        w, text = words(r.text), r.text or ""
        c = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        q = got[r.doc_id]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert q.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and (not q.base_failed or not q.kept)
    kept = good_documents(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, q in got.items() if q.kept}
    assert quality_rules(docs.limit(0), labels).count() == 0
    assert quality_rules(docs, labels.limit(0)).where("rule is not null").count() == 0


def test_url_filter(spark):
    urls = [(1, "http://a.COM/en/1?x"), (2, "http://www.example.com/en/7#y"), (3, None), (4, "com/en/"), (5, "http://com/en/"), (6, "http://x.org/ads/1"), (7, "http://o.net/x.com/en/"), (8, "http://com"), (9, "http://b.com/en/" + "y" * 9000)]
    got = {r.page_id: (r.host, r.path[:8], r.rule, r.verdict) for r in filter_urls(spark.createDataFrame(urls, "page_id long, url string")).collect()}
    assert got[1] == ("a.com", "/en/1", "com/en/", "block") and got[2] == ("www.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[3] == got[4] == ("", "", None, "allow") and got[5][2] == "com/en/" and got[6] == ("x.org", "/ads/1", None, "block")
    assert got[7][2:] == (None, "allow") and got[8] == ("com", "", None, "allow") and got[9][2] == "com/en/"
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_shift_and_equals_regexes():
    rng = random.Random(1)
    globs = ["".join(rng.choice(["a", "b", "/", "?", "*", "**"]) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    hit = ShiftAnd.of(globs).match(np.frombuffer("".join(texts).encode(), np.uint8), offsets)
    for k, g in enumerate(globs):
        p = re.compile("".join({"**": ".*", "*": "[^/]*", "?": "."}.get(x, x) for x in re.findall(r"\*\*|.", g)))
        assert [bool(p.fullmatch(t)) for t in texts] == hit[:, k].tolist(), g


@pytest.mark.parametrize("head", [1_000_000, 50])
def test_suffix_tree_base_score_and_distribution(spark, head):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "the the Zq9"), (-3, "the the Zq9")], docs.schema))
    rows = docs.collect()
    tokens = [(r.doc_id, words((r.text or "").translate(LOWER)) + [0]) for r in rows]
    train = Counter(w for i, t in tokens if zlib.crc32(str(i).encode()) % 5 != 1 for w in t)
    n, v = sum(train.values()), len(train)
    want = {i: (len(t), sum(train[w] > 0 for w in t), sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for i, t in tokens}
    got = suffix_tree_scores(docs, head_tokens=head).collect()
    assert len(got) == len(rows)
    for r in got:
        a, b, c = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (a, b, n) and abs(r.base_score - c) < 1e-6 * max(1, abs(c))
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -6


def naive_tree(texts, depth, least_share, least_gain, strength):
    """log10 of the next byte after a text so far, by dictionaries of contexts."""
    counts = {}
    for t in texts:
        for k in range(len(t)):
            padded = bytes(depth) + t[:k]
            for d in range(depth + 1):
                counts.setdefault(padded[len(padded) - d :], Counter())[t[k]] += 1
    total = sum(counts[b""].values()) if counts else 0
    common = {c: n for c, n in counts.items() if sum(n.values()) >= least_share * total}
    share = lambda c, x: common[c][x] / sum(common[c].values())
    kept = [c for c in common if c and c[1:] in common and sum(n * math.log2(share(c, x) / share(c[1:], x)) for x, n in common[c].items()) >= least_gain]
    states = {b""} | {c[a:b] for c in kept for a in range(len(c)) for b in range(a + 1, len(c) + 1) if c[a:b] in common}
    symbols = len(common.get(b"", {})) + 1

    def p(c, x):
        own = common.get(c, Counter())
        prior = 0.5 if c == b"" else strength * p(c[1:], x)
        return (own[x] + prior) / (sum(own.values()) + (0.5 * 256 if c == b"" else strength))

    def log10(past, x):
        padded = bytes(depth) + past
        return math.log10(p(next(padded[len(padded) - d :] for d in range(depth, -1, -1) if padded[len(padded) - d :] in states), x))

    assert symbols
    return log10


def test_suffix_tree_score_is_that_of_a_naive_tree(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(40).select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(-1, None), (-2, ""), (-4, "the Zq9"), (-4, "the Zq9")]
    tokens = {n: words((t or "").translate(LOWER)) for n, (_, t) in enumerate(rows)}
    train = [n for n, (i, _) in enumerate(rows) if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for n in train for w in [*tokens[n], 0])
    below = sum(counts.values()) + 0.5 * (len(counts) + 1)
    log10 = naive_tree([("".join(w + " " for w in tokens[n]) + "\n").encode() for n in train], 4, 1e-3, 5.0, 4.0)
    got = {}
    for r in suffix_tree_scores(spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)), depth=4, least_share=1e-3, least_gain=5.0, head_tokens=60).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    for n, (i, _) in enumerate(rows):
        said, score = b"", 0.0
        for w in [*tokens[n], 0]:
            spelled = b"\n" if w == 0 else w.encode() + b" "
            each = 0.0
            for x in spelled:
                each += log10(said, x)
                said += bytes([x])
            whole = (counts[w] + 0.5) / below if counts[w] else 10**each * 0.5 / below
            score += math.log10((10**each + whole) / 2)
        assert all(abs(g - score) < 1e-3 * max(1, abs(score)) for g in got[i]), (i, got[i], score)


@pytest.mark.parametrize("head", [0, 1_000_000])
def test_suffix_tree_probabilities_sum_to_at_most_one(spark, head):
    """All texts over {a, b} of up to 7 letters in one word, and of two words of up to 3 letters each."""
    rng = random.Random(2)
    train = [(i, " ".join("".join(rng.choices("ab", k=rng.randrange(1, 4))) for _ in range(rng.randrange(5)))) for i in range(300)]
    train = [t for t in train if zlib.crc32(str(t[0]).encode()) % 5 != 1]
    letters = lambda n: ["".join(x) for k in range(1, n + 1) for x in itertools.product("ab", repeat=k)]
    asked = ["", *letters(7), *(f"{a} {b}" for a in letters(3) for b in letters(3))]
    free = (i for i in itertools.count(10_000) if zlib.crc32(str(i).encode()) % 5 == 1)  # held out
    rows = [(next(free), t) for t in asked]
    got = suffix_tree_scores(spark.createDataFrame(train + rows, "doc_id long, text string"), depth=3, least_share=1e-3, least_gain=1.0, head_tokens=head).where("held_out").collect()
    total = sum(10**r.score for r in got)
    assert len(got) == len(asked) and 0.3 < total <= 1 + 1e-6
    alone = suffix_tree_scores(spark.createDataFrame(rows, "doc_id long, text string"), depth=3).collect()  # without training rows
    assert sum(10**r.score for r in alone) <= 1 + 1e-6


def test_suffix_tree_on_executors_without_the_package(tmp_path):
    import os
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, {0!r})\n"
        "from civicspark.llm.suffix_tree_lm import suffix_tree_scores\n"
        "from civicspark.session import local_session\n"
        "spark = local_session(2, 2)\n"
        "df = spark.createDataFrame([(1, 'a b'), (2, 'a c')], 'doc_id long, text string')\n"
        "print('rows', suffix_tree_scores(df).count())\n"
    ).format(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2" in run.stdout, run.stderr[-2000:]


def test_suffix_tree_without_training(spark):
    assert suffix_tree_scores(docs_of(spark, [])).count() == 0


def test_passages_inside_lines(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    shared = [prose(n) for n in (55, 60, 80, 120)] + [prose(30) + "\n" + prose(10) + "\n" + prose(30)]
    texts = [f"{prose(100)} {p} {prose(90)}\n{prose(12)}" for p in shared for _ in range(4)] + [prose(150) for _ in range(20)] + [None, "", "a a a a"]
    found = [r for r in repeated_paragraphs(docs_of(spark, list(enumerate(texts)))).collect() if r.paragraph is None]
    for n, p in enumerate(shared):
        own = [r for r in found if r.doc_id // 4 == n]
        assert {r.doc_id for r in own} == set(range(4 * n, 4 * n + 4)) and {r.doc_id for r in own if r.kept} == {4 * n}
        assert all(texts[r.doc_id][r.start : r.stop] in p and r.first_doc == 4 * n for r in own)
    assert {r.doc_id for r in found} == set(range(20))
    left = {r.doc_id: r.text for r in without_repeats(docs_of(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        if i >= 20 or i % 4 == 0:
            assert left[i] == text
        else:
            spans = sorted((r.start, r.stop) for r in found if r.doc_id == i)
            assert left[i] == "".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(b for b, _ in spans), len(text)], strict=True))
            assert len(left[i].split()) <= len(text.split()) - 20


def test_passages_beside_edited_partial_and_moved_copies(spark):
    rng = random.Random(6)
    prose = lambda n: "".join(rng.choices("abcdefghij", k=6)) + "".join(" " + "".join(rng.choices("abcdefghij", k=6)) for _ in range(n - 1))
    shared, twice = [prose(60) for _ in range(6)], prose(20)
    edited = [" ".join(["zz" if k == 30 else w for k, w in enumerate(p.split())]) for p in shared]
    partial = [" ".join(p.split()[12:40]) for p in shared]
    texts = [f"{prose(70)} {p} {prose(70)}" for n in range(6) for p in (edited[n], partial[n], shared[n], shared[n], partial[n])]
    texts += [f"{prose(50)} {twice} {prose(50)} {twice} {prose(50)}", " ".join(["a"] * 100)]
    texts += [f"{prose(50)} {p} {prose(50)}" for p in [prose(20)] * 2]
    left = {r.doc_id: r.text.split() for r in without_repeats(docs_of(spark, list(enumerate(texts)))).collect()}
    for n in range(0, 30, 5):
        own = [t.split() for t in texts[n : n + 5]]
        assert left[n] == own[0] and left[n + 1] == own[1]
        assert left[n + 3] == own[3][:70] + own[3][130:] and left[n + 4] == own[4][:70] + own[4][98:]
        assert left[n + 2] == own[2][:70] + own[2][130:]  # a near copy of the first, which stays
        whole = [" ".join(left[k]) for k in range(n, n + 5)]
        assert all(sum(" ".join(w[k : k + 20]) in t for t in whole) == 1 for w in [edited[n // 5].split()] for k in range(41))
    assert [len(left[k]) for k in range(30, 34)] == [170, 20, 120, 100]


def test_edited_passages_inside_lines(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    edits = [(60, {15: "zz"}), (60, {44: ""}), (60, {12: "zz yy"}), (110, {15: "zz", 80: "yy"}), (44, {10: "zz"})]
    texts, sizes = [], []
    for n, changes in edits:
        words = prose(n).split()
        near = [w for k, w in enumerate(words) for w in changes.get(k, w).split()]
        texts += [f"{prose(50)} {' '.join(p)} {prose(50)}" for p in (words, near)]
        sizes.append(len(near))
        assert (len(shingles(" ".join(words), 5) & shingles(" ".join(near), 5)) >= 0.8 * len(shingles(" ".join(words), 5) | shingles(" ".join(near), 5))) == (n > 44)
    left = {r.doc_id: r.text.split() for r in without_repeats(docs_of(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        words = text.split()
        assert left[k] == (words if k % 2 == 0 else words[:50] + words[-50:] if k < 8 else words[:61] + words[-50:])


def test_repeated_paragraphs(spark):
    assert tune_bands(0.8, 0.99)[0] <= 16
    p = [" ".join(f"p{k}w{j}" for j in range(60)) for k in range(4)]
    near = p[0].replace("p0w30 ", "zz ")
    texts = [(1, f"{p[0]}\nshort"), (2, f"intro\n{near}\n{p[1]}"), (3, p[2]), (4, f"{p[0]}\n{p[0]}"), (5, None), (None, p[0])]
    found = {(r.doc_id, r.paragraph): (r.first_doc, r.kept) for r in repeated_paragraphs(docs_of(spark, texts)).collect()}
    assert found == {(1, 0): (1, True), (2, 1): (1, False), (4, 0): (1, False), (4, 1): (1, False)}
    left = {r.doc_id: r for r in without_repeats(docs_of(spark, texts, "paragraph")).collect()}
    assert left[1].text == texts[0][1] and left[2].text == f"intro\n{p[1]}" and left[2].n_chars == len(left[2].text) and 4 not in left and left[3].text == p[2] and left[None].text == p[0]


def test_repeated_lines_of_one_id_with_two_texts(spark):
    p = [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(4)]
    texts = [(1, p[0]), (2, f"{p[0]}\n{p[1]}"), (2, f"{p[2]}\n{p[3]}")]
    left = sorted(r.text for r in without_repeats(docs_of(spark, texts)).collect())
    assert left == sorted([p[0], p[1], f"{p[2]}\n{p[3]}"])


def test_chats_round_trip(spark):
    rng = random.Random(2)
    bits = ["### ", "\\", " </turn>\n", ": ", "#", "<", "word ", "é", "\n", ""]
    rows = [(c, k, "system" if k == 0 and c % 3 == 0 else "user" if k % 2 else "assistant", None if rng.random() < 0.05 else "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for c in range(6) for k in range(rng.choice([1, 9, 150]))]
    rows += [(99, None, "user", "x"), (99, 3, None, "y"), (99, 3, "assistant", "big " * 3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit(1))
    windows = format_chats(turns, budget=120)
    got = {r.conv: r for r in read_back(windows).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((-math.inf if k is None else k, role or "", text or "") for i, k, role, text in rows if i == c))
        said = "".join(t for _, r, t in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert format_chats(turns.limit(0)).count() == 0
    assert unescape(escape("\\### a: </turn>\n")) == "\\### a: </turn>\n"
    few = [(9, 100 * k, "user", f"turn {k}") for k in range(6)]
    long = [(8, k * k * 7 - 300, "system" if k == 0 else "assistant", f"turn {k} " + "x" * (k % 50)) for k in range(300)] + [(7, None, "user", None), (7, None, "user", "b"), (None, 3, "a", "t"), (None, 3, "a", "t")]
    dense = {(9, 100 * k): k for k in range(6)} | {(8, k * k * 7 - 300): k for k in range(300)}
    schema = "conv_id long, turn long, role string, text string"
    made = [format_chats(spark.createDataFrame([(c, f(c, n), r, t) for c, n, r, t in few + long], schema), budget=150) for f in (lambda c, n: n, lambda c, n: dense.get((c, n), n))]
    assert sorted(map(repr, made[0].collect())) == sorted(map(repr, made[1].collect()))
    assert made[0].where("conv = 9").count() == 1 and made[0].where("conv = 8 and n_repeated = 0").count() == 1  # every later window repeats the system turn or history
    told = {r.conv: r.n_turns for r in read_back(made[0]).collect()}
    assert told == {9: 6, 8: 300, 7: 2, None: 2}
    assert spans([(5, False)] * 5, 12, 1) == [(0, 0, 2), (1, 2, 3), (2, 3, 4), (3, 4, 5)]


def test_neighbours_recall_ties_and_invalid_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:900] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(-100, None), (-200, [0.0] * 16), (-300, [float("nan")] + [1.0] * 15), (-400, [None] + [1.0] * 15), (None, [1.0] * 16), (-500, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest_neighbours(df, books=8, words=32, sample=1000, chunk=512, rerank=64, query_block=7).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == set(range(0, 3000, 100))
    hits = 0
    for q, found in by.items():
        gap = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        gap[q] = np.inf
        best = np.lexsort((np.arange(3000), gap))[:10]
        hits += len(set(best) & {v for _, v, _ in found})
        assert sorted(r for r, _, _ in found) == list(range(1, 11)) and all(abs(gap[v] - s) < 1e-12 for _, v, s in found)
    assert hits >= 0.9 * 10 * len(by)
    assert [v for _, v, _ in sorted(by[100])] == list(range(500, 510))
    assert nearest_neighbours(df.limit(0)).count() == 0


def test_neighbours_recall_at_production_parameters(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = queries.op9_nearest_neighbours(spark, "/root/testdata/sf0.1").collect()
    hits = total = 0
    for n in np.flatnonzero(ids % 100 == 0):
        gap = np.sqrt(((x - x[n]) ** 2).sum(1))
        gap[n] = np.inf
        best = ids[np.lexsort((ids, gap))[:10]]
        hits += len(set(best.tolist()) & {r.vec_id for r in got if r.query_id == ids[n]})
        total += len(best)
    print("recall", hits / total)
    assert total and hits >= 0.9 * total


def test_neighbours_of_equal_vectors_with_repeated_ids(spark):
    rows = [(0, [1.0, 2.0])] * 30 + [(1, [1.0, 2.0])] * 30 + [(7, [1.0, 2.0]), (9, [5.0, -2.0])]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3).where("query_id = 0").select("vec_id", "score").distinct()
    assert {(r.vec_id, r.score == 0) for r in got.collect()} >= {(1, True), (7, True)}


def test_packing_is_whole_and_equals_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150).union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "<|endoftext|> x\u0085 y"), (-3, "<|endoftext|> x\u0085 y")], "doc_id long, text string"))
    tool = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*tool.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    rows = pack(docs).collect()
    at = {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows if r.doc_id != -3) == sum(len(v) for k, v in ids.items() if k != -3)
    for pieces in at.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= 1024
    assert sum(r.length for r in rows) > 0.97 * 1024 * (len(at) - 1)
    assert pack(docs.limit(0)).count() == 0
    assert encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))("a b") == tool.encode("a b").ids


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(4)
    tree, rooms = Windows(50), []
    for _ in range(500):
        need = rng.randrange(1, 51)
        fits = [r for r in rooms if r >= need]
        window, offset = tree.put(need)
        if fits:
            assert 50 - offset == min(fits)
            rooms.remove(min(fits))
            rooms.append(min(fits) - need)
        else:
            assert offset == 0
            rooms.append(50 - need)
        assert window < len(rooms)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{queries_folder(spark)}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= before
        before = now
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} == before


def queries_folder(spark):
    import uuid

    from civicspark.session import shared_folder

    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"
