"""Queries op1 to op13 over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm.additive_ann import nearest_neighbours
from civicspark.llm.chat_format import format_chats, read_back
from civicspark.llm.hard_negatives import hard_negatives
from civicspark.llm.lexical_search import lexical_search
from civicspark.llm.license_scan import license_scan
from civicspark.llm.line_dedup import line_dedup
from civicspark.llm.mixing import mix_sources
from civicspark.llm.near_dedup import near_duplicates
from civicspark.llm.packing import pack
from civicspark.llm.quality_rules import quality_rules
from civicspark.llm.substring_dedup import repeated_paragraphs
from civicspark.llm.suffix_tree_lm import suffix_tree_scores
from civicspark.llm.url_filter import filter_urls
from civicspark.session import reading


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)
    return found.selectExpr("doc_id", "cast(n_shingles as long) n_shingles", "component_id", "coalesce(doc_id = component_id, false) kept")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).withColumnRenamed("spans", "notices")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "source", "mix.*").withColumn("blocks", F.array_join(F.transform("blocks", lambda b: b.cast("string")), ","))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(turns.union(extra))).withColumnRenamed("conv", "conv_id")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    return hard_negatives(_table(spark, sf_dir, "embeddings"), label=label)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return reading(found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256")), found)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_license_scan, op3_mix_sources, op4_quality_rules, op5_url_filter, op6_suffix_tree_scores, op7_substring_dedup, op8_chat_format, op9_nearest_neighbours, op10_packing, op11_hard_negatives, op12_line_dedup, op13_lexical_search)}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_near_dedup": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
        each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
            WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN least_of USING (doc_id)
    """,
    "op5_url_filter": f"""
        WITH rest AS (
            SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
        parts AS (
            SELECT page_id, {_LOWER.format("regexp_extract(r, '^([^/?#]*)', 1)")} AS host, regexp_extract(r, '^[^/?#]*(/[^?#]*)', 1) AS path FROM rest),
        rules(verdict, rule, h, p) AS (VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'),
            ('block', 'net/de/', 'net', '/de/'), ('allow', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
        fits AS (
            SELECT page_id, first(rule ORDER BY length(rule) DESC) AS rule, first(verdict ORDER BY length(rule) DESC) AS verdict
            FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE
            WHEN contains(path, '/ads/') OR contains(path, '/wp-login') AND NOT contains(substr(path, strpos(path, '/wp-login') + 1), '/')
              OR starts_with(host, 'ads.') AND path = '' OR regexp_matches('.' || host, '\\..*\\.doubleclick\\.net$') AND path <> '' OR regexp_matches(path, '/track.r/')
            THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN fits USING (page_id)
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.x, v.x) AS BIGINT) AS score
            FROM v a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
        pos AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
            other AS negative_id, positive_score, score AS negative_score
        FROM pos JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op12_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
        keys AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
        often AS (SELECT key, max(doc_id) AS last FROM keys WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT doc_id, i, line, coalesce(doc_id <> last, false) AS gone FROM keys LEFT JOIN often USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op13_lexical_search": f"""
        WITH found AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
        total AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, sum(len(ts)) AS lt FROM found),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
        each AS (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM found),
        tf AS (SELECT doc_id, n, term, count(*) AS tf FROM each GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
        scored AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + CAST((50 * n * nd) // lt AS BIGINT))))) AS BIGINT) AS score
            FROM asked JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 50
    """,
}
