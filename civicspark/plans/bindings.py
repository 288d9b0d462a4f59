"""The driver tables as domain tables: one SQL text per table, the same for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _word(number: str) -> str:
    """SQL of a word of consonants that stands for a number."""
    return f"translate(lpad(CAST({number} AS STRING), 5, '0'), '0123456789', 'BCDFGHJKLM')"


# The specification of each binding; {table} stands for a driver table.
BINDINGS = {
    "permits": """
SELECT o_orderkey AS seq, concat('agency_', CAST(o_custkey % 5 AS STRING)) AS agency, year(o_orderdate) AS year,
  concat('BLDG', substr(CAST(year(o_orderdate) AS STRING), 3, 2), '-', lpad(CAST(o_orderkey AS STRING), 7, '0')) AS permit_no,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'BLD MULTI FAMILY' WHEN '2-HIGH' THEN 'BLD SFD OR DUPLEX'
    WHEN '3-MEDIUM' THEN 'BLD ACCESSORY DWELLING' WHEN '4-NOT SPECIFIED' THEN 'BLD MID RISE' ELSE 'BLD DEMOLITION' END AS type,
  CASE o_orderstatus WHEN 'F' THEN 'FINALED' WHEN 'O' THEN 'ISSUED' ELSE 'PLAN CHECK' END AS status,
  concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) AS applied,
  CASE o_orderkey % 4 WHEN 0 THEN concat(CAST(1 + o_orderkey % 40 AS STRING), ' UNIT APARTMENT BLDG') WHEN 1 THEN 'NEW DUPLEX'
    WHEN 2 THEN concat('LOT ', CAST(o_orderkey % 90 AS STRING), ' - PLAN TYPE A - HARBOR VIEW ', CAST(o_orderkey % 6 AS STRING), ' - NEW SFD')
    ELSE concat(CAST(100 + o_custkey % 40 AS STRING), ' ELM ST NEW HOUSE') END AS description,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS apn,
  CASE WHEN o_orderkey % 7 = 0 THEN concat('MASTER-', CAST(o_orderkey % 50 AS STRING)) END AS linked_parent
FROM {orders}
""",
    "permit_seq": """
SELECT concat('agency_', CAST(o_orderkey % 5 AS STRING)) AS agency, CAST(floor(o_orderkey / 5) AS BIGINT) AS seq,
  CASE WHEN o_custkey % 4 = 0 THEN 'BLD MULTI FAMILY' ELSE 'BLD SFD OR DUPLEX' END AS type,
  concat('TRACT ', CAST(o_orderkey % 3 AS STRING), ' LOT ', CAST(o_orderkey AS STRING)) AS description
FROM {orders}
""",
    "parcels": """
SELECT CAST(c_custkey AS STRING) AS apn, CAST(100 + c_custkey % 40 AS STRING) AS address,
  CASE c_custkey % 3 WHEN 0 THEN 'NORTH ELM STREET' WHEN 1 THEN 'Elm St.' ELSE 'COAST HIGHWAY, #4' END AS street,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'D-1' ELSE upper(substr(c_mktsegment, 1, 3)) END AS zone_code,
  CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE concat(CAST(c_nationkey AS STRING), ' du/acre') END AS density
FROM {customer}
""",
    "planning": """
SELECT o_orderkey AS ord, concat('D', substr(CAST(year(o_orderdate) AS STRING), 3, 2), '-', lpad(CAST(o_orderkey AS STRING), 7, '0')) AS project_no,
  CASE o_orderkey % 3 WHEN 0 THEN 'DEVELOPMENT PLAN' WHEN 1 THEN 'DENSITY BONUS APPLICATION' ELSE 'SIGN PERMIT' END AS type,
  CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'IN REVIEW' ELSE 'DISAPPROVED' END AS status,
  concat('HARBOR VIEW ', CAST(o_orderkey % 6 AS STRING), ' ', CAST(1 + o_orderkey % 30 AS STRING), ' UNITS') AS description,
  CAST(o_custkey AS STRING) AS apn, concat(CAST(100 + o_custkey % 40 AS STRING), ' N ELM ST') AS address,
  substr(CAST(o_orderdate AS STRING), 1, 10) AS applied
FROM {orders} WHERE o_orderkey % 11 = 0
""",
    "apr_filings": """
SELECT concat(lpad(CAST(l_orderkey AS STRING), 9, '0'), '-', CAST(l_linenumber AS STRING), '-', lpad(CAST(l_partkey AS STRING), 8, '0'), '-', lpad(CAST(l_suppkey AS STRING), 6, '0'), '-', substr(CAST(l_shipdate AS STRING), 1, 10)) AS ord, year(l_shipdate) AS year, CAST(l_suppkey * 7 AS STRING) AS apn,
  CAST(l_quantity AS INT) AS tot_proposed_units, CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INT) ELSE 0 END AS tot_approved_units,
  CAST(l_partkey % 3 AS INT) AS vlow_income_dr, CAST(l_partkey % 4 AS INT) AS low_income_ndr, CAST(l_partkey % 2 AS INT) AS mod_income_dr,
  CAST(l_partkey % 10 AS INT) AS above_mod_income, CASE l_linestatus WHEN 'F' THEN 'Yes' ELSE 'No' END AS density_bonus_received,
  CASE l_partkey % 4 WHEN 0 THEN '5+' WHEN 1 THEN 'ADU' WHEN 2 THEN 'SFD' ELSE '2 to 4' END AS unit_cat,
  concat(CAST(100 + l_suppkey % 40 AS STRING), ' ELM STREET') AS street_address
FROM {lineitem} WHERE l_orderkey % 13 = 0
""",
    "lihtc": """
SELECT CAST(s_suppkey AS STRING) AS hud_id, concat('HARBOR VIEW ', CAST(s_suppkey % 6 AS STRING)) AS project,
  concat(CAST(100 + s_suppkey % 40 AS STRING), ' North Elm Street Unit ', CAST(s_suppkey AS STRING)) AS proj_add,
  CASE WHEN s_nationkey < 13 THEN 'OCEANSIDE' ELSE 'VISTA' END AS proj_cty, CAST(s_suppkey % 80 AS INT) AS n_units, CAST(s_suppkey % 60 AS INT) AS li_units
FROM {supplier}
""",
    "doc_text": """
SELECT doc_id, concat('m', CAST(doc_id % 40 AS STRING), '-', CAST(doc_id AS STRING), '-',
    CASE WHEN doc_id % 3 = 0 THEN 'agenda' WHEN doc_id % 3 = 1 THEN 'minutes' WHEN doc_id % 9 = 2 THEN 'warrant_register' ELSE 'staff_report' END, '.txt') AS file_name,
  concat('m', CAST(doc_id % 40 AS STRING)) AS meeting_id, source AS agency, lang AS body, text
FROM {documents}
""",
    "doc_records": """
SELECT d.doc_id, concat('m', CAST(d.doc_id % 40 AS STRING)) AS meeting_id,
  concat('2026-', lpad(CAST(1 + (d.doc_id % 40) % 12 AS STRING), 2, '0'), CASE WHEN d.doc_id % 3 = 0 THEN '-02' ELSE '-01' END) AS date,
  d.lang AS body, d.source AS agency, CASE d.doc_id % 7 WHEN 0 THEN 'agenda' WHEN 1 THEN 'minutes' ELSE 'staff_report' END AS doc_type,
  concat('item-', CAST(d.doc_id % 9 AS STRING)) AS item_id, coalesce(l.quality, 0) = 0 AS procedural_only
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
""",
    "full_records": """
SELECT d.doc_id, concat('m', CAST(d.doc_id % 40 AS STRING)) AS meeting_id,
  concat('m', CAST(d.doc_id % 40 AS STRING), '-', lpad(CAST(d.doc_id AS STRING), 8, '0'), '-', CASE WHEN d.doc_id % 11 = 0 THEN '2024_01_02_x' WHEN d.doc_id % 11 = 1 THEN '2026_01_02_x' ELSE 'x' END, '.json') AS file,
  CASE WHEN d.doc_id % 13 <> 0 THEN concat('2026-', lpad(CAST(1 + (d.doc_id % 40) % 12 AS STRING), 2, '0'), CASE WHEN d.doc_id % 3 = 0 THEN '-02' ELSE '-01' END) END AS date,
  CASE WHEN d.doc_id % 17 = 0 THEN '2025-01-01' WHEN d.doc_id % 19 = 0 THEN '2026-05-05' END AS text_date,
  d.lang AS body, d.source AS agency, CASE d.doc_id % 7 WHEN 0 THEN 'agenda' WHEN 1 THEN 'minutes' ELSE 'staff_report' END AS doc_type,
  CASE WHEN d.doc_id % 4 = 0 THEN '' ELSE concat('item-', CAST(d.doc_id % 9 AS STRING)) END AS vote_id, CASE WHEN d.doc_id % 8 = 0 THEN '' ELSE concat(' Motion ', CAST(d.doc_id % 3 AS STRING)) END AS vote_item,
  CASE WHEN d.doc_id % 5 = 0 THEN concat('h', CAST(d.doc_id AS STRING)) END AS housing, CASE WHEN d.doc_id % 6 = 0 THEN concat('f', CAST(d.doc_id AS STRING)) END AS fiscal,
  concat('Flag ', CAST(d.doc_id % 3 AS STRING)) AS legal, concat('p', CAST(d.doc_id AS STRING)) AS position, concat('c', CAST(d.doc_id % 4 AS STRING)) AS comment, concat('q', CAST(d.doc_id % 5 AS STRING)) AS quote,
  coalesce(l.quality, 0) = 0 AS procedural_only
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
""",
    "probe_log": """
SELECT event_id, concat('agency_', CAST(user_id % 22 AS STRING)) AS agency, ts, event_type <> 'error' AS ok, value AS detail FROM {events}
""",
    "intel_items": """
SELECT event_id, ts, concat('feed_', CAST(user_id % 7 AS STRING)) AS source, event_type AS title, concat('u/', CAST(user_id AS STRING)) AS url,
  substr(md5(concat(event_type, '|u/', CAST(user_id AS STRING))), 1, 12) AS hash
FROM {events}
""",
    "meetings_meta": """
SELECT event_id AS id, CAST(ts AS DATE) AS date, concat('body_', CAST(user_id % 4 AS STRING)) AS body FROM {events} WHERE event_type = 'signup' AND event_id % 6 = 0
""",
    "videos": """
SELECT event_id AS id, CAST(ts AS DATE) AS date, concat('body_', CAST(user_id % 4 AS STRING)) AS body FROM {events} WHERE event_type = 'purchase' AND event_id % 5 = 0
""",
    "segments": """
SELECT CAST(conv_id AS STRING) AS meeting_id, turn AS chunk_no, length(text) AS dur, text FROM {conversations}
""",
    "pipeline_log": """
SELECT concat('pipe_', CAST(user_id % 20 AS STRING)) AS log, event_id AS n,
  concat(CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('[', substr(CAST(ts AS STRING), 1, 19), '] [full] ') END, CASE event_type
    WHEN 'view' THEN concat('Fetching phase ', CAST(event_id % 5 AS STRING), '...', CASE WHEN event_id % 11 = 0 THEN ' done' ELSE '' END)
    WHEN 'click' THEN concat('phase ', CAST(event_id % 5 AS STRING), CASE WHEN event_id % 2 = 0 THEN ' fetch done' ELSE ' done' END)
    WHEN 'signup' THEN 'Starting the pipeline' WHEN 'purchase' THEN 'Pipeline complete'
    ELSE CASE event_id % 5 WHEN 0 THEN 'phase timed out after 1800s' WHEN 1 THEN 'python: command not found' WHEN 2 THEN 'Terminated' WHEN 3 THEN 'No new extractions' ELSE 'New extractions: 4' END END) AS line
FROM {events}
""",
    "extract_log": """
SELECT concat('ext_', CAST(user_id % 20 AS STRING)) AS log, event_id AS n, CASE event_type
    WHEN 'view' THEN concat('  [', CAST(event_id % 100 AS STRING), '/100] doc_', CAST(user_id % 9 AS STRING), '-', CAST(event_id % 4 AS STRING), '.txt')
    WHEN 'click' THEN concat('    Chunking: ', CAST(event_id % 7 AS STRING), ' parts')
    WHEN 'signup' THEN CASE event_id % 4 WHEN 0 THEN '    Auth error (401)' WHEN 1 THEN '  FAILED (timeout, attempt 1/3)' WHEN 2 THEN 'JSON parse error in chunk' ELSE 'chunk timed out' END
    WHEN 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 'Rate limit: waiting' WHEN 1 THEN 'rate limit again' WHEN 2 THEN 'You have hit your session limit' ELSE 'Circuit breaker tripped' END
    ELSE CASE event_id % 5 WHEN 0 THEN 'Terminated' WHEN 1 THEN 'Traceback (most recent call last):' WHEN 2 THEN concat('[', substr(CAST(ts AS STRING), 1, 19), '] checkpoint')
      WHEN 3 THEN concat('Extracting structured data: ', CAST(event_id % 90 AS STRING), ' sources') ELSE concat(CAST(event_id % 3 AS STRING), ' extracted, 3 failed') END END AS line
FROM {events}
""",
    "named_projects": f"""
SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS apn, CAST(c_custkey * 3 AS STRING) AS second_apn,
  concat('D24-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS ref, concat('D24-', lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')) AS case_no,
  concat(CAST(100 + c_custkey % 900 AS STRING), ' ', {_word("c_custkey % 50")}, ' STREET') AS address,
  concat('Harbor-', {_word("c_custkey")}, ' ', lower({_word("c_custkey % 300")}), CASE WHEN c_custkey % 40 = 0 THEN ' harbor' ELSE '' END) AS name
FROM {{customer}}
""",
    "mentions": f"""
SELECT o_orderkey AS seq, concat('m', CAST(o_orderkey % 40 AS STRING)) AS meeting_id, concat('D24-', lpad(CAST(o_orderkey AS STRING), 7, '0')) AS project_no,
  CASE WHEN o_orderkey % 4 = 0 THEN concat(' d24-', lpad(CAST(o_custkey AS STRING), 7, '0'), ' ') END AS filing_number,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE CAST(o_custkey + 7 AS STRING) END AS apn,
  CASE WHEN o_orderkey % 6 = 0 THEN concat(CAST(100 + o_custkey % 900 AS STRING), ' North ', {_word("o_custkey % 50")}, ' St.') END AS address,
  concat(CASE WHEN o_orderkey % 4 < 2 THEN concat('RESOLUTION D24-', lpad(CAST((o_custkey + 1) % 100000 AS STRING), 5, '0'), ' ') ELSE 'HEARING ' END,
    'for the X', lower({_word("o_custkey")}), 'ville and ', {_word("o_custkey % 300")}, CASE WHEN o_orderkey % 5 = 0 THEN concat(' ', {_word("o_custkey")}) ELSE '' END,
    CASE WHEN o_orderkey % 70 = 0 THEN ' harbor' ELSE '' END) AS description
FROM {{orders}}
""",
    "entitlements": f"""
SELECT s_suppkey AS ord, concat('RD24-', lpad(CAST(s_suppkey AS STRING), 5, '0')) AS project_no,
  CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('The ', lower({_word("s_suppkey")}), 's at ', {_word("s_suppkey % 60")}) END AS project_name,
  concat('Villas ', {_word("s_suppkey % 60")}, ' of ', {_word("s_suppkey")}, ' HARBOR') AS description,
  CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE CAST(s_suppkey * 5 AS STRING) END AS apn, concat(CAST(s_suppkey AS STRING), ' COAST HWY') AS address
FROM {{supplier}}
""",
}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a domain table bound to driver tables."""
    if name not in BINDINGS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = BINDINGS[name]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql})


def with_bindings(sql: str, *names: str) -> str:
    """SQL for the oracle, in which the domain tables `names` can be used."""
    bound = ", ".join(f"{n} AS ({BINDINGS[n].format(**{t: t for t in TABLES})})" for n in names)
    if not names:
        return sql
    sql = sql.strip()
    if sql.startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {bound}, {sql[14:]}"
    return f"WITH {bound}, {sql[4:]}" if sql.startswith("WITH ") else f"WITH {bound} {sql}"
