"""Queries for texts, sources, sinks, streams and hooks (X, S, ST, UD)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicspark.operators import publish as P
from civicspark.operators import textops as O
from civicspark.operators.linkage import first_by
from civicspark.operators.meetings import merged_meetings, sanitized_votes
from civicspark.plans.registry import query
from civicspark.plans.report_queries import _MERGED, _UNIFIED, _as_text, bound_housing, full_records
from civicspark.session import shared_folder
from civicspark.sources import io
from civicspark.streaming import jobs

_WORDS = ["license", "the", "permit"]
_TEXTS_A_FILE = 200  # a file is read as one value


def _place(df, name: str) -> str:
    return f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"


def _shards(df, least: int, rows: int = 100_000) -> int:
    """Into how many JSON values df goes, so that each stays small."""
    return max(least, -(-df.count() // rows))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS covered FROM documents")
def x1_chunks(t):
    parts = O.chunks(t("documents"), "doc_id", "text", 5000, 200)
    return parts.groupBy("doc_id").agg(F.max("end").cast("long").alias("covered"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 100")
def x2_split_oversized(t):
    return O.split_oversized(t("documents"), "doc_id", "text", 5000).select("doc_id").distinct()


@query("""WITH p AS (SELECT meeting_id, doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id % 5 END AS item FROM doc_text),
    f AS (SELECT meeting_id, last_value(item IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY doc_id) AS item, count(*) OVER (PARTITION BY meeting_id) AS n FROM p)
    SELECT meeting_id, CAST(item AS INT) AS item, count(*) AS pages FROM f WHERE item IS NOT NULL AND n >= 3 GROUP BY 1, 2 QUALIFY count(*) OVER (PARTITION BY meeting_id) >= 2""", "doc_text")
def x3_packet_items(t):
    page = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Item: "), F.col("doc_id") % 5)).otherwise(F.lit("page"))
    pages = t("doc_text").groupBy("meeting_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", page.alias("p")))), lambda x: x["p"]), "\f").alias("text"))
    return O.packet_items(pages, "meeting_id", "text").select("meeting_id", "item", "pages")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS n FROM documents),
    h AS (SELECT doc_id, k AS keyword, n, line FROM l JOIN (SELECT unnest(['license', 'the', 'permit']) AS k) ON contains(lower(line), k))
    SELECT doc_id, keyword, CAST(min(n) AS INT) AS line_no, substr(trim(arg_min(line, n)), 1, 200) AS line FROM h GROUP BY 1, 2""")
def x4_keyword_lines(t):
    return O.keyword_lines(t("documents"), "doc_id", "text", _WORDS)


@query("SELECT doc_id, CAST(n + 1 AS INT) AS line_no FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS n FROM documents) WHERE contains(lower(line), 'license')")
def x5_search(t):
    lines = t("documents").where(F.contains(F.lower("text"), F.lit("license"))).select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return lines.where(F.contains(F.lower("line"), F.lit("license"))).select("doc_id", (F.col("n") + 1).alias("line_no"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i)licen[cs]e[ds]?|copyright'), lambda x: lower(x)))), ',') AS hits FROM documents WHERE regexp_matches(text, '(?i)licen[cs]e[ds]?|copyright')")
def x6_agenda_alert(t):
    hits = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit("((?i)licen[cs]e[ds]?|copyright)"), 1), lambda x: F.lower(x)))
    return t("documents").select("doc_id", F.array_sort(hits).alias("h")).where(F.size("h") > 0).select("doc_id", F.array_join("h", ",").alias("hits"))


@query("SELECT event_id, CASE WHEN title IN ('signup', 'error') THEN 'direct' WHEN contains(title, 'ur') THEN 'candidate' ELSE 'none' END AS detection, CASE WHEN title IN ('signup', 'error') THEN 10 WHEN contains(title, 'ur') THEN 5 ELSE 0 END AS score FROM intel_items", "intel_items")
def x7_item_detection(t):
    has = lambda words: F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda k: F.contains("title", k))) > 0
    kind = F.when(has(["signup", "error"]), "direct").when(has(["ur"]), "candidate").otherwise("none")
    return t("intel_items").select("event_id", kind.alias("detection")).withColumn("score", F.when(F.col("detection") == "direct", 10).when(F.col("detection") == "candidate", 5).otherwise(0))


@query("SELECT meeting_id, max(CASE WHEN body = 'de' THEN 1 WHEN CAST(contains(lower(text), 'license') AS INT) + CAST(contains(lower(text), 'the') AS INT) >= 2 THEN 1 ELSE 0 END) = 1 AS high FROM doc_text GROUP BY meeting_id", "doc_text")
def x8_priority(t):
    n = F.size(F.filter(F.array(F.lit("license"), F.lit("the")), lambda k: F.contains(F.lower("text"), k)))
    return t("doc_text").groupBy("meeting_id").agg(F.bool_or((F.col("body") == "de") | (n >= 2)).alias("high"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, array_to_string(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), ' ') AS links FROM pages")
def x9_landed_pages(t):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return t("pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.array_join(links, " ").alias("links"))


@query("SELECT c_custkey, o_orderkey, o_orderstatus AS state FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus <> 'P' AND o_totalprice > 1000")
def x10_nested_flatten(t):
    """Orders nested as JSON per customer, read back with a schema, flattened over two levels and filtered."""
    order = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("price"))
    days = t("orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.collect_list(order).alias("items"))
    nested = days.groupBy("o_custkey").agg(F.to_json(F.struct(F.collect_list(F.struct("year", "items")).alias("days"))).alias("doc"))
    parsed = nested.select("o_custkey", F.from_json("doc", "days array<struct<year:int,items:array<struct<id:long,state:string,price:double>>>>").alias("d"))
    flat = parsed.select("o_custkey", F.explode("d.days").alias("day")).select("o_custkey", F.inline("day.items"))
    return t("customer").join(flat, F.col("c_custkey") == F.col("o_custkey")).where("state <> 'P' and price > 1000").select("c_custkey", F.col("id").alias("o_orderkey"), "state")


@query("SELECT meeting_id, chunk_no, CAST(coalesce(sum(dur) OVER (PARTITION BY meeting_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, length(string_agg(text, ' ') OVER (PARTITION BY meeting_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS total FROM segments", "segments")
def x11_transcript(t):
    w = Window.partitionBy("meeting_id").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    # the texts' characters and the blanks between them, as the joined text would have
    total = F.sum(F.length("text")) + F.count("text") - 1
    whole = t("segments").groupBy("meeting_id").agg(total.cast("long").alias("total"))
    starts = t("segments").select("meeting_id", "chunk_no", F.coalesce(F.sum("dur").over(w), F.lit(0)).cast("long").alias("start"))
    return starts.join(whole, "meeting_id")


@query("SELECT seq, status, agency, CAST(year AS INT) AS year FROM permits", "permits")
def s1_json_lines(t):
    rows = t("permits").select("seq", "status", "agency", "year")
    path = _place(rows, "s1")
    rows.write.partitionBy("agency", "year").json(path)
    return io.read_json_lines(rows.sparkSession, f"{path}/*/*", "seq long, status string").select("seq", "status", F.col("_agency").alias("agency"), F.col("_year").alias("year"))


@query("SELECT ord, status FROM planning", "planning")
def s2_planning_lines(t):
    rows = t("planning").select("ord", "status")
    path = _place(rows, "s2")
    io.append_log(rows, path)
    return io.read_json_lines(rows.sparkSession, path, "ord long, status string").select("ord", "status")


@query("SELECT apn, CASE WHEN a.o IS NOT NULL THEN 'first' ELSE 'second' END AS file FROM (SELECT apn, min(ord) AS o FROM planning WHERE ord % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT DISTINCT apn FROM planning) b USING (apn)", "planning")
def s3_array_union(t):
    plans = t("planning")
    one, two = _place(plans, "s3a"), _place(plans, "s3b")
    shards = _shards(plans, 8)
    for rows, file, path in ((plans.where("ord % 2 = 0"), "first", one), (plans, "second", two)):
        arrays = rows.groupBy(F.pmod(F.xxhash64("apn", "ord"), F.lit(shards)).alias("shard")).agg(F.to_json(F.collect_list(F.struct("apn", F.lit(file).alias("file")))).alias("value"))
        arrays.write.partitionBy("shard").text(path)  # one array a file
    return io.read_json_arrays(plans.sparkSession, [one, two], "apn string, file string", "apn").select("apn", "file")


# Raw columns of the two tables by their SQL over the bound ones; others hold their own name in blanks.
_RAW_FILING = {
    "YEAR": "CAST(year AS STRING)", "APN": "concat('1-', apn, '-0')", "STREET_ADDRESS": "street_address", "JURS_TRACKING_ID": "ord", "UNIT_CAT": "unit_cat", "TOT_PROPOSED_UNITS": "concat(' ', CAST(tot_proposed_units AS STRING), ' ')",
    "TOT_APPROVED_UNITS": "CASE WHEN tot_approved_units = 0 THEN 'none' ELSE CAST(tot_approved_units AS STRING) END", "VLOW_INCOME_DR": "CAST(vlow_income_dr AS STRING)", "LOW_INCOME_NDR": "CAST(low_income_ndr AS STRING)",
    "MOD_INCOME_DR": "CASE WHEN mod_income_dr = 0 THEN '' ELSE CAST(mod_income_dr AS STRING) END", "ABOVE_MOD_INCOME": "CAST(above_mod_income AS STRING)", "LATITUDE": "CASE WHEN unit_cat = 'SFD' THEN 'north' ELSE '33.25' END", "LONGITUDE": "'-117.5'",
    "JURIS_NAME": "CASE WHEN unit_cat = 'ADU' THEN ' Vista ' WHEN unit_cat = 'SFD' THEN 'VISTA' ELSE 'Elsewhere' END",
}
_RAW_CREDIT = {
    "HUD_ID": "hud_id", "PROJECT": "project", "PROJ_ADD": "proj_add", "PROJ_CTY": "lower(proj_cty)", "PROJ_ST": "CASE WHEN n_units % 3 = 0 THEN 'NV' ELSE ' ca' END", "N_UNITS": "CAST(n_units AS STRING)", "LI_UNITS": "CASE WHEN li_units < 9 THEN 'few' ELSE CAST(li_units AS STRING) END",
    "YR_PIS": "'1999'", "LATITUDE": "'33.5'",
}


def _read_column(name: str, raw: dict[str, str], numbers: dict[str, str], zero: bool) -> str:
    value = f"trim({raw.get(name, repr(' ' + name + ' '))})"
    if name not in numbers:
        return value
    number = f"try_cast({value} AS {numbers[name]})"
    return f"coalesce({number}, 0)" if zero and numbers[name] == "int" else number


def _csv(t, bound: str, raw: dict[str, str], names: list[str], place: str) -> str:
    rows = t(bound).select(*[F.expr(raw.get(c, repr(" " + c + " "))).alias(c) for c in names])
    path = _place(rows, place)
    io.publish_csv(rows, path)
    return path


_FILED = {c: _read_column(c, _RAW_FILING, io.FILING_NUMBERS, True) for c in io.FILING_FIELDS}


@query(f"SELECT {', '.join((f"replace({v}, '-', '')" if c == "APN" else v) + f' AS {c.lower()}' for c, v in _FILED.items())}, CAST({' + '.join(_FILED[c] for c in io.AFFORDABLE_FIELDS)} AS INT) AS affordable_units FROM apr_filings WHERE unit_cat IN ('ADU', 'SFD')", "apr_filings")
def s4_csv_filings(t):
    return io.read_filings(t("apr_filings").sparkSession, _csv(t, "apr_filings", _RAW_FILING, [*io.FILING_FIELDS, "JURIS_NAME"], "s4"), "VISTA")


@query(f"SELECT {', '.join(_read_column(c, _RAW_CREDIT, io.CREDIT_NUMBERS, False) + f' AS {c.lower()}' for c in io.CREDIT_FIELDS)} FROM lihtc WHERE proj_cty = 'VISTA' AND n_units % 3 <> 0", "lihtc")
def s5_credit_table(t):
    return io.read_credits(t("lihtc").sparkSession, _csv(t, "lihtc", _RAW_CREDIT, io.CREDIT_FIELDS, "s5"), "CA", ["VISTA", "NOWHERE"])


@query("SELECT doc_id, meeting_id FROM doc_records WHERE doc_id % 5 <> 0", "doc_records")
def s6_nested_records(t):
    rows = t("doc_records").select("doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("meeting_id")).alias("meeting_id"), F.array(F.struct("item_id")).alias("votes"))
    path = _place(rows, "s6")
    io.append_log(rows, path)
    read = io.read_json_lines(rows.sparkSession, path, "doc_id long, meeting_id string, votes array<struct<item_id:string>>", agency_year=False)
    return read.where("meeting_id is not null and votes is not null").select("doc_id", "meeting_id")


@query("SELECT count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def s7_whole_texts(t):
    docs = t("documents").select("text")
    path = _place(docs, "s7")
    docs.select(F.to_json(F.struct("text")).alias("value")).write.option("maxRecordsPerFile", _TEXTS_A_FILE).text(path)
    lines = io.read_texts(docs.sparkSession, f"{path}/*.txt").select(F.explode(F.split(F.rtrim("text", F.lit("\n")), "\n")).alias("line"))
    return lines.agg(F.count("*").alias("docs"), F.sum(F.length(F.from_json("line", "text string")["text"])).alias("chars"))


@query("SELECT apn, address || ' ' || street AS address FROM parcels WHERE address <> ''", "parcels")
def s8_parcel_addresses(t):
    rows = t("parcels")
    path = _place(rows, "s8")
    io.publish(rows, path)
    read = rows.sparkSession.read.parquet(path).select("apn", "address", "street").where("apn is not null and address <> ''")
    return read.select("apn", F.concat_ws(" ", "address", "street").alias("address"))


@query("SELECT apn, zone_code FROM parcels", "parcels")
def s9_lookup_object(t):
    shard = t("parcels").groupBy(F.pmod(F.xxhash64("apn"), F.lit(_shards(t("parcels"), 16))).alias("shard")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("apn", F.struct(F.col("zone_code").alias("z")))))).alias("doc"))
    return io.map_rows(shard, "doc", "struct<z:string>").select(F.col("key").alias("apn"), F.col("value.z").alias("zone_code"))


@query("SELECT event_id, strftime(ts, '%Y-%m') AS month FROM intel_items", "intel_items")
def s10_news_items(t):
    rows = t("intel_items").select("event_id", F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0000'")).alias("published"), F.date_format("ts", "yyyy-MM").alias("month"))
    path = _place(rows, "s10")
    rows.write.partitionBy("month").json(path)
    from civicspark.functions.dates import feed_timestamp

    read = rows.sparkSession.read.schema("event_id long, published string").json(f"{path}/*")
    return read.select("event_id", F.coalesce(F.date_format(feed_timestamp(F.col("published")), "yyyy-MM"), F.regexp_extract("_metadata.file_path", r"month=(\d{4}-\d{2})", 1)).alias("month"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r <= 5")
def s11_tail(t):
    last = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("event_id")))
    # a log ends with its last lines; one more than asked for leaves the cut to tail_lines and the cell small
    ends = t("events").select("user_id", "event_id", last.alias("r")).where("r <= 6")
    logs = ends.groupBy("user_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), "\n").alias("text"))
    return io.tail_lines(logs, "user_id", "text", 5).select("user_id", F.col("line").cast("long").alias("event_id"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def s12_log(t):
    rows = t("events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    path = _place(rows, "s12")
    io.append_log(rows, path)
    return io.read_log(rows.sparkSession, path, "event_id long, ts string", "2024-01-15").select("event_id")


@query("SELECT CAST(seq AS INT) AS seq, applied, CAST(year AS INT) AS year FROM permits", "permits")
def s13_typed_publish(t):
    rows = t("permits").select("seq", "applied", "year")
    path = _place(rows, "s13")
    io.publish(rows, path, {"seq": "int", "year": "int"})
    return rows.sparkSession.read.parquet(path)


@query("SELECT ord, status FROM planning", "planning")
def s14_sorted_lines(t):
    rows = t("planning").select("ord", "status")
    path = _place(rows, "s14")
    io.publish_lines(rows, path, "ord")
    return rows.sparkSession.read.schema("ord long, status string").json(path)


@query("SELECT seq, agency, CASE WHEN agency = 'agency_1' THEN 'NEW' ELSE status END AS status FROM permits", "permits")
def s15_changed_partitions(t):
    rows = t("permits").select("seq", "status", "agency")
    path = _place(rows, "s15")
    io.publish(rows, path, {"seq": "long"}, ["agency"])
    io.publish(rows.where("agency = 'agency_1'").withColumn("status", F.lit("NEW")), path, {"seq": "long"}, ["agency"])
    return rows.sparkSession.read.parquet(path).select("seq", "agency", "status")


@query("SELECT agency, CAST(count(*) AS VARCHAR) AS n FROM probe_log GROUP BY agency", "probe_log")
def s16_csv_report(t):
    rows = t("probe_log").groupBy("agency").agg(F.count("*").alias("n"))
    path = _place(rows, "s16")
    io.publish_csv(rows, path)
    return rows.sparkSession.read.option("header", True).csv(path)


def _published(df, name: str):
    """df written as the published table and read back."""
    path = _place(df, "s17")
    io.publish(df, path, P.columns_of(name))
    back = df.sparkSession.read.parquet(path)
    if [(f.name, f.dataType.simpleString()) for f in back.schema.fields] != list(P.columns_of(name).items()):
        raise ValueError(f"{name} was not written in its layout")
    return back


def _zoning(t):
    return t("parcels").select("apn", "zone_code", F.lower("zone_code").alias("zone_category"), "density", F.concat(F.col("address"), F.lit(" FT")).alias("height"))


_FLAT = "coalesce({0}, '') AS {0}"
_PARCELS = "zp AS (SELECT apn, address || ' ' || street AS parcel_address, zone_code AS z, lower(zone_code) AS zc, CAST(nullif(regexp_extract(density, '([\\d.]+)\\s*du', 1), '') AS DOUBLE) AS dens, address || ' FT' AS height FROM parcels)"


@query(f"""WITH {_PARCELS}, m AS (SELECT permit_no, linked_parent AS project_id FROM permits WHERE linked_parent IS NOT NULL)
    SELECT p.permit_no, p.year, p.agency, p.type, '' AS subtype, description, status, strftime(o_orderdate, '%Y-%m-%d') AS applied, CAST(NULL AS VARCHAR) AS approved, CASE WHEN seq % 2 = 0 THEN '2020-01-02' END AS issued, coalesce(p.apn, '') AS apn, '' AS owner,
      CASE WHEN seq % 3 <> 0 THEN '1 OWN ST' ELSE coalesce(parcel_address, '') END AS address, CASE WHEN seq % 5 = 0 THEN 'OWN' ELSE coalesce(z, '') END AS zone_code, coalesce(zc, '') AS zone_category, dens AS max_density, coalesce(height, '') AS max_height,
      seq % 2 = 0 AS is_downtown, coalesce(project_id, '') AS project_id FROM permits p JOIN orders ON seq = o_orderkey LEFT JOIN zp USING (apn) LEFT JOIN m ON m.permit_no = p.permit_no""", "permits parcels")
def s17_permits_table(t):
    rows = t("permits").withColumns({
        "subtype": F.lit(None).cast("string"), "approved": F.lit("soon"), "issued": F.when(F.col("seq") % 2 == 0, "1/2/2020").otherwise(""), "owner": F.lit(None).cast("string"), "address": F.when(F.col("seq") % 3 != 0, "1 OWN ST"),
        "zone_code": F.when(F.col("seq") % 5 == 0, "OWN").otherwise(""), "is_downtown": F.col("seq") % 2 == 0,
    })
    projects = t("permits").where("linked_parent is not null").groupBy(F.col("linked_parent").alias("project_id")).agg(F.min("seq").alias("ord"), F.collect_list("permit_no").alias("permits"))
    return _published(P.permits_table(rows, projects, t("parcels"), _zoning(t)), "permits")


@query("""SELECT linked_parent AS project_id, 'P ' || linked_parent AS project_name, 'linked_parent' AS source, CAST(count(*) AS INT) AS permit_count, CAST(0 AS INT) AS estimated_units, coalesce(min(nullif(apn, '')), '') AS apn, '' AS owner, '' AS address,
    strftime(min(o_orderdate), '%Y-%m-%d') AS first_applied, CAST(NULL AS VARCHAR) AS last_applied, CASE WHEN count(*) % 2 = 0 THEN '["E1","E2"]' ELSE '' END AS entitlement_refs FROM permits JOIN orders ON seq = o_orderkey WHERE linked_parent IS NOT NULL GROUP BY linked_parent""", "permits")
def s17_projects_table(t):
    from civicspark.functions.dates import lenient_date

    rows = t("permits").where("linked_parent is not null").groupBy(F.col("linked_parent").alias("project_id")).agg(F.count("*").alias("permit_count"), F.min(F.nullif("apn", F.lit(""))).alias("apn"), F.min(lenient_date(F.col("applied"))).alias("first_applied"))
    refs = F.when(F.col("permit_count") % 2 == 0, F.array(F.lit("E1"), F.lit("E2"))).otherwise(F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    rows = rows.withColumns({"project_name": F.concat(F.lit("P "), "project_id"), "source": F.lit("linked_parent"), "estimated_units": none, "owner": none, "address": none, "last_applied": F.lit("x"), "entitlement_refs": refs})
    return _published(P.permit_projects_table(rows), "permit_projects")


@query("""SELECT year, apn, CASE WHEN tot_proposed_units % 2 = 0 THEN street_address ELSE 'STD' END AS street_address, '' AS project_name, ord AS tracking_id, unit_cat, '' AS tenure, '' AS app_submit_dt, '' AS application_status, '' AS project_type,
    tot_proposed_units, tot_approved_units, CAST(0 AS INT) AS tot_disapproved_units, above_mod_income, CAST(0 AS INT) AS affordable_units, density_bonus_received AS density_bonus, '' AS sb35, 0.5::DOUBLE AS latitude, 0.0::DOUBLE AS longitude, tot_approved_units > 0 AS is_downtown,
    CASE WHEN tot_approved_units > 0 THEN 'D-1,R-3' ELSE '' END AS zones, false AS has_building_permit, '' AS match_method FROM apr_filings""", "apr_filings")
def s17_filings_table(t):
    none = F.lit(None).cast("string")
    rows = t("apr_filings").withColumns({
        "street_address": F.when(F.col("tot_proposed_units") % 2 == 0, F.col("street_address")).otherwise(""), "std_address": F.lit("STD"), "jurs_tracking_id": F.col("ord"), "latitude": F.lit(0.5), "longitude": none, "tot_disapproved_units": F.lit("x"),
        "is_downtown": F.when(F.col("tot_approved_units") > 0, True), "zones": F.when(F.col("tot_approved_units") > 0, F.array(F.lit("D-1"), F.lit("R-3"))),
        **{c: none for c in ("project_name", "tenure", "app_submit_dt", "application_status", "project_type", "affordable_units", "app_submitted_sb35", "has_building_permit", "match_method")},
    })
    return _published(P.filings_table(rows), "apr_filings")


@query(f"""WITH {_PARCELS} SELECT project_no, CAST(substr(applied, 1, 4) AS INT) AS year, 'a' AS agency, type, status, '' AS name, description, applied, '' AS approved, CASE WHEN ord % 2 = 0 THEN coalesce(parcel_address, '') ELSE planning.address END AS address, apn,
    '' AS planner, coalesce(z, '') AS zone_code, dens AS max_density, coalesce(height, '') AS max_height FROM planning LEFT JOIN zp USING (apn)""", "planning parcels")
def s17_planning_table(t):
    none = F.lit(None).cast("string")
    rows = t("planning").withColumns({"year": F.left("applied", F.lit(4)), "agency": F.lit("a"), "name": none, "approved": none, "planner": none, "address": F.when(F.col("ord") % 2 == 0, "").otherwise(F.col("address"))})
    return _published(P.planning_table(rows, t("parcels"), _zoning(t)), "planning_projects")


@query(f"""WITH {_PARCELS}, u AS ({_UNIFIED}) SELECT project_id, project_name, coalesce(nullif(u.address, ''), parcel_address, '') AS address, u.apn, coalesce(z, '') AS zone_code, coalesce(zc, '') AS zone_category, dens AS max_density, coalesce(height, '') AS max_height,
    CAST(best AS INT) AS units_best, best_source AS units_source, status, density_bonus, coalesce(first_activity, '') AS first_activity, coalesce(last_activity, '') AS last_activity, CAST(meetings AS INT) AS meeting_mention_count FROM u LEFT JOIN zp ON zp.apn = u.apn""", "named_projects mentions apr_filings parcels")
def s17_housing_table(t):
    back = _published(P.housing_table(bound_housing(t, {"planning": ["project_no"], "filings": ["tracking_id"]}), t("parcels"), _zoning(t)), "housing_projects")
    return back.select(
        "project_id", "project_name", "address", "apn", "zone_code", "zone_category", "max_density", "max_height", "units_best", "units_source", "status", "density_bonus", "first_activity", "last_activity", "meeting_mention_count"
    )


@query("SELECT CAST(s_suppkey AS INT) AS account, s_name AS business, CASE WHEN s_suppkey % 2 = 0 THEN 'Active' ELSE '' END AS license_status, '' AS business_area, '' AS rental_type, '' AS address, CAST(s_nationkey AS VARCHAR) AS apn, '' AS property_manager, s_acctbal AS latitude, 0.0::DOUBLE AS longitude FROM supplier")
def s17_licenses_table(t):
    none = F.lit(None).cast("string")
    rows = t("supplier").select(F.col("s_suppkey").alias("account"), F.col("s_name").alias("business"), F.when(F.col("s_suppkey") % 2 == 0, "Active").alias("license_status"), F.col("s_nationkey").alias("apn"), F.col("s_acctbal").alias("latitude"))
    return _published(P.licenses_table(rows.withColumns({c: none for c in ("business_area", "rental_type", "address", "property_manager", "longitude")})), "str_licenses")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS votes, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END AS positions FROM doc_records", "doc_records")
def f27_sanitized_votes(t):
    who = F.array(F.lit("A"))
    vote = F.struct("item_id", F.when(F.col("doc_id") % 3 == 0, "AB 1234").otherwise("SB 79 oppose position").alias("item"), F.lit("54-20").alias("result"), who.alias("yes"), who.alias("no"), who.alias("abstain"))
    rows = t("doc_records").select("doc_id", F.array(vote).alias("votes"), F.array(F.struct("item_id", F.lit("A").alias("member"))).alias("council_positions"))
    return sanitized_votes(rows).select("doc_id", F.size("votes").alias("votes"), F.size("council_positions").alias("positions"))


def _stream(rows, batches: int = 4):
    """rows as a file stream that comes in so many micro-batches, in the order of the first column."""
    path, first = _place(rows, "stream"), rows.columns[0]
    cuts = rows.select(F.col(first).cast("double").alias("x")).approxQuantile("x", [k / batches for k in range(1, batches)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = rows if low is None else rows.where(F.col(first) > low)
        part = part if high is None else part.where(F.col(first) <= high)
        part.coalesce(1).write.mode("append").parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _result(rows, stream, mode: str = "append"):
    to = _place(rows, "out")
    jobs.run_available(rows.sparkSession, stream, to, _place(rows, "checkpoint"), mode)
    return rows.sparkSession.read.parquet(to)


@query("SELECT DISTINCT hash FROM intel_items", "intel_items")
def st1_new_items(t):
    rows = t("intel_items").select("event_id", "hash")
    return _result(rows, jobs.new_items(_stream(rows))).select("hash")


@query("SELECT event_id, coalesce(title <> lag(title) OVER (PARTITION BY url ORDER BY event_id), true) AS changed FROM intel_items", "intel_items")
def st2_page_changes(t):
    rows = t("intel_items").select(F.col("event_id").alias("at"), "url", F.col("title").alias("hash"))
    return _result(rows, jobs.page_changes(_stream(rows))).select("event_id", "changed")


@query("""WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY agency ORDER BY event_id) AS k FROM (SELECT event_id, agency, ok, event_id % 97 = 0 AS release FROM probe_log)),
    s AS (SELECT agency, event_id, k, release, CASE WHEN release OR ok THEN 0 ELSE 1 END AS f, false AS q FROM r WHERE k = 1
      UNION ALL SELECT r.agency, r.event_id, r.k, r.release, CASE WHEN r.release THEN CASE WHEN s.q THEN 0 ELSE s.f END WHEN s.q THEN s.f WHEN r.ok THEN 0 ELSE s.f + 1 END,
        CASE WHEN r.release THEN false WHEN s.q THEN true ELSE NOT r.ok AND s.f + 1 >= 3 END FROM s JOIN r ON r.agency = s.agency AND r.k = s.k + 1)
    SELECT event_id, CAST(f AS INT) AS failures, q AS quarantined FROM s WHERE NOT release""", "probe_log")
def st3_health(t):
    rows = t("probe_log").select(F.col("event_id").alias("at"), "agency", "ok")
    stream = _stream(rows)
    probes, releases = stream.where("at % 97 <> 0"), stream.where("at % 97 = 0")
    return _result(rows, jobs.health(probes, releases)).select("event_id", "failures", "quarantined")


@query("SELECT meeting_id FROM doc_records WHERE doc_id % 40 < 10 GROUP BY meeting_id", "doc_records")
def st4_changed_keys(t):
    prints = t("doc_records").groupBy("meeting_id").agg(F.md5(F.array_join(F.array_sort(F.collect_list("date")), ",")).alias("print"), F.min(F.col("doc_id") % 40).alias("k"))
    old = prints.select("meeting_id", F.when(F.col("k") < 10, "stale").otherwise(F.col("print")).alias("print"))
    return jobs.changed_keys(prints, old, "meeting_id", "print")


@query("SELECT doc_id, meeting_id FROM doc_text", "doc_text")
def st5_hand_off(t):
    rows = t("doc_text").select("doc_id", "meeting_id")
    return _result(rows, _stream(rows))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, agency, count(*) AS n FROM probe_log GROUP BY 1, 2", "probe_log")
def st6_daily_volume(t):
    rows = t("probe_log").select("event_id", "ts", "agency")
    return _result(rows, jobs.daily_volume(_stream(rows)), "complete")


@query(f"WITH {_MERGED} SELECT * FROM merged", "full_records")
def st7_late_sources(t):
    records, dates = full_records(t)
    table, published = _place(records, "table"), _place(records, "published")
    jobs.merge_late(_stream(records), "meeting_id", ["doc_id"], table, _place(records, "checkpoint"), lambda rows: merged_meetings(rows, dates), published)
    return _as_text(records.sparkSession.read.parquet(published))


@query("SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS parts FROM documents")
def ud1_splitter(t):
    return O.split_with(t("documents"), "lines", "doc_id", "text").groupBy("doc_id").agg(F.count("*").alias("parts"))


@query("SELECT event_id, length(title || url) > 8 AS relevant, CAST(least(length(title || url), 10) AS BIGINT) AS score FROM intel_items", "intel_items")
def ud2_scorer(t):
    items = t("intel_items").select("event_id", F.concat("title", "url").alias("x"))
    return O.score_items(items, "x").select("event_id", "verdict.relevant", "verdict.score")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(length(text) AS BIGINT) END AS chars, CASE WHEN doc_id % 7 = 0 THEN 'no_json' END AS error FROM documents")
def ud3_extractor(t):
    docs = t("documents").select("doc_id", F.concat((F.col("doc_id") % 7).cast("string"), F.lit("|"), "text").alias("text"))
    found = O.extract_records(docs, "doc_id", "text", lambda x: "none" if x.startswith("0|") else "Here: " + json.dumps({"chars": len(x) - 2}) + " done", "chars long")
    return found.select("doc_id", F.col("record.chars").alias("chars"), "error")


@query("SELECT event_id FROM intel_items WHERE event_id IN (SELECT min(event_id) FROM intel_items GROUP BY hash)", "intel_items")
def a11_first_item(t):
    return first_by(t("intel_items"), ["hash"], "event_id").select("event_id")
