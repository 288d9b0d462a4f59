"""One query per scalar function over a bound table."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.functions import dates as D
from civicspark.functions import text as X
from civicspark.operators.reports import work_queues
from civicspark.plans.registry import query

_ISO = "printf('%04d-%02d-%02d', CAST(split_part({0}, '/', 3) AS INT), CAST(split_part({0}, '/', 1) AS INT), CAST(split_part({0}, '/', 2) AS INT))"
_US = "concat(CAST(month(ts) AS VARCHAR), '/', CAST(day(ts) AS VARCHAR), '/', CAST(year(ts) AS VARCHAR))"


@query(f"SELECT seq, {_ISO.format('applied')} AS applied FROM permits", "permits")
def f1_lenient_date(t):
    return t("permits").select("seq", D.lenient_date(F.col("applied")).alias("applied"))


@query(f"SELECT seq, CASE WHEN seq % 3 = 0 THEN {_ISO.format('applied')} WHEN seq % 3 = 1 THEN NULL END AS d FROM permits", "permits")
def f2_strict_date(t):
    raw = F.when(F.col("seq") % 3 == 0, F.col("applied")).when(F.col("seq") % 3 == 1, F.lit("no date")).otherwise(F.lit("unknown"))
    return t("permits").select("seq", D.strict_date(raw).alias("d"))


@query("SELECT p.seq, strftime(make_date(p.year, CAST(split_part(p.applied, '/', 1) AS INT), 1), '%Y-%m') AS month, substr(q.applied, 1, 7) AS plan_month FROM permits p LEFT JOIN planning q ON p.seq = q.ord", "permits planning")
def f3_month_key(t):
    plans = t("planning").selectExpr("ord seq", "applied iso")
    return t("permits").join(plans, "seq", "left").select("seq", D.month_key(F.col("applied")).alias("month"), D.month_key(F.col("iso")).alias("plan_month"))


@query("SELECT ord, CASE ord % 3 WHEN 0 THEN applied WHEN 1 THEN concat(substr(applied, 1, 7), '-01') ELSE '' END AS d FROM planning", "planning")
def f4_normalized_date(t):
    raw = F.when(F.col("ord") % 3 == 0, F.concat("applied", F.lit("T00:00"))).when(F.col("ord") % 3 == 1, F.substring("applied", 1, 7)).otherwise(F.lit("soon"))
    return t("planning").select("ord", D.normalized_date(raw).alias("d"))


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS d FROM events")
def f5_title_date(t):
    day = F.col("ts")
    forms = [F.date_format(day, "MMMM d, yyyy"), F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day)), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "M.d.yyyy")]
    title = F.concat(F.lit("Regular Meeting - "), F.element_at(F.array(*forms), (F.col("event_id") % 4 + 1).cast("int")))
    return t("events").select("event_id", D.title_date(title).alias("d"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-01') END AS d FROM events")
def f6_id_date(t):
    made = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "'cb-body-'yyyyMMdd")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "'ccc-'yyyy-MM")).otherwise(F.lit("m-12"))
    return t("events").select("event_id", D.id_date(made).alias("d"))


@query("SELECT event_id, strftime(CASE event_id % 2 WHEN 0 THEN date_trunc('second', ts) ELSE date_trunc('day', ts) END, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def f7_feed_timestamp(t):
    raw = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0000'")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return t("events").select("event_id", F.date_format(D.feed_timestamp(raw), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_id, epoch_ms(date_trunc('milliseconds', ts)) AS ms FROM events")
def f8_epoch_timestamp(t):
    raw = F.concat(F.lit("/Date("), F.unix_millis(F.col("ts").cast("timestamp")), F.lit(")/"))
    return t("events").select("event_id", F.unix_millis(D.epoch_timestamp(raw)).alias("ms"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '2020-08-05' WHEN 1 THEN '2023-10-04' WHEN 2 THEN '2024-12-18' END AS d FROM documents")
def f9_document_date(t):
    head = F.element_at(F.array(F.lit("DATE:  August 5, 2020 "), F.lit("Minutes of October 4 2023 "), F.lit("12/18/2024 "), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return t("documents").select("doc_id", D.document_date(F.concat(head, F.col("text"))).alias("d"))


@query("SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN year(ts) WHEN 1 THEN year(ts) WHEN 2 THEN 2021 END AS INT) AS y, coalesce(CASE event_id % 4 WHEN 2 THEN 2021 ELSE year(ts) END = year(ts), true) AS consistent FROM events")
def f10_filename_year(t):
    k = F.col("event_id") % 4
    name = F.when(k == 0, F.date_format("ts", "'12-34-'yyyy_MM_dd'_Minutes'")).when(k == 1, F.date_format("ts", "'12-34-'M_d_yyyy'_Agenda'")).when(k == 2, F.lit("12-34-Ordinance_No__21_OR")).otherwise(F.lit("12-34-Exhibit"))
    y = D.filename_year(name)
    return t("events").select("event_id", y.alias("y"), F.coalesce(y == F.year("ts"), F.lit(True)).alias("consistent"))


@query("SELECT event_id, concat('Body ', CAST(user_id % 4 AS VARCHAR)) AS body FROM events")
def f11_body_name(t):
    title = F.concat(F.lit("Regular Body "), (F.col("user_id") % 4).cast("string"), F.lit(" Meeting 6:00 p.m. - "), F.date_format("ts", "MMM d, yyyy"))
    body = F.regexp_replace(title, r"^(Regular|Special|Adjourned) ", "")
    for p in (r" - [A-Z][a-z]{2} \d{1,2}, \d{4}$", r" \d{1,2}:\d{2} [ap]\.m\.", r" Meeting$"):
        body = F.regexp_replace(body, p, "")
    return t("events").select("event_id", body.alias("body"))


@query("SELECT p_partkey, concat('prj-', rtrim(substr(trim(regexp_replace(lower(p_name || '  #' || p_type), '[^a-z0-9]+', '-', 'g'), '-'), 1, 20), '-')) AS slug FROM part")
def f12_slug(t):
    return t("part").select("p_partkey", X.slug(F.concat("p_name", F.lit("  #"), "p_type"), 20, "prj-").alias("slug"))


@query("""SELECT event_id, substr(md5(concat(title, '|', url)), 1, 12) AS id,
    substr(sha256('{"event_id":' || CAST(event_id AS VARCHAR) || ',"source":"' || source || '","title":"' || title || '"}'), 1, 16) AS content FROM intel_items""", "intel_items")
def f13_hash_ids(t):
    return t("intel_items").select("event_id", X.short_hash(F.concat_ws("|", "title", "url")).alias("id"), X.content_hash("title", "source", "event_id").alias("content"))


_ADDR = "trim(regexp_replace({0}, '[#,.]', '', 'g'))"
_ABBR = "upper({0})"
for _full, _short in X.STREET_WORDS:
    _ABBR = f"regexp_replace({_ABBR}, '\\b{_full}\\b', '{_short}', 'g')"


@query(f"""SELECT apn, {_ADDR.format(_ABBR.format("address || ' ' || street"))} AS a FROM parcels
    UNION ALL SELECT 'l' || hud_id, {_ADDR.format("regexp_replace(" + _ABBR.format("proj_add") + ", '\\b(SUITE|STE|UNIT|BLDG|BUILDING|APT)\\b.*$', '')")} FROM lihtc""", "parcels lihtc")
def f14_address(t):
    parcels = t("parcels").select("apn", X.normalized_address(F.concat_ws(" ", "address", "street")).alias("a"))
    return parcels.union(t("lihtc").select(F.concat(F.lit("l"), "hud_id"), X.normalized_address(F.col("proj_add"), drop_unit=True)))


@query("SELECT ord, regexp_extract(street_address, '^(\\d+)', 1) AS n FROM apr_filings", "apr_filings")
def f15_street_number(t):
    return t("apr_filings").select("ord", X.street_number(F.col("street_address")).alias("n"))


_UNITS = "CASE WHEN regexp_matches({0}, '(\\d+)\\s*(UNIT|DU|DWELLING|APT|APARTMENT|CONDO|ROOM)') THEN CAST(regexp_extract({0}, '(\\d+)\\s*(UNIT|DU|DWELLING|APT|APARTMENT|CONDO|ROOM)', 1) AS INT) WHEN regexp_matches({0}, '(\\d+)\\s*[-\\s]?PLEX') THEN CAST(regexp_extract({0}, '(\\d+)\\s*[-\\s]?PLEX', 1) AS INT)"
EST_UNITS = _UNITS.format("upper(description)") + " WHEN contains(upper(description), 'TRIPLEX') THEN 3 WHEN contains(upper(description), 'DUPLEX') THEN 2 ELSE 1 END"


@query(f"""SELECT seq, {EST_UNITS} AS units, {_UNITS.format('upper(description)')} END AS text_units,
    coalesce(try_cast(regexp_extract(upper(description), '(\\d+)\\s*(?:UNIT|DU|DWELLING)', 1) AS INT), 1) AS digest_units FROM permits""", "permits")
def f16_units(t):
    return t("permits").select("seq", X.estimated_units(F.col("description")).alias("units"), X.units_in_text(F.col("description")).alias("text_units"), X.digest_units(F.col("description")).alias("digest_units"))


_TOLD = ["", "monarch north  river farms", "MELROSE HTS PA2 STRAND", "PH 3 MELROSE HEIGHTS PA 1HARBOR", "PA3 SUNSET", "PA 1 PHASE 2", "PA2 LOT 4", "NEPTUNE", "MODERA MELROSE", "olive  park", "COAST VILLAS", "SANDPIPER VILLA", "GREENBRIER VILLAGE", "SOUTH RIVER VILLAGE", "AVOCADO ROAD"]
_TEXT = "upper(trim(description || ' ' || ['" + "', '".join(_TOLD) + f"'][CAST(seq % {len(_TOLD)} AS INT) + 1]))"
_FORMED = {"{1}": "g1", "MELROSE HEIGHTS {1}": "'MELROSE HEIGHTS ' || g1", "MELROSE HEIGHTS PA {1} {2}": "'MELROSE HEIGHTS PA ' || g1 || ' ' || g2", "MELROSE HEIGHTS PA 2": "'MELROSE HEIGHTS PA 2'"}


def _formed(pattern: str, form: str) -> str:
    return _FORMED[form].replace("g1", f"trim(regexp_extract(d, '{pattern}', 1))").replace("g2", f"trim(regexp_extract(d, '{pattern}', 2))")


@query(f"""WITH t AS (SELECT seq, {_TEXT} AS d FROM permits), n AS (SELECT seq, CASE {' '.join(f"WHEN regexp_matches(d, '{p}') THEN {{'name': {_formed(p, f)}, 'method': '{m}'}}" for p, m, f in X.NAME_RULES)} END AS x FROM t)
    SELECT seq, regexp_replace(regexp_replace(regexp_replace(x.name, '\\s+', ' ', 'g'), 'PA\\s*(\\d)', 'PA \\1', 'g'), '\\bNORTH\\b', 'N', 'g') AS name, x.method AS method FROM n""", "permits")
def f17_project_name(t):
    said = F.element_at(F.array(*[F.lit(x) for x in _TOLD]), (F.col("seq") % len(_TOLD) + 1).cast("int"))
    return t("permits").select("seq", X.project_name(F.concat_ws(" ", "description", said)).alias("p")).select("seq", "p.name", "p.method")


@query("SELECT apn, CASE WHEN density IS NULL THEN NULL ELSE CAST(split_part(density, ' ', 1) AS DOUBLE) END AS per_acre FROM parcels", "parcels")
def f18_density(t):
    return t("parcels").select("apn", X.density(F.col("density")).alias("per_acre"))


@query("SELECT ord, vlow_income_dr + low_income_ndr + mod_income_dr AS affordable, replace(concat(substr(apn, 1, 1), '-', substr(apn, 2)), '-', '') AS apn FROM apr_filings", "apr_filings")
def f19_affordable_units(t):
    tiers = [F.coalesce(F.col(c), F.lit(0)) for c in ("vlow_income_dr", "low_income_ndr", "mod_income_dr")]
    dashed = F.concat(F.substring("apn", 1, 1), F.lit("-"), F.expr("substr(apn, 2)"))
    return t("apr_filings").select("ord", sum(tiers[1:], tiers[0]).alias("affordable"), F.regexp_replace(dashed, "-", "").alias("apn"))


@query("""SELECT 'permit' AS kind, seq AS id FROM permits WHERE type IN ('BLD SFD OR DUPLEX', 'BLD MULTI FAMILY', 'BLD MID RISE', 'BLD ACCESSORY DWELLING')
    UNION ALL SELECT 'plan', ord FROM planning WHERE contains(type, 'DEVELOPMENT PLAN') OR contains(type, 'DENSITY BONUS')""", "permits planning")
def f20_categories(t):
    permits = t("permits").where(F.col("type").isin(X.HOUSING_TYPES)).select(F.lit("permit").alias("kind"), F.col("seq").alias("id"))
    listed = F.exists(F.array(*[F.lit(x) for x in X.PLANNING_TYPES]), lambda x: F.contains(F.col("type"), x))
    return permits.union(t("planning").where(listed).select(F.lit("plan"), "ord"))


_BARE = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query(f"""WITH b AS (SELECT doc_id, {_BARE} AS s FROM documents),
    c AS (SELECT doc_id, s, list_filter(string_split(s, chr(10))[1:200], lambda x: trim(x) <> '') AS l FROM b)
    SELECT doc_id, CASE WHEN length(s) < 100 THEN 'too_short' WHEN length(s) > 20000 THEN 'oversized'
      WHEN length(regexp_replace(substr(s, 1, 5000), '[^\\p{{L}}\\s]', '', 'g')) / greatest(length(substr(s, 1, 5000)), 1) < 0.2 THEN 'garbled_pdf'
      WHEN list_sum(list_transform(l, lambda x: length(trim(x)))) / greatest(len(l), 1) < 3 AND len(l) > 50 THEN 'garbled_pdf' END AS reason FROM c""")
def f21_skip_reason(t):
    return t("documents").select("doc_id", X.skip_reason(F.col("text"), 20_000).alias("reason"))


def _count(words):
    return " + ".join(f"CAST((length(s) - length(replace(s, '{w}', ''))) / {len(w)} AS INT)" for w in words)


def _kinds(words):
    return " + ".join(f"CAST(contains(s, '{w}') AS INT)" for w in words)


@query(f"""SELECT doc_id, v.keep AS keep, v.confidence AS confidence FROM (
    SELECT doc_id, CASE
      WHEN length({_BARE}) < 200 OR regexp_matches(f, 'bid.?tabulation|warrant.?register|check.?register|treasurer.?report|vendor.?list') THEN {{'keep': false, 'confidence': 0.0::DOUBLE}}
      WHEN regexp_matches(f, 'staff[-_]report') OR regexp_matches(s, '(aye|yea|nay|yes|no)\\s*[-:]\\s*\\d') THEN {{'keep': true, 'confidence': 0.9::DOUBLE}}
      WHEN kinds = 0 AND pkinds >= 3 THEN {{'keep': false, 'confidence': 0.05::DOUBLE}}
      WHEN hits / per < 0.5 AND phits / per > hits / per * 3 AND NOT contains(f, 'minutes') THEN {{'keep': false, 'confidence': 0.1::DOUBLE}}
      WHEN kinds >= 2 OR regexp_matches(s, 'item\\s+\\d+') OR contains(f, 'agenda') THEN {{'keep': true, 'confidence': least(0.95::DOUBLE, 0.3::DOUBLE + kinds * 0.05::DOUBLE + hits / per * 0.1::DOUBLE)}}
      WHEN contains(f, 'minutes') AND kinds >= 1 THEN {{'keep': true, 'confidence': 0.5::DOUBLE}}
      WHEN hits > 0 THEN {{'keep': true, 'confidence': 0.3::DOUBLE}} ELSE {{'keep': false, 'confidence': 0.1::DOUBLE}} END AS v
    FROM (SELECT doc_id, f, s, text, per, ({_count(X.SUBSTANTIVE)}) AS hits, ({_kinds(X.SUBSTANTIVE)}) AS kinds, ({_count(X.PROCEDURAL)}) AS phits, ({_kinds(X.PROCEDURAL)}) AS pkinds
      FROM (SELECT doc_id, lower(file_name) AS f, text, greatest(length(text), 1) / 1000::DOUBLE AS per,
        lower(CASE WHEN length(text) > 24000 THEN substr(text, 1, 8000) || substr(text, length(text) // 2 - 3999, 8000) || right(text, 8000) ELSE substr(text, 1, 8000) END) AS s FROM doc_text)))""", "doc_text")
def f22_relevance(t):
    return t("doc_text").select("doc_id", X.relevance(F.col("text"), F.col("file_name")).alias("v")).select("doc_id", "v.keep", "v.confidence")


@query("""SELECT doc_id, CASE WHEN contains(file_name, 'agenda') THEN 'agenda' WHEN contains(file_name, 'minutes') THEN 'minutes' WHEN contains(file_name, 'staff') THEN 'staff_report' ELSE 'other' END AS doc_type,
    split_part(file_name, '-', 1) AS agency FROM doc_text""", "doc_text")
def f23_document_type(t):
    kind = F.lit("other")
    for word, name in (("staff", "staff_report"), ("minutes", "minutes"), ("agenda", "agenda")):
        kind = F.when(F.contains("file_name", F.lit(word)), name).otherwise(kind)
    return t("doc_text").select("doc_id", kind.alias("doc_type"), F.split_part("file_name", F.lit("-"), F.lit(1)).alias("agency"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'bldg' WHEN 'MACHINERY' THEN 'mach' ELSE concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) END AS body FROM customer")
def f24_body_code(t):
    codes = F.create_map(F.lit("BUILDING"), F.lit("bldg"), F.lit("MACHINERY"), F.lit("mach"))
    return t("customer").select("c_custkey", F.coalesce(F.try_element_at(codes, F.col("c_mktsegment")), F.initcap(F.replace("c_mktsegment", F.lit("_"), F.lit(" ")))).alias("body"))


@query("SELECT seq, year + seq % 3 >= 1997 AND year <= 1999 AS inside FROM permits", "permits")
def f25_year_range(t):
    folder = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("Minutes "), "year")).otherwise(F.concat(F.lit("Minutes "), F.col("year"), F.lit("-"), F.col("year") + F.col("seq") % 3))
    years = F.transform(F.regexp_extract_all(folder, F.lit(r"(\d{4})"), 1), lambda x: x.cast("int"))
    return t("permits").select("seq", ((F.array_max(years) >= 1997) & (F.array_min(years) <= 1999)).alias("inside"))


@query("SELECT ord, array_to_string(list_distinct([project_no, 'CUP' || substr(applied, 3, 2) || '-00123']).list_sort(), ',') AS refs FROM planning", "planning")
def f26_case_numbers(t):
    short = F.concat(F.lit("see CUP"), F.substring("applied", 3, 2), F.lit("-00123 and CUP"), F.substring("applied", 3, 2), F.lit("-00123."))
    found = F.regexp_extract_all(short, F.lit(f"({X.CASE_NUMBER})"), 1)
    refs = F.array_union(found, F.transform(F.array("project_no"), lambda x: F.upper(F.trim(x))))
    return t("planning").select("ord", F.array_join(F.array_sort(refs), ",").alias("refs"))


@query("SELECT seq, CASE WHEN seq % 2 = 0 THEN 'owner ' || apn ELSE '' END AS owner FROM permits", "permits")
def f28_owner_of_contacts(t):
    contact = lambda role, name: F.struct(role.alias("role"), name.alias("name"))
    role = F.when(F.col("seq") % 2 == 0, F.lit("OWNER")).otherwise(F.lit("AGENT"))
    contacts = F.array(contact(F.lit("APPLICANT"), F.lit("a")), contact(role, F.concat(F.lit("owner "), F.col("apn"))), contact(role, F.lit("b")))
    return t("permits").select("seq", F.coalesce(F.try_element_at(F.filter(contacts, lambda c: c["role"] == "OWNER"), F.lit(1))["name"], F.lit("")).alias("owner"))


@query("""SELECT custkey, n, nos, first_day FROM (SELECT o_custkey AS custkey, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS nos,
    min(strftime(o_orderdate, '%Y-%m-%d')) AS first_day FROM orders GROUP BY o_custkey)""")
def f29_flatten(t):
    refs = F.sort_array(F.collect_list(F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))))
    nested = t("orders").groupBy(F.col("o_custkey").alias("custkey")).agg(refs.alias("refs"))
    return nested.select("custkey", F.size("refs").cast("long").alias("n"), F.array_join(F.transform("refs", lambda x: x["o_orderkey"].cast("string")), ",").alias("nos"), F.array_min(F.transform("refs", lambda x: x["day"])).alias("first_day"))


@query("SELECT apn, CASE WHEN zone_code = 'D-1' THEN 'D-1' ELSE 'R-3' END AS zone, zone_code = 'D-1' AS is_downtown FROM parcels", "parcels")
def f30_zone_pick(t):
    zones = F.array(F.lit("R-3"), F.col("zone_code"))
    town = F.filter(zones, lambda z: z.startswith("D-"))
    return t("parcels").select("apn", F.coalesce(F.try_element_at(town, F.lit(1)), F.try_element_at(zones, F.lit(1)), F.lit("")).alias("zone"), (F.size(town) > 0).alias("is_downtown"))


@query("""SELECT doc_id, CASE WHEN doc_type = 'minutes' THEN 'hot' WHEN k % 2 = 1 THEN 'tally' WHEN k IS NOT NULL THEN CASE WHEN date >= '2026-06-01' THEN 'forward' ELSE 'cold' END WHEN date >= '2026-09-01' THEN 'hot' ELSE 'cold' END AS queue
    FROM (SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN date END AS date, agency, doc_type FROM doc_records) LEFT JOIN (SELECT DISTINCT 'src' || CAST(r_regionkey AS VARCHAR) AS agency, r_regionkey AS k FROM region) USING (agency)""", "doc_records")
def f31_work_queue(t):
    agencies = t("region").select(F.concat(F.lit("src"), F.col("r_regionkey").cast("string")).alias("agency"), (F.col("r_regionkey") % 2 == 1).alias("tally_only"), F.lit(True).alias("forward_only"), F.lit("2026-06-01").alias("enabled_date"))
    docs = t("doc_records").select("doc_id", "agency", F.when(F.col("doc_id") % 13 != 0, F.col("date")).alias("date"), (F.col("doc_type") == "minutes").alias("transcript"))
    return work_queues(docs, agencies, "2026-09-01").select("doc_id", "queue")


@query("SELECT vec_id, round(list_avg(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS mean FROM embeddings")
def f32_centroid(t):
    ring = F.col("embedding").cast("array<double>")
    return t("embeddings").select("vec_id", F.round(F.aggregate(ring, F.lit(0.0), lambda a, x: a + x) / F.size(ring), 6).alias("mean"))


@query("SELECT seq, substr(description || ' ' || type, 1, 20) AS summary FROM permits", "permits")
def f33_permit_summary(t):
    cut = F.struct("permit_no", F.substring(F.concat_ws(" ", "description", "type"), 1, 20).alias("description"))
    listed = F.slice(F.array_repeat(cut, 30), 1, 20)
    return t("permits").select("seq", listed[19]["description"].alias("summary"))


@query("SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 0 THEN r.date ELSE '2026-01-01' END AS date, split_part(file_name, '-', 1) AS meeting_id FROM doc_text d JOIN doc_records r USING (doc_id)", "doc_text doc_records")
def f34_record_completion(t):
    index = t("doc_records").where("doc_id % 4 = 0").select("doc_id", "date")
    file_date = F.regexp_extract(F.lit("notes-2026-01-01.txt"), r"(\d{4}-\d{2}-\d{2})", 1)
    return t("doc_text").join(index, "doc_id", "left").select("doc_id", F.coalesce("date", file_date).alias("date"), F.regexp_extract("file_name", "^([^-]+)-", 1).alias("meeting_id"))


@query("""SELECT doc_id, CAST(length(text) // 4 + 800 * chunks AS BIGINT) AS input_tokens, CAST(1500 * chunks AS BIGINT) AS output_tokens,
    round((length(text) // 4 + 800 * chunks) * 0.25 / 1e6 + 1500 * chunks * 1.25 / 1e6, 9) AS usd FROM (SELECT doc_id, text, 1 + length(text) // 5000 AS chunks FROM documents)""")
def f35_cost(t):
    rows = t("documents").select("doc_id", F.length("text").alias("n"), (F.lit(1) + F.floor(F.length("text") / 5000)).alias("chunks"))
    given, made = F.floor(F.col("n") / 4) + 800 * F.col("chunks"), 1500 * F.col("chunks")
    return rows.select("doc_id", given.cast("long").alias("input_tokens"), made.cast("long").alias("output_tokens"), F.round(given * 0.25 / 1e6 + made * 1.25 / 1e6, 9).alias("usd"))


@query("""SELECT page_id, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) WHEN regexp_matches(url, '[?&]ref=') THEN regexp_extract(url, '[?&]ref=([^&#]*)', 1)
    ELSE substr(md5(url), 1, 12) END AS id FROM pages""")
def f36_id_from_url(t):
    value = lambda k: F.when(F.col("url").rlike(f"[?&]{k}="), F.regexp_extract("url", f"[?&]{k}=([^&#]*)", 1))
    return t("pages").select("page_id", F.coalesce(F.coalesce(F.try_url_decode(value("page")), value("page")), F.coalesce(F.try_url_decode(value("ref")), value("ref")), X.short_hash(F.col("url"))).alias("id"))
