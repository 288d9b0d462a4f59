"""Queries for lookups, linkage and set comparison (J, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicspark.functions import text as X
from civicspark.operators.linkage import address_pairs, entitlement_links, filing_permits, first_by, longest_prefix, meeting_links, meeting_videos, planning_links, prioritized, scored_links, upsert
from civicspark.operators.overlap import token_pairs_within
from civicspark.operators.reports import fallback_zones
from civicspark.plans.registry import query
from civicspark.plans.scalar_queries import _ABBR, _ADDR


@query("SELECT p.seq, coalesce(nullif(p.description, ''), r.address) AS address, r.zone_code, split_part(r.density, ' ', 1)::DOUBLE AS density FROM permits p LEFT JOIN parcels r USING (apn)", "permits parcels")
def j1_parcel_lookup(t):
    dim = t("parcels").select("apn", "address", "zone_code", X.density(F.col("density")).alias("density"))
    return t("permits").join(dim, "apn", "left").select("seq", F.coalesce(F.nullif("description", F.lit("")), F.col("address")).alias("address"), "zone_code", "density")


@query("SELECT p.seq, m.project FROM permits p LEFT JOIN (SELECT l_orderkey AS seq, max(l_suppkey) AS project FROM lineitem GROUP BY 1) m USING (seq)", "permits")
def j2_permit_to_project(t):
    projects = t("lineitem").groupBy(F.col("l_suppkey").alias("project")).agg(F.collect_set("l_orderkey").alias("permits"))
    pairs = first_by(projects.select("project", F.explode("permits").alias("seq")), ["seq"], F.desc("project"))
    return t("permits").join(pairs, "seq", "left").select("seq", "project")


@query("""WITH apns AS (SELECT id, apn FROM named_projects UNION SELECT id, second_apn FROM named_projects), es AS (SELECT *, upper(CASE WHEN project_name = '' THEN description ELSE project_name END) AS title FROM entitlements),
    by_apn AS (SELECT a.id, e.project_no, e.apn FROM apns a JOIN es e USING (apn) WHERE a.apn <> '' QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY a.apn, e.ord) = 1),
    words AS (SELECT id, unnest(list_filter(string_split(replace(upper(name), '-', ' '), ' '), lambda w: length(w) > 3)) AS w FROM named_projects WHERE id NOT IN (SELECT id FROM by_apn)),
    hits AS (SELECT id, ord, count(*) AS hits FROM words JOIN es ON contains(title, w) GROUP BY id, ord HAVING count(*) >= 2)
    SELECT id, project_no, apn, 'apn' AS method FROM by_apn UNION ALL
    SELECT id, project_no, apn, 'name' FROM (SELECT id, arg_min(ord, (-hits, ord)) AS ord FROM hits GROUP BY id) JOIN es USING (ord)""", "named_projects entitlements")
def j3_entitlement_match(t):
    projects = t("named_projects").select("id", "name", F.array("apn", "second_apn").alias("apns"))
    return entitlement_links(projects, t("entitlements")).drop("address")


_NORM = _ADDR.format(_ABBR)
_MET = "regexp_extract({0}, '^(\\d+)', 1) = regexp_extract({1}, '^(\\d+)', 1) AND regexp_extract({0}, '^(\\d+)', 1) <> '' AND len(list_intersect({2}, {3})) >= 1"
_STREET = "list_filter(list_distinct(regexp_extract_all({0}, '[A-Z]+')), lambda x: x NOT IN ('ST','AVE','BLVD','DR','LN','CT','RD','HWY','N','S','E','W','CA'))"
_PLACES = f"""pa AS (SELECT id, {_NORM.format('address')} AS x FROM named_projects), ma AS (SELECT *, {_NORM.format('address')} AS y FROM mentions WHERE address IS NOT NULL),
    met AS (SELECT * FROM pa JOIN ma ON {_MET.format('x', 'y', _STREET.format('x'), _STREET.format('y'))})"""


@query(f"""WITH {_PLACES}, pw AS (SELECT id, unnest(list_filter(list_distinct(regexp_split_to_array(upper(name), '\\W+')), lambda w: length(w) > 3)) AS w FROM named_projects),
    mw AS (SELECT project_no, unnest(list_filter(list_distinct(regexp_split_to_array(upper(description), '\\W+')), lambda w: length(w) > 3)) AS w FROM mentions),
    u AS (SELECT id, project_no, 1 AS m FROM named_projects JOIN mentions USING (apn) WHERE apn <> '' UNION ALL SELECT id, project_no, 2 FROM named_projects JOIN mentions ON ref = project_no
      UNION ALL SELECT id, project_no, 3 FROM met UNION ALL SELECT id, project_no, 4 FROM pw JOIN mw USING (w) GROUP BY id, project_no HAVING count(*) >= 2)
    SELECT id, project_no, ['apn', 'entitlement_ref', 'address', 'name_fuzzy'][min(m)] AS method FROM u GROUP BY id, project_no""", "named_projects mentions")
def j4_planning_match(t):
    return planning_links(t("named_projects").withColumn("refs", F.array("ref")), t("mentions"))


@query("""WITH a AS (SELECT ord, year, apn, CAST(split_part(ord, '-', 1) AS BIGINT) AS permit FROM apr_filings), p AS (SELECT seq, apn FROM permits)
    SELECT seq, year, apn, CASE WHEN min(m) = 1 THEN 'permit_crossref' ELSE 'apn' END AS method FROM (
      SELECT p.seq, a.year, a.apn, 1 AS m FROM p JOIN a ON p.seq = a.permit UNION ALL SELECT p.seq, a.year, a.apn, 2 FROM p JOIN a ON p.apn = a.apn AND p.apn <> '') GROUP BY ALL""", "permits apr_filings")
def j5_filing_match(t):
    filings = t("apr_filings").select("year", "apn", F.split_part("ord", F.lit("-"), F.lit(1)).cast("long").alias("permit"))
    permits = t("permits").select("seq", F.col("apn").alias("own"))
    crossed = permits.join(filings, permits.seq == filings.permit)
    same = permits.where("own <> ''").join(filings, permits.own == filings.apn)
    return prioritized([("permit_crossref", crossed), ("apn", same)], ["seq", "year", "apn"])


@query(f"""WITH told AS (SELECT *, substr(description, 1, 80) AS item, list_filter(list_distinct(list_concat([upper(trim(coalesce(filing_number, '')))], regexp_extract_all(description, '\\b(?:D|RD|DB|ZA|CUP|RC|RRP|SC|GPA|EXT|TPM|H)\\d{{2}}-\\d{{4,5}}\\b'))), lambda x: x <> '') AS cases FROM mentions),
    {_PLACES}, refs AS (SELECT id, ref AS c FROM named_projects UNION SELECT id, case_no FROM named_projects),
    words AS (SELECT id, unnest(list_filter(regexp_split_to_array(upper(name), '\\W+'), lambda w: length(w) > 3)) AS w FROM named_projects),
    texts AS (SELECT DISTINCT meeting_id, item, upper(description) AS text FROM told WHERE len(cases) > 0),
    u AS (SELECT id, meeting_id, item, 1 AS m FROM refs JOIN (SELECT meeting_id, item, unnest(cases) AS c FROM told) USING (c) UNION ALL SELECT id, meeting_id, substr(description, 1, 80), 2 FROM met
      UNION ALL SELECT id, meeting_id, item, 3 FROM words JOIN texts ON contains(text, w) GROUP BY id, meeting_id, item, text HAVING count(*) >= 2)
    SELECT id, meeting_id, item, ['project_ref', 'address', 'name_fuzzy'][min(m)] AS method FROM u GROUP BY ALL""", "named_projects mentions")
def j6_meeting_mentions(t):
    projects = t("named_projects").withColumn("refs", F.array("ref", "case_no"))
    return meeting_links(projects, t("mentions").withColumn("filing_numbers", F.when(F.col("filing_number").isNotNull(), F.array("filing_number"))))


_PLAN_A = _ADDR.format(_ABBR.format("address"))
_PARCEL_A = _ADDR.format(_ABBR.format("address || ' ' || street"))


@query(f"""WITH a AS (SELECT ord, {_PLAN_A} AS x FROM planning), b AS (SELECT apn, {_PARCEL_A} AS y FROM parcels)
    SELECT ord, apn FROM a JOIN b ON regexp_extract(x, '^(\\d+)', 1) = regexp_extract(y, '^(\\d+)', 1) AND regexp_extract(x, '^(\\d+)', 1) <> ''
      AND len(list_intersect({_STREET.format('x')}, {_STREET.format('y')})) >= 1""", "planning parcels")
def j7_address_match(t):
    return address_pairs(t("planning").select("ord", "address"), t("parcels").select("apn", F.concat_ws(" ", "address", "street").alias("address"))).select("ord", "apn")


@query("SELECT ord FROM planning WHERE apn NOT IN (SELECT apn FROM permits WHERE type = 'BLD MULTI FAMILY')", "planning permits")
def j8_planning_only(t):
    return t("planning").join(t("permits").where("type = 'BLD MULTI FAMILY'"), "apn", "left_anti").select("ord")


_ASKED = "CASE tot_proposed_units % 4 WHEN 0 THEN street_address WHEN 1 THEN replace(street_address, ' ELM', ' NORTH ELM') WHEN 2 THEN replace(street_address, 'ELM STREET', 'OAK PLACE') ELSE replace(street_address, ' ELM', '-B ELM') END"
_PARCEL = "CASE WHEN unit_cat = 'ADU' THEN apn ELSE concat('P', apn) END"
_NUM = "regexp_extract({0}, '^(\\d+)', 1)"


@query(f"""WITH asked AS (SELECT ord, {_PARCEL} AS apn, {_ASKED} AS address FROM apr_filings), f AS (SELECT ord, apn, {_NORM.format('address')} AS a FROM asked),
    p AS (SELECT seq, apn, upper(description) AS d, type IN ('BLD MULTI FAMILY', 'BLD ACCESSORY DWELLING') OR regexp_matches(upper(description), 'UNIT|DWELLING|ADU|SFR|DUPLEX|TRIPLEX|CONDO|APARTMENT|TOWNHOME') AS h FROM permits),
    k AS (SELECT seq, h, unnest(regexp_extract_all(d, '\\b\\d{{2,5}}\\s+(?:[NSEW]\\.?\\s+)?[A-Z]{{3,}}\\s+(?:ST|AVE|BLVD|DR|LN|CT|RD|HWY|WAY|PL|CIR)')) AS raw FROM p),
    s AS (SELECT seq, h, {_NORM.format('raw')} AS street FROM k), keys AS (SELECT street, min(seq) AS first FROM s GROUP BY 1),
    m1 AS (SELECT ord, seq, h, 'apn' AS method FROM f JOIN p USING (apn) WHERE apn <> ''),
    m2 AS (SELECT ord, seq, h, 'addr_in_desc' AS method FROM f JOIN s ON a = street WHERE ord NOT IN (SELECT ord FROM m1)),
    near AS (SELECT a, arg_min(street, first) AS street FROM (SELECT DISTINCT a FROM f WHERE {_NUM.format('a')} <> '') JOIN keys
      ON {_NUM.format('a')} = {_NUM.format('street')} AND len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(street, ' ')))) >= 2 GROUP BY a),
    m3 AS (SELECT ord, seq, h, 'addr_fuzzy' AS method FROM f JOIN near USING (a) JOIN s USING (street) WHERE ord NOT IN (SELECT ord FROM m1 UNION SELECT ord FROM m2)),
    u AS (SELECT *, bool_or(h) OVER (PARTITION BY ord) AS any_h FROM (FROM m1 UNION ALL FROM m2 UNION ALL FROM m3)),
    r AS (SELECT * FROM u WHERE h OR NOT any_h QUALIFY row_number() OVER (PARTITION BY ord ORDER BY seq) <= 20)
    SELECT f.ord, coalesce(string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq), '') AS permits, coalesce(min(method), 'none') AS method FROM f LEFT JOIN r USING (ord) GROUP BY f.ord""", "apr_filings permits")
def j9_filing_crossref(t):
    filings = t("apr_filings").select("ord", F.expr(_PARCEL).alias("apn"), F.expr(_ASKED).alias("address"))
    found = filing_permits(filings, t("permits").select(F.col("seq").alias("ord"), "apn", "type", "description", F.col("seq").alias("permit")))
    return found.select("ord", F.array_join(F.transform("permits", lambda x: x.cast("string")), ",").alias("permits"), F.coalesce("match_method", F.lit("none")).alias("method"))


_LIHTC_A = _ADDR.format("regexp_replace(" + _ABBR.format("proj_add") + ", '\\b(SUITE|STE|UNIT|BLDG|BUILDING|APT)\\b.*$', '')")


@query(f"""WITH l AS (SELECT hud_id AS id, project AS name, trim({_LIHTC_A}) AS a FROM lihtc), r AS (SELECT project_no AS id, description AS name, {_PLAN_A} AS a FROM planning),
    w AS (SELECT l.id AS li, r.id AS ri, list_distinct(string_split(trim(regexp_replace(l.a, '^\\d+', '')), ' ')) AS ls, list_distinct(string_split(trim(regexp_replace(r.a, '^\\d+', '')), ' ')) AS rs,
      list_intersect(list_distinct(string_split(l.name, ' ')), list_distinct(string_split(r.name, ' '))) AS nm
      FROM l JOIN r ON regexp_extract(l.a, '^(\\d+)', 1) = regexp_extract(r.a, '^(\\d+)', 1) AND regexp_extract(l.a, '^(\\d+)', 1) <> ''),
    s AS (SELECT li, ri, 40 + 30 * len(list_intersect(ls, rs))::DOUBLE / greatest(len(ls), len(rs)) + CASE WHEN len(nm) >= 2 THEN 25 WHEN len(nm) = 1 AND length(nm[1]) > 4 THEN 10 ELSE 0 END AS score FROM w)
    SELECT li AS left_id, arg_min(ri, (-score, ri)) AS right_id, max(score) AS score FROM s WHERE score >= 50 GROUP BY li""", "lihtc planning")
def j10_scored_linkage(t):
    left = t("lihtc").select(F.col("hud_id").alias("id"), F.col("project").alias("name"), X.normalized_address(F.col("proj_add"), drop_unit=True).alias("address"))
    right = t("planning").select(F.col("project_no").alias("id"), F.col("description").alias("name"), X.normalized_address(F.col("address")).alias("address"))
    return scored_links(left, right)


@query("SELECT hud_id FROM lihtc WHERE hud_id NOT IN (SELECT apn FROM planning)", "lihtc planning")
def j11_unmatched(t):
    return t("lihtc").join(t("planning"), F.col("hud_id") == F.col("apn"), "left_anti").select("hud_id")


@query("""SELECT video, meeting, gap FROM (SELECT video, arg_min(meeting, (gap, meeting)) AS meeting, CAST(min(gap) AS INT) AS gap FROM (
    SELECT v.id AS video, m.id AS meeting, abs(v.date - m.date) AS gap FROM videos v JOIN meetings_meta m ON v.body = m.body AND abs(v.date - m.date) <= 1) GROUP BY video) QUALIFY row_number() OVER (PARTITION BY meeting ORDER BY video) = 1""", "videos meetings_meta")
def j12_nearest_date(t):
    return meeting_videos(t("videos").withColumnRenamed("id", "video"), t("meetings_meta").withColumnRenamed("id", "meeting"), "body", "date", "video", "meeting")


@query("SELECT id FROM videos WHERE id NOT IN (SELECT event_id FROM events WHERE user_id % 3 = 0)", "videos")
def j13_not_yet_done(t):
    return t("videos").join(t("events").where("user_id % 3 = 0").select(F.col("event_id").alias("id")), "id", "left_anti").select("id")


@query("SELECT file_name AS name, CASE WHEN doc_id % 5 = 0 THEN meeting_id || '-' || doc_id ELSE meeting_id END AS id FROM doc_text", "doc_text")
def j14_longest_prefix(t):
    docs = t("doc_text")
    ids = docs.select(F.col("meeting_id").alias("id")).union(docs.where("doc_id % 5 = 0").select(F.concat_ws("-", "meeting_id", "doc_id"))).distinct()
    return longest_prefix(docs.select(F.col("file_name").alias("name")), ids, "name", "id")


@query("SELECT doc_id, r.date FROM doc_text d LEFT JOIN (SELECT meeting_id, min(date) AS date FROM doc_records GROUP BY 1) r USING (meeting_id)", "doc_text doc_records")
def j15_meeting_metadata(t):
    meta = t("doc_records").groupBy("meeting_id").agg(F.min("date").alias("date"))
    docs = t("doc_text").select("doc_id", F.split_part("file_name", F.lit("-"), F.lit(1)).alias("meeting_id"))
    return docs.join(meta, "meeting_id", "left").select("doc_id", "date")


@query("SELECT agency, count(*) AS remaining FROM doc_text WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 10 <> 3 GROUP BY agency", "doc_text")
def j16_remaining_work(t):
    docs = t("doc_text")
    left = docs.join(docs.where("doc_id % 10 = 3").select("doc_id"), "doc_id", "left_anti").join(t("labels"), "doc_id", "left_anti")
    return left.groupBy("agency").agg(F.count("*").alias("remaining"))


@query("""SELECT year, CASE WHEN a IS NULL THEN 'extra' WHEN b IS NULL THEN 'missing' ELSE 'both' END AS state, count(*) AS n FROM (
    SELECT coalesce(p.year, q.year) AS year, p.seq AS a, q.seq AS b FROM (SELECT * FROM permits WHERE seq % 2 = 0) p FULL JOIN (SELECT * FROM permits WHERE seq % 3 = 0) q USING (seq)) GROUP BY ALL""", "permits")
def j17_coverage(t):
    p = t("permits").where("seq % 2 = 0").select("seq", F.col("year").alias("ya"), F.lit(1).alias("a"))
    q = t("permits").where("seq % 3 = 0").select("seq", F.col("year").alias("yb"), F.lit(1).alias("b"))
    state = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").otherwise("both")
    return p.join(q, "seq", "full_outer").groupBy(F.coalesce("ya", "yb").alias("year"), state.alias("state")).agg(F.count("*").alias("n"))


@query("SELECT v.id, CASE WHEN m.date IS NULL THEN 'none' WHEN v.date = m.date THEN 'match' WHEN v.date < m.date THEN 'older' ELSE 'newer' END AS state FROM videos v LEFT JOIN (SELECT body, min(date) AS date FROM meetings_meta GROUP BY body) m USING (body)", "videos meetings_meta")
def j18_date_reconciliation(t):
    listed = t("meetings_meta").groupBy("body").agg(F.min("date").alias("listed"))
    state = F.when(F.col("listed").isNull(), "none").when(F.col("date") == F.col("listed"), "match").when(F.col("date") < F.col("listed"), "older").otherwise("newer")
    return t("videos").join(listed, "body", "left").select("id", state.alias("state"))


@query("SELECT substr(date, 1, 7) AS month, count(*) AS orphans FROM doc_records WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY 1", "doc_records")
def j19_orphans(t):
    gone = t("doc_records").join(t("documents").where("lang = 'en'"), "doc_id", "left_anti")
    return gone.groupBy(F.substring("date", 1, 7).alias("month")).agg(F.count("*").alias("orphans"))


@query("""WITH asked AS (SELECT ord, CASE WHEN unit_cat = 'SFD' THEN '' ELSE apn END AS apn, CASE WHEN tot_proposed_units % 5 = 0 THEN 0 ELSE 33 + (tot_proposed_units % 40) / 3e6 END AS lat, -117.0::DOUBLE AS lon FROM apr_filings),
    z AS (SELECT apn, [zone_code] AS zones, zone_code = 'D-1' AS d, CAST(apn AS INT) % 6 = 0 AS lost FROM parcels WHERE CAST(apn AS INT) % 2 = 0),
    p AS (SELECT printf('%.6f', 33 + (CAST(apn AS INT) % 25) / 3e6) AS point, arg_min(zone_code, CAST(apn AS INT)) AS zone FROM parcels GROUP BY 1),
    met AS (SELECT a.ord, z.zones, z.d, z.lost, CASE WHEN lat <> 0 THEN printf('%.6f', lat) END AS point, p.zone FROM asked a LEFT JOIN z ON z.apn = nullif(a.apn, '') LEFT JOIN p ON lat <> 0 AND printf('%.6f', lat) = p.point),
    s AS (SELECT *, CASE WHEN NOT lost THEN 'apn' WHEN point IS NOT NULL THEN CASE WHEN zone IS NOT NULL THEN 'point' ELSE 'none' END WHEN zones IS NOT NULL THEN 'apn' ELSE 'none' END AS step FROM met)
    SELECT ord, step, coalesce(CASE step WHEN 'apn' THEN zones[1] WHEN 'point' THEN zone END, '') AS zone, coalesce(CASE step WHEN 'apn' THEN d WHEN 'point' THEN zone = 'D-1' END, false) AS is_downtown FROM s""", "apr_filings parcels")
def j20_fallback_lookup(t):
    lat = F.when(F.col("tot_proposed_units") % 5 == 0, F.lit(0.0)).otherwise(33 + (F.col("tot_proposed_units") % 40) / 3e6)
    asked = t("apr_filings").select("ord", F.when(F.col("unit_cat") == "SFD", "").otherwise(F.col("apn")).alias("apn"), lat.alias("latitude"), F.lit(-117.0).alias("longitude"))
    zones, number = [F.array("zone_code").alias("zones"), (F.col("zone_code") == "D-1").alias("is_downtown")], F.col("apn").cast("int")
    by_parcel = t("parcels").where(number % 2 == 0).select("apn", *zones, F.when(number % 6 == 0, "parcel_not_found").alias("error"))
    by_point = t("parcels").select(number.alias("ord"), (33 + (number % 25) / 3e6).alias("latitude"), F.lit(-117.0).alias("longitude"), *zones)
    return fallback_zones(asked, by_parcel, by_point).select("ord", "step", F.coalesce(F.get("zones", F.lit(0)), F.lit("")).alias("zone"), "is_downtown")


@query("""WITH m AS (SELECT DISTINCT substr(date, 1, 7) AS month FROM doc_records UNION SELECT DISTINCT strftime(ts, '%Y-%m') FROM intel_items UNION SELECT DISTINCT substr(applied, 1, 7) FROM planning)
    SELECT month, coalesce(r.n, 0) AS records, coalesce(i.n, 0) AS items, coalesce(p.n, 0) AS plans FROM m LEFT JOIN (SELECT substr(date, 1, 7) AS month, count(*) AS n FROM doc_records GROUP BY 1) r USING (month)
    LEFT JOIN (SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n FROM intel_items GROUP BY 1) i USING (month) LEFT JOIN (SELECT substr(applied, 1, 7) AS month, count(*) AS n FROM planning GROUP BY 1) p USING (month)""", "doc_records intel_items planning")
def j21_month_alignment(t):
    count = lambda df, m, name: df.groupBy(m.alias("month")).agg(F.count("*").alias(name))
    parts = [count(t("doc_records"), F.substring("date", 1, 7), "records"), count(t("intel_items"), F.date_format("ts", "yyyy-MM"), "items"), count(t("planning"), F.substring("applied", 1, 7), "plans")]
    months = parts[0].select("month").union(parts[1].select("month")).union(parts[2].select("month")).distinct()
    for p in parts:
        months = months.join(p, "month", "left")
    return months.fillna(0, ["records", "items", "plans"])


@query("""SELECT month, string_agg(project || ':' || CAST(n AS VARCHAR), ',' ORDER BY project) AS projects FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, linked_parent AS project, count(*) AS n FROM permits JOIN orders ON seq = o_orderkey WHERE linked_parent IS NOT NULL GROUP BY 1, 2) GROUP BY month""", "permits")
def j22_active_projects(t):
    from civicspark.functions.dates import month_key

    counts = t("permits").where("linked_parent is not null").groupBy(month_key(F.col("applied")).alias("month"), F.col("linked_parent").alias("project")).agg(F.count("*").alias("n"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("project", "n"))), lambda x: F.concat_ws(":", x["project"], x["n"].cast("string")))
    return counts.groupBy("month").agg(F.array_join(listed, ",").alias("projects"))


@query("SELECT coalesce(a.seq, b.seq) AS seq, CASE WHEN b.seq IS NOT NULL THEN 'NEW' ELSE a.status END AS status FROM (SELECT * FROM permits WHERE seq % 2 = 0) a FULL JOIN (SELECT * FROM permits WHERE seq % 3 = 0) b USING (seq)", "permits")
def j23_upsert(t):
    old = t("permits").where("seq % 2 = 0").select("seq", "status")
    return upsert(old, t("permits").where("seq % 3 = 0").select("seq", F.lit("NEW").alias("status")), "seq")


@query("SELECT seq, true AS pending FROM permits WHERE seq % 3 = 0 AND seq % 2 <> 0 UNION ALL SELECT seq, false FROM permits WHERE seq % 2 = 0", "permits")
def j24_new_keys(t):
    have = t("permits").where("seq % 2 = 0").select("seq")
    new = t("permits").where("seq % 3 = 0").select("seq").join(have, "seq", "left_anti")
    return new.withColumn("pending", F.lit(True)).union(have.withColumn("pending", F.lit(False)))


@query("SELECT DISTINCT k FROM (SELECT meeting_id AS k FROM doc_records UNION SELECT agency FROM probe_log UNION SELECT source FROM intel_items)", "doc_records probe_log intel_items")
def u1_union_of_keys(t):
    return t("doc_records").select(F.col("meeting_id").alias("k")).union(t("probe_log").select("agency")).union(t("intel_items").select("source")).distinct()


@query("SELECT apn FROM parcels EXCEPT SELECT apn FROM permits", "parcels permits")
def u2_difference(t):
    return t("parcels").select("apn").subtract(t("permits").select("apn"))


@query("""WITH w AS (SELECT p_partkey AS k, unnest(list_filter(list_distinct(regexp_split_to_array(upper(p_name), '\\W+')), lambda x: length(x) > 3)) AS x FROM part)
    SELECT a.k AS a, b.k AS b, count(*) AS shared FROM w a JOIN w b ON a.x = b.x AND a.k < b.k GROUP BY 1, 2 HAVING count(*) >= 2""")
def u3_word_overlap(t):
    return token_pairs_within(t("part"), "p_partkey", "p_name", "a", "b")
