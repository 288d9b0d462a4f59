"""Record linkage: keep-first, prioritized matching, filings and permits, scored address linkage, prefix and day joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.functions.text import ADDRESS_IN_TEXT, CASE_NUMBER, CROSSREF_TYPES, CROSSREF_WORDS, bound, normalized_address, street_number, street_words
from civicspark.operators.overlap import best_keyword_match, keyword_signs, met, signed, spread_pairs, token_signs
from civicspark.session import cut, dealt, reading


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def prioritized(matches: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """Union of match sets with column `method`; each key keeps the first method that found it."""
    parts = [df.select(*keys, F.lit(k).alias("__order")) for k, (_, df) in enumerate(matches)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    method = F.get(F.array(*[F.lit(name) for name, _ in matches]), F.col("__order"))  # a least number is hashed, a text would be sorted
    return union.groupBy(*keys).agg(F.min("__order").alias("__order")).select(*keys, method.alias("method"))


def address_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of rows whose addresses have one street number and share a street word; both sides have `address`, under any
    name. Distinct addresses are compared once and then spread to their rows (spread_pairs)."""
    side = lambda df, s: df.withColumn(s, normalized_address(F.col("address"))).drop("address").where(street_number(F.col(s)) != "")
    lefts, rights = side(left, "__a"), side(right, "__b")
    kinds = lambda df, s: df.select(s).distinct().select(s, street_number(F.col(s)).alias("__number"), F.explode(street_words(F.col(s))).alias("__word"))
    pairs = kinds(lefts, "__a").join(kinds(rights, "__b"), ["__number", "__word"]).select("__a", "__b").distinct()
    return spread_pairs(pairs, lefts, rights, "__a", "__b")


def address_signs(address: Column) -> Column:
    """The street number with each street word, as an array, so that two addresses have a sign in common if they have one
    number and a word in common."""
    number = street_number(address)
    return F.when(number != "", F.transform(street_words(address), lambda w: F.concat_ws(" ", number, w))).otherwise(F.array())


def _ranked(*signs: Column) -> Column:
    """An array of (rank, sign) of columns of arrays of signs, whose ranks are their places, for F.inline."""
    one = lambda c, k: F.transform(F.coalesce(c.cast("array<string>"), F.array().cast("array<string>")), lambda x: F.struct(F.lit(k).alias("rank"), x.alias("sign")))
    return F.flatten(F.array(*[one(c, k) for k, c in enumerate(signs)]))


PLANNING_METHODS = ["apn", "entitlement_ref", "address", "name_fuzzy"]
MEETING_METHODS = ["project_ref", "address", "name_fuzzy"]


def planning_signs(projects: DataFrame, plans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, rank, sign) of projects and (project_no, rank, sign) of plans, as planning_links takes them: what the two must
    have in common, by method."""
    by_name, by_text = token_signs(projects, plans, "name", "description")
    own = F.filter(F.array(F.trim("apn")), lambda x: x != "")
    place = bound(normalized_address(F.col("address")), address_signs)
    left = projects.select("id", F.inline(_ranked(own, F.col("refs"), place))).unionByName(projects.select("id", "name").join(by_name, "name").select("id", F.lit(3).alias("rank"), "sign"))
    right = plans.select("project_no", F.inline(_ranked(own, F.array("project_no"), place)))
    return left, right.unionByName(plans.select("project_no", "description").join(by_text, "description").select("project_no", F.lit(3).alias("rank"), "sign"))


def named(methods: list[str]) -> Column:
    """The method of a rank."""
    return F.get(F.array(*[F.lit(m) for m in methods]), F.col("rank")).alias("method")


def planning_links(projects: DataFrame, plans: DataFrame) -> DataFrame:
    """(id, project_no, method) of projects (id, apn, refs, address, name) and plans (project_no, apn, address,
    description): by parcel number, entitlement reference, address, and two shared name words of over three letters, each
    pair with the first method that finds it (overlap.met)."""
    plans = cut(dealt(plans.select("project_no", "apn", "address", "description"), "project_no"))
    left, right = signed(*planning_signs(projects, plans), ["id"], ["project_no"])
    return reading(met(left, right).select("id", "project_no", named(PLANNING_METHODS)), left, right, plans)


def told_items(items: DataFrame) -> DataFrame:
    """(meeting_id, item, address, description, cases) of meeting items: the description's first 80 characters and the case
    numbers, which are the filing numbers and those in the description."""
    described = F.coalesce("description", F.lit(""))
    cases = F.array_union(F.transform(F.coalesce("filing_numbers", F.array()), lambda x: F.upper(F.trim(x))), F.regexp_extract_all(described, F.lit(CASE_NUMBER), 0))
    return items.select("meeting_id", F.substring(described, 1, 80).alias("item"), "address", described.alias("description"), F.filter(cases, lambda x: x != "").alias("cases"))


def meeting_signs(projects: DataFrame, told: DataFrame, refs: DataFrame, cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, rank, sign) of projects and (meeting_id, item, rank, sign) of told_items, as meeting_links takes them; `refs`
    (id, sign) and `cases` (meeting_id, item, sign) are the signs of references."""
    item = ["meeting_id", "item"]
    texts = told.where("size(cases) > 0").select(*item, F.upper("description").alias("text"))
    some = projects.where(F.length("name") > 5).select("id", "name")
    by_name, by_text = keyword_signs(some.select("name").distinct(), texts, "name", "text", split_on=r"\W+")
    place = F.explode(bound(normalized_address(F.col("address")), address_signs)).alias("sign")
    at = lambda df, k: df.withColumn("rank", F.lit(k))
    left = at(refs, 0).unionByName(at(projects.select("id", place), 1)).unionByName(at(some.join(by_name, "name").select("id", "sign"), 2))
    return left, at(cases, 0).unionByName(at(told.select(*item, place), 1)).unionByName(at(texts.join(by_text, "text").select(*item, "sign"), 2))


def meeting_links(projects: DataFrame, items: DataFrame) -> DataFrame:
    """(id, meeting_id, item, method) of projects (id, refs, address, name) and meeting items (meeting_id,
    filing_numbers, address, description): by case number, address, and two name words of over three letters that stand
    in the description of an item with a case number, inside words too (told_items). Each pair has the first method that
    finds it (overlap.met)."""
    told = cut(told_items(dealt(items.select("meeting_id", "filing_numbers", "address", "description"), "description")))
    signs = meeting_signs(projects, told, projects.select("id", F.explode("refs").alias("sign")), told.select("meeting_id", "item", F.explode("cases").alias("sign")))
    left, right = signed(*signs, ["id"], ["meeting_id", "item"])
    return reading(met(left, right).select("id", "meeting_id", "item", named(MEETING_METHODS)), left, right, told)


def entitlement_links(projects: DataFrame, entitlements: DataFrame) -> DataFrame:
    """(id, project_no, address, apn, method) of projects (id, name, apns) and entitlements (ord, project_no,
    project_name, description, apn, address): the first entitlement of the smallest parcel number that has one, else the
    one whose name (its description without one) holds the most words of over three letters of the project's name, two
    at least, the first on ties. Projects without either have no row."""
    parcels = projects.select("id", F.explode("apns").alias("apn")).where("apn <> ''").join(entitlements.select("ord", "project_no", "address", "apn"), "apn")
    by_apn = first_by(parcels, ["id"], "apn", "ord").select("id", "project_no", "address", "apn", F.lit("apn").alias("method"))
    rest = projects.select("id", "name").join(by_apn.select("id"), "id", "left_anti")
    titled = entitlements.select(F.struct("ord", "project_no", "address", "apn").alias("found"), F.coalesce(F.nullif("project_name", F.lit("")), F.col("description")).alias("title"))
    best = best_keyword_match(rest.select("name").distinct(), titled, "name", "found", "title")
    return by_apn.unionByName(rest.join(best, "name").select("id", "found.project_no", "found.address", "found.apn", F.lit("name").alias("method")))


def _first_permits(keyed: DataFrame, key: str, most: int) -> DataFrame:
    """(key, permits): the first `most` housing permits of each key in order, or the first of all where none is housing."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("housing"), "ord"))
    some = keyed.withColumn("__rank", rank).where(F.col("__rank") <= most).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "housing", "permit"))).alias("found"))
    any_housing = F.exists("found", lambda x: x["housing"])
    return some.select(key, F.transform(F.filter("found", lambda x: x["housing"] | ~any_housing), lambda x: x["permit"]).alias("permits"))


def filing_permits(filings: DataFrame, permits: DataFrame, most: int = 20, types: list[str] | None = None, words: list[str] | None = None) -> DataFrame:
    """(ord, permits, has_building_permit, match_method) of filings (ord, apn, address) and permits (ord, apn, type,
    description, permit): each filing with the first `most` housing permits, or permits of any kind where there is none
    of housing, that are found by parcel number (apn), by its address in a permit's text (addr_in_desc), or by number and
    another word of the first such address (addr_fuzzy); unmatched filings have no permits and a null method.

    Permits are gathered by key before filings meet them: a parcel or an address is one row with at most `most` permits,
    and an address is listed by its number and each other word, where only the first address stays. So every join has
    one row per key on one side and makes no pairs of filings and permits. Housing is a type of `types` or a word of
    `words` in the text. Of an address that does not start with its number as a word of its own, two words must be shared.
    """
    types, words = types or CROSSREF_TYPES, words or CROSSREF_WORDS
    text = F.upper(F.coalesce("description", F.lit("")))
    housing = F.upper(F.coalesce("type", F.lit(""))).isin(types) | text.rlike("|".join(words))
    own = permits.select("ord", "apn", text.alias("text"), housing.alias("housing"), "permit")
    by_parcel = _first_permits(own.where("apn <> ''"), "apn", most)
    named = own.select("ord", "housing", "permit", F.posexplode(F.regexp_extract_all("text", F.lit(ADDRESS_IN_TEXT), 0)).alias("at", "raw"))
    named = named.withColumn("street", normalized_address(F.col("raw")))
    by_street = _first_permits(named, "street", most)

    tokens = lambda c: F.array_distinct(F.split(c, r"\s+"))
    others = lambda c: F.array_except(tokens(c), F.array(street_number(c)))
    two = lambda c: F.filter(F.flatten(F.transform(others(c), lambda a: F.transform(others(c), lambda b: F.when(a < b, F.concat_ws(" ", a, b))))), lambda x: x.isNotNull())
    place = lambda c, listed: F.transform(listed, lambda w: F.concat_ws("|", street_number(c), w))
    seen = named.groupBy("street").agg(F.min(F.struct("ord", "at")).alias("first"))
    street = F.col("street")
    first = seen.select("street", "first", F.explode(F.array_union(place(street, others(street)), place(street, two(street)))).alias("place"))
    listed = first.groupBy("place").agg(F.min(F.struct("first", "street")).alias("like"))

    address = normalized_address(F.col("address"))
    asked = filings.select("ord", F.col("apn").alias("parcel"), address.alias("at"))
    exact = asked.join(by_parcel.withColumnsRenamed({"apn": "parcel", "permits": "p1"}), "parcel", "left").join(by_street.withColumnsRenamed({"street": "at", "permits": "p2"}), "at", "left")
    lone = F.array_contains(tokens(F.col("at")), street_number(F.col("at")))
    places = F.when(lone, place(F.col("at"), others(F.col("at")))).otherwise(place(F.col("at"), two(F.col("at"))))
    streets = exact.where("p1 is null and p2 is null").select("at").distinct().where(street_number(F.col("at")) != "")
    near = streets.select("at", F.explode(places).alias("place")).join(listed, "place").groupBy("at").agg(F.min("like")["street"].alias("street"))
    near = near.join(by_street, "street").select("at", F.col("permits").alias("p3"))
    method = F.when(F.col("p1").isNotNull(), "apn").when(F.col("p2").isNotNull(), "addr_in_desc").when(F.col("p3").isNotNull(), "addr_fuzzy")
    found = F.coalesce("p1", "p2", "p3")
    none = F.array().cast(by_parcel.schema["permits"].dataType)
    return exact.join(near, "at", "left").select("ord", F.coalesce(found, none).alias("permits"), found.isNotNull().alias("has_building_permit"), method.alias("match_method"))


def scored_links(left: DataFrame, right: DataFrame, least: float = 50.0, overrides: DataFrame | None = None) -> DataFrame:
    """Best right row for each left row by address and name: 40 for the street number, up to 30 for shared street
    words, 25 or 10 for shared name words; rows (left_id, right_id, score) from `least` on.

    Both sides have (id, name, address), addresses normalized. A name alone reaches 25, so the join on street numbers
    loses nothing while least is above 25. Ties go to the smaller right id. Left rows with a row in `overrides` (left_id,
    right_id; each left_id once) get that right_id, without score, and no other.

    Rows of a side with one number and equal word sets are one entry; of the right ones it has the smallest id, so that
    copies make no pairs. Each left entry finds its best right one, and its rows take that.
    """
    if overrides is not None:
        given = left.select(F.col("id").alias("left_id")).join(overrides, "left_id").select("left_id", "right_id", F.lit(None).cast("double").alias("score"))
        others = left.join(overrides.select(F.col("left_id").alias("id")), "id", "left_anti")
        return scored_links(others, right, least).unionByName(given)
    if least <= 25:
        raise ValueError("links by name alone would be lost")
    words = lambda c: F.array_sort(F.filter(F.array_distinct(F.split(F.trim(c), r"\s+")), lambda w: w != ""))
    side = lambda df, s: df.select(F.col("id").alias(f"{s}_id"), street_number(F.col("address")).alias("number"), words(F.regexp_replace("address", r"^\d+", "")).alias(f"{s}_street"), words(F.upper("name")).alias(f"{s}_name"))
    kinds = ["number", "left_street", "left_name"]
    lefts = side(left, "left").where("number <> ''")
    rights = side(right, "right").where("number <> ''").groupBy("number", "right_street", "right_name").agg(F.min(F.struct("right_id")).alias("best"))
    met = lefts.select(*kinds).distinct().join(rights, "number")
    shared = F.size(F.array_intersect("left_street", "right_street"))
    longest = F.greatest(F.size("left_street"), F.size("right_street"))
    names = F.array_intersect("left_name", "right_name")
    by_name = F.when(F.size(names) >= 2, 25).when((F.size(names) == 1) & (F.length(F.get(names, F.lit(0))) > 4), 10).otherwise(0)
    score = 40 + F.when(longest > 0, 30 * shared / longest).otherwise(0) + by_name
    found = met.withColumn("score", score.cast("double")).where(F.col("score") >= least)
    best = found.groupBy(*kinds).agg(F.min(F.struct((-F.col("score")).alias("below"), F.col("best.right_id").alias("right_id"))).alias("best"))
    first = lefts.select("left_id", *kinds).join(best, kinds).groupBy("left_id").agg(F.min("best").alias("best"))
    return first.select("left_id", "best.right_id", (-F.col("best.below")).alias("score"))


def nearest_day(left: DataFrame, right: DataFrame, key: str, day: str, left_id: str, right_id: str, within: int = 1) -> DataFrame:
    """For each left row the right row of the same key at most `within` days away: nearest, then smallest id.

    The interval becomes an equi-join: each left row looks up each day offset, in a table of the smallest id of each key
    and day, so that a day of many rows makes no pairs."""
    offsets = F.explode(F.array(*[F.lit(d) for d in range(-within, within + 1)]))
    asked = left.select(left_id, key, F.col(day).alias("__day"), offsets.alias("gap")).withColumn(day, F.date_add("__day", F.col("gap")))
    met = asked.join(right.groupBy(key, day).agg(F.min(right_id).alias(right_id)), [key, day])
    nearest = met.groupBy(left_id).agg(F.min(F.struct(F.abs("gap").alias("gap"), right_id)).alias("nearest"))
    return nearest.select(left_id, f"nearest.{right_id}", "nearest.gap")


def meeting_videos(videos: DataFrame, meetings: DataFrame, key: str, day: str, video: str, meeting: str, within: int = 1) -> DataFrame:
    """(video, meeting, gap): each video with its nearest meeting (nearest_day), where each meeting keeps its first video;
    a video whose meeting has one already is left out."""
    nearest = nearest_day(videos, meetings, key, day, video, meeting, within)
    first = nearest.groupBy(meeting).agg(F.min(F.struct(video, "gap")).alias("first"))
    return first.select(f"first.{video}", meeting, "first.gap")


def longest_prefix(names: DataFrame, ids: DataFrame, name: str, id_: str, separator: str = "-") -> DataFrame:
    """(name, id) of the longest id that is the name's start up to a separator; null without one."""
    parts = F.split(name, separator)
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), separator))
    met = names.select(name, F.explode(starts).alias(id_)).join(ids.select(id_).distinct(), id_)
    best = met.groupBy(name).agg(F.max_by(id_, F.length(id_)).alias(id_))
    return names.select(name).distinct().join(best, name, "left")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with rows of new put in by key: new values win, keys of either side stay."""
    columns = [c for c in old.columns if c != key]
    renamed = new.select(key, F.lit(True).alias("__new"), *[F.col(c).alias(f"__{c}") for c in columns])
    return old.join(renamed, key, "full_outer").select(key, *[F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in columns])
