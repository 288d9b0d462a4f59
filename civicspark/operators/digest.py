"""Monthly digests of meetings, permits, projects, news items and planning projects, rebuilt where their sources changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.dates import month_key
from civicspark.functions.text import content_hash, digest_units
from civicspark.operators.linkage import first_by

#: Which date of a permit puts it into which section.
PERMIT_DATES = {"permits": "applied", "permits_approved": "approved", "permits_issued": "issued"}


def _ordered(values: Column, *order: Column) -> Column:
    """Aggregate: values as an array in the given order."""
    listed = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], values.alias("v"))))
    return F.transform(listed, lambda x: x["v"])


def most_common(rows: DataFrame, keys: list[str], by: str, order: str) -> DataFrame:
    """(*keys, <by>): counts per value of `by` as a map, most frequent first, ties to the one seen first."""
    counts = rows.groupBy(*keys, by).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    entries = _ordered(F.struct(F.coalesce(by, F.lit("unknown")).alias("key"), "n"), -F.col("n"), F.col("first"))
    return counts.groupBy(*keys).agg(F.map_from_entries(entries).alias(f"by_{by}"))


def _dated_permits(permits: DataFrame) -> DataFrame:
    dates = F.array(*[F.struct(F.lit(section).alias("section"), F.col(c).alias("day")) for section, c in PERMIT_DATES.items()])
    rows = permits.select("ord", "permit_no", "type", "status", digest_units(F.col("description")).alias("units"), F.inline(dates))
    return rows.withColumn("month", month_key(F.col("day"))).where("month is not null")


def permit_sections(permits: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """(month, permits, permits_approved, permits_issued): totals, units and counts by type and status of the permits
    filed, approved and issued in a month, null without any; those filed with the projects they belong to, busiest
    first. A permit of several projects belongs to the last."""
    keys, dated = ["section", "month"], _dated_permits(permits)
    sums = dated.groupBy(*keys).agg(F.count("*").alias("total"), F.sum("units").alias("estimated_units"))
    sums = sums.join(most_common(dated, keys, "type", "ord"), keys).join(most_common(dated, keys, "status", "ord"), keys)
    plain = F.struct("total", "estimated_units", "by_type", "by_status")
    out = sums.groupBy("month").agg(*[F.first(F.when(F.col("section") == s, plain), ignorenulls=True).alias(s) for s in PERMIT_DATES])
    if projects is None:
        return out
    member = first_by(projects.select("ord", "project_id", F.explode("permits").alias("permit_no")), ["permit_no"], F.desc("ord")).select("permit_no", "project_id")
    active = dated.where("section = 'permits'").join(member, "permit_no").groupBy("month", "project_id").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    owner = F.when(F.col("source") != "type_aggregate", F.nullif(F.col("owner"), F.lit(""))).alias("owner")
    named = active.join(projects.select("project_id", "project_name", "estimated_units", owner), "project_id")
    entry = F.struct("project_name", "estimated_units", F.col("n").alias("permits_this_month"), "owner")
    return out.join(named.groupBy("month").agg(_ordered(entry, -F.col("n"), F.col("first")).alias("projects")), "month", "left").withColumn("permits", F.when(F.col("permits").isNotNull(), F.struct("permits.*", "projects"))).drop("projects")


def meeting_section(meetings: DataFrame) -> DataFrame:
    """Counts, bodies, agencies and lists of a month's meetings; lists are of substantive meetings alone, in the order of
    ids; flags, comments and quotes are distinct without regard to case and blanks, the first stays."""
    own = meetings.withColumns({"month": month_key(F.col("date")), "told": ~F.coalesce("procedural_only", F.lit(False))}).where("month is not null")
    lists = ["votes", "housing_items", "fiscal_items", "legal_flags", "council_positions", "public_comments", "key_quotes"]
    flat = lambda c: F.flatten(_ordered(F.when(F.col("told"), F.col(c)).otherwise(F.array()), F.col("meeting_id")))
    held = own.groupBy("month").agg(
        F.count("*").alias("meeting_count"), F.count_if("told").alias("substantive_count"), F.array_sort(F.collect_set(F.nullif("body", F.lit("")))).alias("bodies"), F.array_sort(F.collect_set(F.nullif("agency", F.lit("")))).alias("agencies"),
        F.count_if(F.size("votes") > 0).alias("meetings_with_votes"), F.count_if(F.size("housing_items") > 0).alias("meetings_with_housing"), *[flat(c).alias(c) for c in lists],
    )
    totals = [F.size(c).cast("long").alias(f"total_{c}") for c in ("votes", "housing_items", "legal_flags")]
    summary = held.withColumn("activity_summary", F.struct("meetings_with_votes", "meetings_with_housing", *totals)).drop("meetings_with_votes", "meetings_with_housing")
    plain = lambda x: F.lower(F.trim(x))
    distinct = lambda c: F.filter(c, lambda v, i: F.array_position(F.transform(c, plain), plain(v)) == i + 1)
    return summary.withColumns({c: distinct(c) for c in ("legal_flags", "public_comments", "key_quotes")})


def intel_entries(intel: DataFrame) -> DataFrame:
    """(month, ord, entry): a row per news item, the long form of the section's list."""
    item = F.struct("source", "title", "url", F.coalesce("relevance_score", F.lit(0)).alias("relevance_score"))
    return intel.where("month is not null").select("month", "ord", item.alias("entry"))


def planning_entries(planning: DataFrame) -> DataFrame:
    """(month, ord, entry, type): a row per planning project, the long form of the section's list."""
    entry = F.struct("project_no", "type", F.left(F.coalesce("description", F.lit("")), F.lit(100)).alias("description"), "address")
    return planning.select(month_key(F.col("applied")).alias("month"), "ord", entry.alias("entry"), "type").where("month is not null")


def intel_section(intel: DataFrame, lists: bool = True) -> DataFrame:
    """(month, intel): a month's news items in order, or without `lists` their number and the first one."""
    own = intel_entries(intel).groupBy("month")
    if not lists:
        return own.agg(F.struct(F.count("*").alias("total"), F.min_by("entry", "ord").alias("first")).alias("intel"))
    return own.agg(_ordered(F.col("entry"), F.col("ord")).alias("intel"))


def planning_section(planning: DataFrame, lists: bool = True) -> DataFrame:
    """(month, planning_projects): total, counts by type and a month's projects in order, or without `lists` the first."""
    own = planning_entries(planning)
    projects = _ordered(F.col("entry"), F.col("ord")).alias("projects") if lists else F.min_by("entry", "ord").alias("first")
    listed = own.groupBy("month").agg(F.count("*").alias("total"), projects).join(most_common(own, ["month"], "type", "ord"), "month")
    return listed.select("month", F.struct("total", "by_type", "projects" if lists else "first").alias("planning_projects"))


def source_prints(meetings: DataFrame, permits: DataFrame, intel: DataFrame, planning: DataFrame) -> DataFrame:
    """(month, _source_hash) of all months that any source has: a fingerprint of the meetings' contents and source
    counts and of the numbers of all other rows."""
    told = meetings.select(month_key(F.col("date")).alias("month"), F.struct("meeting_id", "source_count", F.sha2(F.to_json(F.struct(*sorted(meetings.columns))), 256).alias("content")).alias("told"))
    prints = told.groupBy("month").agg(F.array_sort(F.collect_list("told")).alias("meetings"))
    counts = _dated_permits(permits).select("month", "section")
    counts = counts.unionByName(intel.select("month", F.lit("intel").alias("section"))).unionByName(planning.select(month_key(F.col("applied")).alias("month"), F.lit("planning").alias("section")))
    kinds = [*PERMIT_DATES, "intel", "planning"]
    sums = counts.groupBy("month").agg(*[F.count_if(F.col("section") == k).alias(k) for k in kinds])
    both = prints.join(sums, "month", "full_outer").where("month is not null").fillna(0, kinds)
    return both.select("month", content_hash("meetings", *kinds).alias("_source_hash"))


def monthly_digests(meetings: DataFrame, permits: DataFrame, intel: DataFrame, planning: DataFrame, projects: DataFrame | None = None, months: DataFrame | None = None, lists: bool = True) -> DataFrame:
    """One row per month that any source has: merged meetings (see merged_meetings), permits (ord, permit_no, type,
    status, description, applied, approved, issued), news items (ord, month, source, title, url, relevance_score),
    planning projects (ord, project_no, type, description, address, applied) and permit projects (ord, project_id,
    project_name, estimated_units, owner, source, permits). Sections without rows are null. With `months` (month,
    _source_hash) only these months are built. A month's news items and planning projects are lists in its row; without
    `lists` the row has their first ones and numbers, so that it stays small, and intel_entries and planning_entries
    have them as rows."""
    wanted = months if months is not None else source_prints(meetings, permits, intel, planning)
    out = wanted.select("month", "_source_hash")
    for section in (meeting_section(meetings), permit_sections(permits, projects), intel_section(intel, lists), planning_section(planning, lists)):
        out = out.join(section, "month", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("meeting_count", "substantive_count")}
    return out.withColumns(zero)


def rebuild_changed(spark: SparkSession, path: str, *sources: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """Builds and publishes the digests whose fingerprint isn't the published one, a folder per month; gives their months.

    Rows of other months leave before anything is grouped, and their folders stay as they are.
    """
    prints = source_prints(*sources)
    published = spark._jvm.org.apache.hadoop.fs.Path(path)
    if published.getFileSystem(spark._jsc.hadoopConfiguration()).exists(published):
        old = spark.read.parquet(path).select(F.col("month").cast("string").alias("month"), F.col("_source_hash").alias("was"))
        prints = prints.join(old, "month", "left").where(~F.col("_source_hash").eqNullSafe(F.col("was"))).drop("was")
    changed = spark.createDataFrame(prints.collect(), prints.schema)  # a row per month
    meetings, permits, intel, planning = sources
    of = lambda df, c: df.join(F.broadcast(changed.select("month")), month_key(F.col(c)) == F.col("month"), "left_semi")
    some = [F.col("month") == month_key(F.col(c)) for c in PERMIT_DATES.values()]
    used = permits.join(F.broadcast(changed.select("month")), some[0] | some[1] | some[2], "left_semi")
    out = monthly_digests(of(meetings, "date"), used, intel.join(F.broadcast(changed.select("month")), "month", "left_semi"), of(planning, "applied"), projects, changed)
    out.write.mode("overwrite").partitionBy("month").option("partitionOverwriteMode", "dynamic").parquet(path)
    return changed
