"""Reports over documents and lookups: volume by agency, tier and scenario; zones by parcel or point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.operators.linkage import first_by

# Tiers in the order in which they would be taken on, and the scenario that each one completes.
TIERS = [("FULL", "Current (FULL only)"), ("FORWARD", "+ FORWARD agencies"), ("TALLY", "+ TALLY -> FORWARD")]


def agency_tier() -> Column:
    """FULL, FORWARD or TALLY from the flags tally_only and forward_only."""
    return F.when(F.coalesce("tally_only", F.lit(False)), "TALLY").when(F.coalesce("forward_only", F.lit(False)), "FORWARD").otherwise("FULL")


def work_queues(docs: DataFrame, agencies: DataFrame, hot_since: str) -> DataFrame:
    """docs (agency, date, transcript, ...) with `queue`: transcripts are hot; documents of agencies that are only counted
    are tally; of agencies that are only read forward those since their enabled_date are forward, others cold; of all
    others those since `hot_since` are hot, others cold, also those without a date. `agencies` is a small dimension
    (agency, tally_only, forward_only, enabled_date); what it lacks has no flags."""
    known = docs.join(agencies.select("agency", agency_tier().alias("__tier"), F.col("enabled_date").alias("__from")), "agency", "left")
    since = lambda day: F.coalesce(F.col("date") >= day, F.lit(False))
    queue = (
        F.when(F.col("transcript"), "hot").when(F.col("__tier") == "TALLY", "tally")
        .when(F.col("__tier") == "FORWARD", F.when(since(F.coalesce("__from", F.lit(""))), "forward").otherwise("cold"))
        .when(since(F.lit(hot_since)), "hot").otherwise("cold")
    )
    return known.withColumn("queue", queue).drop("__tier", "__from")


def volume_report(docs: DataFrame, agencies: DataFrame, since: str) -> DataFrame:
    """(block, name, tier, docs, per_day, per_month, last_day) of documents (agency, day) of agencies (agency,
    tally_only, forward_only) since a day. Rates are per day of the window that has documents.

    Blocks: `agency`, each agency with documents in the window; `total`; `tier`, with its documents; `scenario`, the
    running sum over the tiers in order, with its rate for 30 days; `zero`, agencies that aren't of the tier TALLY and have
    no documents in the window, with the day of their latest one, null if there is none. Documents are counted by agency
    and day once; everything else is of those counts. Agencies that aren't listed have the tier '?', which is in no
    other block but the total.
    """
    counts = docs.where("day is not null").groupBy("agency", "day").agg(F.count("*").alias("n"))
    window = counts.where(F.col("day") >= since)
    own = counts.groupBy("agency").agg(F.sum(F.when(F.col("day") >= since, F.col("n"))).alias("docs"), F.max("day").alias("last_day"))
    days = window.agg(F.greatest(F.countDistinct("day"), F.lit(1)).alias("days"))
    listed = agencies.select("agency", agency_tier().alias("tier"))
    all_ = listed.join(own, "agency", "full_outer").withColumns({"tier": F.coalesce("tier", F.lit("?")), "docs": F.coalesce("docs", F.lit(0))})
    active = all_.where("docs > 0").select(F.lit("agency").alias("block"), F.col("agency").alias("name"), "tier", "docs")
    sums = F.struct(*[F.sum(F.when(F.col("tier") == t, F.col("docs")).otherwise(0)).alias(t) for t, _ in TIERS], F.sum("docs").alias("all"))
    total = all_.agg(sums.alias("s")).where("s.all > 0")
    running = [sum((F.col(f"s.{t}") for t, _ in TIERS[1 : k + 1]), F.col(f"s.{TIERS[0][0]}")) for k in range(len(TIERS))]
    rows = [("total", "TOTAL", F.lit(None).cast("string"), F.col("s.all"))]
    rows += [("tier", t, F.lit(t), F.col(f"s.{t}")) for t, _ in TIERS] + [("scenario", label, F.lit(t), running[k]) for k, (t, label) in enumerate(TIERS)]
    summed = total.select(F.inline(F.array(*[F.struct(F.lit(b).alias("block"), F.lit(n).alias("name"), t.alias("tier"), d.alias("docs")) for b, n, t, d in rows])))
    per_day = F.col("docs") / F.col("days")
    rated = _with_one(active.unionByName(summed), days)
    told = rated.select("block", "name", "tier", "docs", per_day.alias("per_day"), F.when(F.col("block") == "scenario", per_day * 30).alias("per_month"), F.lit(None).cast("string").alias("last_day"))
    zero = all_.where("docs = 0 and tier in ('FULL', 'FORWARD')").select(F.lit("zero").alias("block"), F.col("agency").alias("name"), "tier", "docs", "last_day")
    return told.unionByName(zero, allowMissingColumns=True)


def _with_one(rows: DataFrame, one: DataFrame) -> DataFrame:
    """rows with the columns of a table of one row, by an equality that always holds."""
    return rows.withColumn("__one", F.lit(1)).join(F.broadcast(one.withColumn("__one", F.lit(1))), "__one").drop("__one")


def fallback_zones(asked: DataFrame, by_parcel: DataFrame, by_point: DataFrame) -> DataFrame:
    """asked (ord, apn, latitude, longitude, ...) with zones, is_downtown and `step`: by the parcel number; else, where
    it is empty, unknown or marked parcel_not_found in `error`, by the point to six decimals; else none.

    by_parcel (apn, zones, is_downtown, error) has a row per parcel; of points (ord, latitude, longitude, zones,
    is_downtown) that are equal to six decimals the first is used. A parcel that was not found keeps its own entry where
    there is no point. A latitude or longitude of 0 or null is no point; a point that is unknown gives no zones.
    """
    key = lambda: F.when((F.col("latitude") != 0) & (F.col("longitude") != 0), F.format_string("%.6f,%.6f", F.col("latitude").cast("double"), F.col("longitude").cast("double")))
    points = first_by(by_point.withColumn("point", key()).where("point is not null"), ["point"], "ord").select("point", F.struct("zones", "is_downtown").alias("p"))
    parcels = by_parcel.select(F.col("apn").alias("parcel"), F.struct("zones", "is_downtown").alias("a"), (F.coalesce("error", F.lit("")) == "parcel_not_found").alias("lost"))
    met = asked.withColumns({"parcel": F.nullif(F.col("apn"), F.lit("")), "point": key()}).join(parcels, "parcel", "left").join(points, "point", "left")
    found = F.col("a").isNotNull() & ~F.col("lost")
    step = F.when(found, "apn").when(F.col("point").isNotNull(), F.when(F.col("p").isNotNull(), "point").otherwise("none")).when(F.col("a").isNotNull(), "apn").otherwise("none")
    used = F.when(F.col("step") == "apn", F.col("a")).when(F.col("step") == "point", F.col("p"))
    out = met.withColumn("step", step).withColumn("used", used)
    return out.select(*asked.columns, F.coalesce("used.zones", F.array().cast("array<string>")).alias("zones"), F.coalesce("used.is_downtown", F.lit(False)).alias("is_downtown"), "step")
