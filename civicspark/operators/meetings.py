"""Per-document records to meetings and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.functions.dates import filename_year
from civicspark.operators.linkage import first_by


def majority(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) of the most frequent value; ties to the one seen first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
    return first_by(counts, [key], F.desc("__n"), "__first").select(key, value)


def in_order(value: Column | str, order: str) -> Column:
    """Aggregate: the values of a group as an array in the given order, without nulls."""
    value = F.col(value) if isinstance(value, str) else value
    listed = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v")))))
    return F.transform(listed, lambda x: x["v"])


def first_votes(rows: DataFrame, key: str, by: str, order: str) -> DataFrame:
    """The first row of each (key, by); rows without a value of `by` all stay."""
    named = F.coalesce(F.col(by), F.lit("")) != ""
    return first_by(rows.where(named), [key, by], order).unionByName(rows.where(~named))


def keep_substantive(records: DataFrame, key: str, procedural: str) -> DataFrame:
    """records without procedural ones, except where they are the only one of their key."""
    counts = records.groupBy(key).agg(F.count("*").alias("__n"))
    return records.join(counts, key).where(~F.coalesce(F.col(procedural), F.lit(False)) | (F.col("__n") == 1)).drop("__n")


def sanitized_votes(record: DataFrame) -> DataFrame:
    """Drops votes on state bills unless local, when their tally is over 20 or no voter is named, and the positions
    on their items."""
    bill = lambda v: v["item"].rlike(r"\b(AB|SB|ACA|SCA) ?\d+") & ~F.lower(v["item"]).rlike("oppose|support|position")
    tally = lambda v: F.coalesce(F.regexp_extract(v["result"], r"(\d+)-(\d+)", 1).try_cast("int"), F.lit(0)) + F.coalesce(F.regexp_extract(v["result"], r"(\d+)-(\d+)", 2).try_cast("int"), F.lit(0))
    voters = lambda v: F.size(v["yes"]) + F.size(v["no"]) + F.size(v["abstain"])
    drop = lambda v: F.coalesce(bill(v) & ((tally(v) > 20) | (voters(v) == 0)), F.lit(False))
    gone = F.transform(F.filter("votes", lambda v: drop(v) & v["item_id"].isNotNull()), lambda v: v["item_id"])
    marked = record.withColumn("__gone", gone)
    kept = marked.withColumns({"votes": F.filter("votes", lambda v: ~drop(v)), "council_positions": F.filter("council_positions", lambda p: ~F.coalesce(F.array_contains(F.col("__gone"), p["item_id"]), F.lit(False)))})
    return kept.drop("__gone")


#: Lists of a document's record that a meeting takes from records of its own date alone, and from all of its records.
OF_THE_DATE, OF_ALL = ["votes", "council_positions", "key_quotes"], ["housing_items", "fiscal_items", "legal_flags", "public_comments"]


def _votes_of_meetings(used: DataFrame, order: str) -> DataFrame:
    """(meeting_id, votes): the votes in order, without those whose key stands before them; those with an empty key all
    stay. Votes are rows until then, as a search of each in an array of all takes quadratic time."""
    vote = F.col("vote")
    key = F.coalesce(F.nullif(vote["item_id"], F.lit("")), F.left(F.trim(F.lower(F.coalesce(vote["item"], F.lit("")))), F.lit(80)))
    each = used.select("meeting_id", F.col(order).alias("__order"), "doc_type", F.posexplode("votes").alias("at", "vote"))
    placed = each.select("meeting_id", F.struct("__order", "doc_type", "at").alias("place"), "vote", key.alias("key"))
    first = placed.where("key <> ''").groupBy("meeting_id", "key").agg(F.min_by("vote", "place").alias("vote"), F.min("place").alias("place"))
    kept = first.drop("key").unionByName(placed.where("key = ''").drop("key"))
    return kept.groupBy("meeting_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "vote"))), lambda x: x["vote"]).alias("votes"))


def merged_meetings(records: DataFrame, text_dates: DataFrame | None = None, order: str = "_file") -> DataFrame:
    """One row per meeting from the records of its documents (meeting_id, date, body, agency, doc_type, procedural_only,
    _file and the lists of OF_THE_DATE and OF_ALL), in the order of `order`.

    The meeting's date is the most frequent of all its records, the first on ties. Procedural records are left out
    unless a meeting has one record alone. A record is historical if its date differs, if its file name has another
    year, or if `text_dates` (stem, text_date; the date in the document's text) has another year; a missing date is no
    difference. Historical records keep their types, body, agency and the lists of OF_ALL, but their votes, positions and
    quotes are withheld. The published date and agency are the most frequent of the records that are left, the body is
    the smallest. Flags, comments and quotes are distinct in order, votes by item id, else by the first 80 characters of
    the item; votes without either all stay. `sources` has (file, type, date_match) of the records used,
    `source_count` counts all. A meeting is one row, so its documents meet in one task.
    """
    day = F.nullif(F.col("date"), F.lit(""))
    dates = majority(records.withColumn("date", day), "meeting_id", "date", order).withColumnRenamed("date", "canonical")
    counted = records.groupBy("meeting_id").agg(F.count("*").alias("source_count"))
    used = keep_substantive(records, "meeting_id", "procedural_only").join(dates, "meeting_id", "left")
    stem = F.regexp_replace("_file", r"\.json$", "")
    text_year = F.lit(None).cast("string")
    if text_dates is not None:
        used = used.withColumn("stem", stem).join(text_dates.select("stem", "text_date"), "stem", "left")
        text_year = F.substring("text_date", 1, 4)
    year = F.substring("canonical", 1, 4)
    same = (day == F.col("canonical"), filename_year(F.col("_file")) == year.try_cast("int"), text_year == year)
    matches = F.coalesce(same[0], F.lit(True)) & F.coalesce(same[1], F.lit(True)) & F.coalesce(same[2], F.lit(True))
    used = used.withColumn("__matches", matches)
    listed = lambda c: F.coalesce(F.col(c), F.array())
    told = F.struct(
        F.col(order).alias("__order"), F.struct(F.col("_file").alias("file"), F.col("doc_type").alias("type"), F.col("__matches").alias("date_match")).alias("source"),
        *[F.when(F.col("__matches"), listed(c)).otherwise(F.array()).alias(c) for c in OF_THE_DATE if c != "votes"], *[listed(c).alias(c) for c in OF_ALL],
    )
    # few, large rows: adaptive execution would put them into one task; an exchange into the usual number of parts can be left out
    dealt = used.repartition(2 * int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")), "meeting_id")
    some = dealt.groupBy("meeting_id").agg(
        F.array_sort(F.collect_list(told)).alias("all"), F.min(F.nullif(F.col("body"), F.lit(""))).alias("body"), F.array_sort(F.collect_set(F.nullif(F.col("doc_type"), F.lit("")))).alias("doc_types"),
    )
    together = lambda c: F.flatten(F.transform("all", lambda r: r[c]))
    joined = some.select("meeting_id", "body", "doc_types", F.transform("all", lambda r: r["source"]).alias("sources"), *[together(c).alias(c) for c in OF_THE_DATE + OF_ALL if c != "votes"])
    votes = _votes_of_meetings(used.where("__matches"), order)
    joined = joined.join(votes, "meeting_id", "left").withColumn("votes", F.coalesce("votes", F.array().cast(votes.schema["votes"].dataType)))
    empty = (F.size("votes") == 0) & (F.size("housing_items") == 0) & (F.size("fiscal_items") == 0)
    merged = joined.withColumns({"procedural_only": empty, **{c: F.array_distinct(c) for c in ("legal_flags", "public_comments", "key_quotes")}})
    published = majority(used.withColumn("date", day), "meeting_id", "date", order)
    agency = majority(used.withColumn("agency", F.nullif(F.col("agency"), F.lit(""))), "meeting_id", "agency", order)
    out = counted.join(merged, "meeting_id", "left").join(published, "meeting_id", "left").join(agency, "meeting_id", "left")
    lists = [F.coalesce(c, F.array().cast(merged.schema[c].dataType)).alias(c) for c in ("doc_types", "sources", *OF_THE_DATE, *OF_ALL)]
    unknown = lambda c: F.coalesce(c, F.lit("Unknown")).alias(c)
    return out.select("meeting_id", F.coalesce("date", F.lit("")).alias("date"), unknown("body"), unknown("agency"), "source_count", *lists, F.coalesce("procedural_only", F.lit(True)).alias("procedural_only"))


def merged_chunks(chunks: DataFrame, key: str = "doc_id", order: str = "chunk_no") -> DataFrame:
    """One row per document from its chunks: items deduplicated in order, first date and body that are not empty,
    procedural only if every chunk is."""
    first = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lead = chunks.select(key, *[F.first(F.nullif(c, F.lit("")), ignorenulls=True).over(first).alias(c) for c in ("date", "body")]).distinct()
    lists = chunks.groupBy(key).agg(F.array_distinct(F.flatten(in_order("items", order))).alias("items"), F.bool_and("procedural_only").alias("procedural_only"))
    return lead.join(lists, key)
