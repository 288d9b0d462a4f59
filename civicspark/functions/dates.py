"""Dates as columns: lenient and strict parsing, month keys, dates in titles, ids, feeds and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark.functions.text import bound

# Fixed values.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
MONTH_NAME = "(?i)(january|february|march|april|may|june|july|august|september|october|november|december)"


def _digits(text: Column, width: int) -> Column:
    number = text.try_cast("int").cast("string")
    return F.when(F.length(number) >= width, number).otherwise(F.lpad(number, width, "0"))


def _month_number(name: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(name))
    return F.when(at > 0, F.lpad(at.cast("string"), 2, "0"))


def _found(text: Column, pattern: str, group: int) -> Column:
    """The group of the first match, null without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def lenient_date(text: Column) -> Column:
    """M/D/YYYY becomes ISO, numbers without a range check; text without '/' passes; null is ''."""
    return bound(F.coalesce(text, F.lit("")), lambda t: F.when(F.contains(t, F.lit("/")), bound(F.split(t, "/"), lambda p: F.when(F.size(p) == 3, _slashed(p)).otherwise(t))).otherwise(t))


def _slashed(parts: Column) -> Column:
    number = lambda k: F.get(parts, F.lit(k)).try_cast("int")
    iso = F.concat_ws("-", _digits(F.get(parts, F.lit(2)), 4), _digits(F.get(parts, F.lit(0)), 2), _digits(F.get(parts, F.lit(1)), 2))
    return F.when(number(0).isNotNull() & number(1).isNotNull() & number(2).isNotNull(), iso).otherwise("")


def strict_date(text: Column) -> Column:
    """As lenient_date, but null unless the result starts like an ISO date."""
    return bound(lenient_date(text), lambda out: F.when(out.rlike(r"^\d{4}-\d{2}-\d{2}"), out))


def month_key(text: Column) -> Column:
    """YYYY-MM of either form, else null."""
    key = lambda iso: F.when(iso.rlike(r"^\d{4,}-\d{2}-\d+$"), F.regexp_extract(iso, r"^(\d+-\d{2})", 1))
    return bound(text, lambda t: F.when(F.contains(t, F.lit("/")), bound(lenient_date(t), key)).when(F.contains(t, F.lit("-")) & (F.length(t) >= 7), F.substring(t, 1, 7)))


def normalized_date(text: Column) -> Column:
    """ISO date of ISO text, of a month (its first day), or of M/D/YYYY; else ''."""
    text = F.coalesce(text, F.lit(""))
    return F.coalesce(
        _found(text, r"^(\d{4}-\d{2}-\d{2})", 1),
        F.concat(_found(text, r"^(\d{4}-\d{2})$", 1), F.lit("-01")),
        F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), lenient_date(text)),
        F.lit(""),
    )


def title_date(title: Column) -> Column:
    """The first valid date of a title: month name, slashes, ISO, dots."""
    p = MONTH_NAME + r"\w*\.? +(\d{1,2}),? +(\d{4})"
    named = F.concat_ws("-", _found(title, p, 3), _month_number(_found(title, p, 1)), F.lpad(_found(title, p, 2), 2, "0"))
    q = r"(\d{1,2})/(\d{1,2})/(\d{4})"
    slash = F.concat_ws("-", _found(title, q, 3), F.lpad(_found(title, q, 1), 2, "0"), F.lpad(_found(title, q, 2), 2, "0"))
    d = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
    dots = F.concat_ws("-", _found(title, d, 3), F.lpad(_found(title, d, 1), 2, "0"), F.lpad(_found(title, d, 2), 2, "0"))
    rungs = [named, slash, _found(title, r"(\d{4}-\d{2}-\d{2})", 1), dots]
    return F.coalesce(*[F.try_to_date(F.when(F.length(r) == 10, r), "yyyy-MM-dd") for r in rungs]).cast("string")


def id_date(meeting_id: Column) -> Column:
    """The date that ends an id: YYYYMMDD, or YYYY-MM as its first day; else null."""
    p = r"(20\d{2})(\d{2})(\d{2})$"
    return F.coalesce(
        F.when(meeting_id.rlike(p), F.concat_ws("-", *[F.regexp_extract(meeting_id, p, k) for k in (1, 2, 3)])),
        F.concat(_found(meeting_id, r"(20\d{2}-\d{2})$", 1), F.lit("-01")),
    )


def feed_timestamp(text: Column) -> Column:
    """RFC-2822 with or without weekday, or ISO date; else null."""
    bare = F.regexp_replace(text, r"^[A-Za-z]{3}, *", "")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(_found(text, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")))


def epoch_timestamp(text: Column) -> Column:
    """/Date(ms)/ as a UTC timestamp; else null."""
    return F.timestamp_millis(_found(text, r"/Date\((-?\d+)\)/", 1).try_cast("bigint"))


def document_date(text: Column) -> Column:
    """The date in the first 1000 characters: a DATE: line, month name, slashes, ISO; else null."""
    head = F.substring(text, 1, 1000)
    rungs = []
    for p in (r"DATE:\s*(\w+)\s+(\d{1,2}),?\s+(\d{4})", r"(January|February|March|April|May|June|July|August|September|October|November|December)\s+(\d{1,2}),?\s+(\d{4})"):
        month = _month_number(_found(head, p, 1))
        rungs.append(F.when(month.isNotNull(), F.concat_ws("-", _found(head, p, 3), month, F.lpad(_found(head, p, 2), 2, "0"))))
    p = r"(\d{1,2})/(\d{1,2})/(\d{4})"
    rungs.append(F.when(head.rlike(p), F.concat_ws("-", _found(head, p, 3), F.lpad(_found(head, p, 1), 2, "0"), F.lpad(_found(head, p, 2), 2, "0"))))
    return F.coalesce(*rungs, _found(head, r"(20\d{2}-\d{2}-\d{2})", 1))


def filename_year(name: Column) -> Column:
    """The year that a file name says, after its first two '-' parts; two digits up to 30 are 20xx; else null."""
    rest = F.when(F.size(F.split(name, "-")) > 2, F.regexp_replace(name, "^[^-]*-[^-]*-", "")).otherwise(name)
    two = _found(rest, r"No__(\d{2})_[A-Z]", 1).try_cast("int")
    return F.coalesce(
        _found(rest, r"(20\d{2})_(\d{1,2})_(\d{1,2})", 1).try_cast("int"),
        _found(rest, r"(\d{1,2})_(\d{1,2})_(20\d{2})", 3).try_cast("int"),
        _found(rest, r"(\d{1,2})-(\d{1,2})-(20\d{2})", 3).try_cast("int"),
        F.when(two <= 30, two + 2000).otherwise(two + 1900),
    )
