"""Addresses, units, names, ids, categories and text quality as columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviations of street words, in order.
STREET_WORDS = [
    ("STREET", "ST"), ("AVENUE", "AVE"), ("BOULEVARD", "BLVD"), ("DRIVE", "DR"), ("LANE", "LN"), ("COURT", "CT"),
    ("ROAD", "RD"), ("HIGHWAY", "HWY"), ("NORTH", "N"), ("SOUTH", "S"), ("EAST", "E"), ("WEST", "W"),
]
STREET_NOISE = ["ST", "AVE", "BLVD", "DR", "LN", "CT", "RD", "HWY", "N", "S", "E", "W", "CA"]
# Units in a description, and planning case numbers.
UNITS = r"(\d+)\s*(?:UNIT|DU|DWELLING|APT|APARTMENT|CONDO|ROOM)"
DIGEST_UNITS = r"(\d+)\s*(?:UNIT|DU|DWELLING)"
PLEX = r"(\d+)\s*[-\s]?PLEX"
CASE_NUMBER = r"\b(?:D|RD|DB|ZA|CUP|RC|RRP|SC|GPA|EXT|TPM|H)\d{2}-\d{4,5}\b"
HOUSING_TYPES = ["BLD SFD OR DUPLEX", "BLD MULTI FAMILY", "BLD MID RISE", "BLD ACCESSORY DWELLING"]
# Addresses in permit texts, and the types and words of permits for housing in the filings' cross-reference.
ADDRESS_IN_TEXT = r"\b(\d{2,5})\s+([NSEW]\.?\s+)?([A-Z]{3,}\s+(?:ST|AVE|BLVD|DR|LN|CT|RD|HWY|WAY|PL|CIR))"
CROSSREF_TYPES = [
    "BLD MULTI FAMILY", "BLD SINGLE FAMILY", "BLD ACCESSORY DWELLING", "BLD NEW RESIDENTIAL", "BLD ROOM ADDITION", "BLD MOBILE HOME",
    "BLD DUPLEX", "BLD CONDO", "BLD APARTMENT", "BLD TOWNHOUSE",
]
CROSSREF_WORDS = ["UNIT", "DWELLING", "ADU", "SFR", "DUPLEX", "TRIPLEX", "CONDO", "APARTMENT", "TOWNHOME"]
PLANNING_TYPES = ["DEVELOPMENT PLAN", "DENSITY BONUS"]
# Words of procedure and of substance in meeting texts, and file names that are never read.
PROCEDURAL = [
    "consent calendar", "roll call", "pledge of allegiance", "invocation", "approval of minutes", "adjournment", "public comment period",
    "ceremonial", "proclamation", "presentation", "recognition", "warrant register", "treasurer report", "city manager report",
    "moment of silence", "flag salute",
]
SUBSTANTIVE = [
    "motion", "second", "vote", "aye", "nay", "approved", "denied", "continued", "tabled", "public hearing", "ordinance", "resolution",
    "zoning", "permit", "variance", "conditional use", "general plan", "specific plan", "ceqa", "eir", "subdivision", "development",
    "budget", "bond", "tax", "fee", "assessment", "grant", "appropriat", "revenue", "expenditure", "contract", "violation", "enforcement",
    "litigation", "compliance", "penalty", "lawsuit", "state law", "appeal", "housing", "density", "affordable", "rezone",
    "infrastructure", "traffic", "water", "sewer", "utilities", "public safety", "fire", "police", "emergency", "park", "recreation",
    "library", "transit",
]
SKIPPED_NAMES = ["bid.?tabulation", "warrant.?register", "check.?register", "treasurer.?report", "vendor.?list"]


def normalized_address(address: Column, drop_unit: bool = False) -> Column:
    """Upper case, single blanks, abbreviated street words, no '#,.'; with drop_unit no suite, unit or building either."""
    out = F.regexp_replace(F.trim(F.upper(F.coalesce(address, F.lit("")))), r"\s+", " ")
    out = reduce(lambda c, w: F.regexp_replace(c, rf"\b{w[0]}\b", w[1]), STREET_WORDS, out)
    if drop_unit:
        out = F.regexp_replace(out, r"\b(SUITE|STE|UNIT|BLDG|BUILDING|APT)\b.*$", "")
    return F.trim(F.regexp_replace(out, "[#,.]", ""))


def street_number(address: Column) -> Column:
    return F.regexp_extract(address, r"^(\d+)", 1)


def street_words(address: Column) -> Column:
    """The distinct words of a normalized address that are not suffixes or directions."""
    words = F.regexp_extract_all(address, F.lit("([A-Z]+)"), 1)
    return F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in STREET_NOISE]))


def addresses_match(a: Column, b: Column) -> Column:
    same = (street_number(a) != "") & (street_number(a) == street_number(b))
    return same & (F.size(F.array_intersect(street_words(a), street_words(b))) >= 1)


def units_in_text(text: Column) -> Column:
    """Units that a text names, else null."""
    upper = F.upper(text)
    return F.coalesce(*[F.regexp_extract(upper, p, 1).try_cast("int") for p in (UNITS, PLEX)])


def estimated_units(description: Column) -> Column:
    upper = F.upper(F.coalesce(description, F.lit("")))
    return F.coalesce(units_in_text(upper), F.when(F.contains(upper, F.lit("TRIPLEX")), 3).when(F.contains(upper, F.lit("DUPLEX")), 2), F.lit(1))


def digest_units(description: Column) -> Column:
    """Units of a permit as the monthly digest counts them: by fewer words, else 1."""
    return F.coalesce(F.regexp_extract(F.upper(description), DIGEST_UNITS, 1).try_cast("int"), F.lit(1))


def slug(text: Column, most: int = 40, prefix: str = "") -> Column:
    """Lower case, other than letters and digits to '-', trimmed, cut."""
    dashed = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.concat(F.lit(prefix), F.rtrim(F.substring(dashed, 1, most), F.lit("-")))


def short_hash(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 12)


def content_hash(*columns: str) -> Column:
    """First 16 hex digits of SHA-256 over the JSON of the columns in sorted order, nulls kept."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256), 1, 16)


def project_name(description: Column, rules: list[tuple[str, str, str]] | None = None) -> Column:
    """struct(name, method) by the first of (pattern, method, name) that matches, where {1} and {2} in a name stand for
    the pattern's groups; names have single blanks, "PA 1" for "PA1" and "N" for "NORTH". Both are null without a match."""
    upper = F.trim(F.upper(description))
    out = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("method"))
    for pattern, method, form in reversed(rules or NAME_RULES):
        parts = [F.trim(F.regexp_extract(upper, pattern, int(p))) if p in ("1", "2") else F.lit(p) for p in re.split(r"\{(\d)\}", form) if p]
        name = F.regexp_replace(F.regexp_replace(F.concat(*parts), r"\s+", " "), r"PA\s*(\d)", "PA $1")
        out = F.when(upper.rlike(pattern), F.struct(F.regexp_replace(name, r"\bNORTH\b", "N").alias("name"), F.lit(method).alias("method"))).otherwise(out)
    return out


# Default rules as (pattern, method, name), in order.
NAME_RULES = [
    (r"LOT\s+\d+\s*[-–]\s*PLAN\s+TYPE\s+\w+\s*[-–]\s*([\w\s]+?)\s*[-–]", "lot_plan", "{1}"),
    (r"((?:MONARCH|MAGNOLIA|MAHOGANY|CYPRESS|MONTEREY)\s+(?:N|NORTH)\s+RIVER\s+FARMS)", "river_farms", "{1}"),
    (r"MELRO[SE]+\s+H(?:EI|GH)?(?:TS|GHTS)\s+(PA\s*\d+\s*(?:HARBOR|STRAND|SUNSET))", "melrose_heights", "MELROSE HEIGHTS {1}"),
    (r"PH\s*\d+\s+MELRO[SE]+\s+H(?:EI|GH)?(?:TS|GHTS)\s+(PA\s*\d+\s*(?:HARBOR|STRAND|SUNSET))", "melrose_heights", "MELROSE HEIGHTS {1}"),
    (r"PA\s*([123])\s*(HARBOR|STRAND|SUNSET)", "melrose_pa_num", "MELROSE HEIGHTS PA {1} {2}"),
    (r"(PA\s*1)\s+PHASE", "melrose_pa", "MELROSE HEIGHTS {1}"),
    (r"PA\s*2\s+(?:PLAN|LOT)", "melrose_pa2", "MELROSE HEIGHTS PA 2"),
    (r"(NEPTUNE)", "named_project", "{1}"),
    (r"(MODERA\s+MELROSE)", "named_project", "{1}"),
    (r"(OLIVE\s+PARK)", "named_project", "{1}"),
    (r"(COAST\s+VILLAS)", "named_project", "{1}"),
    (r"(SANDPIPER\s+VILLA)", "named_project", "{1}"),
    (r"(GREENBRIER\s+VILLAGE)", "named_project", "{1}"),
    (r"(SOUTH\s+RIVER\s+VILLAGE)", "named_project", "{1}"),
    (r"(AVOCADO\s+ROAD)", "named_project", "{1}"),
]


def density(text: Column) -> Column:
    """Dwellings per acre that a text says, else null; NaN is null."""
    number = text.try_cast("double")
    plain = F.when(~F.isnan(number), number)
    return F.coalesce(plain, F.regexp_extract(text, r"(?i)([\d.]+)\s*(?:du|dwelling)", 1).try_cast("double"))


def occurrences(text: Column, keyword: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(keyword), F.lit("")))) / len(keyword)).cast("int")


def bound(value: Column, use) -> Column:
    """use(value), with value computed once however often `use` takes it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def skip_reason(text: Column, most: int = 2_000_000) -> Column:
    """Why a text is not worth reading, else null."""
    return bound(F.btrim(text, F.lit(" \t\n\x0b\f\r")), lambda bare: _skip_reason(bare, most))


def _skip_reason(bare: Column, most: int) -> Column:
    sample = F.substring(bare, 1, 5000)
    letters = F.length(F.regexp_replace(sample, r"[^\p{L}\s]", "")) / F.greatest(F.length(sample), F.lit(1))
    lines = F.filter(F.slice(F.split(bare, "\n"), 1, 200), lambda x: F.trim(x) != "")
    average = F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(F.trim(x))) / F.greatest(F.size(lines), F.lit(1))
    listed = reduce(lambda a, b: a | b, [F.contains(F.lower(F.substring(bare, 1, 2000)), F.lit(k)) for k in ("salary schedule", "revised architectural plans", "plan set\n")])
    return (
        F.when(F.length(bare) < 100, "too_short").when(F.length(bare) > most, "oversized").when(letters < 0.2, "garbled_pdf")
        .when((average < 3) & (F.size(lines) > 50), "garbled_pdf").when(listed & (F.length(bare) > 200_000), "non_meeting_content")
    )


def relevance(text: Column, name: Column, procedural: list[str] | None = None, substantive: list[str] | None = None) -> Column:
    """struct(keep, confidence) by keyword counts in a head, middle and tail sample, and the file name."""
    procedural, substantive = procedural or PROCEDURAL, substantive or SUBSTANTIVE
    n = F.length(text)
    mid = F.floor(n / 2).cast("int")
    sample = F.lower(F.when(n > 24000, F.concat(F.substring(text, 1, 8000), F.substr(text, mid - 3999, F.lit(8000)), F.right(text, F.lit(8000)))).otherwise(F.substring(text, 1, 8000)))
    return bound(sample, lambda s: bound(_keyword_counts(s, procedural, substantive), lambda c: _relevance(text, n, F.lower(name), s, c)))


def _keyword_counts(sample: Column, procedural: list[str], substantive: list[str]) -> Column:
    """struct(hits, kinds) of substantive keywords and (hits_p, kinds_p) of procedural ones."""
    total = lambda words: reduce(lambda a, b: a + b, [occurrences(sample, w) for w in words])
    unique = lambda words: reduce(lambda a, b: a + b, [F.contains(sample, F.lit(w)).cast("int") for w in words])
    return F.struct(total(substantive).alias("hits"), unique(substantive).alias("kinds"), total(procedural).alias("hits_p"), unique(procedural).alias("kinds_p"))


def _relevance(text: Column, n: Column, name: Column, sample: Column, counts: Column) -> Column:
    per = F.greatest(n, F.lit(1)) / 1000
    hits, kinds = counts["hits"], counts["kinds"]
    dense, dense_p = hits / per, counts["hits_p"] / per
    voted = sample.rlike(r"(aye|yea|nay|yes|no)\s*[-:]\s*\d")
    minutes, agenda = F.contains(name, F.lit("minutes")), F.contains(name, F.lit("agenda"))
    verdict = lambda keep, c: F.struct(F.lit(keep).alias("keep"), (c if isinstance(c, Column) else F.lit(float(c))).alias("confidence"))
    return (
        F.when((F.length(F.btrim(text, F.lit(" \t\n\x0b\f\r"))) < 200) | name.rlike("|".join(SKIPPED_NAMES)), verdict(False, 0))
        .when(name.rlike("staff[-_]report") | voted, verdict(True, 0.9))
        .when((kinds == 0) & (counts["kinds_p"] >= 3), verdict(False, 0.05))
        .when((dense < 0.5) & (dense_p > dense * 3) & ~minutes, verdict(False, 0.1))
        .when((kinds >= 2) | sample.rlike(r"item\s+\d+") | agenda, verdict(True, F.least(F.lit(0.95), F.lit(0.3) + kinds * 0.05 + dense * 0.1)))
        .when(minutes & (kinds >= 1), verdict(True, 0.5))
        .when(hits > 0, verdict(True, 0.3))
        .otherwise(verdict(False, 0.1))
    )


def word_overlap(a: Column, b: Column, longer_than: int = 0) -> Column:
    """Distinct words that two strings share."""
    words = lambda c: F.filter(F.array_distinct(F.split(F.upper(c), r"\W+")), lambda w: F.length(w) > longer_than)
    return F.size(F.array_intersect(words(a), words(b)))
