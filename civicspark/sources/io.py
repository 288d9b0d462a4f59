"""Sources and sinks of the library; only this module touches paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, agency_year: bool = True) -> DataFrame:
    """JSON lines with a fixed schema; bad lines go; agency and year come from .../agency=<agency>/year=<year>/ or .../<agency>/<...year>.jsonl."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)
    if not agency_year:
        return rows
    path = F.col("_metadata.file_path")
    return rows.select("*", _of_path(path, r"/agency=([^/]+)/", r"/([^/]+)/[^/]*$").alias("_agency"), _of_path(path, r"/year=(\d+)/", r"(\d{4})[^/]*$").try_cast("int").alias("_year"))


def _of_path(path: Column, folder: str, name: str) -> Column:
    return F.when(path.rlike(folder), F.url_decode(F.regexp_extract(path, folder, 1))).otherwise(F.regexp_extract(path, name, 1))


def read_json_arrays(spark: SparkSession, paths: list[str], schema: str | T.StructType, key: str) -> DataFrame:
    """JSON arrays of several files in order; the first record of a key wins."""
    parts = [spark.read.schema(schema).option("multiLine", True).json(p).withColumn("_file_rank", F.lit(k)) for k, p in enumerate(paths)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_file_rank"))
    return union.withColumn("_r", rank).where("_r = 1").drop("_r")


def read_texts(spark: SparkSession, paths: str) -> DataFrame:
    """(file_name, text) of whole text files."""
    return spark.read.text(paths, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("file_name"), F.col("value").alias("text"))


def map_rows(objects: DataFrame, json_col: str, value_schema: str) -> DataFrame:
    """(key, value) rows of JSON objects used as lookup tables."""
    parsed = F.from_json(F.col(json_col), f"map<string, {value_schema}>")
    return objects.select(F.explode(parsed).alias("key", "value"))


def tail_lines(rows: DataFrame, file_col: str, text_col: str, lines: int = 500) -> DataFrame:
    """The last lines of each log: (file, line_no, line)."""
    parts = F.split(F.col(text_col), "\n")
    return rows.select(file_col, F.size(parts).alias("n"), F.posexplode(parts).alias("line_no", "line")).where(F.col("line_no") >= F.col("n") - lines).drop("n")


def publish(df: DataFrame, path: str, types: dict[str, str] | None = None, partition_by: list[str] | None = None) -> None:
    """Typed snappy Parquet: named columns are cast, others are strings; with partition_by only the partitions in df are
    rewritten."""
    typed = df.select(*[F.col(c).cast((types or {}).get(c, "string" if c not in (partition_by or []) else df.schema[c].dataType.simpleString())).alias(c) for c in df.columns])
    writer = typed.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def publish_lines(df: DataFrame, path: str, *order: str) -> None:
    """Sorted JSON lines."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str, since: str) -> DataFrame:
    """Log rows from a moment on; lines that can't be read go."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.col("ts") >= F.lit(since))


def publish_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)



# The columns kept of the statewide housing filings, which of them are whole numbers and decimals, and the
# income columns that count as affordable; and the columns kept of the national table of housing credits.
FILING_FIELDS = [
    "YEAR", "PRIOR_APN", "APN", "STREET_ADDRESS", "PROJECT_NAME", "JURS_TRACKING_ID", "UNIT_CAT", "TENURE", "APP_SUBMIT_DT",
    "ACUTELY_LOW_INCOME_DR", "ACUTELY_LOW_INCOME_NDR", "EXTREMELY_LOW_INCOME_DR", "EXTREMELY_LOW_INCOME_NDR",
    "VLOW_INCOME_DR", "VLOW_INCOME_NDR", "LOW_INCOME_DR", "LOW_INCOME_NDR", "MOD_INCOME_DR", "MOD_INCOME_NDR", "ABOVE_MOD_INCOME",
    "TOT_PROPOSED_UNITS", "TOT_APPROVED_UNITS", "TOT_DISAPPROVED_UNITS", "APP_SUBMITTED_SB35", "DENSITY_BONUS_RECEIVED",
    "DENSITY_BONUS_APPROVED", "APPLICATION_STATUS", "PROJECT_TYPE", "NOTES", "LATITUDE", "LONGITUDE", "STD_ADDRESS",
]
AFFORDABLE_FIELDS = FILING_FIELDS[9:19]
FILING_NUMBERS = {**dict.fromkeys(FILING_FIELDS[9:23], "int"), "LATITUDE": "double", "LONGITUDE": "double"}
CREDIT_FIELDS = [
    "HUD_ID", "PROJECT", "PROJ_ADD", "PROJ_CTY", "PROJ_ST", "PROJ_ZIP", "LATITUDE", "LONGITUDE", "N_UNITS", "LI_UNITS", "YR_ALLOC",
    "YR_PIS", "CREDIT", "TYPE", "STATE_ID", "FIPS2010",
]
CREDIT_NUMBERS = {"LATITUDE": "double", "LONGITUDE": "double", **dict.fromkeys(["N_UNITS", "LI_UNITS", "YR_ALLOC", "YR_PIS"], "int")}


def _trimmed(name: str) -> Column:
    return F.btrim(F.coalesce(F.col(name), F.lit("")), F.lit(" \t\n\x0b\f\r"))


def _said(name: str, *values: str) -> Column:
    return F.upper(_trimmed(name)).isin(*values)


def read_filings(spark: SparkSession, path: str, jurisdiction: str) -> DataFrame:
    """The filings of one jurisdiction from the statewide CSV with header: FILING_FIELDS in lower case, trimmed; a bad
    whole number is 0, a bad decimal null, a missing text ''; apn without dashes; and affordable_units, the sum of the
    affordable income columns. The filter on JURIS_NAME is on trimmed upper case."""
    rows = spark.read.option("header", True).csv(path).where(_said("JURIS_NAME", jurisdiction))
    number = lambda c, kind: F.coalesce(_trimmed(c).try_cast("int"), F.lit(0)) if kind == "int" else _trimmed(c).try_cast(kind)
    out = rows.select(*[(number(c, FILING_NUMBERS[c]) if c in FILING_NUMBERS else _trimmed(c)).alias(c.lower()) for c in FILING_FIELDS])
    affordable = sum((F.col(c.lower()) for c in AFFORDABLE_FIELDS[1:]), F.col(AFFORDABLE_FIELDS[0].lower()))
    return out.withColumns({"apn": F.replace("apn", F.lit("-"), F.lit("")), "affordable_units": affordable})


def read_credits(spark: SparkSession, path: str, state: str, cities: list[str]) -> DataFrame:
    """Housing credit projects of a state's cities from the national table, a CSV with header: CREDIT_FIELDS in lower
    case, trimmed; a bad number is null, a missing text ''. Filters are on trimmed upper case, first the state."""
    rows = spark.read.option("header", True).csv(path).where(_said("PROJ_ST", state) & _said("PROJ_CTY", *cities))
    return rows.select(*[(_trimmed(c).try_cast(CREDIT_NUMBERS[c]) if c in CREDIT_NUMBERS else _trimmed(c)).alias(c.lower()) for c in CREDIT_FIELDS])
