"""Session settings and tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "civicspark") -> SparkSession:
    """A session for tests and benchmarks on one machine; on a cluster spark-submit gives these settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where it is unset, on one machine only, a new temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-civic-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """df dealt by columns over all the shuffle's parts, also where its files are few and its rows want much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: short lineage that survives lost executors.

    With columns `by` there is a folder for each of their values. The write's shuffle files go when it ends, not when the
    driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def reading(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """df, marked as a reader of these tables: drop_cut(df) removes them."""
    df._cut_tables = tables
    return df


def drop_cut(df: DataFrame | None) -> None:
    """Removes a table made by cut() that nothing reads any more, and those that df is marked as reading."""
    for table in getattr(df, "_cut_tables", ()):
        drop_cut(table)
    path = getattr(df, "_cut_path", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
