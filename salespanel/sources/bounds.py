"""First and last time of every file of a Parquet table, kept beside it.

Spark pushes no condition on TIMESTAMP_NTZ to Parquet, and footers are read only when a scan has
begun. With this table a read picks its files before: a trailing window of a table that is laid
out by time opens the last few files, and finding the last time opens none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Inside the table; readers skip folders that begin with an underscore.
FOLDER = "_bounds"
SCHEMA = "file string, first timestamp_ntz, last timestamp_ntz, n long"


def _bounds_of(files: DataFrame, ts: str) -> DataFrame:
    at = F.col(f"`{ts}`").cast("timestamp_ntz")
    return files.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n")
    )


def write_by_time(
    df: DataFrame, path: str, ts: str = "timestamp", files: int | None = None, mode: str = "errorifexists"
) -> None:
    """A Parquet table whose files hold ranges of time, and its bounds. Without ``files`` Spark
    makes as many as the size asks for. A time with very many rows is divided: rows of one
    time are told apart by a hash of all their columns."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranged = df.repartitionByRange(*([files] if files else []), F.col(f"`{ts}`"), whole)
    ranged.write.mode(mode).parquet(path)
    spark = df.sparkSession
    _bounds_of(spark.read.parquet(path), ts).coalesce(1).write.mode("overwrite").parquet(f"{path}/{FOLDER}")


def file_bounds(spark: SparkSession, path: str, ts: str = "timestamp") -> DataFrame:
    """``file, first, last, n`` of the files that are there. Files that were added without
    bounds are read for them, bounds of files that are gone are left out."""
    there = {f.rsplit("/", 1)[-1]: f for f in spark.read.parquet(path).inputFiles()}
    stored = spark.read.schema(SCHEMA).parquet(f"{path}/{FOLDER}")
    known = {r["file"] for r in stored.select("file").collect()}
    names = spark.createDataFrame([(f,) for f in sorted(there)], "file string")
    bounds = stored.join(names, "file", "left_semi")
    new = [there[f] for f in sorted(there.keys() - known)]
    return bounds.unionByName(_bounds_of(spark.read.parquet(*new), ts)) if new else bounds


def read_trailing(spark: SparkSession, path: str, ts: str = "timestamp", days: int = 123) -> DataFrame:
    """The rows from ``days`` days before the latest time on, both ends included, from those
    files only that hold any. Their names come to the driver, which lists files anyway.
    The table is flat: no partition folders."""
    bounds = file_bounds(spark, path, ts)
    cutoff = bounds.agg((F.max("last") - F.expr(f"INTERVAL '{int(days)}' DAY")).cast("string")).first()[0]
    every = spark.read.parquet(path)
    if cutoff is None:
        return every.limit(0)
    since = F.lit(cutoff).cast("timestamp_ntz")
    wanted = {r["file"] for r in bounds.filter(F.col("last") >= since).select("file").collect()}
    files = [f for f in every.inputFiles() if f.rsplit("/", 1)[-1] in wanted]
    rows = spark.read.schema(every.schema).parquet(*files)
    return rows.filter(F.col(f"`{ts}`") >= since)
