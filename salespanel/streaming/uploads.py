"""Uploads as a stream of dropped files, and a running monthly panel over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import PANDAS_NA, na_to_null
from ..operators.cleaning import clean_upload
from ..sources.tabular import read_upload


def upload_stream(
    spark: SparkSession, directory: str, columns: list[str], prop_schema: T.StructType,
    numeric: tuple[str, ...] = (), on_bad: str = "quarantine",
) -> DataFrame:
    """Cleaned rows of every ``|``-separated CSV dropped into ``directory``.

    A stream cannot look at all rows first, so the columns, which of them are numeric and
    the property keys are declared; the batch rule that drops empty columns is left out.
    """
    raw = (
        spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        .option("sep", "|").option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", True)
        .option("enforceSchema", False)  # a file whose header differs raises
        .csv(directory)
    )
    text = raw.select(*[na_to_null(F.col(f"`{c}`"), PANDAS_NA).alias(c) for c in columns])
    counts = {c: (1, 1 if c in numeric else 0) for c in columns}
    return clean_upload(text, on_bad, prop_schema, counts)


def stream_uploads(
    spark: SparkSession, directory: str, columns: list[str], prop_schema: T.StructType,
    out: str, checkpoint: str, numeric: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append what is new in ``directory`` to the Parquet table ``out`` and stop. The
    checkpoint makes each file count once over any number of runs."""
    cleaned = upload_stream(spark, directory, columns, prop_schema, numeric)
    return (
        cleaned.writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def stream_uploads_once(
    spark: SparkSession, directory: str, columns: list[str], prop_schema: T.StructType,
    out: str, checkpoint: str, numeric: tuple[str, ...] = (), within: str = "30 days",
    files_per_batch: int = 1000, on_bad: str = "quarantine",
) -> StreamingQuery:
    """As :func:`stream_uploads`, but a file whose content was uploaded before, under any name,
    is left out.

    The stream is one of files, not rows: a file's key is a digest of its bytes, and
    ``dropDuplicatesWithinWatermark`` remembers keys until files have come that were modified
    more than ``within`` later. Equal rows inside one file or in files that differ all count.
    Names of at most ``files_per_batch`` new files come to the driver, which reads them as one
    upload; a batch replaces its own folder ``out/batch=N``, so one that is run again after a
    failure counts once. A file's bytes are one value, at most 2 GB.
    """
    files = (
        spark.readStream.schema("path string, modificationTime timestamp, length long, content binary")
        .format("binaryFile").option("maxFilesPerTrigger", files_per_batch).load(directory)
        .select("path", "modificationTime", F.sha2("content", 256).alias("digest"))
        .withWatermark("modificationTime", within)
        .dropDuplicatesWithinWatermark(["digest"])
    )
    counts = {c: (1, 1 if c in numeric else 0) for c in columns}

    def read(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]
        if not paths:
            return
        raw = read_upload(spark, paths)
        if raw.columns != list(columns):
            raise ValueError(f"an upload has the columns {raw.columns}, not {list(columns)}")
        cleaned = clean_upload(raw, on_bad, prop_schema, counts)
        cleaned.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        files.writeStream.foreachBatch(read).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_monthly(rows: DataFrame, late: str = "1 day") -> DataFrame:
    """``segment, timestamp (month start), target``: sums per segment and month, each put
    out once, when its month has closed.

    Event time is the instant a row's month ends. A month closes when a finished batch
    has seen a row of a month that ends more than ``late`` after it; rows for a closed
    month are too late and are dropped. ``late='32 days'`` keeps one more month open;
    :func:`~salespanel.streaming.corrections.stream_monthly_corrected` puts out corrections.
    State holds the open months only.
    """
    month = F.trunc("timestamp", "month")
    closes = F.add_months(month, 1).cast("timestamp")
    return (
        rows.filter(F.col("segment").isNotNull() & F.col("timestamp").isNotNull())
        .select("segment", closes.alias("closes"), F.col("target").cast("double").alias("target"))
        .withWatermark("closes", late)
        .groupBy("segment", "closes")
        .agg(F.coalesce(F.sum("target"), F.lit(0.0)).alias("target"))
        .select(
            "segment",
            F.add_months(F.col("closes").cast("date"), -1).cast("timestamp_ntz").alias("timestamp"),
            "target",
        )
    )
