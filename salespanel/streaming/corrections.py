"""Monthly sums of a stream that are put right when late rows come in.

A month's sum is put out when the month has closed. A row that comes later is added to the
kept sum, and the new sum is put out with the next revision number. The sum with the highest
revision is the one of all rows so far.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

# Workers get the processor by value and need none of these files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTIAL = "segment string, closes timestamp, closes_ms long, target double"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of what a task reads, so that a hot month is few rows when it is shuffled."""
    for batch in batches:
        if batch.num_rows:
            sums = pa.Table.from_batches([batch]).group_by(["segment", "closes", "closes_ms"]).aggregate([("target", "sum")])
            sums = sums.rename_columns(["segment", "closes", "closes_ms", "target"])
            total = pc.fill_null(sums.column("target"), 0.0)
            yield from sums.set_column(3, "target", total).to_batches()


class MonthSums(StatefulProcessor):
    """One month of one segment: its sum and how often it was put out.

    The watermark trails the latest month by ``keep`` days, as rows are taken for so long. A
    month closes ``late`` days after its end; the timer for that is set back by ``keep``.
    """

    def __init__(self, late: int, keep: int):
        self.late, self.keep = late, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "total double, revision int")

    def handleInputRows(self, key, rows, timerValues):
        total, revision = self.sums.get() if self.sums.exists() else (0.0, None)
        for row in rows:
            total += row.target
        if revision is None:
            revision = 0
            self.handle.registerTimer(key[1] + (self.late - self.keep) * DAY_MS)
        elif revision:
            revision += 1
            yield Row(segment=key[0], closes_ms=key[1], target=total, revision=revision)
        self.sums.update((total, revision))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        total, revision = self.sums.get()
        if revision:
            self.sums.clear()  # later rows are behind the watermark
            return
        self.sums.update((total, 1))
        self.handle.registerTimer(key[1] + 1)
        yield Row(segment=key[0], closes_ms=key[1], target=total, revision=1)

    def close(self) -> None:
        pass


def stream_monthly_corrected(rows: DataFrame, late: int = 1, keep: int = 400) -> DataFrame:
    """``segment, timestamp (month start), target, revision`` of a stream of rows (``segment,
    timestamp, target``).

    A month is put out when a finished batch has seen a month that ends more than ``late`` days
    after it, and again, with the next revision, for every batch that brings rows for it.
    Rows are lost only if they come when months have been seen that end ``keep`` days after
    theirs; until then state holds one sum per segment and month. Rows without a segment or a
    time are left out; a missing target adds nothing. Needs the RocksDB state store, see
    :func:`run_monthly_corrected`.
    """
    if not 0 <= late < keep:
        raise ValueError("a month has to close before it is forgotten")
    closes = F.add_months(F.trunc("timestamp", "month"), 1).cast("timestamp")
    partial = (
        rows.filter(F.col("segment").isNotNull() & F.col("timestamp").isNotNull())
        .select("segment", closes.alias("closes"), F.col("target").cast("double").alias("target"))
        .select("segment", "closes", F.unix_millis("closes").alias("closes_ms"), "target")
        .mapInArrow(_summed, PARTIAL)
    )
    put_out = (
        partial.withWatermark("closes", f"{keep} days")
        .groupBy("segment", "closes_ms")
        .transformWithState(
            MonthSums(late, keep), "segment string, closes_ms long, target double, revision int", "Append", "EventTime"
        )
    )
    month = F.add_months(F.timestamp_millis("closes_ms").cast("date"), -1)
    return put_out.select("segment", month.cast("timestamp_ntz").alias("timestamp"), "target", "revision")


def run_monthly_corrected(
    rows: DataFrame, out: str, checkpoint: str, late: int = 1, keep: int = 400
) -> StreamingQuery:
    """Append what is new to the Parquet table ``out`` and stop. Timers and sums are in the
    checkpoint, so another run goes on where this one ends."""
    spark = rows.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)  # a query keeps the settings it starts with
    try:
        return (
            stream_monthly_corrected(rows, late, keep).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def latest_revisions(put_out: DataFrame) -> DataFrame:
    """``segment, timestamp, target``: the sums as they are after all corrections."""
    return put_out.groupBy("segment", "timestamp").agg(F.max_by("target", "revision").alias("target"))
