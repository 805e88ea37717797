"""Python over batches of rows, spread out by Spark's partitions."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


PART_BYTES = 2 << 20  # of a batch that are worked on, and handed on, at a time


def parts(batch: pa.RecordBatch, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in order, as batches of at most `most` bytes or one row. Batches are
    cut by rows where they come from, so one of long texts may hold hundreds of megabytes."""
    if batch.num_rows < 2 or batch.nbytes <= most:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from parts(batch.slice(0, half), most)
    yield from parts(batch.slice(half), most)


def hand_back() -> None:
    """Free memory goes back to the system: a worker that waits for its next task would keep
    what the last one took, beside the memory of the executor itself."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: StructType) -> DataFrame:
    """`fn` on every batch, by parts of bounded size; it keeps nothing between them."""

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                yield fn(part)
            del batch
        hand_back()

    return df.mapInArrow(run, schema)


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns under names that no operator uses, and these names by column."""
    names = {c: f"_held_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def with_columns(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict], added: str, without: tuple[str, ...] = ()
) -> DataFrame:
    """The rows with the columns that `fn` makes of each batch, and without some that only `fn`
    needs. A column of the input that is called like a new one is replaced."""
    new = StructType.fromDDL(added)
    kept = [f for f in df.schema.fields if f.name not in new.names and f.name not in without]
    schema = StructType(kept + new.fields)
    arrow, names = to_arrow_schema(schema), [f.name for f in kept]

    def one(batch):
        made = fn(batch)
        old = [batch.column(batch.schema.get_field_index(c)).cast(arrow.field(c).type) for c in names]
        return pa.RecordBatch.from_arrays(
            old + [pa.array(made[f.name], arrow.field(f.name).type) for f in new.fields], schema=arrow
        )

    return map_batches(df, one, schema)


def to_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Only the columns that `fn` makes of each batch, which may be more or fewer rows."""
    made = StructType.fromDDL(schema)
    arrow = to_arrow_schema(made)

    def one(batch):
        columns = fn(batch)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], arrow.field(f.name).type) for f in made.fields], schema=arrow
        )

    return map_batches(df, one, made)
