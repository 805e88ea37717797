"""Small driver-made tables and lineage cuts."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    return str(value)


def parameter_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Driver-made rows as a table of literals. Spark knows its size and places the join; the
    types are those of the values, whatever the number of rows."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="salespanel-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder name under the checkpoint folder, for job-private tables."""
    return os.path.join(checkpoint_root(spark), f"{name}-{os.urandom(6).hex()}")


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """The result as a table in the checkpoint folder: computed once, safe from executor
    loss, and of a size Spark knows when it plans what reads it."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
