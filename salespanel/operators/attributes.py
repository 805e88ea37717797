"""What is known of a segment at a point in time, and target statistics of such values.

Attributes change. A model that is tested on past months must not see what became known later,
so values are looked up as of a row's time. Categories of any number become one column by the
mean target of their earlier rows; a row never sees its own target or a later one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Attributes:
    """``changes`` has ``segment, timestamp`` and the ``columns``: from that time on a segment
    has these values; missing ones say nothing. ``weight``: as how many rows the mean over all
    categories counts in a category's mean."""

    changes: DataFrame
    columns: tuple[str, ...]
    weight: float = 10.0

    def until(self, month) -> Attributes:
        """As they were known at the end of a month."""
        ends = F.add_months(F.trunc(F.lit(str(month)[:10]).cast("date"), "month"), 1)
        return replace(self, changes=self.changes.filter(F.col("timestamp") < ends))


def _latest(column: str, ts: str):
    """The last value of a column that is not missing; of one time the largest."""
    known = F.col(f"`{column}`").isNotNull()
    return F.max(F.when(known, F.struct(F.col(ts).alias("t"), F.col(f"`{column}`").alias("v"))))["v"]


def attributes_as_of(
    rows: DataFrame, changes: DataFrame, columns: Sequence[str], key: str = "segment", ts: str = "timestamp"
) -> DataFrame:
    """``rows`` with the last value of each column that ``changes`` gives at or before a row's
    time. Columns of the same name are replaced; rows without key or time get NULL.

    Changes and rows of one (key, month) are ordered by time together; what is known when a
    month begins comes from one row per key and month. So a key with very many rows is worked
    on month by month, in many tasks, and changes are summed before they are shuffled.
    """
    kept = [c for c in rows.columns if c not in columns]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    at, month = F.col(ts).cast("timestamp_ntz"), F.trunc("_at", "month")
    asked = rows.select(F.col(key).alias("_key"), at.alias("_at"), whole.alias("_row")).withColumn("_month", month)
    named = {c: f"_value_{i}" for i, c in enumerate(columns)}
    known = changes.select(
        F.col(key).alias("_key"), at.alias("_at"), *[F.col(f"`{c}`").alias(v) for c, v in named.items()]
    ).filter("_key IS NOT NULL AND _at IS NOT NULL")
    points = known.groupBy("_key", "_at").agg(*[F.max(v).alias(v) for v in named.values()]).withColumn("_month", month)

    timed = asked.filter("_key IS NOT NULL AND _at IS NOT NULL")
    closing = points.groupBy("_key", "_month").agg(*[_latest(v, "_at").alias(v) for v in named.values()])
    months = closing.unionByName(timed.select("_key", "_month").distinct(), allowMissingColumns=True)
    months = months.groupBy("_key", "_month").agg(*[F.max(v).alias(v) for v in named.values()])
    before = W.partitionBy("_key").orderBy("_month").rowsBetween(W.unboundedPreceding, -1)
    opening = months.select(
        "_key", "_month", *[F.last(v, ignorenulls=True).over(before).alias(f"{v}_then") for v in named.values()]
    )

    both = timed.withColumn("_asks", F.lit(1)).unionByName(
        points.withColumn("_asks", F.lit(0)), allowMissingColumns=True
    )
    so_far = W.partitionBy("_key", "_month").orderBy("_at", "_asks").rowsBetween(W.unboundedPreceding, 0)
    inside = both.withColumns({v: F.last(v, ignorenulls=True).over(so_far) for v in named.values()}).filter("_asks = 1")
    found = inside.join(opening, ["_key", "_month"], "left").select(
        "_row.*", *[F.coalesce(v, f"{v}_then").alias(c) for c, v in named.items()]
    )
    types = {f.name: f.dataType for f in changes.schema.fields}
    lost = asked.filter("_key IS NULL OR _at IS NULL").select(
        "_row.*", *[F.lit(None).cast(types[c]).alias(c) for c in columns]
    )
    return found.unionByName(lost)


def ordered_means(
    rows: DataFrame, column: str, out: str, y: str = "y", ts: str = "timestamp", weight: float = 10.0,
    first: float = 0.0,
) -> DataFrame:
    """``rows`` with ``out``: the mean of ``y`` over the rows of the same category at earlier
    times, drawn towards the mean over all rows at earlier times, which counts as ``weight``
    rows; ``first`` where there is no earlier row at all. Missing values are a category.

    Rows are summed per (category, time) before they are shuffled. The sums run along time per
    category, so no row's own target is in its mean, nor is another one of the same time."""
    sums = [F.count(y).alias("_n"), F.sum(y).alias("_total")]
    by = rows.groupBy(F.col(f"`{column}`").alias("_value"), F.col(ts).alias("_ts")).agg(*sums)
    earlier = W.partitionBy("_value").orderBy("_ts").rowsBetween(W.unboundedPreceding, -1)
    # one row per time, so the running sum over all categories is a small task
    overall = W.orderBy("_ts").rowsBetween(W.unboundedPreceding, -1)
    prior = rows.groupBy(F.col(ts).alias("_ts")).agg(*sums).select(
        F.col("_ts").alias("_prior_ts"),
        F.coalesce(F.sum("_total").over(overall) / F.nullif(F.sum("_n").over(overall), F.lit(0)), F.lit(first)).alias("_prior"),
    )
    means = by.withColumns(
        {"_n": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_total": F.coalesce(F.sum("_total").over(earlier), F.lit(0.0))}
    ).join(prior, F.col("_ts").eqNullSafe(F.col("_prior_ts")))
    means = means.select("_value", "_ts", smoothed(F.col("_n"), F.col("_total"), F.col("_prior"), weight).alias(out))
    kept = rows.drop(out)
    return kept.join(
        means, kept[column].eqNullSafe(means["_value"]) & kept[ts].eqNullSafe(means["_ts"]), "left"
    ).drop("_value", "_ts")


def smoothed(n, total, prior, weight: float):
    return F.when(n + F.lit(weight) > 0, (total + F.lit(weight) * prior) / (n + F.lit(weight))).otherwise(prior)


def category_sums(rows: DataFrame, columns: Sequence[str], y: str = "y") -> DataFrame:
    """``attribute, value, n, total``: count and sum of ``y`` per attribute and category (as
    text). Sums of different months or tables add up, see :func:`merged_sums`."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ]))
    return rows.select(F.col(y).alias("_y"), pairs.alias("of")).groupBy("of.attribute", "of.value").agg(
        F.count("_y").alias("n"), F.coalesce(F.sum("_y"), F.lit(0.0)).alias("total")
    )


def merged_sums(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy("attribute", "value").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def with_means(
    rows: DataFrame, sums: DataFrame, column: str, out: str, weight: float = 10.0, first: float = 0.0
) -> DataFrame:
    """``rows`` with the mean of their category as :func:`category_sums` has it: what
    :func:`ordered_means` would give a row later than all that were summed. A category that
    is new has the mean over all."""
    own = sums.filter(F.col("attribute") == column)
    prior = own.agg(F.coalesce(F.sum("total") / F.nullif(F.sum("n"), F.lit(0)), F.lit(first))).scalar()
    own = own.select(F.col("value").alias("_value"), F.lit(True).alias("_known"), "n", "total")
    own = own.withColumnsRenamed({"n": "_n", "total": "_total"})
    kept = rows.drop(out)
    n, total = F.coalesce("_n", F.lit(0)), F.coalesce("_total", F.lit(0.0))
    return (
        kept.join(own, kept[column].cast("string").eqNullSafe(own["_value"]), "left")
        .withColumn(out, smoothed(n, total, prior, weight)).drop("_value", "_known", "_n", "_total")
    )
