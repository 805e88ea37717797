"""Casts that are kept from run to run: only what rests on other data is cast again.

A recurrence forecast from an origin (its last training month) rests on the segment's months up
to the origin only, so it stays true whatever comes later. Casts are stored by origin, beside a
digest of those months. After new months the folds of the last run are those of this one, moved
on; after late rows only their segments, and only origins from their month on, are cast again.
Actual values are not stored with casts; they are read from the panel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import month_index, month_start
from ..params import parameter_table
from .recurrence import linear_forecast
from .specs import SeasonalMA

CASTS = "window int, season int, segment string, h int, yhat double, origin int"
DIGESTS = "segment string, origin int, first int, digest_a bigint, digest_b bigint, recast boolean"
_SAME = ("segment", "origin", "first", "digest_a", "digest_b")


def last_month(panel: DataFrame) -> int:
    """Month number of the panel's end; 0 for an empty panel. Pass a stored panel."""
    return panel.agg(F.max(month_index("timestamp"))).first()[0] or 0


def origin_digests(panel: DataFrame, ends: Sequence[tuple], last: int) -> DataFrame:
    """``segment, origin, first, digest_a, digest_b``: what casts from each origin rest on.

    The digests are two 64-bit sums (exclusive or) over a segment's observed months up to the
    origin, which merge in any order, so a segment is one row per task before it is shuffled.
    A monthly sum that differs in its last bit, added in another order, costs a cast, no more.
    ``first`` is the panel's first month where that is after the first month ahead, which decides
    the steps that have a panel row.
    """
    month = month_index("timestamp")
    seen = F.col("target").isNotNull()
    aggs = [F.min(month - F.col("t_idx")).alias("lo")]
    for i, (_, train_end, _) in enumerate(ends):
        known = seen & (F.col("from_end") >= train_end)
        for side, salt in (("a", 1), ("b", 2)):
            digest = F.bit_xor(F.when(known, F.xxhash64(F.lit(salt), month, F.col("target"))))
            aggs.append(F.coalesce(digest, F.lit(0)).alias(f"{side}{i}"))
    each = [
        F.struct(
            F.lit(last - train_end).alias("origin"),
            F.greatest("lo", F.lit(last - train_end + 1)).alias("first"),
            F.col(f"a{i}").alias("digest_a"), F.col(f"b{i}").alias("digest_b"),
        )
        for i, (_, train_end, _) in enumerate(ends)
    ]
    return panel.groupBy("segment").agg(*aggs).select("segment", F.inline(F.array(*each)))


def _among(pairs: Sequence[tuple[int, int]]) -> Column:
    each = [(F.col("window") == w) & (F.col("season") == s) for w, s in pairs]
    return reduce(lambda a, b: a | b, each)


def _cast(panel: DataFrame, pairs: Sequence[tuple[int, int]], horizon: int, end: tuple, origin: int) -> DataFrame:
    specs = [SeasonalMA(w, s) for w, s in pairs]
    names = parameter_table(
        panel.sparkSession, [(spec.name, *spec.recurrence) for spec in specs], ("model", "window", "season")
    )
    return linear_forecast(panel, specs, horizon, [end]).join(names, "model").select(
        "window", "season", "segment", "h", "yhat", F.lit(origin).alias("origin")
    )


def cast_origins(
    panel: DataFrame, specs: Sequence, horizon: int, ends: Sequence[tuple], folder: str,
    since: str | None = None,
) -> DataFrame:
    """Casts of all recurrence specs from the origins ``ends`` (see ``folds``; training from the
    first month on), stored in ``{folder}/casts``, their digests in ``{folder}/digests``.

    ``since`` is the folder of an earlier run, whose casts are taken over where the digest is
    the same; segments that are gone, or new, or have other months, are seen by it. Specs or
    steps that the earlier run did not cast are cast for all segments. Specs with the same
    recurrence share their casts. Pass a stored panel. To the driver come counts per origin
    and recurrence.
    """
    spark = panel.sparkSession
    last = last_month(panel)
    pairs = sorted({spec.recurrence for spec in specs})
    digests = origin_digests(panel, ends, last)
    have: dict[tuple[int, int, int], int] = {}
    if since is None:
        digests = digests.withColumn("recast", F.lit(True))
    else:
        origins = [last - train_end for _, train_end, _ in ends]
        casts = spark.read.schema(CASTS).parquet(f"{since}/casts").filter(F.col("origin").isin(origins))
        steps = casts.groupBy("window", "season", "origin").agg(F.max("h").alias("h"))
        have = {(r.window, r.season, r.origin): r.h for r in steps.collect()}
        before = spark.read.schema(DIGESTS).parquet(f"{since}/digests").select(*_SAME, F.lit(False).alias("recast"))
        digests = digests.join(before, list(_SAME), "left").withColumn("recast", F.coalesce("recast", F.lit(True)))
    digests.select(*_SAME, "recast").write.mode("overwrite").parquet(f"{folder}/digests")
    digests = spark.read.schema(DIGESTS).parquet(f"{folder}/digests")
    changed = {
        r.origin for r in digests.filter("recast").select("origin").distinct().collect()
    } if since else set()
    parts = []
    for end in ends:
        origin = last - end[1]
        here = digests.filter(F.col("origin") == origin)
        known = [p for p in pairs if have.get((*p, origin), 0) >= horizon]
        new = [p for p in pairs if p not in known]
        if new:
            parts.append(_cast(panel, new, horizon, end, origin))
        if known:
            kept = here.filter("NOT recast").select("segment")
            earlier = casts.filter((F.col("origin") == origin) & _among(known) & (F.col("h") <= horizon))
            parts.append(earlier.join(kept, "segment", "left_semi"))
        if known and origin in changed:
            again = panel.join(here.filter("recast").select("segment"), "segment", "left_semi")
            parts.append(_cast(again, known, horizon, end, origin))
    # A part is of one origin, so a task writes one file and nothing is shuffled for the layout.
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").partitionBy("origin").parquet(f"{folder}/casts")
    return spark.read.schema(CASTS).parquet(f"{folder}/casts")


def _per_model(rows: DataFrame, specs: Sequence, numbers: Sequence[int]) -> DataFrame:
    models = [(s.name, no, *s.recurrence) for s, no in zip(specs, numbers)]
    names = parameter_table(rows.sparkSession, models, ("model", "candidate_no", "window", "season"))
    return rows.join(names, ["window", "season"]).select(
        "model", "candidate_no", "fold", "segment", "h",
        month_start(F.col("origin") + F.col("h")).alias("timestamp"), "actual", "yhat",
    )


def cast_backtest(
    casts: DataFrame, panel: DataFrame, specs: Sequence, ends: Sequence[tuple],
    numbers: Sequence[int] | None = None,
) -> DataFrame:
    """The rows of ``forecasting.backtest`` for these specs and folds, from stored casts."""
    numbers = range(len(specs)) if numbers is None else numbers
    last = last_month(panel)
    folds = parameter_table(
        panel.sparkSession, [(fold, last - train_end) for fold, train_end, _ in ends], ("fold", "origin")
    )
    tested = panel.filter(F.col("from_end") < max(train_end for _, train_end, _ in ends)).select(
        "segment", month_index("timestamp").alias("month"), F.col("target").alias("actual")
    )
    due = casts.join(folds, "origin").withColumn("month", F.col("origin") + F.col("h"))
    return _per_model(due.join(tested, ["segment", "month"]), specs, numbers)


def cast_ahead(
    casts: DataFrame, panel: DataFrame, specs: Sequence, numbers: Sequence[int] | None = None
) -> DataFrame:
    """The rows of ``forecasting.forecast`` for these specs, from stored casts."""
    numbers = range(len(specs)) if numbers is None else numbers
    ahead = casts.filter(F.col("origin") == last_month(panel)).withColumns(
        {"fold": F.lit(0), "actual": F.lit(None).cast("double")}
    )
    return _per_model(ahead, specs, numbers)
