"""Feature steps on a regular panel. All windows are keyed by segment, which is how
:func:`regularise` leaves the data, so none of them shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .panel import by_segment

DATE_FLAGS = ("month_number_in_year", "season_number", "year_number")


def log_target(df: DataFrame, base: float = 10, out_col: str = "target") -> DataFrame:
    """``log_base(target + 1)``. A negative target stops the job."""
    y = F.col("target").cast("double")
    logged = F.log10(y + 1) if base == 10 else F.log(y + 1) / F.log(F.lit(float(base)))
    negative = F.raise_error(F.lit("log of a negative target")).cast("double")
    return df.withColumn(out_col, F.when(y < 0, negative).otherwise(logged))


def unlog(c: Column | str, base: float = 10) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.pow(F.lit(float(base)), c) - 1


def add_holiday(
    df: DataFrame, holidays: DataFrame, iso_code: str = "RUS", out_col: str = "holiday"
) -> DataFrame:
    """1 when the row's date is in ``holidays(iso_code, date)`` for the country, else 0.

    A country's calendar is a few dozen days a year; Spark broadcasts it by its size.
    """
    days = (
        holidays.filter(F.col("iso_code") == iso_code)
        .select(F.col("date").cast("date").alias("_day"))
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    joined = df.join(days, F.col("timestamp").cast("date") == F.col("_day"), "left")
    return joined.withColumn(out_col, F.coalesce("_hit", F.lit(0))).drop("_day", "_hit")


def _date_flag(name: str) -> Column:
    ts = F.col("timestamp")
    weekday = F.weekday(ts)  # Monday is 0
    flags = {
        "day_number_in_week": weekday,
        "day_number_in_month": F.dayofmonth(ts),
        "day_number_in_year": F.dayofyear(ts),
        "week_number_in_month": F.floor(
            (F.dayofmonth(ts) - 1 + F.weekday(F.trunc(ts, "month"))) / 7
        ).cast("int") + 1,
        "week_number_in_year": F.weekofyear(ts),
        "month_number_in_year": F.month(ts),
        "season_number": F.floor((F.month(ts) % 12) / 3).cast("int") + 1,
        "year_number": F.year(ts),
        "is_weekend": (weekday >= 5).cast("int"),
    }
    if name not in flags:
        raise ValueError(f"unknown date flag {name!r}; known: {sorted(flags)}")
    return flags[name]


def add_date_flags(
    df: DataFrame, flags: Sequence[str] = DATE_FLAGS, prefix: str = "flag_"
) -> DataFrame:
    return df.withColumns({prefix + f: _date_flag(f) for f in flags})


def impute_seasonal(
    df: DataFrame, seasonality: int = 1, column: str = "target", by: Sequence[str] = ("segment",)
) -> DataFrame:
    """A missing value becomes the mean of all earlier observed values of its segment
    (of the same ``t_idx % seasonality`` phase). Before the first one it stays NULL."""
    w = W.partitionBy(
        *by, *([F.col("t_idx") % seasonality] if seasonality > 1 else [])
    ).orderBy("t_idx").rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(column, F.coalesce(F.col(column), F.avg(column).over(w)))


def dense_codes(keys: DataFrame, key: str, code: str) -> DataFrame:
    """0-based position of every distinct key in sorted order, with no global sort.

    A hash-ordered sample of keys, one for each shuffle partition, splits the key space into
    ranges; keys are numbered inside their range and shifted by the sizes of the ranges
    before. The sample depends on the keys alone, so a recomputed task gives the same codes.
    """
    cuts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    sample = (
        distinct.orderBy(F.xxhash64(key), key).limit(cuts)
        .agg(F.array_sort(F.collect_list(key))).scalar()
    )
    # The number of borders up to the key, found by halves: a step is taken if the border it
    # leads to exists and is not after the key.
    halves = [2**k for k in reversed(range(max(cuts, 1).bit_length()))]
    at_most = F.aggregate(
        F.array(*[F.lit(n) for n in halves]), F.lit(0),
        lambda at, n: at + F.when(F.get("_cuts", at + n - 1) <= F.col(key), n).otherwise(0),
    )
    ranged = distinct.withColumn("_cuts", sample).select(key, at_most.alias("_range"))
    # One row more than there are shuffle partitions at most, so the running sum over all of them is one small task.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        F.col("_range").alias("_range_no"),
        F.coalesce(
            F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = F.row_number().over(W.partitionBy("_range").orderBy(key)) - 1
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(before), F.col("_range") == F.col("_range_no"))
        .select(key, (F.col("_before") + F.col("_inside")).cast("bigint").alias(code))
    )


def encode_segment(df: DataFrame, out_col: str = "segment_code") -> DataFrame:
    """Integer code of the segment in sorted order, from 0."""
    return df.join(dense_codes(df, "segment", out_col), "segment", "left")


def add_lags(df: DataFrame, lags: Sequence[int], prefix: str = "target_lag") -> DataFrame:
    """Earlier targets of the segment as columns ``{prefix}_{lag}``."""
    by_time = by_segment().orderBy("t_idx")
    return df.withColumns({f"{prefix}_{k}": F.lag("target", k).over(by_time) for k in lags})


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_label") -> DataFrame:
    """Sorted-order integer code per column; missing values get no code (NULL)."""
    for c in cols:
        codes = dense_codes(df, c, c + suffix)
        df = df.join(codes, c, "left")
    return df


def one_hot(df: DataFrame, cols: Sequence[str], suffix: str = "_onehot") -> DataFrame:
    """Sparse indicator vector per column, one slot per category in sorted order and one
    more for missing values. Slots come from :func:`dense_codes`, so the category list is
    never gathered in one place; the encoder only learns the largest slot."""
    slots = [f"_{c}_slot" for c in cols]
    coded = label_encode(df, cols, "_slot_code")
    # Past every known slot: the encoder's extra slot for values it does not know.
    unknown = F.lit(float(2**31 - 1))
    coded = coded.withColumns(
        {s: F.coalesce(F.col(f"{c}_slot_code").cast("double"), unknown) for s, c in zip(slots, cols)}
    ).drop(*[f"{c}_slot_code" for c in cols])
    known = coded
    for s in slots:
        known = known.filter(F.col(s) != unknown)
    model = OneHotEncoder(
        inputCols=slots, outputCols=[c + suffix for c in cols], dropLast=False,
        handleInvalid="keep",
    ).fit(known)
    return model.transform(coded).drop(*slots)


def decompose(df: DataFrame, period: int) -> DataFrame:
    """Classical additive decomposition: ``trend``, ``seasonal``, ``resid`` columns.

    Trend is the centred moving average over one period (an even period weighs the two
    end points half), NULL where the window is cut off or has a gap. Seasonal is the mean
    detrended value of the phase ``t_idx % period``, shifted to average 0 over phases.
    """
    half = period // 2
    by_time = by_segment().orderBy("t_idx")
    inner = period - 1 if period % 2 == 0 else period
    reach = inner // 2
    core = by_time.rowsBetween(-reach, reach)
    total = F.when(F.count("target").over(core) == inner, F.sum("target").over(core))
    if period % 2 == 0:
        ends = F.lag("target", half).over(by_time) + F.lead("target", half).over(by_time)
        total = total + ends / 2
    trended = df.withColumn("trend", total / period)
    phase = W.partitionBy("segment", F.col("t_idx") % period)
    detrended = F.col("target") - F.col("trend")
    with_phase = trended.withColumn("_phase_mean", F.avg(detrended).over(phase))
    # Each phase counts once, whatever number of rows it has.
    phase_first = F.row_number().over(phase.orderBy("t_idx")) == 1
    centred = with_phase.withColumn(
        "_centre", F.when(phase_first, F.col("_phase_mean"))
    ).withColumn("_centre", F.avg("_centre").over(by_segment()))
    seasonal = F.col("_phase_mean") - F.col("_centre")
    return (
        centred.withColumn("seasonal", seasonal)
        .withColumn("resid", F.col("target") - F.col("trend") - F.col("seasonal"))
        .drop("_phase_mean", "_centre")
    )
