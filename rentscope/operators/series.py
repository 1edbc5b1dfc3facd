"""Hourly series per provider and GPU: features, decomposition, availability, spreads.

Bucketing to hours comes first and is combined map-side, so a series never holds more rows
than there are hours in the covered calendar span; windows per series stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.functions.scalars import hour_of, settled_round

SERIES = ["provider", "gpu_name"]
PRICE = "price_per_gpu_hr"

# Feature order of the model.
FEATURES = [
    "t",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "price_lag_1h",
    "price_lag_6h",
    "price_lag_24h",
    "price_lag_168h",
    "rolling_mean_24h",
    "rolling_std_24h",
    "rolling_mean_7d",
    "offer_count",
    "offer_count_lag_1h",
]

# Rows looked back, and rows needed, per feature family.
DAY, WEEK = 24, 168
LAGS = [1, 6, 24, 168]
MIN_DAY_ROWS, MIN_WEEK_ROWS = 6, 24

# Widest and narrowest trend window, and rows per step of width.
MAX_TREND, MIN_TREND, ROWS_PER_WIDTH = 6, 2, 4
MIN_DECOMPOSE_ROWS = 4
TINY = 1e-9

# Availability outlook.
OUTLOOK_HOURS, RECENT_ROWS, MIN_OUTLOOK_ROWS = 6, 6, 3
HOUR_MEAN_WEIGHT, RECENT_WEIGHT = 0.7, 0.3

# Spread analysis.
SPREAD_PROVIDERS = ["vast", "runpod", "spheron"]
MIN_SPREAD_PROVIDERS, MIN_SPREAD_HOURS, SPREAD_FACTOR = 2, 4, 1.5


def hourly_series(offers: DataFrame) -> DataFrame:
    """Lowest positive price and number of offers per hour, provider and GPU."""
    return (
        offers.filter(F.col(PRICE) > 0)
        .groupBy(hour_of(offers, "captured_at").alias("captured_at"), *SERIES)
        .agg(F.min(PRICE).alias("price"), F.count("*").alias("offer_count"))
    )


def align_supply(prices: DataFrame, counts: DataFrame) -> DataFrame:
    """Offer counts on the hours of the prices: last known count, 0 before the first.

    Needed only when the two come from different tables; ``hourly_series`` is aligned already.
    """
    so_far = _in_time().rowsBetween(W.unboundedPreceding, 0)
    known = F.last("offer_count", ignorenulls=True).over(so_far)
    return (
        prices.select("captured_at", *SERIES, "price")
        .join(counts.select("captured_at", *SERIES, "offer_count"), ["captured_at", *SERIES], "left")
        .select("captured_at", *SERIES, "price", F.coalesce(known, F.lit(0)).alias("offer_count"))
    )


def _in_time() -> W:
    return W.partitionBy(*SERIES).orderBy("captured_at")


def _cycle(c: Column, period: int, wave) -> Column:
    return wave(c * F.lit(2 * math.pi) / F.lit(period))


def price_features(hourly: DataFrame) -> DataFrame:
    """The model's features; each sees only rows before its own, but for the offer count."""
    in_time = _in_time()
    day = in_time.rowsBetween(-DAY, -1)
    week = in_time.rowsBetween(-WEEK, -1)
    hour, weekday = F.hour("captured_at"), F.weekday("captured_at")

    def enough(c: Column, over, least: int) -> Column:
        return F.when(F.count("price").over(over) >= least, c.over(over))

    lags = [F.lag("price", k).over(in_time).alias(f"price_lag_{k}h") for k in LAGS]
    features = hourly.select(
        "captured_at",
        *SERIES,
        "price",
        (F.row_number().over(in_time) - 1).cast("double").alias("t"),
        _cycle(hour, 24, F.sin).alias("hour_sin"),
        _cycle(hour, 24, F.cos).alias("hour_cos"),
        _cycle(weekday, 7, F.sin).alias("dow_sin"),
        _cycle(weekday, 7, F.cos).alias("dow_cos"),
        *lags,
        enough(F.avg("price"), day, MIN_DAY_ROWS).alias("rolling_mean_24h"),
        F.coalesce(enough(F.stddev_samp("price"), day, MIN_DAY_ROWS), F.lit(0.0)).alias("rolling_std_24h"),
        enough(F.avg("price"), week, MIN_WEEK_ROWS).alias("rolling_mean_7d"),
        F.col("offer_count").cast("double").alias("offer_count"),
        F.lag("offer_count").over(in_time).cast("double").alias("offer_count_lag_1h"),
    )
    return features.select("captured_at", *SERIES, "price", *FEATURES)


def training_rows(hourly: DataFrame) -> DataFrame:
    """Number of rows with every feature, per series."""
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in FEATURES])
    return price_features(hourly).groupBy(*SERIES).agg(F.count_if(complete).alias("training_rows"))


def decompose(hourly: DataFrame) -> DataFrame:
    """Trend, seasonal and noise parts of each point.

    The trend window depends on the series length, so all possible widths are computed over
    one sort and the right one is picked per series.
    """
    in_time = _in_time()
    series = W.partitionBy(*SERIES)
    width = F.least(F.lit(MAX_TREND), F.greatest(F.lit(MIN_TREND), F.floor(F.col("_n") / ROWS_PER_WIDTH)))
    trend = F.lit(None).cast("double")
    for w in range(MIN_TREND, MAX_TREND + 1):
        ahead = (w - 1) // 2
        trend = F.when(width == w, F.avg("price").over(in_time.rowsBetween(ahead - (w - 1), ahead))).otherwise(trend)
    return (
        hourly.filter(F.col("price").isNotNull())
        .select(
            "captured_at",
            *SERIES,
            "price",
            F.count("*").over(series).alias("_n"),
            (F.row_number().over(in_time) - 1).alias("_i"),
        )
        .withColumn("trend", trend)
        .withColumn("_detrended", F.col("price") - F.col("trend"))
        .withColumn("seasonal", F.avg("_detrended").over(W.partitionBy(*SERIES, F.hour("captured_at"))))
        .withColumn("noise", F.col("_detrended") - F.col("seasonal"))
    )


def decompose_points(hourly: DataFrame) -> DataFrame:
    """The components per hour."""
    return decompose(hourly).select("captured_at", *SERIES, "price", "trend", "seasonal", "noise")


def decompose_summary(hourly: DataFrame, min_rows: int = MIN_DECOMPOSE_ROWS) -> DataFrame:
    """Trend slope per row, seasonal strength and noise deviation of each series."""
    detrended = F.stddev_samp("_detrended")
    base = F.when(detrended == 0, F.lit(TINY)).otherwise(detrended)
    return (
        decompose(hourly)
        .groupBy(*SERIES)
        .agg(
            F.count("*").alias("_rows"),
            F.regr_slope("trend", "_i").alias("trend_slope"),
            F.least(F.lit(1.0), F.stddev_samp("seasonal") / base).alias("seasonal_strength"),
            F.stddev_samp("noise").alias("noise_std"),
        )
        .filter(F.col("_rows") >= min_rows)
        .drop("_rows")
    )


def availability_6h(hourly: DataFrame) -> DataFrame:
    """Expected offers in the next six hours: hour-of-day mean blended with the last rows."""
    recent = W.partitionBy(*SERIES).orderBy(F.desc("captured_at"))
    rank = F.row_number().over(recent)
    by_hour = (
        hourly.withColumn("_recent", rank <= RECENT_ROWS)
        .groupBy(*SERIES, F.hour("captured_at").alias("_hour"))
        .agg(
            F.max("captured_at").alias("_last"),
            F.count("*").alias("_rows"),
            F.sum("offer_count").alias("_sum"),
            F.count_if("_recent").alias("_recent_rows"),
            F.coalesce(F.sum(F.when(F.col("_recent"), F.col("offer_count"))), F.lit(0)).alias("_recent_sum"),
        )
    )
    # At most 24 entries per series.
    profile = F.map_from_entries(F.collect_list(F.struct("_hour", F.col("_sum") / F.col("_rows"))))
    per_series = (
        by_hour.groupBy(*SERIES)
        .agg(
            profile.alias("_profile"),
            F.max("_last").alias("_last"),
            F.sum("_rows").alias("_n"),
            (F.sum("_sum") / F.sum("_rows")).alias("_mean"),
            (F.sum("_recent_sum") / F.sum("_recent_rows")).alias("_recent"),
        )
        .filter(F.col("_n") >= MIN_OUTLOOK_ROWS)
    )
    ahead = per_series.select("*", F.explode(F.sequence(F.lit(1), F.lit(OUTLOOK_HOURS))).alias("hours_ahead"))
    stamp = F.col("_last") + F.make_dt_interval(hours=F.col("hours_ahead"))
    expected = F.coalesce(F.try_element_at("_profile", F.hour(stamp)), F.col("_mean"))
    return ahead.select(
        *SERIES,
        "hours_ahead",
        stamp.alias("timestamp"),
        settled_round(HOUR_MEAN_WEIGHT * expected + RECENT_WEIGHT * F.col("_recent"), 1).alias("predicted_offers"),
    )


def spread_analysis(hourly: DataFrame, providers: Sequence[str] | None = SPREAD_PROVIDERS) -> DataFrame:
    """Hourly price gap between providers per GPU; flags a latest gap far above its mean.

    ``providers`` are those compared; None compares all that occur.
    """
    entry = F.struct("provider", settled_round(F.col("price"), 4).alias("price"))
    per_hour = (
        (hourly if providers is None else hourly.filter(F.col("provider").isin(list(providers))))
        .groupBy("gpu_name", "captured_at")
        .agg(
            (F.max("price") - F.min("price")).alias("_gap"),
            F.min(F.struct("price", "provider"))["provider"].alias("_cheapest"),
            F.min(F.struct((-F.col("price")).alias("neg"), "provider"))["provider"].alias("_dearest"),
            F.array_sort(F.collect_list(entry)).alias("_prices"),
        )
    )
    # One entry per provider of an hour, so the sets and lists are tiny.
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("_prices", lambda e: e["provider"])))))
    latest = F.max_by(F.struct("_gap", "_cheapest", "_dearest", "_prices"), "captured_at")
    per_gpu = per_hour.groupBy("gpu_name").agg(
        seen.alias("_seen"),
        F.count("*").alias("_hours"),
        F.avg("_gap").alias("_mean"),
        F.stddev_samp("_gap").alias("_std"),
        latest.alias("_latest"),
    )
    threshold = F.col("_mean") * SPREAD_FACTOR
    return (
        per_gpu.filter((F.size("_seen") >= MIN_SPREAD_PROVIDERS) & (F.col("_hours") >= MIN_SPREAD_HOURS))
        .select(
            "gpu_name",
            F.col("_seen").alias("providers_compared"),
            settled_round(F.col("_latest._gap"), 4).alias("latest_spread"),
            settled_round(F.col("_mean"), 4).alias("hist_avg_spread"),
            settled_round(F.col("_std"), 4).alias("hist_std_spread"),
            settled_round(threshold, 4).alias("threshold_1_5x"),
            (F.col("_latest._gap") > threshold).alias("spread_alert"),
            F.col("_latest._cheapest").alias("cheapest_provider"),
            F.col("_latest._dearest").alias("most_expensive_provider"),
            F.map_from_entries("_latest._prices").alias("latest_prices"),
        )
        .orderBy(F.desc("latest_spread"), "gpu_name")
    )


def series_overview(hourly: DataFrame) -> DataFrame:
    """Hourly rows, GPUs, providers and covered dates."""
    per_series = hourly.groupBy(*SERIES).agg(
        F.count("*").alias("rows"), F.min("captured_at").alias("first"), F.max("captured_at").alias("last")
    )
    return per_series.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.countDistinct("gpu_name").alias("gpu_classes"),
        F.countDistinct("provider").alias("providers"),
        F.to_date(F.min("first")).alias("since"),
        F.to_date(F.max("last")).alias("latest"),
    )


def of_gpu(hourly: DataFrame, gpu: str, provider: str | None = None) -> DataFrame:
    """One GPU's series; the filter is on the window keys, so it moves below the windows."""
    picked = hourly.filter(F.col("gpu_name") == gpu)
    return picked if provider is None else picked.filter(F.col("provider") == provider)
