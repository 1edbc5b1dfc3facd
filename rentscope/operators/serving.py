"""Comparison, alert and budget views on top of offers, provider windows and forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.functions.scalars import settled_round
from rentscope.plans.recency import first_nonempty_tier, latest_capture

PRICE = "price_per_gpu_hr"

# List lengths of the views.
COMPARISON_ROWS = 20
MATRIX_ROWS = 12
BUDGET_ROWS = 10

# Alert thresholds.
MIN_SPREAD = 0.005
SPREAD_FACTOR = 1.5
SPREAD_FLOOR = 0.05
SPREAD_SHARE = 0.15

# GPUs shown when none is asked for, and providers of the matrix.
DEFAULT_FORECAST_GPUS = ["RTX_4090", "H100_SXM", "A100_40GB", "L40S"]
MATRIX_PROVIDERS = ["vast", "runpod", "spheron"]

# Price taken for a window without a median.
MISSING_MEDIAN = 9999.0

# Inclusive upper bounds of the volatility bands.
VOLATILITY_BANDS = [(0.05, "very low"), (0.15, "low"), (0.30, "medium"), (0.50, "high")]
TOP_BAND = "very high"

# Lowest availability percent of the green and yellow lights.
GREEN_FROM = 70
YELLOW_FROM = 40


def _current(offers: DataFrame, as_of: datetime | Column | None) -> DataFrame:
    """Priced offers of the first look-back that has any; 'now' defaults to the last capture."""
    priced = offers.filter(F.col(PRICE).isNotNull())
    now = latest_capture(offers) if as_of is None else as_of
    return first_nonempty_tier(priced, now)


def price_comparison(
    offers: DataFrame, as_of: datetime | Column | None = None, limit: int | None = COMPARISON_ROWS
) -> DataFrame:
    """Current prices per GPU as a map of providers, with the cheapest by average."""
    per_provider = (
        _current(offers, as_of)
        .groupBy("gpu_name", "provider")
        .agg(
            settled_round(F.min(PRICE), 4).alias("min_price"),
            settled_round(F.avg(PRICE), 4).alias("avg_price"),
            F.count("*").alias("offer_count"),
        )
    )
    # An average of 0 does not compete; a struct with a null price sorts first, so mask it out.
    competes = F.col("avg_price") != 0
    entry = F.struct("provider", F.struct("min_price", "avg_price", "offer_count"))
    compared = (
        per_provider.groupBy("gpu_name")
        .agg(
            F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("providers"),
            F.min(F.when(competes, F.struct("avg_price", "provider"))).alias("_best"),
            F.count("*").alias("provider_count"),
        )
        .filter(F.col("_best").isNotNull())
        .select(
            "gpu_name",
            "providers",
            F.col("_best.provider").alias("cheapest_provider"),
            F.col("_best.avg_price").alias("cheapest_price"),
            "provider_count",
        )
        .orderBy(F.desc("provider_count"), "gpu_name")
    )
    return compared if limit is None else compared.limit(limit)


def volatility_rollup(windows: DataFrame) -> DataFrame:
    """Average and largest volatility per GPU class with their bands, and its providers by median price."""
    volatility = F.coalesce("price_volatility", F.lit(0.0))
    listed = F.array_sort(F.collect_list(F.struct("price_per_gpu_hour_p50", "provider")))
    return (
        windows.groupBy("gpu_class")
        .agg(
            settled_round(F.avg(volatility), 4).alias("avg_volatility"),
            settled_round(F.max(volatility), 4).alias("max_volatility"),
            F.transform(listed, lambda e: e["provider"]).alias("providers"),
        )
        .withColumn("avg_band", volatility_band(F.col("avg_volatility")))
        .withColumn("max_band", volatility_band(F.col("max_volatility")))
        .orderBy(F.desc("avg_volatility"), "gpu_class")
    )


def forecast_lookup(forecasts: DataFrame, gpu: str | None = None) -> DataFrame:
    """Forecast rows of one GPU, or of the default ones."""
    return forecasts.filter(F.col("gpu_class").isin([gpu] if gpu else DEFAULT_FORECAST_GPUS))


def spread_alerts(
    offers: DataFrame, windows: DataFrame, as_of: datetime | Column | None = None
) -> DataFrame:
    """Price gaps between providers of a GPU, judged against the gap of their medians."""
    current = (
        _current(offers, as_of).groupBy("gpu_name", "provider").agg(F.min(PRICE).alias("price"))
    )
    gaps = (
        current.groupBy("gpu_name")
        .agg(
            F.count("*").alias("_n"),
            F.min(F.struct("price", "provider")).alias("_low"),
            F.max("price").alias("_high"),
            F.min(F.struct((-F.col("price")).alias("neg"), "provider")).alias("_top"),
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("provider", settled_round(F.col("price"), 4).alias("price"))))
            ).alias("prices"),
        )
        .withColumn("_gap", F.col("_high") - F.col("_low.price"))
        .filter((F.col("_n") >= 2) & (F.col("_gap") >= MIN_SPREAD))
    )
    median = F.coalesce("price_per_gpu_hour_p50", F.lit(0.0))
    usual = windows.groupBy(F.col("gpu_class").alias("gpu_name")).agg(
        F.count("*").alias("_known"), (F.max(median) - F.min(median)).alias("_usual_gap")
    )
    against_usual = (F.col("_gap") > F.col("_usual_gap") * SPREAD_FACTOR) & (F.col("_gap") > SPREAD_FLOOR)
    against_price = F.col("_gap") / F.col("_high") > SPREAD_SHARE
    return (
        gaps.join(usual, "gpu_name", "left")
        .select(
            "gpu_name",
            settled_round(F.col("_gap"), 4).alias("spread"),
            F.col("_low.provider").alias("cheapest_provider"),
            settled_round(F.col("_low.price"), 4).alias("cheapest_price"),
            F.col("_top.provider").alias("priciest_provider"),
            settled_round(F.col("_high"), 4).alias("priciest_price"),
            settled_round(F.col("_gap") * 100, 2).alias("savings_per_100h"),
            "prices",
            F.when(F.coalesce("_known", F.lit(0)) >= 2, against_usual).otherwise(against_price).alias("is_alert"),
        )
        .orderBy(F.desc("spread"), "gpu_name")
    )


def budget_options(windows: DataFrame, budget: float) -> DataFrame:
    """Windows whose median fits the budget, cheapest first."""
    median = F.coalesce("price_per_gpu_hour_p50", F.lit(MISSING_MEDIAN))
    return (
        windows.filter(median <= budget)
        .select(
            "provider",
            "gpu_class",
            median.alias("price_p50"),
            F.coalesce("price_per_gpu_hour_p10", median).alias("price_p10"),
            F.coalesce("availability_probability", F.lit(0.0)).alias("availability"),
            F.coalesce("price_volatility", F.lit(0.0)).alias("volatility"),
            settled_round(F.lit(budget) - median, 4).alias("savings_vs_budget"),
            F.coalesce("n_price_samples", F.lit(0)).alias("n_samples"),
        )
        .orderBy("price_p50", "gpu_class", "provider")
    )


def volatility_band(volatility: Column) -> Column:
    """Band of a volatility; upper bounds are inclusive and a missing value counts as 0."""
    v = F.coalesce(volatility, F.lit(0.0))
    return reduce(
        lambda rest, band: F.when(v <= band[0], band[1]).otherwise(rest),
        reversed(VOLATILITY_BANDS),
        F.lit(TOP_BAND),
    )


def budget_cost(
    windows: DataFrame, budget: float = 1.0, hours: int = 4, limit: int = BUDGET_ROWS
) -> DataFrame:
    """Cost of a job on the cheapest fitting windows, with how many more would fit."""
    options = budget_options(windows, budget)
    percent = F.floor(F.round(F.col("availability") * 100, 9) + 0.5)
    light = F.when(percent >= GREEN_FROM, "green").when(percent >= YELLOW_FROM, "yellow").otherwise("red")
    return (
        options.orderBy("price_p50", "gpu_class", "provider")
        .limit(limit)
        .select(
            "provider",
            "gpu_class",
            settled_round(F.col("price_p50"), 4).alias("price_p50"),
            settled_round(F.col("price_p50") * hours, 2).alias("total_cost"),
            percent.alias("availability_pct"),
            light.alias("availability_light"),
            settled_round(F.col("volatility"), 3).alias("volatility"),
            volatility_band(F.col("volatility")).alias("volatility_band"),
        )
        .withColumn(
            "more_options",
            F.greatest(options.agg(F.count("*")).scalar() - limit, F.lit(0).cast("bigint")),
        )
    )


def volatility_bands(windows: DataFrame) -> DataFrame:
    """Volatility band of each provider window."""
    return windows.select(
        "provider", "gpu_class", "price_volatility", volatility_band(F.col("price_volatility")).alias("volatility_band")
    )


def price_matrix(
    offers: DataFrame,
    as_of: datetime | Column | None = None,
    limit: int | None = MATRIX_ROWS,
    providers: Sequence[str] = MATRIX_PROVIDERS,
) -> DataFrame:
    """First rows of the comparison as a GPU x provider matrix; ties for the best are all marked."""
    wide = price_comparison(offers, as_of, limit)
    wide = wide.select(
        "gpu_name",
        "provider_count",
        *[F.try_element_at("providers", F.lit(p))["avg_price"].alias(p) for p in providers],
    )
    best = F.least(*providers) if len(providers) > 1 else F.col(providers[0])
    marks = [F.coalesce(F.col(p) == best, F.lit(False)).alias(f"{p}_best") for p in providers]
    return wide.select("gpu_name", "provider_count", *providers, *marks)


def forecast_series(forecasts: DataFrame, gpu: str) -> DataFrame:
    """Forecast points of one GPU per provider, in order of hours ahead."""
    point = F.struct(
        F.col("forecast_hours_ahead").alias("hours_ahead"),
        "forecast_timestamp",
        "price_forecast",
        "price_forecast_lower",
        "price_forecast_upper",
    )
    return (
        forecasts.filter(F.col("gpu_class") == gpu)
        .groupBy("provider")
        .agg(F.array_sort(F.collect_list(point)).alias("points"))
        .orderBy("provider")
    )
