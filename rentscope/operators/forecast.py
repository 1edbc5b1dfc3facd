"""24-hour price forecasts: ridge regression on lag features, walked forward hour by hour.

Features and the sums the regression needs are Spark aggregates. Python sees one row per
series (sums, the last week of prices, the last offer counts), solves a 14 x 14 system for a
whole Arrow batch of series at once and walks 24 steps.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.functions.scalars import settled_round
from rentscope.operators.series import (
    DAY,
    FEATURES,
    SERIES,
    TINY,
    WEEK,
    availability_6h,
    decompose_summary,
    price_features,
)

# The solver travels with the job: Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ridge penalty, horizon, band width and the rows a series needs.
ALPHA = 1.0
HORIZON = 24
BAND = 1.96
MIN_ROWS, MIN_TRAINING_ROWS = 30, 10
TOP_FEATURES = 3

K = len(FEATURES)
PAIRS = [(i, j) for i in range(K) for j in range(i, K)]

# Columns handed to the solver, next to the series key.
MODEL_COLUMNS = [
    "n", "rows", "price_level", "offer_level", "x", "y", "xx", "xy", "yy", "buffer", "offers_last", "offers_before",
    "hour", "weekday",
]
PRICE_FEATURES = [n for n in FEATURES if n.startswith("price_lag") or n.startswith("rolling_mean")]
OFFER_FEATURES = [n for n in FEATURES if n.startswith("offer_count")]
MODEL_SCHEMA = """
    provider STRING, gpu_name STRING, last_hour TIMESTAMP, n_train BIGINT, resid_std DOUBLE,
    forecast ARRAY<DOUBLE>, importance ARRAY<DOUBLE>
"""


def _sufficient_statistics(hourly: DataFrame) -> DataFrame:
    """One row per series with sums over its complete rows and the seed of the walk.

    Prices and offer counts are taken relative to their series mean, and t to its middle:
    sums of squares of the raw values would lose the digits that matter.
    """
    series = W.partitionBy(*SERIES)
    rows = price_features(hourly.filter(F.col("price").isNotNull())).select(
        "*",
        F.count("*").over(series).alias("rows"),
        F.avg("price").over(series).alias("price_level"),
        F.avg("offer_count").over(series).alias("offer_level"),
    )
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in FEATURES])

    def relative(name: str) -> Column:
        if name == "t":
            return F.col("t") - F.col("rows") / 2
        if name in OFFER_FEATURES:
            return F.col(name) - F.col("offer_level")
        return F.col(name) - F.col("price_level") if name in [*PRICE_FEATURES, "price"] else F.col(name)

    rows = rows.withColumn("ok", complete)
    rows = rows.select(
        *SERIES, "captured_at", "price", "t", "offer_count", "rows", "price_level", "offer_level", "ok",
        *[F.when(F.col("ok"), relative(n)).alias(f"r_{n}") for n in [*FEATURES, "price"]],
    )

    def product(a: str, b: str) -> Column:
        return F.sum(F.col(f"r_{a}") * F.col(f"r_{b}"))

    last_week = F.when(F.col("t") >= F.col("rows") - WEEK, F.struct("t", "price"))
    offers_at = lambda back: F.max(F.when(F.col("t") == F.col("rows") - back, F.col("offer_count")))
    return (
        rows.groupBy(*SERIES, "rows", "price_level", "offer_level")
        .agg(
            F.max("captured_at").cast("timestamp").alias("last_hour"),
            F.count_if("ok").alias("n"),
            F.array(*[F.sum(f"r_{n}") for n in FEATURES]).alias("x"),
            F.sum("r_price").alias("y"),
            F.array(*[product(FEATURES[i], FEATURES[j]) for i, j in PAIRS]).alias("xx"),
            F.array(*[product(n, "price") for n in FEATURES]).alias("xy"),
            product("price", "price").alias("yy"),
            F.transform(F.array_sort(F.collect_list(last_week)), lambda e: e["price"]).alias("buffer"),
            offers_at(1).alias("offers_last"),
            offers_at(2).alias("offers_before"),
        )
        .filter((F.col("rows") >= MIN_ROWS) & (F.col("n") >= MIN_TRAINING_ROWS))
        .withColumn("hour", F.hour("last_hour"))
        .withColumn("weekday", F.weekday("last_hour"))
        .select(*SERIES, "last_hour", *MODEL_COLUMNS)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float)


def _levels(batch: pd.DataFrame) -> np.ndarray:
    """What was subtracted from each feature."""
    levels = {"t": batch["rows"] / 2}
    levels.update({n: batch["price_level"] for n in PRICE_FEATURES})
    levels.update({n: batch["offer_level"] for n in OFFER_FEATURES})
    zero = np.zeros(len(batch))
    return np.column_stack([levels.get(n, zero) for n in FEATURES]).astype(float)


def _fit(batch: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Feature means and scales, price mean, weights and residual deviation of each series."""
    n = batch["n"].to_numpy(float)
    x, y = _matrix(batch["x"]) / n[:, None], batch["y"].to_numpy(float) / n
    gram = np.zeros((len(batch), K, K))
    upper = _matrix(batch["xx"])
    for column, (i, j) in enumerate(PAIRS):
        gram[:, i, j] = gram[:, j, i] = upper[:, column]
    gram -= n[:, None, None] * x[:, :, None] * x[:, None, :]
    target = _matrix(batch["xy"]) - (n * y)[:, None] * x
    total = batch["yy"].to_numpy(float) - n * y * y
    mean = x + _levels(batch)
    variance = np.maximum(np.einsum("bii->bi", gram) / n[:, None], 0.0)
    eps = np.finfo(float).eps
    constant = variance <= n[:, None] * eps * variance + (n[:, None] * mean * eps) ** 2
    scale = np.where(constant, 1.0, np.sqrt(np.where(constant, 1.0, variance)))
    z_gram = gram / scale[:, :, None] / scale[:, None, :]
    z_target = target / scale
    weights = np.linalg.solve(z_gram + ALPHA * np.eye(K), z_target[:, :, None])[:, :, 0]
    explained = 2 * np.einsum("bi,bi->b", weights, z_target) - np.einsum("bi,bij,bj->b", weights, z_gram, weights)
    resid = np.sqrt(np.maximum(total - explained, 0.0) / n)
    return mean, scale, y + batch["price_level"].to_numpy(float), weights, resid


def _walk(
    batch: pd.DataFrame, mean: np.ndarray, scale: np.ndarray, level: np.ndarray, weights: np.ndarray
) -> np.ndarray:
    """Forecasts of the next hours; each prediction becomes history for the next one."""
    prices = np.hstack([_matrix(batch["buffer"]), np.zeros((len(batch), HORIZON))])
    offers, before = batch["offers_last"].to_numpy(float), batch["offers_before"].to_numpy(float)
    hour0, weekday0 = batch["hour"].to_numpy(), batch["weekday"].to_numpy()
    rows = batch["rows"].to_numpy(float)
    for step in range(HORIZON):
        now = WEEK + step
        clock = hour0 + step + 1
        hour_angle = 2 * math.pi * (clock % 24) / 24
        week_angle = 2 * math.pi * ((weekday0 + clock // 24) % 7) / 7
        day = prices[:, now - DAY : now]
        x = np.column_stack(
            [
                rows + step,
                np.sin(hour_angle), np.cos(hour_angle), np.sin(week_angle), np.cos(week_angle),
                prices[:, now - 1], prices[:, now - 6], prices[:, now - DAY], prices[:, now - WEEK],
                day.mean(axis=1), day.std(axis=1), prices[:, now - WEEK : now].mean(axis=1),
                offers, before if step == 0 else offers,
            ]
        )
        predicted = level + np.einsum("bi,bi->b", (x - mean) / scale, weights)
        prices[:, now] = np.maximum(predicted, 0.0)
    return prices[:, WEEK:]


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if batch.empty:
            continue
        mean, scale, level, weights, resid = _fit(batch)
        size = np.abs(weights)
        yield pd.DataFrame(
            {
                "provider": batch["provider"],
                "gpu_name": batch["gpu_name"],
                "last_hour": batch["last_hour"],
                "n_train": batch["n"],
                "resid_std": resid,
                "forecast": list(_walk(batch, mean, scale, level, weights)),
                "importance": list(size / (size.sum(axis=1, keepdims=True) + TINY)),
            }
        )


def fit_models(hourly: DataFrame) -> DataFrame:
    """One row per series: residual deviation, 24 forecasts and feature importances."""
    return _sufficient_statistics(hourly).mapInPandas(_solve, MODEL_SCHEMA)


def forecast_points(models: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Models to one row per future hour with the 95 % band, floored at 0."""
    keep = keep or []
    band = F.lit(BAND) * F.col("resid_std")
    steps = models.select(*SERIES, *keep, "last_hour", "resid_std", F.posexplode("forecast").alias("_i", "forecast"))
    return steps.select(
        *SERIES,
        *keep,
        (F.col("_i") + 1).alias("hours_ahead"),
        (F.col("last_hour") + F.make_dt_interval(hours=F.col("_i") + 1)).alias("timestamp"),
        "forecast",
        F.greatest(F.col("forecast") - band, F.lit(0.0)).alias("lower_95"),
        (F.col("forecast") + band).alias("upper_95"),
    )


def forecast_24h(hourly: DataFrame) -> DataFrame:
    """24 hourly forecasts per series that has at least 30 rows and 10 complete ones."""
    return forecast_points(fit_models(hourly))


def _ranked_features(importance: Column) -> Column:
    """(rank key, feature) by falling rounded importance; ties keep the feature order."""
    names = F.array(*[F.lit(n) for n in FEATURES])
    entries = F.transform(
        importance,
        lambda v, i: F.struct(
            (-F.round(v, 4)).alias("neg"), i.alias("position"), F.try_element_at(names, i + 1).alias("feature")
        ),
    )
    return F.array_sort(entries)


def feature_importance(models: DataFrame) -> DataFrame:
    """Share of each feature in a series' model, ranked."""
    ranked = models.select(*SERIES, F.posexplode(_ranked_features(F.col("importance"))).alias("_i", "e"))
    return ranked.select(
        *SERIES,
        (F.col("_i") + 1).alias("rank"),
        F.col("e.feature").alias("feature"),
        (-F.col("e.neg")).alias("importance"),
    )


def forecast_windows(hourly: DataFrame, generated_at: datetime | Column | None = None) -> DataFrame:
    """Forecast rows with price levels, trend, availability and leading features of the series.

    Pass a stored hourly table (``plans.saved.save``): four branches read it.
    """
    leading = F.slice(_ranked_features(F.col("importance")), 1, TOP_FEATURES)
    models = fit_models(hourly).withColumn("top_features", F.transform(leading, lambda e: e["feature"]))
    price = F.col("price")
    levels = hourly.groupBy(*SERIES).agg(
        F.percentile("price", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("_p"),
        (F.stddev_pop(price) / (F.avg(price) + TINY)).alias("_vol"),
        F.avg((F.col("offer_count") > 0).cast("double")).alias("_avail"),
        F.max_by("price", "captured_at").alias("_last"),
        F.count("price").alias("n_price_samples"),
    )
    outlook = availability_6h(hourly).select(*SERIES, "hours_ahead", "predicted_offers")
    made = F.current_timestamp() if generated_at is None else F.lit(generated_at).cast("timestamp")

    def r4(c) -> Column:
        return settled_round(F.col(c) if isinstance(c, str) else c, 4)

    return (
        forecast_points(models, ["top_features"])
        .join(levels, SERIES)
        .join(decompose_summary(hourly), SERIES)
        .join(outlook, [*SERIES, "hours_ahead"], "left")
        .select(
            "provider",
            F.col("gpu_name").alias("gpu_class"),
            F.col("timestamp").alias("forecast_timestamp"),
            made.alias("generated_at"),
            F.col("hours_ahead").alias("forecast_hours_ahead"),
            r4("forecast").alias("price_forecast"),
            r4("lower_95").alias("price_forecast_lower"),
            r4("upper_95").alias("price_forecast_upper"),
            r4("_last").alias("last_actual_price"),
            r4(F.col("_p")[0]).alias("price_per_gpu_hour_p10"),
            r4(F.col("_p")[1]).alias("price_per_gpu_hour_p50"),
            r4(F.col("_p")[2]).alias("price_per_gpu_hour_p90"),
            r4("_vol").alias("price_volatility"),
            r4("_avail").alias("availability_probability"),
            settled_round(F.col("trend_slope"), 6).alias("trend_slope_per_hour"),
            r4("seasonal_strength").alias("seasonal_strength"),
            "predicted_offers",
            "n_price_samples",
            "top_features",
        )
    )
