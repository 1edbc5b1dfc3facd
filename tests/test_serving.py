"""Comparison and alert rules on hand-written rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import series, serving, summary

NOW = "2024-01-10 00:00:00"


def offers(spark, rows):
    """(gpu, provider, price, hours before NOW)."""
    df = spark.createDataFrame(rows, "gpu_name string, provider string, price_per_gpu_hr double, age int")
    return df.withColumn("captured_at", F.lit(NOW).cast("timestamp") - F.make_dt_interval(hours=F.col("age")))


def windows(spark, rows=()):
    """(gpu_class, provider, p50)."""
    df = spark.createDataFrame(list(rows), "gpu_class string, provider string, price_per_gpu_hour_p50 double")
    for field in schemas.PROVIDER_WINDOWS:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


@pytest.mark.parametrize("gap,kept", [(0.0049, 0), (0.0051, 1)])
def test_smallest_spread(spark, gap, kept):
    df = offers(spark, [("g", "a", 1.0, 0), ("g", "b", 1.0 + gap, 0), ("h", "a", 1.0, 0)])
    assert serving.spread_alerts(df, windows(spark)).count() == kept


@pytest.mark.parametrize(
    "high,medians,alert",
    [
        (1.16, [], False),
        (1.18, [], True),
        (1.18, [("g", "a", 1.0)], True),
        (1.18, [("g", "a", 1.0), ("g", "b", 1.2)], False),
        (1.31, [("g", "a", 1.0), ("g", "b", 1.2)], True),
        (1.04, [("g", "a", 1.0), ("g", "b", 1.0)], False),
    ],
)
def test_alert_rule(spark, high, medians, alert):
    df = offers(spark, [("g", "b", high, 0), ("g", "a", 1.0, 0), ("g", "c", high, 1)])
    row = serving.spread_alerts(df, windows(spark, medians)).first()
    assert row["is_alert"] is alert and row["prices"] == {"a": 1.0, "b": high, "c": high}
    assert (row["cheapest_provider"], row["priciest_provider"]) == ("a", "b")
    assert row["savings_per_100h"] == pytest.approx((high - 1.0) * 100, abs=0.0051)


@pytest.mark.parametrize("ages,seen", [([1, 10], {1}), ([10, 60], {10}), ([60, 500], {60, 500}), ([20000], set())])
def test_first_tier_with_rows(spark, ages, seen):
    df = offers(spark, [(f"g{a}", "a", 1.0, a) for a in ages])
    found = serving.price_comparison(df, datetime(2024, 1, 10)).collect()
    assert {int(r["gpu_name"][1:]) for r in found} == seen


def test_zero_average_does_not_compete(spark):
    df = offers(spark, [("g", "a", 0.0, 0), ("g", "b", 2.0, 0), ("g", "c", 2.0, 0), ("z", "a", 0.0, 0), ("n", "a", None, 0)])
    rows = serving.price_comparison(df).collect()
    assert [(r["gpu_name"], r["cheapest_provider"], r["cheapest_price"], r["provider_count"]) for r in rows] == [("g", "b", 2.0, 3)]
    assert rows[0]["providers"]["a"].asDict() == {"min_price": 0.0, "avg_price": 0.0, "offer_count": 1}


def test_matrix_marks_all_ties(spark):
    df = offers(spark, [("g", "vast", 1.0, 0), ("g", "runpod", 1.0, 0), ("h", "other", 1.0, 0)])
    rows = {r["gpu_name"]: r for r in serving.price_matrix(df).collect()}
    g, h = rows["g"], rows["h"]
    assert (g["vast_best"], g["runpod_best"], g["spheron_best"], g["spheron"]) == (True, True, False, None)
    assert not h["vast_best"] and h["vast"] is None


def test_bands(spark):
    values = [None, 0.0, 0.05, 0.0501, 0.15, 0.3, 0.31, 0.5, 0.51]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bands = [r[0] for r in df.select(serving.volatility_band(F.col("v"))).collect()]
    assert bands == ["very low"] * 3 + ["low"] * 2 + ["medium", "high", "high", "very high"]


def test_budget_cost_counts_the_rest(spark):
    df = windows(spark, [(f"g{i:02d}", "a", 0.1 * i) for i in range(1, 16)])
    rows = serving.budget_cost(df, budget=1.25, hours=3).collect()
    assert len(rows) == 10 and {r["more_options"] for r in rows} == {2}
    assert rows[1]["total_cost"] == 0.6 and rows[0]["availability_light"] == "red"


def test_default_forecast_gpus(spark):
    df = spark.createDataFrame([("RTX_4090",), ("A40",), ("L40S",)], "gpu_class string")
    assert {r[0] for r in serving.forecast_lookup(df).collect()} == {"RTX_4090", "L40S"}
    assert [r[0] for r in serving.forecast_lookup(df, "A40").collect()] == ["A40"]


def test_history_takes_like_wildcards(spark):
    df = offers(spark, [("RTX_4090", "a", 1.0, 0), ("RTXX4090", "a", 3.0, 0), ("A40", "a", 1.0, 0)])
    assert summary.gpu_history(df, "rtx_4").first()["offers"] == 2


def test_offer_window_defaults(spark):
    rows = [(1, "s", "a", "g", None, None, None), (2, "s", "a", "g", 1.0, 0.0, 1), (3, "s", "a", "g", 2.0, 0.5, 0)]
    df = spark.createDataFrame(
        rows, "id long, snapshot_id string, provider string, gpu_name string, price_per_gpu_hr double, reliability_score double, interruptible int"
    ).withColumn("captured_at", F.lit(NOW).cast("timestamp"))
    found = summary.offer_windows(df, limit=2).collect() + summary.offer_windows(df).collect()[2:]
    assert [(r[0], r["price_per_gpu_hour_p90"], r["availability_probability"], r["interruption_probability"]) for r in found] == [
        ("s_a_g_3", 2.5, 0.5, 0.02), ("s_a_g_2", 1.25, 0.6, 0.15), ("s_a_g_1", 0.0, 0.6, 0.02),
    ]


def test_spread_needs_two_providers_and_four_hours(spark):
    def hourly(gpu, provider, prices):
        return [(datetime(2024, 1, 1, i), provider, gpu, p, 1) for i, p in enumerate(prices) if p is not None]

    rows = hourly("g", "vast", [1.0] * 5) + hourly("g", "runpod", [2.0, None, 1.0, 1.0, 4.0])
    rows += hourly("one", "vast", [1.0] * 5) + hourly("short", "vast", [1.0] * 3) + hourly("short", "runpod", [1.0] * 3)
    rows += hourly("other", "vast", [1.0] * 5) + hourly("other", "akash", [1.0] * 5)
    df = spark.createDataFrame(rows, "captured_at timestamp, provider string, gpu_name string, price double, offer_count long")
    found = series.spread_analysis(df).collect()
    assert len(found) == 1
    r = found[0]
    assert (r["latest_spread"], r["hist_avg_spread"], r["threshold_1_5x"], r["spread_alert"]) == (3.0, 0.8, 1.2, True)
    assert (r["cheapest_provider"], r["most_expensive_provider"]) == ("vast", "runpod")
    assert r["latest_prices"] == {"vast": 1.0, "runpod": 4.0} and r["providers_compared"] == ["runpod", "vast"]
