"""Exact percentiles and the scores built on them."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rentscope.operators import scores
from rentscope.plans.quantiles import exact_percentiles

PROBS = {"p0": 0.0, "p10": 0.1, "p37": 0.37, "p50": 0.5, "p90": 0.9, "p100": 1.0}
value = st.one_of(st.floats(1e-6, 1e4), st.sampled_from([0.5, 0.5, 1.0, 2.0]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(value, min_size=1, max_size=60), min_size=1, max_size=4))
def test_equal_to_numpy(spark, groups):
    df = spark.createDataFrame([(i, v) for i, g in enumerate(groups) for v in g], "k int, v double")
    for r in exact_percentiles(df, ["k"], "v", PROBS).collect():
        group = groups[r["k"]]
        assert r["n"] == len(group)
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.percentile(group, p * 100), rel=1e-12)


def test_heavy_group(spark):
    """A group with most rows, a third of them one value."""
    df = spark.range(200_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN 'rest' ELSE 'heavy' END AS k",
        "CASE WHEN id % 3 = 0 THEN 1.5D ELSE 0.25D + (id * 7919 % 10007) / 1000D END AS v",
    )
    pdf = df.toPandas()
    for r in exact_percentiles(df, ["k"], "v", PROBS).collect():
        group = pdf[pdf["k"] == r["k"]]["v"]
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.percentile(group, p * 100), rel=1e-12)


def test_hot_band_is_split(spark, monkeypatch):
    """Three million distinct prices within 0.3 per cent: no cell that is ordered holds many."""
    from rentscope.plans import quantiles

    kept = []
    real = quantiles.save
    monkeypatch.setattr(quantiles, "save", lambda df, label: kept.append(real(df, label)) or kept[-1])
    n = 3_000_000
    df = spark.range(n).selectExpr("'g' AS k", "1.0D + id * 1e-9D AS v")
    (r,) = exact_percentiles(df, ["k"], "v", PROBS).collect()
    for name, p in PROBS.items():
        assert r[name] == pytest.approx(1 + (n - 1) * p * 1e-9, rel=1e-15)
    widest = [cells.agg({"_rows": "max"}).first()[0] for cells in kept]
    assert widest[0] > n / 3 and widest[-1] <= quantiles.ORDERED_ROWS


OFFER = "gpu_name string, provider string, price_per_gpu_hr double, interruptible int, snapshot_id string, vram_gb double"
RUNS = "snapshot_id string, started_at timestamp, finished_at timestamp"


def runs(spark, n):
    return spark.createDataFrame([(f"s{i}", None, None) for i in range(n)], RUNS).selectExpr(
        "snapshot_id", "timestamp'2024-01-01' AS started_at", "timestamp'2024-01-02' AS finished_at"
    )


def test_price_stats_edges(spark):
    rows = [("g", "vast", p, 1, "s0", 24.0) for p in (1.0, 2.0, 4.0, 9.0)] + [("h", "vast", p, 1, "s0", 24.0) for p in (1.0, 2.0)]
    rows += [("g", "vast", None, 1, "s0", 24.0), ("g", "vast", 0.0, 1, "s0", 24.0)]
    found = scores.price_stats(spark.createDataFrame(rows, OFFER)).collect()
    assert len(found) == 1
    r = found[0]
    assert (r["n_samples"], r["p10"], r["p50"], r["p90"], r["mean"]) == (4, 1.3, 3.0, 7.5, 4.0)
    assert r["volatility"] == pytest.approx(np.std([1, 2, 4, 9], ddof=1) / 4, abs=6e-5)


@pytest.mark.parametrize("n,expected", [(9, 0.2), (10, 0.7 * 0.2 + 0.3)])
def test_blend_needs_ten_rows(spark, n, expected):
    df = spark.createDataFrame([("g", "Vast", 1.0, 1, "s0", 1.0)] * n + [("g", "Vast", None, 0, "s0", 1.0)] * 5, OFFER)
    assert scores.interruption_probability(df).first()[1] == pytest.approx(expected)


def test_unknown_provider_and_unpriced(spark):
    df = spark.createDataFrame([("g", "other", None, 1, "s0", 1.0)], OFFER)
    assert scores.interruption_probability(df).first()[1] == 0.15
    assert scores.availability_score(df, runs(spark, 0)).first()["availability"] == 0.0


def test_windows_filters(spark):
    rows = [("g", "vast", p, 1, f"s{i}", v) for i, (p, v) in enumerate([(1.0, 8.0), (2.0, 24.0), (3.0, 48.0)])]
    rows += [("h", "vast", p, 0, "s0", 8.0) for p in (5.0, 6.0, 7.0)]
    offers, snaps = spark.createDataFrame(rows, OFFER), runs(spark, 4)
    all_windows = {r["gpu_class"]: r for r in scores.provider_windows(offers, snaps).collect()}
    assert set(all_windows) == {"g", "h"} and all_windows["g"]["availability_probability"] == 0.75
    picked = scores.provider_windows(offers, snaps, min_vram=24.0).collect()
    assert [(r["gpu_class"], r["vram_gb"], r["n_price_samples"]) for r in picked] == [("g", 48.0, 3)]
    assert [r["gpu_class"] for r in scores.provider_windows(offers, snaps, budget=2.0).collect()] == ["g"]
    # Both providers' rows count for the provider's spot share: 3 of 6, too few to blend.
    assert picked[0]["interruption_probability"] == 0.2
