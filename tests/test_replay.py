"""Replays against a search of every job, over many small blocks."""

from __future__ import annotations

import math
from bisect import bisect_left
from contextlib import contextmanager
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rentscope.operators import replay
from rentscope.plans import blocks
from rentscope.sources import tables

START = datetime(2024, 1, 1)


@contextmanager
def small_blocks(rows):
    """Blocks of few rows, so that series span several of them."""
    before = blocks.BLOCK_ROWS
    blocks.BLOCK_ROWS = rows
    try:
        yield
    finally:
        blocks.BLOCK_ROWS = before


def points(spark, series: dict[tuple[str, str], list[float]]):
    rows = [
        (az, kind, float(price), START + timedelta(hours=i), "", i)
        for (kind, az), prices in series.items()
        for i, price in enumerate(prices)
    ]
    return spark.createDataFrame(
        rows, "az string, instance_type string, price double, ts timestamp, file string, seq long"
    )


def expected_jobs(prices: list[float], budget: float, hours: float, max_starts: int | None = None) -> dict[int, dict]:
    """Every job by searching its series: where enough affordable points in a row end, and what lies before."""
    need = max(1, math.ceil(hours))
    ok = [p <= budget for p in prices]
    ends = [e for e in range(need - 1, len(prices)) if all(ok[e - need + 1 : e + 1])]
    breaks = [i for i in range(1, len(prices)) if ok[i - 1] and not ok[i]]
    step = 1 if max_starts is None else max(1, len(prices) // max_starts)
    out, n_done = {}, 0
    for start in range(0, len(prices) - 1, step):
        later = bisect_left(ends, start + need - 1)
        end = ends[later] if later < len(ends) else None
        stop = len(prices) if end is None else end + 1
        broken = [i for i in breaks if start < i < stop]
        paid_to = stop if end is not None else (broken[-1] if broken else start)
        cost = sum(p for p, fits in zip(prices[start:paid_to], ok[start:paid_to], strict=True) if fits)
        waited = 0 if end is None else ok[start:stop].count(False)
        n_done += end is not None
        out[start] = {
            "completed": end is not None,
            "wait_hours": waited,
            "interruptions": len(broken),
            "cost": round(cost, 6),
            "elapsed_hours": None if end is None else stop - start,
            "elapsed_hours_pooled": None if end is None else waited + need * (n_done if broken else 1),
        }
    return out


def found_jobs(df) -> dict[str, dict[int, dict]]:
    out: dict[str, dict[int, dict]] = {}
    names = ["completed", "wait_hours", "interruptions", "elapsed_hours", "elapsed_hours_pooled"]
    for r in df.collect():
        job = {n: r[n] for n in names} | {"cost": round(r["cost"], 6)}
        out.setdefault(r["instance_type"], {})[r["start_index"]] = job
    return out


prices = st.lists(st.sampled_from([0.5, 1.0, 2.0, 3.0]), min_size=2, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(prices, min_size=3, max_size=3), st.sampled_from([0.7, 1.5, 2.5]), st.sampled_from([0.5, 1.0, 2.2, 4.0]))
def test_replay_equals_search(spark, series, budget, hours):
    data = {(f"g5.{i}", "a"): p for i, p in enumerate(series)}
    with small_blocks(11):
        found = found_jobs(replay.replay_jobs(points(spark, data), budget, hours))
    assert found == {kind: expected_jobs(p, budget, hours) for (kind, _), p in data.items()}


def test_one_heavy_series_over_many_blocks(spark):
    """One type holds nearly all points, many at the same time; rows are split all the same."""
    heavy = [1.0 + ((i * 7919) % 13) / 4 for i in range(5000)]
    data = {("g5.heavy", "a"): heavy, ("g5.light", "a"): [1.0, 9.0, 1.0, 1.0]}
    df = points(spark, data).selectExpr(
        "az", "instance_type", "price", "date_trunc('year', ts) AS ts", "file", "seq"
    )
    with small_blocks(700):
        placed = blocks.in_ordered_blocks(df, ["instance_type"], replay.ORDER, 5004)
        sizes = [r["count"] for r in placed.filter("instance_type = 'g5.heavy'").groupBy("block").count().collect()]
        assert len(sizes) >= 6 and max(sizes) < 1500
        found = found_jobs(replay.replay_jobs(df, 3.0, 4))
    assert found == {kind: expected_jobs(p, 3.0, 4) for (kind, _), p in data.items()}


def test_summary(spark):
    """ok, bad, ok, ok with two hours: one break, one wait hour, done at the fourth point."""
    data = {("g5.x", "a"): [1.0, 9.0, 1.0, 1.0], ("g5.never", "a"): [9.0, 9.0, 9.0], ("g5.single", "a"): [1.0]}
    rows = {r["instance_type"]: r for r in replay.replay_summary(points(spark, data), 2.0, 2).collect()}
    jobs = expected_jobs(data[("g5.x", "a")], 2.0, 2)
    assert jobs[0]["interruptions"] == 1 and jobs[0]["wait_hours"] == 1 and jobs[0]["elapsed_hours"] == 4
    x = rows["g5.x"]
    done = sorted(j["elapsed_hours"] for j in jobs.values() if j["completed"])
    breaks = sum(j["interruptions"] for j in jobs.values())
    assert (x["completed_jobs"], x["interrupted_jobs"], x["total_windows"]) == (len(done), breaks, 4)
    assert x["completion_rate"] == pytest.approx(len(done) / (len(done) + breaks))
    assert x["avg_actual_cost"] == pytest.approx(sum(j["cost"] for j in jobs.values()) / len(done))
    assert (x["p50_completion_hours"], x["p90_completion_hours"]) == (done[len(done) // 2], done[int(len(done) * 0.9)])
    never = rows["g5.never"]
    assert never["completed_jobs"] == 0 and never["p50_completion_hours"] is None and never["avg_wait_hours"] == 0
    assert rows["g5.single"]["total_windows"] == 1 and rows["g5.single"]["completion_rate"] == 0


def test_all_starts_or_a_sample(spark):
    series = [float(i % 5) for i in range(1203)]
    df = points(spark, {("g4.x", "a"): series})
    every = found_jobs(replay.replay_jobs(df, 2.0, 3))["g4.x"]
    assert every == expected_jobs(series, 2.0, 3) and set(every) == set(range(1202))
    some = found_jobs(replay.replay_jobs(df, 2.0, 3, max_starts=500))["g4.x"]
    assert some == expected_jobs(series, 2.0, 3, 500) and set(some) == set(range(0, 1202, 2))


def test_densest_zone_and_given_zone(spark):
    data = {("g5.x", "b"): [1.0] * 3, ("g5.x", "a"): [1.0] * 3, ("g5.y", "a"): [1.0], ("g5.y", "b"): [1.0, 2.0]}
    df = points(spark, data)
    df = df.withColumn("seq", df.seq + (df.az == "a").cast("int") * 100)
    assert {r["instance_type"]: (r["az"], r["total_windows"]) for r in replay.densest_zone(df).collect()} == {
        "g5.x": ("b", 3), "g5.y": ("b", 2)
    }
    assert {r["instance_type"]: r["az"] for r in replay.densest_zone(df, "a").collect()} == {"g5.x": "a", "g5.y": "a"}


def test_archive_lines(spark, tmp_path):
    import zstandard

    good = "use1-az1\tg5.xlarge\tLinux/UNIX\t1.25\t2024-01-01T00:00:00+00:00"
    lines = [
        good,
        "use1-az1\tg5.xlarge\tLinux/UNIX",
        good + "\tsixth",
        "use1-az1\tg5.xlarge\tLinux/UNIX\tabc\t2024-01-01T01:00:00",
        "use1-az1\tp3.2xlarge\t\t0.5\t2024-01-01T02:00:00",
        "use1-az1\tg5.xlarge\tLinux/UNIX\tNaN\t2024-01-01T00:00:00",
        "use1-az1\tg5.xlarge\tWindows\t1.0\t2024-01-01T00:00:00",
        "use1-az1\tg4dn.xlarge\tLinux/UNIX\t1.0\t2024-01-01T00:00:00",
        "use1-az1\tg5.xlarge\tLinux/UNIX\t1.0\tyesterday",
        "use1-az1\tg5.xlarge\tLinux/UNIX\t1.0\t10:00:00",
        "use1-az1\tg5.xlarge\tLinux/UNIX\t1.0\t2024-03",
        "use1-az1\tg5.xlarge\tLinux/UNIX\t1.0\t2024",
    ]
    body = zstandard.ZstdCompressor().compress(("\n".join(lines) + "\n").encode())
    (tmp_path / "a.tsv.zst").write_bytes(body)
    read = tables.read_spot_lines(spark, str(tmp_path / "*.tsv.zst"))
    assert read.count() == len(lines)
    rows = [(r["instance_type"], r["price"], str(r["ts"])) for r in replay.spot_prices(read).orderBy("seq").collect()]
    assert rows == [
        ("g5.xlarge", 1.25, "2024-01-01 00:00:00"),
        ("g5.xlarge", 1.25, "2024-01-01 00:00:00"),
        ("p3.2xlarge", 0.5, "2024-01-01 02:00:00"),
    ]
    assert [r[0] for r in replay.gpu_types(replay.spot_prices(read)).collect()] == ["g5.xlarge", "p3.2xlarge"]
