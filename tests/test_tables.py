"""Files in and out, saved tables, and restarts of the streams."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import serving, summary
from rentscope.plans import saved
from rentscope.registry import fixtures as fx
from rentscope.sources import tables
from rentscope.streaming import jobs


@pytest.fixture(scope="module")
def stored(spark, small_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("offers") / "table")
    offers = fx.offers(spark, small_dir)
    tables.append_offers(offers, path)
    return tables.read_offers(spark, path, offers.schema)


def scanned_days(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return plan


def test_stored_offers_give_equal_reports(spark, small_dir, stored):
    plain = fx.offers(spark, small_dir)
    for report in (summary.provider_coverage, summary.cheapest_by_provider, serving.price_comparison, serving.price_matrix):
        assert report(stored).collect() == report(plain).collect()
    assert summary.cheapest_offers(stored).collect() == summary.cheapest_offers(plain).collect()


def test_recency_prunes_days(stored):
    for report in (summary.provider_coverage, serving.price_comparison):
        plan = scanned_days(report(stored))
        filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
        assert filters and all("capture_date" in f for f in filters)


def test_single_runs_read_their_day(spark, small_dir, stored):
    runs = fx.snapshots(spark, small_dir)
    last = runs.orderBy(F.desc("started_at")).first()["snapshot_id"]
    for report in (summary.latest_snapshot(stored, runs), summary.snapshot_summary(stored, last, runs)):
        assert report.count() > 0
        plan = report._jdf.queryExecution().executedPlan().toString()
        filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
        assert any("capture_date" in f and "Subquery" in f for f in filters)


def test_json_and_csv(spark, tmp_path):
    rows = spark.createDataFrame(
        [("vast", "g", None, 0.1, 0.2, 0.3, 0.5, 1.0, 0.2, 7)], schemas.PROVIDER_WINDOWS
    )
    path = str(tmp_path / "windows")
    assert tables.read_json(spark, path, schemas.PROVIDER_WINDOWS).count() == 0
    tables.write_json(rows, path)
    assert tables.read_json(spark, path, schemas.PROVIDER_WINDOWS).collect() == rows.collect()
    text = spark.read.text(path).first()[0]
    assert '"vram_gb":null' in text
    tables.write_csv(rows.select("provider", "gpu_class"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).collect()[0].asDict() == {"provider": "vast", "gpu_class": "g"}


def test_typed_import(spark):
    rows = spark.createDataFrame([(1, "2024-01-01T10:00:00+02:00", "1.5")], "id int, captured_at string, vram_gb string")
    r = tables.typed(rows, schemas.OFFERS).first()
    assert str(r["captured_at"]) == "2024-01-01 08:00:00" and r["vram_gb"] == 1.5 and r["provider"] is None


class Session:
    """Just enough of a session to name a folder."""

    def __init__(self, master, folder=None):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder():
    assert saved.shared_dir(Session("spark://host:7077", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(ValueError):
        saved.shared_dir(Session("spark://host:7077"))
    assert saved.shared_dir(Session("local[2]")) == saved.shared_dir(Session("local[2]"))


def test_ingest_stream_takes_each_payload_once(spark, small_dir, tmp_path):
    payloads = fx.monthly_payloads(spark, small_dir)
    half = F.hash("snapshot_id") % 2 == 0
    landed, offers, checkpoint = (str(tmp_path / name) for name in ("landed", "offers", "checkpoint"))

    def drain():
        jobs.stream_ingest(spark, landed, offers, checkpoint, payloads.schema).awaitTermination()
        return tables.read_offers(spark, offers).filter("provider = 'akash'").count()

    tables.land_payloads(payloads.filter(half), landed)
    first = drain()
    assert drain() == first
    tables.land_payloads(payloads.filter(~half), landed)
    from rentscope.operators.ingest import ingest_monthly_prices

    assert first < drain() == ingest_monthly_prices(payloads).count()


def test_split_runs_count_once(spark, small_dir, tmp_path):
    """A run's web page lands before its service answer; the answer then replaces the page's rows."""
    from rentscope.operators.ingest import collect_run

    payloads = fx.price_list_payloads(spark, small_dir, "kind = 0").unionByName(fx.price_page_payloads(spark, small_dir))
    landed, offers, checkpoint = (str(tmp_path / name) for name in ("landed", "offers", "checkpoint"))
    for first in (F.col("source") == "price_page", F.col("source") == "price_list"):
        tables.land_payloads(payloads.filter(first), landed)
        jobs.stream_ingest(spark, landed, offers, checkpoint, payloads.schema).awaitTermination()
    found, expected = (
        sorted(map(tuple, df.select("snapshot_id", "offer_id", "price_per_gpu_hr", "extra_json").collect()))
        for df in (tables.read_offers(spark, offers), collect_run(payloads))
    )
    assert found == expected
    ids = [r["id"] for r in tables.read_offers(spark, offers).select("id").collect()]
    assert None not in ids and len(set(ids)) == len(ids)


def test_ingest_stream_reads_payloads_where_they_landed(spark, tmp_path, monkeypatch):
    """A batch makes no copy of the payloads; what lands while it runs waits for the next one."""
    from rentscope.operators.ingest import collect_run

    landed, offers, checkpoint = (str(tmp_path / name) for name in ("landed", "offers", "checkpoint"))
    columns = "snapshot_id string, captured_at timestamp, provider string, source string, payload string"

    def land(number):
        body = '{"offers":[{"id":"%d","gpu_name":"RTX 4090","dph_total":1.5}]}' % number
        row = ("r", datetime(2024, 1, 1), "vast", "marketplace", body)
        tables.land_payloads(spark.createDataFrame([row], columns), landed)

    read = []

    def collect(payloads):
        read.append(payloads.inputFiles())
        land(len(read) + 1)
        return collect_run(payloads)

    monkeypatch.setattr(jobs, "collect_run", collect)
    land(1)
    for batch in (1, 2):
        jobs.stream_ingest(spark, landed, offers, checkpoint).awaitTermination()
        found = sorted(r["offer_id"] for r in tables.read_offers(spark, offers).select("offer_id").collect())
        assert found == [str(n) for n in range(1, batch + 1)]
    assert [len(files) for files in read] == [1, 2] and all(landed in file for files in read for file in files)


def land_prices(spark, landed, *rows):
    """Append ``time, provider, gpu, price`` and return a stream over all that has landed."""
    schema = "captured_at timestamp, provider string, gpu_name string, price_per_gpu_hr double"
    spark.createDataFrame(rows, "t string, provider string, gpu_name string, price_per_gpu_hr double").selectExpr(
        "CAST(t AS timestamp) AS captured_at", "provider", "gpu_name", "price_per_gpu_hr"
    ).coalesce(1).write.mode("append").parquet(landed)
    return spark.readStream.schema(schema).parquet(landed)


@pytest.mark.parametrize("lateness", ["2 hours", "30 days"])
def test_late_hours_count(spark, tmp_path, lateness):
    """Whether an hour is still open or closed when an offer comes late."""
    landed, out, checkpoint = (str(tmp_path / name) for name in ("landed", "out", "checkpoint"))

    def land(*rows):
        jobs.stream_hourly_series(land_prices(spark, landed, *rows), out, checkpoint, lateness).awaitTermination()
        rows = spark.read.schema(jobs.HOURLY_STATE).parquet(out).orderBy("captured_at").collect()
        return [(str(r["captured_at"]), r["price"], r["offer_count"]) for r in rows], [r["late_count"] for r in rows]

    first, _ = land(("2024-01-01 00:10:00", "p", "g", 2.0), ("2024-01-01 00:50:00", "p", "g", 1.0), ("2024-01-01 05:00:00", "p", "g", 3.0), ("2024-01-01 05:00:00", "p", "g", None))
    assert first == [("2024-01-01 00:00:00", 1.0, 2), ("2024-01-01 05:00:00", 3.0, 1)]
    second, late = land(("2024-01-01 00:20:00", "p", "g", 0.5), ("2024-01-01 05:10:00", "p", "g", 9.0), ("2024-01-02 09:00:00", "p", "g", 4.0))
    assert second == [("2024-01-01 00:00:00", 0.5, 3), ("2024-01-01 05:00:00", 3.0, 2), ("2024-01-02 09:00:00", 4.0, 1)]
    assert late == ([1, 0, 0] if lateness == "2 hours" else [0, 0, 0])
    third, late = land(("2024-01-01 00:20:00", "p", "g", 0.75), ("2023-12-31 23:59:59", "q", None, 1.0))
    assert third == [("2023-12-31 23:00:00", 1.0, 1), ("2024-01-01 00:00:00", 0.5, 4), *second[1:]]
    assert late == ([1, 2, 0, 0] if lateness == "2 hours" else [0, 0, 0, 0])


def test_a_batch_reads_only_the_days_it_touches(spark, tmp_path):
    """Days of the series that a batch does not touch may even be unreadable."""
    landed, out, checkpoint = (str(tmp_path / name) for name in ("landed", "out", "checkpoint"))
    jobs.stream_hourly_series(land_prices(spark, landed, ("2024-01-01 00:10:00", "p", "g", 2.0), ("2024-01-05 00:10:00", "p", "g", 2.0)), out, checkpoint).awaitTermination()
    for file in (tmp_path / "out" / "capture_date=2024-01-01").iterdir():
        file.unlink()
    (tmp_path / "out" / "capture_date=2024-01-01" / "part-broken.parquet").write_bytes(b"no parquet")
    jobs.stream_hourly_series(land_prices(spark, landed, ("2024-01-05 00:20:00", "p", "g", 1.0)), out, checkpoint).awaitTermination()
    (row,) = spark.read.schema(jobs.HOURLY_STATE).parquet(out).filter("capture_date = DATE '2024-01-05'").collect()
    assert (row["price"], row["offer_count"]) == (1.0, 2)


def test_a_repeated_batch_of_hours_adds_nothing_twice(spark, tmp_path):
    """The last batch runs again after its result was written, as after a lost driver."""
    landed, out, checkpoint = (str(tmp_path / name) for name in ("landed", "out", "checkpoint"))
    for rows in ([("2024-01-01 00:10:00", "p", "g", 2.0), ("2024-01-09 00:00:00", "p", "g", 1.0)], [("2024-01-01 00:20:00", "p", "g", 1.5)]):
        jobs.stream_hourly_series(land_prices(spark, landed, *rows), out, checkpoint, "1 hour").awaitTermination()

    def held():
        return sorted((str(r["captured_at"]), r["price"], r["offer_count"], r["late_count"]) for r in spark.read.schema(jobs.HOURLY_STATE).parquet(out).collect())

    expected = [("2024-01-01 00:00:00", 1.5, 2, 1), ("2024-01-09 00:00:00", 1.0, 1, 0)]
    assert held() == expected
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for commit in commits[2:]:
        for file in (commit, commit.with_name(f".{commit.name}.crc")):
            file.unlink(missing_ok=True)
    schema = "captured_at timestamp, provider string, gpu_name string, price_per_gpu_hr double"
    jobs.stream_hourly_series(spark.readStream.schema(schema).parquet(landed), out, checkpoint, "1 hour").awaitTermination()
    assert held() == expected


def test_alerts_are_written_when_they_change(spark, tmp_path):
    """After each batch the alerts that hold equal those over all offers; rows are changes; one folder per day, two versions."""
    landed, state, alerts, checkpoint = (str(tmp_path / name) for name in ("landed", "state", "alerts", "checkpoint"))
    windows = spark.createDataFrame([("p", "g", 1.0), ("q", "g", 1.1)], "provider string, gpu_class string, price_per_gpu_hour_p50 double")
    batches = [
        [("2024-01-01 00:00:00", "p", "g", 2.0), ("2024-01-01 00:10:00", "q", "g", 1.0), ("2024-01-01 00:10:00", "p", "h", 1.0)],
        [("2024-01-01 01:00:00", "p", "g", 2.5), ("2024-01-01 01:00:00", "q", "h", 5.0)],
        [("2024-01-01 01:30:00", "p", "g", 2.6)],
        [("2024-01-01 04:05:00", "q", "g", 1.2)],
        [("2024-01-01 09:00:00", "p", "g", 1.2), ("2024-01-01 09:00:00", "q", "g", 1.2)],
        [("2024-01-02 09:00:00", "q", "g", None)],
        [("2024-01-01 00:30:00", "q", "g", 0.1)],
    ]
    changes, expected_changes, seen = 0, 0, {}
    for rows in batches:
        jobs.stream_alerts(land_prices(spark, landed, *rows), state, windows, alerts, checkpoint).awaitTermination()
        written = spark.read.schema(jobs.ALERT_CHANGES).parquet(alerts)
        held = {r["gpu_name"]: r.asDict() for r in jobs.current_alerts(written).collect()}
        whole = {r["gpu_name"]: r.asDict() for r in serving.spread_alerts(spark.read.parquet(landed), windows).collect()}
        assert held == whole
        expected_changes += sum(seen.get(g) != whole.get(g) for g in seen.keys() | whole.keys())
        changes, seen = written.count(), whole
        assert changes == expected_changes
    assert len(list((tmp_path / "state").glob("version=*"))) == 2
    assert {f.name for f in (tmp_path / "alerts").glob("capture_date=*")} <= {"capture_date=2024-01-01", "capture_date=2024-01-02"}


def test_ids_are_stable(spark, small_dir):
    """The same rows get the same ids, and equal rows different ones."""
    from rentscope.operators.ingest import ingest_gpu_types

    rows = ingest_gpu_types(fx.gpu_type_payloads(spark, small_dir))
    doubled = rows.unionByName(rows)
    first, second = ({r["id"] for r in tables.with_ids(df).collect()} for df in (doubled, doubled.repartition(7)))
    assert first == second and len(first) == doubled.count()
    assert {r["id"] for r in tables.with_ids(rows).collect()} < first


def test_run_log_keeps_the_last_row(spark, tmp_path):
    path = str(tmp_path / "runs")
    columns = ["snapshot_id", "started_at", "finished_at", "all_offers", "errors"]
    for finished, n in ((None, 0), ("2024-01-01 00:05:00", 3)):
        rows = spark.createDataFrame([("s", "2024-01-01 00:00:00", finished, n, ["x: no rows"])], "a string, b string, c string, d long, e array<string>").toDF(*columns)
        tables.append_snapshots(tables.typed(rows, schemas.SNAPSHOTS), path)
    (row,) = tables.read_snapshots(spark, path).collect()
    assert str(row["finished_at"]) == "2024-01-01 00:05:00" and row["all_offers"] == 3
    empty = spark.createDataFrame([], schemas.OFFERS)
    (report,) = summary.run_report(empty, tables.read_snapshots(spark, path)).collect()
    assert (report["provider"], report["cnt"], report["errors"], report["finished_at"]) == (None, 0, ["x: no rows"], "2024-01-01 00:05")


def test_newest_day_from_the_first_level_of_folders(spark, stored):
    from rentscope.plans import recency

    days = recency.stored_days(stored)
    assert days == sorted({str(r[0]) for r in stored.select("capture_date").distinct().collect()}, reverse=True)
    assert recency.stored_days(stored.filter("provider = 'vast'")) == days
    assert recency.stored_days(spark.createDataFrame([(1,)], "a int")) == []
    newest = stored.select(recency.latest_capture(stored).alias("t")).first()[0]
    assert newest == stored.agg(F.max("captured_at")).first()[0]


def test_row_groups_without_a_run_are_not_read(spark, tmp_path):
    """Two files whose run ids overlap in range: only the one that holds the run gives rows to the filter."""
    path = str(tmp_path / "table")
    for odd in (0, 1):
        rows = [(f"snap_{i:05d}", "2024-01-01 00:00:00", f"o{i}", "p", "g", 1.0, 0) for i in range(odd, 4000, 2)]
        df = spark.createDataFrame(rows, "snapshot_id string, t string, offer_id string, provider string, gpu_name string, price_per_gpu_hr double, interruptible int")
        df = df.withColumn("captured_at", F.col("t").cast("timestamp")).drop("t").coalesce(1)
        tables.append_offers(df, path)
    found = spark.read.parquet(path).filter("snapshot_id = 'snap_01234'")
    assert found.count() == 1
    plan = found.select("offer_id")
    plan.collect()
    metrics = plan._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics()
    assert 0 < metrics.apply("numOutputRows").value() <= 2000


def test_a_stream_without_alerts_gives_none(spark, tmp_path):
    """Equal prices everywhere: no change is written, and a reader finds an empty table."""
    from rentscope.registry.queries import queries

    events = spark.range(200).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts", "id AS user_id",
        "element_at(array('click', 'view', 'purchase', 'error'), CAST(id % 4 + 1 AS INT)) AS event_type", "10.0D AS value", "'{}' AS props",
    )
    for name, rows in (("some", events), ("none", events.limit(0))):
        rows.write.parquet(str(tmp_path / name / "events.parquet"))
        found = queries()["stream_alerts"](spark, str(tmp_path / name))
        assert found.collect() == [] and "provider" in found.columns
    assert queries()["stream_hourly_series"](spark, str(tmp_path / "none")).collect() == []
    assert queries()["stream_ingest"](spark, str(tmp_path / "none")).collect() == []
