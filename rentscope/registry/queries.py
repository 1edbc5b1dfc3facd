"""Every operator as a query over the driver tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.functions.names import canonical_gpu_name, parse_size_gb
from rentscope.functions.nested import deep_find
from rentscope.functions.scalars import settled_round
from rentscope.operators import forecast, ingest, replay, scores, series, serving, summary
from rentscope.plans.saved import new_path, save
from rentscope.registry import fixtures as fx
from rentscope.registry import streams
from rentscope.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with the reference SQL.
GPU_PATTERN = "rtx_"
MIN_VRAM = 48.0
BUDGET = 4.0
WINDOW_BUDGET = 5.0
JOB_BUDGET = 5.0
JOB_HOURS = 3
ONE_RUN = "2024-01-02 05:00:00"
FOCUS_GPU = "RTX_4090"
GENERATED_AT = datetime(2024, 2, 1)

OFFER_VALUES = [
    "snapshot_id", "captured_at", "provider", "offer_id", "gpu_name", "gpu_name_raw", "gpu_count", "vram_gb",
    "price_per_gpu_hr", "price_total_hr", "interruptible", "reliability_score", "geography", "inet_down_mbps",
    "inet_up_mbps", "disk_space_gb", "gpu_utilization_pct", "extra_json",
]


def _over_offers(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf: operator(fx.offers(spark, sf), **params)


def _with_runs(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf: operator(fx.offers(spark, sf), fx.snapshots(spark, sf), **params)


def _over_hourly(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: operator(series.hourly_series(fx.offers(spark, sf)))


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return scores.provider_windows(fx.offers(spark, sf), fx.snapshots(spark, sf))


def _over_windows(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf: operator(_windows(spark, sf), **params)


def _no_zone(df: DataFrame) -> DataFrame:
    """Instants as plain timestamps, like those of the driver tables."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if kinds[c] == "timestamp" else F.col(c) for c in df.columns]
    )


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(
        *[settled_round(F.col(c), digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns]
    )


def _ingested(reader: Callable[[DataFrame], DataFrame], landed: Query) -> Query:
    return lambda spark, sf: _no_zone(reader(landed(spark, sf)).select(*OFFER_VALUES))


def _price_comparison(spark: SparkSession, sf: str) -> DataFrame:
    compared = serving.price_comparison(fx.offers(spark, sf))
    return compared.select(
        "gpu_name", "cheapest_provider", "cheapest_price", "provider_count",
        F.explode("providers").alias("provider", "v"),
    ).select(
        "gpu_name", "cheapest_provider", "cheapest_price", "provider_count", "provider",
        "v.min_price", "v.avg_price", "v.offer_count",
    )


def _spread_alerts(spark: SparkSession, sf: str) -> DataFrame:
    alerts = serving.spread_alerts(fx.offers(spark, sf), _windows(spark, sf))
    return alerts.select(*[c for c in alerts.columns if c != "prices"], F.explode("prices").alias("provider", "price"))


def _volatility_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return serving.volatility_rollup(_windows(spark, sf)).withColumn("providers", F.array_join("providers", ","))


def _spread_analysis(spark: SparkSession, sf: str) -> DataFrame:
    found = series.spread_analysis(series.hourly_series(fx.offers(spark, sf)))
    return (
        found.withColumn("providers_compared", F.array_join("providers_compared", ","))
        .select(*[c for c in found.columns if c != "latest_prices"], F.explode("latest_prices").alias("provider", "price"))
    )


def _run_log(spark: SparkSession, sf: str) -> DataFrame:
    return summary.run_log(fx.offers(spark, sf), fx.snapshots(spark, sf)).drop("errors")


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    payloads, path = fx.payloads(spark, sf), new_path(spark, "landed")
    tables.land_payloads(payloads, path)
    return tables.read_payloads(spark, path, payloads.schema)


def _collect_log(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed(spark, sf)
    log = ingest.collect_log(landed, save(ingest.collect_run(landed), "offers"))
    return _no_zone(log.withColumn("errors", F.array_join("errors", ",")))


def _collect_run(spark: SparkSession, sf: str) -> DataFrame:
    return _no_zone(ingest.collect_run(_landed(spark, sf)).select(*OFFER_VALUES))


def _stored_run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Payloads landed, collected, appended and logged; the tables as a later reader finds them."""
    landed, offers_at, runs_at = _landed(spark, sf), new_path(spark, "offers"), new_path(spark, "runs")
    tables.append_offers(ingest.collect_run(landed), offers_at)
    offers = tables.read_offers(spark, offers_at)
    tables.append_snapshots(ingest.collect_log(landed, offers), runs_at)
    return offers, tables.read_snapshots(spark, runs_at)


def _pipeline_windows(spark: SparkSession, sf: str) -> DataFrame:
    return scores.provider_windows(*_stored_run(spark, sf))


def _pipeline_offer_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Every window with how many different ids there are: as many as rows, and none null."""
    found = summary.offer_windows(_stored_run(spark, sf)[0])
    return _no_zone(found.withColumn("window_ids", found.agg(F.countDistinct("window_id")).scalar()).drop("window_id"))


def _first_source(spark: SparkSession, sf: str) -> DataFrame:
    landed = save(fx.payloads(spark, sf).filter(F.col("provider") == "spheron"), "landed")
    rows = ingest.list_price_rows(landed)
    source = F.get_json_object("extra_json", "$.source")
    return _no_zone(rows.groupBy("snapshot_id", source.alias("source")).agg(F.count("*").alias("rows")))


def _static_prices(spark: SparkSession, sf: str) -> DataFrame:
    landed = fx.empty_price_payloads(spark, sf)
    runs = landed.select("snapshot_id", "captured_at").distinct()
    return _no_zone(ingest.ingest_static_prices(runs).select(*OFFER_VALUES))


def _names(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of the fixture names and of part names, which hit the fall-through."""
    raw = fx.offers(spark, sf).select("gpu_name_raw").distinct()
    parts = fx.table(spark, sf, "part").select(F.col("p_name").alias("gpu_name_raw")).distinct()
    both = raw.unionByName(parts).distinct()
    return both.select("gpu_name_raw", canonical_gpu_name(F.col("gpu_name_raw")).alias("gpu_name"))


SIZE_TEXT = """CASE event_id % 8 WHEN 0 THEN '80Gi' WHEN 1 THEN ' 24g ' WHEN 2 THEN '16384Mi' WHEN 3 THEN '512M'
    WHEN 4 THEN 'n/a' WHEN 5 THEN '48 GB' WHEN 6 THEN '' ELSE CAST(user_id AS STRING) || 'Gi' END"""


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = fx.table(spark, sf, "events").select("event_id", F.expr(SIZE_TEXT).alias("size"))
    return sizes.withColumn("gb", settled_round(parse_size_gb(F.col("size")), 6))


def _attributes(spark: SparkSession, sf: str) -> DataFrame:
    items = fx.provider_payloads(spark, sf)
    return ingest.ingest_provider_list(items).select("offer_id", "geography", "inet_down_mbps", "inet_up_mbps")


def _deep_find(spark: SparkSession, sf: str) -> DataFrame:
    """The event's own value, nested at a depth that varies with the event."""
    events = fx.table(spark, sf, "events")
    target = F.struct(F.col("user_id").alias("k"))
    wrapped = F.when(
        F.col("event_id") % 3 == 0, F.to_json(F.struct(F.lit(1).alias("a"), F.array(F.struct(target.alias("in"))).alias("b")))
    ).when(F.col("event_id") % 3 == 1, F.to_json(target)).otherwise(F.col("props"))
    return events.select("event_id", deep_find("k")(wrapped).alias("found"))


def _snapshot_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").select("event_id", ingest.make_snapshot_id(F.col("ts")).alias("snapshot_id"))


def _append_offers(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "offers")
    offers = fx.offers(spark, sf)
    tables.append_offers(offers.filter(F.col("interruptible") == 1), path)
    tables.append_offers(offers.filter(F.col("interruptible") == 0), path)
    return tables.read_offers(spark, path, offers.schema)


def _window_file(spark: SparkSession, sf: str) -> DataFrame:
    """Provider windows written as JSON and read back."""
    path = new_path(spark, "provider-windows")
    windows = _windows(spark, sf)
    tables.write_json(windows, path)
    return tables.read_json(spark, path, windows.schema)


def _spot_prices(spark: SparkSession, sf: str) -> DataFrame:
    points = replay.spot_prices(fx.spot_lines(spark, sf))
    return _no_zone(points.select("az", "instance_type", "price", "ts", "seq"))


def _spot_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives read in small splits, so that several tasks read each."""
    lines = tables.read_spot_lines(spark, fx.spot_archives(spark, sf), fx.ARCHIVE_SPLIT)
    return _no_zone(replay.spot_prices(lines).select("az", "instance_type", "price", "ts"))


def _gpu_points(spark: SparkSession, sf: str) -> DataFrame:
    return replay.gpu_instance_filter(fx.spot_history(spark, sf)).select("az", "instance_type", "price", "ts", "seq")


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return replay.keep_gpu_points(fx.spot_history(spark, sf))


def _replay(max_starts: int | None = None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(replay.replay_jobs(_points(spark, sf), JOB_BUDGET, JOB_HOURS, max_starts=max_starts).drop("az"), 4)

    return query


def _replay_summary(compat: bool, gpu_type: str | None = None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        points = replay.keep_gpu_points(fx.spot_history(spark, sf), gpu_type)
        return _rounded(replay.replay_summary(points, JOB_BUDGET, JOB_HOURS, compat=compat), 4)

    return query


def _hourly_table(spark: SparkSession, sf: str) -> DataFrame:
    return save(series.hourly_series(fx.offers(spark, sf)), "hourly")


def _forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.forecast_windows(_hourly_table(spark, sf), GENERATED_AT)


def _listed(windows: DataFrame) -> DataFrame:
    return _no_zone(windows.withColumn("top_features", F.array_join("top_features", ",")))


def _forecast_series(spark: SparkSession, sf: str) -> DataFrame:
    found = serving.forecast_series(_forecasts(spark, sf), FOCUS_GPU)
    return _no_zone(found.select("provider", F.explode("points").alias("p")).select("provider", "p.*"))


def _focus(spark: SparkSession, sf: str) -> DataFrame:
    return series.of_gpu(series.hourly_series(fx.offers(spark, sf)), FOCUS_GPU)


def _supply(spark: SparkSession, sf: str) -> DataFrame:
    """Counts known only for every third hour."""
    hourly = series.hourly_series(fx.offers(spark, sf))
    return series.align_supply(hourly, hourly.filter(F.hour("captured_at") % 3 == 0))


def _alert_count(spark: SparkSession, sf: str) -> DataFrame:
    found = series.spread_analysis(series.hourly_series(fx.offers(spark, sf)))
    return found.agg(F.count("*").alias("gpu_classes"), F.count_if("spread_alert").alias("alerts"))


def _as_of_two_days_on(spark: SparkSession, sf: str) -> Column:
    latest = fx.offers(spark, sf).agg(F.max("captured_at")).scalar()
    return latest + F.expr("INTERVAL '24' HOUR")


def _price_matrix_late(spark: SparkSession, sf: str) -> DataFrame:
    """A day after the last capture only the wider look-back has rows."""
    return serving.price_matrix(fx.offers(spark, sf), _as_of_two_days_on(spark, sf))


def _stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    found = streams.alerts(spark, sf)
    return found.select(*[c for c in found.columns if c != "prices"], F.explode("prices").alias("provider", "price"))


def queries() -> dict[str, Query]:
    return {
        "price_summary": _over_offers(summary.price_summary),
        "gpu_history": _over_offers(summary.gpu_history, gpu=GPU_PATTERN),
        "gpu_history_newest": _over_offers(summary.gpu_history, gpu=GPU_PATTERN, limit=100),
        "cheapest_offers": lambda s, d: summary.cheapest_offers(fx.offers_by_run(s, d), MIN_VRAM),
        "budget_windows": _over_offers(summary.budget_windows, budget=BUDGET),
        "price_volatility": _over_offers(summary.price_volatility),
        "offer_windows": _over_offers(summary.offer_windows),
        "offer_windows_newest": _over_offers(summary.offer_windows, limit=5000),
        "db_stats": _with_runs(summary.db_stats),
        "price_stats": _over_offers(scores.price_stats),
        "availability_score": _with_runs(scores.availability_score),
        "interruption_probability": _over_offers(scores.interruption_probability),
        "provider_windows": _windows,
        "provider_windows_filtered": _with_runs(scores.provider_windows, budget=WINDOW_BUDGET, min_vram=MIN_VRAM),
        "provider_windows_file": _window_file,
        "snapshot_summary": _over_offers(summary.snapshot_summary, snapshot_id=ONE_RUN),
        "latest_snapshot": _with_runs(summary.latest_snapshot),
        "run_log": _run_log,
        "run_report": lambda s, d: summary.run_report(fx.offers(s, d), fx.snapshots(s, d)).withColumn("errors", F.array_join("errors", ",")),
        "stats_overview": _over_offers(summary.stats_overview),
        "provider_coverage": _over_offers(summary.provider_coverage),
        "cheapest_by_provider": _over_offers(summary.cheapest_by_provider),
        "cheapest_per_provider": _over_offers(summary.cheapest_by_provider, limit=3),
        "cheapest_by_provider_first": _over_offers(summary.cheapest_by_provider, per_provider=False, limit=15),
        "dataset_stats": _over_offers(summary.dataset_stats),
        "price_comparison": _price_comparison,
        "volatility_rollup": _volatility_rollup,
        "forecast_lookup": lambda s, d: _listed(serving.forecast_lookup(_forecasts(s, d))),
        "spread_alerts": _spread_alerts,
        "budget_options": _over_windows(serving.budget_options, budget=WINDOW_BUDGET),
        "budget_cost": _over_windows(serving.budget_cost, budget=WINDOW_BUDGET, hours=8),
        "volatility_band": _over_windows(serving.volatility_bands),
        "price_matrix": _over_offers(serving.price_matrix),
        "price_matrix_all": _over_offers(serving.price_matrix, limit=None, providers=["vast", "runpod", "akash", "spheron", "other"]),
        "price_matrix_late": _price_matrix_late,
        "forecast_series": _forecast_series,
        "ingest_marketplace": _ingested(ingest.ingest_marketplace, fx.marketplace_payloads),
        "ingest_gpu_types": _ingested(ingest.ingest_gpu_types, fx.gpu_type_payloads),
        "ingest_monthly_prices": _ingested(ingest.ingest_monthly_prices, fx.monthly_payloads),
        "ingest_provider_list": _ingested(ingest.ingest_provider_list, fx.provider_payloads),
        "ingest_price_list": _ingested(ingest.ingest_price_list, fx.price_list_payloads),
        "ingest_price_page": _ingested(ingest.ingest_price_page, fx.web_pages),
        "ingest_static_prices": _static_prices,
        "first_nonempty_source": _first_source,
        "canonical_gpu_name": _names,
        "parse_size_gb": _sizes,
        "attribute_lookup": _attributes,
        "deep_find": _deep_find,
        "collect_run": _collect_run,
        "collect_log": _collect_log,
        "pipeline_windows": _pipeline_windows,
        "pipeline_offer_windows": _pipeline_offer_windows,
        "make_snapshot_id": _snapshot_ids,
        "append_offers": _append_offers,
        "spot_prices": _spot_prices,
        "spot_archives": _spot_archives,
        "gpu_instance_filter": _gpu_points,
        "densest_zone": lambda s, d: replay.densest_zone(_points(s, d)),
        "spot_replay": _replay(),
        "spot_replay_sampled": _replay(max_starts=200),
        "replay_summary": _replay_summary(True),
        "replay_all_types": _replay_summary(False),
        "gpu_types": lambda s, d: replay.gpu_types(fx.spot_history(s, d)),
        "hourly_series": lambda s, d: series.hourly_series(fx.offers(s, d)),
        "decompose": lambda s, d: _rounded(series.decompose_summary(series.hourly_series(fx.offers(s, d)))),
        "decompose_points": lambda s, d: _rounded(series.decompose_points(series.hourly_series(fx.offers(s, d)))),
        "price_features": lambda s, d: _rounded(series.price_features(series.hourly_series(fx.offers(s, d)))),
        "forecast_24h": lambda s, d: _no_zone(_rounded(forecast.forecast_24h(_hourly_table(s, d)))),
        "feature_importance": lambda s, d: forecast.feature_importance(forecast.fit_models(_hourly_table(s, d))),
        "training_rows": _over_hourly(series.training_rows),
        "availability_6h": _over_hourly(series.availability_6h),
        "spread_analysis": _spread_analysis,
        "forecast_windows": lambda s, d: _listed(_forecasts(s, d)),
        "series_overview": _over_hourly(series.series_overview),
        "supply_alignment": _supply,
        "gpu_forecast": lambda s, d: _no_zone(_rounded(forecast.forecast_24h(_focus(s, d)))),
        "gpu_decompose": lambda s, d: _rounded(series.decompose_summary(_focus(s, d))),
        "gpu_availability": lambda s, d: series.availability_6h(_focus(s, d)),
        "spread_alert_count": _alert_count,
        "stream_ingest": lambda s, d: _no_zone(streams.ingest(s, d).select(*OFFER_VALUES)),
        "stream_hourly_series": lambda s, d: _no_zone(streams.hourly_series(s, d)),
        "stream_alerts": _stream_alerts,
    }
