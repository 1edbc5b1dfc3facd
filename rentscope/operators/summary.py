"""Grouped reports over the offers table and the run log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.functions.scalars import settled_round, spot_only
from rentscope.plans.recency import DAY, captured_since, latest_capture, within_hours

PRICE = "price_per_gpu_hr"

# Providers with a count column of their own in the run log.
LOGGED_PROVIDERS = ["vast", "runpod", "akash", "spheron"]

# Fixed value: rows of the list of cheapest offers, a top-k view.
CHEAPEST_ROWS = 30

# Scheduler window defaults.
P90_MARKUP = 1.25
DEFAULT_AVAILABILITY = 0.6
SPOT_INTERRUPTION = 0.15
ON_DEMAND_INTERRUPTION = 0.02

MIN_VOLATILITY_SNAPSHOTS = 3


def _money(c: Column) -> Column:
    return settled_round(c, 4)


def _first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def price_summary(offers: DataFrame) -> DataFrame:
    """All-time price landscape per provider and GPU."""
    price = F.col(PRICE)
    return (
        offers.groupBy("provider", "gpu_name")
        .agg(
            F.countDistinct("snapshot_id").alias("snapshots_seen"),
            F.count("*").alias("total_offers"),
            _money(F.min(price)).alias("all_time_min"),
            _money(F.avg(price)).alias("all_time_avg"),
            _money(F.max(price)).alias("all_time_max"),
            _money(F.avg(spot_only(price))).alias("avg_spot_price"),
            _money(F.avg(F.when(F.col("interruptible") == 0, price))).alias("avg_ondemand_price"),
            F.min("captured_at").alias("first_seen"),
            F.max("captured_at").alias("last_seen"),
        )
        .orderBy("gpu_name", "provider")
    )


def gpu_history(offers: DataFrame, gpu: str, limit: int | None = None) -> DataFrame:
    """Daily prices per provider of the GPUs whose label contains ``gpu`` (LIKE wildcards apply).

    All days, newest first; ``limit`` keeps the newest rows.
    """
    history = (
        offers.filter(F.col("gpu_name").ilike(f"%{gpu}%"))
        .groupBy(F.to_date("captured_at").alias("day"), "provider")
        .agg(
            F.max("captured_at").alias("captured_at"),
            F.count("*").alias("offers"),
            _money(F.min(PRICE)).alias("min_price"),
            _money(F.avg(PRICE)).alias("avg_price"),
            _money(F.max(PRICE)).alias("max_price"),
        )
        .orderBy(F.desc("captured_at"), "provider")
    )
    return _first_rows(history, limit).drop("day")


def cheapest_offers(offers: DataFrame, min_vram: float = 0.0, limit: int | None = CHEAPEST_ROWS) -> DataFrame:
    """Cheapest offers of the latest capture with enough memory."""
    ranked = (
        captured_since(offers, latest_capture(offers))
        .filter(F.col("vram_gb") >= min_vram)
        .orderBy(F.asc_nulls_first(PRICE), "id")
    )
    return (
        _first_rows(ranked, limit)
        .select(
            "provider", "gpu_name", "gpu_name_raw", "gpu_count", "vram_gb", PRICE, "price_total_hr",
            "interruptible", "reliability_score", "geography", "captured_at",
        )
    )


def budget_windows(offers: DataFrame, budget: float) -> DataFrame:
    """Spot offers at or under a bid, per provider and GPU."""
    return (
        offers.filter((F.col(PRICE) <= budget) & (F.col("interruptible") == 1))
        .groupBy("provider", "gpu_name")
        .agg(
            F.count("*").alias("qualifying_offers"),
            F.countDistinct(F.to_date("captured_at")).alias("days_with_offers"),
            _money(F.min(PRICE)).alias("cheapest_seen"),
            _money(F.avg(PRICE)).alias("avg_when_cheap"),
            F.min("captured_at").alias("first_window"),
            F.max("captured_at").alias("last_window"),
        )
        .orderBy(F.desc("qualifying_offers"), "provider", "gpu_name")
    )


def price_volatility(offers: DataFrame) -> DataFrame:
    """Spread of spot prices per provider and GPU seen in at least three runs."""
    return (
        offers.filter(F.col("interruptible") == 1)
        .groupBy("provider", "gpu_name")
        .agg(
            F.countDistinct("snapshot_id").alias("snapshots"),
            _money(F.avg(PRICE)).alias("mean_price"),
            _money(F.coalesce(F.stddev_pop(PRICE), F.lit(0.0))).alias("std_dev"),
            _money(F.min(PRICE)).alias("p0"),
            _money(F.max(PRICE)).alias("p100"),
        )
        .filter(F.col("snapshots") >= MIN_VOLATILITY_SNAPSHOTS)
        .orderBy(F.desc("std_dev"), "provider", "gpu_name")
    )


def offer_windows(offers: DataFrame, limit: int | None = None) -> DataFrame:
    """Offers as scheduler windows, newest first: all of them, or the newest ``limit``."""
    price = F.col(PRICE)
    listed = offers.select("id", "snapshot_id", "provider", "gpu_name", "captured_at", PRICE, "reliability_score", "interruptible")
    newest = _first_rows(listed.orderBy(F.desc("captured_at"), F.desc("id")), limit)
    return newest.select(
        F.concat(
            "snapshot_id", F.lit("_"), "provider", F.lit("_"), "gpu_name", F.lit("_"), F.col("id").cast("string")
        ).alias("window_id"),
        "provider",
        F.col("gpu_name").alias("gpu_class"),
        F.col("captured_at").alias("start_time"),
        price.alias("price_per_gpu_hour_p50"),
        settled_round(F.coalesce(price, F.lit(0.0)) * P90_MARKUP, 6).alias("price_per_gpu_hour_p90"),
        F.coalesce(F.nullif(F.col("reliability_score"), F.lit(0.0)), F.lit(DEFAULT_AVAILABILITY)).alias(
            "availability_probability"
        ),
        F.when(F.coalesce(F.col("interruptible"), F.lit(0)) != 0, SPOT_INTERRUPTION)
        .otherwise(ON_DEMAND_INTERRUPTION)
        .alias("interruption_probability"),
    )


def db_stats(offers: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Row counts and the first and last run start."""
    return snapshots.agg(
        F.count("*").alias("total_snapshots"),
        F.min("started_at").alias("oldest_snapshot"),
        F.max("started_at").alias("latest_snapshot"),
    ).withColumn("total_offers", offers.agg(F.count("*")).scalar())


def latest_run_id(snapshots: DataFrame) -> Column:
    """Id of the run started last, as a scalar subquery."""
    return snapshots.agg(F.max_by("snapshot_id", F.struct("started_at", "snapshot_id"))).scalar()


def of_run(offers: DataFrame, snapshots: DataFrame | None, snapshot_id: str | Column) -> DataFrame:
    """Offers of one run. A run has one capture time, so on stored offers the run log prunes to its day."""
    wanted = snapshot_id if isinstance(snapshot_id, Column) else F.lit(snapshot_id)
    mine = F.col("snapshot_id") == wanted
    if snapshots is not None and DAY in offers.columns:
        started = snapshots.filter(mine).agg(F.max("started_at")).scalar()
        mine = (F.col(DAY) == F.to_date(started)) & mine
    return offers.filter(mine)


def snapshot_summary(offers: DataFrame, snapshot_id: str | Column, snapshots: DataFrame | None = None) -> DataFrame:
    """Offers of one run per provider and GPU; with the run log only the run's day is read."""
    return (
        of_run(offers, snapshots, snapshot_id)
        .groupBy("provider", "gpu_name")
        .agg(
            F.count("*").alias("offers"),
            _money(F.min(PRICE)).alias("min_p"),
            _money(F.avg(PRICE)).alias("avg_p"),
            _money(F.max(PRICE)).alias("max_p"),
            F.sum("interruptible").alias("spot"),
        )
        .orderBy("gpu_name", "provider")
    )


def latest_snapshot(offers: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Every offer of the run started last."""
    return of_run(offers, snapshots, latest_run_id(snapshots)).orderBy("provider", "gpu_name", PRICE, "id")


def run_log(offers: DataFrame, snapshots: DataFrame, providers: Sequence[str] = LOGGED_PROVIDERS) -> DataFrame:
    """Start, end, rows per provider and errors of each run, derived rather than updated in place.

    ``all_offers`` also counts the rows of providers without a column.
    """
    named = [f"{p}_offers" for p in providers]
    counted = offers.groupBy("snapshot_id").agg(
        *[F.count_if(F.col("provider") == p).alias(c) for p, c in zip(providers, named, strict=True)],
        F.count("*").alias("all_offers"),
    )
    errors = "errors" if "errors" in snapshots.columns else F.lit(None).cast("array<string>").alias("errors")
    return (
        snapshots.select("snapshot_id", "started_at", "finished_at", errors)
        .join(counted, "snapshot_id", "left")
        .na.fill(0, [*named, "all_offers"])
    )


def run_report(offers: DataFrame, snapshots: DataFrame, snapshot_id: str | Column | None = None) -> DataFrame:
    """Rows per provider and errors of one run, next to the table totals (default: the run started last).

    A run without rows gives one row with a null provider and a count of 0.
    """
    if snapshot_id is None:
        wanted = latest_run_id(snapshots)
    else:
        wanted = snapshot_id if isinstance(snapshot_id, Column) else F.lit(snapshot_id)
    errors = F.array_distinct(F.flatten(F.collect_list("errors"))) if "errors" in snapshots.columns else F.array().cast("array<string>")
    run = snapshots.filter(F.col("snapshot_id") == wanted).groupBy("snapshot_id").agg(
        F.coalesce(F.date_format(F.max("finished_at"), "yyyy-MM-dd HH:mm"), F.lit("")).alias("finished_at"),
        errors.alias("errors"),
    )
    counted = of_run(offers, snapshots, wanted).groupBy("snapshot_id", "provider").agg(F.count("*").alias("cnt"))
    return (
        run.join(counted, "snapshot_id", "left")
        .select("snapshot_id", "provider", F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt"), "finished_at", "errors")
        .withColumn("total_snapshots", snapshots.agg(F.count("finished_at")).scalar())
        .withColumn("total_rows", offers.agg(F.count("*")).scalar())
        .orderBy("provider")
    )


def _by_run_and_provider(offers: DataFrame) -> DataFrame:
    # One map-side combined pass; the distinct counts then run over this small frame.
    return offers.groupBy("snapshot_id", "provider").agg(
        F.count("*").alias("rows"), F.min("captured_at").alias("first"), F.max("captured_at").alias("last")
    )


def stats_overview(offers: DataFrame) -> DataFrame:
    """Runs, rows, providers and the covered dates."""
    return _by_run_and_provider(offers).agg(
        F.countDistinct("snapshot_id").alias("snapshots"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.countDistinct("provider").alias("providers"),
        F.to_date(F.min("first")).alias("since"),
        F.to_date(F.max("last")).alias("latest"),
    )


def dataset_stats(offers: DataFrame) -> DataFrame:
    """Runs, rows, providers, last update and whole days of data (at least one)."""
    days = F.floor(F.timestamp_diff("SECOND", F.min("first"), F.max("last")) / 86400) + 1
    return _by_run_and_provider(offers).agg(
        F.countDistinct("snapshot_id").alias("total_snapshots"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.countDistinct("provider").alias("providers"),
        F.max("last").alias("last_updated"),
        F.greatest(F.lit(1).cast("bigint"), days).alias("days_of_data"),
    )


def provider_coverage(offers: DataFrame, as_of: datetime | None = None, hours: int = 48) -> DataFrame:
    """GPU types and offers per provider in the last hours."""
    return (
        within_hours(offers, hours, as_of)
        .groupBy("provider", "gpu_name")
        .agg(F.count("*").alias("rows"))
        .groupBy("provider")
        .agg(F.count("gpu_name").alias("gpu_types"), F.sum("rows").alias("offers"))
        .orderBy(F.desc("offers"), "provider")
    )


def cheapest_by_provider(
    offers: DataFrame,
    as_of: datetime | None = None,
    hours: int = 48,
    limit: int | None = None,
    per_provider: bool = True,
) -> DataFrame:
    """Lowest price per provider and GPU in the last hours.

    ``limit`` keeps the cheapest GPUs of each provider, or, without ``per_provider``, the first
    rows of the whole list, which one provider can fill.
    """
    lowest = (
        within_hours(offers, hours, as_of)
        .filter(F.col(PRICE).isNotNull())
        .groupBy("provider", "gpu_name")
        .agg(_money(F.min(PRICE)).alias("min_price"))
    )
    if limit is not None and per_provider:
        rank = F.row_number().over(W.partitionBy("provider").orderBy("min_price", "gpu_name"))
        return lowest.withColumn("_rank", rank).filter(F.col("_rank") <= limit).drop("_rank")
    return _first_rows(lowest.orderBy("provider", "min_price", "gpu_name"), limit)
