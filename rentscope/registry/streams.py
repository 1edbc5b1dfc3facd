"""The streaming jobs run once over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import scores
from rentscope.plans.saved import new_path, save
from rentscope.registry import fixtures as fx
from rentscope.sources import tables
from rentscope.streaming import jobs


def _offer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers over a stream of the events files.

    The one-letter class makes the path a pattern: the file source takes a table that is a
    single file only through one.
    """
    schema = fx.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    stream = spark.sql(fx.OFFERS_SQL.replace("FROM events", "FROM {events}"), events=events)
    return stream.withColumn("captured_at", F.col("captured_at").cast("timestamp"))


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs whose payloads land in two parts: the web pages first, all other answers later."""
    payloads = save(fx.payloads(spark, sf_dir), "payloads")
    landed, offers, checkpoint = new_path(spark, "landed"), new_path(spark, "offers"), new_path(spark, "stream")
    for first in (F.col("source") == "price_page", F.col("source") != "price_page"):
        tables.land_payloads(payloads.filter(first), landed)
        jobs.stream_ingest(spark, landed, offers, checkpoint, payloads.schema).awaitTermination()
    return jobs.stored(spark, offers, schemas.OFFERS)


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, out = _offer_stream(spark, sf_dir), new_path(spark, "hourly")
    jobs.stream_hourly_series(stream, out, new_path(spark, "stream")).awaitTermination()
    return jobs.stored(spark, out, schemas.HOURLY_SERIES).select(*schemas.HOURLY_SERIES.names)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, out = new_path(spark, "prices"), new_path(spark, "alerts")
    windows = save(scores.provider_windows(fx.offers(spark, sf_dir), fx.snapshots(spark, sf_dir)), "windows")
    stream = _offer_stream(spark, sf_dir)
    jobs.stream_alerts(stream, state, windows, out, new_path(spark, "stream")).awaitTermination()
    return jobs.current_alerts(jobs.stored(spark, out, jobs.ALERT_CHANGES))
