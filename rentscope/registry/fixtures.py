"""Offers, runs, price history and landed payloads derived from the driver tables.

The SQL texts run unchanged in Spark and DuckDB, so queries and reference SQL share them.
Payload pages hold at most 100 items each, like a marketplace page.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.operators.ingest import make_snapshot_id
from rentscope.plans.saved import new_path
from rentscope.session import use_utc
from rentscope.sources import archives

# Fixed value: items per marketplace page.
PAGE_ITEMS = 100
#: Bytes of text in a frame of the made archives, and compressed bytes that a task reads of them.
ARCHIVE_FRAME, ARCHIVE_SPLIT = 8_192, 4_096

PROVIDER = """CASE event_type WHEN 'click' THEN 'vast' WHEN 'view' THEN 'runpod'
       WHEN 'purchase' THEN 'spheron' WHEN 'error' THEN 'akash' ELSE 'other' END"""

RAW_NAME = """CASE user_id % 8 WHEN 0 THEN 'NVIDIA H100 SXM5 80GB' WHEN 1 THEN 'NVIDIA H100 PCIe'
       WHEN 2 THEN 'GeForce RTX 4090' WHEN 3 THEN 'RTX A4000' WHEN 4 THEN 'RTX A6000'
       WHEN 5 THEN 'Tesla V100-PCIE-16GB' WHEN 6 THEN 'A100-SXM4-80GB' ELSE 'NVIDIA GH200' END"""

LABEL = """CASE user_id % 8 WHEN 0 THEN 'H100_SXM' WHEN 1 THEN 'H100_PCIE' WHEN 2 THEN 'RTX_4090'
       WHEN 3 THEN 'A40' WHEN 4 THEN 'RTX_A6000' WHEN 5 THEN 'V100'
       WHEN 6 THEN 'A100_80GB' ELSE 'H200' END"""

OFFERS_SQL = f"""
SELECT event_id AS id,
  CAST(date_trunc('hour', ts) AS STRING) AS snapshot_id,
  ts AS captured_at,
  {PROVIDER} AS provider,
  CAST(event_id AS STRING) AS offer_id,
  {LABEL} AS gpu_name,
  {RAW_NAME} AS gpu_name_raw,
  CAST(1 + event_id % 8 AS INTEGER) AS gpu_count,
  CASE WHEN event_type = 'error' THEN NULL
       ELSE CAST(16 * (1 + user_id % 8) AS DOUBLE) END AS vram_gb,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 50.0 END AS price_per_gpu_hr,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 50.0 * (1 + event_id % 8) END AS price_total_hr,
  CAST(CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS interruptible,
  CASE WHEN event_type = 'view' THEN NULL
       ELSE CAST(event_id % 10 AS DOUBLE) / 10.0 END AS reliability_score,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'geo' || CAST(user_id % 5 AS STRING) END AS geography
FROM events
"""

SNAPSHOTS_SQL = """
SELECT CAST(date_trunc('hour', ts) AS STRING) AS snapshot_id,
  MIN(ts) AS started_at,
  CASE WHEN MIN(event_id) % 29 = 0 THEN NULL ELSE MAX(ts) END AS finished_at
FROM events GROUP BY CAST(date_trunc('hour', ts) AS STRING)
"""

SPOT_SQL = """
SELECT 'az' || CAST(user_id % 3 AS STRING) AS az,
  CASE event_type WHEN 'click' THEN 'g5.xlarge' WHEN 'view' THEN 'p3.2xlarge'
       WHEN 'purchase' THEN 'g4dn.xlarge' WHEN 'error' THEN 'm5.large' ELSE 'g6.xlarge' END AS instance_type,
  CASE WHEN event_id % 11 = 0 THEN 'Windows' WHEN event_id % 13 = 0 THEN '' ELSE 'Linux/UNIX' END AS product,
  value / 50.0 AS price, ts, '' AS file, event_id AS seq
FROM events
"""

# Items of the payloads, one per event; gaps and zeros exercise the readers' defaults.
MARKET_ITEMS_SQL = f"""
SELECT event_id, ts, CAST(event_id AS STRING) AS id,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE {RAW_NAME} END AS gpu_name,
  CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN NULL ELSE 1 + event_id % 8 END AS num_gpus,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(16384 * (1 + user_id % 8) AS DOUBLE) END AS gpu_ram,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value / 50.0 END AS dph_total,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(event_id % 10 AS DOUBLE) / 10.0 END AS reliability2,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'geo' || CAST(user_id % 5 AS STRING) END AS geolocation,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 1000 AS DOUBLE) END AS inet_down,
  user_id AS machine_id, event_id % 2 = 0 AS verified
FROM events WHERE event_type IN ('click', 'signup')
"""

GPU_TYPE_ITEMS_SQL = f"""
SELECT event_id, ts, 'id' || CAST(event_id AS STRING) AS id,
  CASE WHEN event_id % 31 = 0 THEN '' ELSE {RAW_NAME} END AS display_name,
  CAST(16 * (1 + user_id % 8) AS DOUBLE) AS memory_gb,
  event_id % 2 = 0 AS secure_cloud,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 50.0 END AS bid,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 25.0 END AS on_demand
FROM events WHERE event_type = 'view'
"""

MONTHLY_ITEMS_SQL = f"""
SELECT event_id, ts, {RAW_NAME} AS gpu,
  CASE event_id % 5 WHEN 0 THEN '80Gi' WHEN 1 THEN '24G' WHEN 2 THEN '16384Mi' WHEN 3 THEN 'n/a' ELSE '48 GB' END AS ram,
  CASE WHEN event_id % 3 = 0 THEN 'PCIe' ELSE 'SXM4' END AS interface,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS low,
  CASE WHEN event_id % 11 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 7 = 0 THEN NULL ELSE value * 2 END AS mid
FROM events WHERE event_type = 'error'
"""

PROVIDER_ITEMS_SQL = f"""
SELECT event_id, ts, 'akash1' || CAST(1000000000000 + event_id AS STRING) AS owner,
  CAST(event_id % 100 AS DOUBLE) AS uptime, 'region' || CAST(user_id % 4 AS STRING) AS region,
  CAST(event_id % 9 AS INTEGER) AS lease_count, {RAW_NAME} AS attr_model,
  CASE WHEN event_id % 4 = 0 THEN '' WHEN event_id % 4 = 1 THEN {RAW_NAME} ELSE 'T4' END AS cap_model,
  CASE WHEN event_id % 3 = 0 THEN 'Country' ELSE 'tier' END AS place_key, 'geo' || CAST(user_id % 5 AS STRING) AS place,
  CASE WHEN event_id % 5 = 0 THEN 'fast' ELSE CAST(event_id % 1000 AS STRING) END AS speed,
  CASE WHEN event_id % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE value END AS monthly
FROM events WHERE event_type = 'error'
"""

PRICE_ITEMS_SQL = f"""
SELECT event_id, ts, extract(hour FROM ts) % 3 AS kind,
  CASE WHEN event_id % 2 = 0 THEN {RAW_NAME} ELSE NULL END AS name, {RAW_NAME} AS gpu,
  CASE WHEN event_id % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE value / 50.0 END AS on_demand_price,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 40.0 END AS hourly_price,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 100.0 END AS spot_price,
  CASE WHEN event_id % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(16 * (1 + user_id % 8) AS DOUBLE) END AS vram,
  CAST(80 AS DOUBLE) AS memory_gb
FROM events WHERE event_type = 'purchase'
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, OFFERS_SQL)


def offers_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers stamped with the start of their run, as one collection does."""
    return offers(spark, sf_dir).withColumn(
        "captured_at", F.date_trunc("hour", "captured_at").cast("timestamp_ntz")
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SNAPSHOTS_SQL)


def spot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SPOT_SQL)


def spot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history as archive lines; some are cut short or have half a time, some carry a sixth field."""
    seq = F.col("seq")
    line = F.concat_ws(
        "\t", "az", "instance_type", "product",
        F.when(seq % 101 == 0, "n/a").otherwise(F.col("price").cast("string")),
        F.when(seq % 109 == 0, "10:00:00").when(seq % 113 == 0, "2024-03").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
    )
    short = F.concat_ws("\t", "az", "instance_type", "product")
    value = F.when(seq % 103 == 0, short).when(seq % 107 == 0, F.concat(line, F.lit("\textra"))).otherwise(line)
    return spot_history(spark, sf_dir).select(value.alias("value"), "file", "seq")


def spot_archives(spark: SparkSession, sf_dir: str) -> str:
    """The same lines as archives in the shared folder: a pattern of their paths.

    Lines lie in four archives by their order, the first of one frame and the others of many.
    """
    folder = new_path(spark, "spot-archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (f"{line}\n".encode() for batch in batches for line in batch.column(0).to_pylist())
        first = next(lines, None)
        if first is not None:
            part = TaskContext.get().partitionId()
            store, name = archives.open_store(folder)
            store.create_dir(name, recursive=True)
            # A task that runs again writes the same name and bytes.
            n = archives.write_frames(itertools.chain([first], lines), f"{folder}/{part}.tsv.zst", ARCHIVE_FRAME if part else 1 << 40)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n_frames"])

    dealt = spot_lines(spark, sf_dir).repartitionByRange(4, "seq").sortWithinPartitions("seq").select("value")
    dealt.mapInArrow(write, "n_frames long").agg(F.sum("n_frames")).collect()
    return f"{folder}/*.tsv.zst"


# Keys whose numbers come as quoted texts on every third page.
QUOTED = (
    "dph_total|num_gpus|gpu_ram|reliability2|inet_down|memoryInGb|minimumBidPrice|uninterruptablePrice|min|avg|uptime|gpu|"
    "onDemandPrice|hourlyPrice|spotPrice|vram|memoryGb|memory|price"
)


def _some_quoted(payload: Column, page: Column) -> Column:
    quoted = F.regexp_replace(payload, rf'"({QUOTED})":(-?[0-9][0-9.eE+-]*)', '"$1":"$2"')
    return F.when(page % 3 == 0, quoted).otherwise(payload)


def _pages(items: DataFrame, source: str, provider: str, item: Column, wrap) -> DataFrame:
    """Items of one run in pages of at most 100, as JSON bodies.

    Pages are cut by row position, so that a run or a repeated event of any size stays in
    many small pages.
    """
    run_at = F.date_trunc("hour", "ts")
    page = F.floor(F.monotonically_increasing_id() / PAGE_ITEMS)
    return (
        items.withColumn("page", page)
        .groupBy(run_at.alias("captured_at"), "page")
        .agg(F.collect_list(item).alias("items"))
        .select(
            make_snapshot_id(F.col("captured_at")).alias("snapshot_id"),
            "captured_at",
            F.lit(provider).alias("provider"),
            F.lit(source).alias("source"),
            _some_quoted(wrap(F.col("items")), F.col("page")).alias("payload"),
        )
    )


def marketplace_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        "id", "gpu_name", "num_gpus", "gpu_ram", "dph_total", "reliability2", "geolocation", "inet_down",
        "machine_id", "verified",
    )
    return _pages(
        _view(spark, sf_dir, MARKET_ITEMS_SQL), "marketplace", "vast", item,
        lambda items: F.to_json(F.struct(items.alias("offers"))),
    )


def gpu_type_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowest = F.struct(F.col("bid").alias("minimumBidPrice"), F.col("on_demand").alias("uninterruptablePrice"))
    item = F.struct(
        "id", F.col("display_name").alias("displayName"), F.col("memory_gb").alias("memoryInGb"),
        F.col("secure_cloud").alias("secureCloud"), lowest.alias("lowestPrice"),
    )
    return _pages(
        _view(spark, sf_dir, GPU_TYPE_ITEMS_SQL), "gpu_types", "runpod", item,
        lambda items: F.to_json(F.struct(F.struct(items.alias("gpuTypes")).alias("data"))),
    )


def monthly_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.struct(F.col("low").alias("min"), F.col("mid").alias("avg"))
    item = F.struct("gpu", "ram", "interface", price.alias("price"))
    return _pages(
        _view(spark, sf_dir, MONTHLY_ITEMS_SQL), "monthly_prices", "akash", item, F.to_json
    )


def provider_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even pages as an object, odd ones as a bare array."""

    def attr(key: Column, value: str) -> Column:
        return F.struct(key.alias("key"), F.col(value).alias("value"))

    attrs = F.array(
        attr(F.lit("capabilities/GPU/vendor/model"), "attr_model"),
        attr(F.col("place_key"), "place"),
        attr(F.lit("Network-Speed-Down"), "speed"),
    )
    models = F.array(F.struct(F.col("cap_model").alias("model")))
    item = F.struct(
        "owner", "uptime", "region", F.col("lease_count").alias("leaseCount"), attrs.alias("attributes"),
        F.struct(F.struct(models.alias("models")).alias("gpu")).alias("capabilities"),
        F.struct(F.col("monthly").alias("gpu")).alias("pricing"),
    )
    return _pages(
        _view(spark, sf_dir, PROVIDER_ITEMS_SQL), "provider_list", "akash", item,
        lambda items: F.when(F.col("page") % 2 == 0, F.to_json(F.struct(items.alias("providers")))).otherwise(
            F.to_json(items)
        ),
    )


def _price_item() -> Column:
    return F.struct(
        "name", "gpu", F.col("on_demand_price").alias("onDemandPrice"), F.col("hourly_price").alias("hourlyPrice"),
        F.col("spot_price").alias("spotPrice"), "vram", F.col("memory_gb").alias("memoryGb"),
        F.col("memory_gb").alias("memory"),
    )


def price_list_payloads(spark: SparkSession, sf_dir: str, where: str = "TRUE") -> DataFrame:
    """Answers of the price service; in ``payloads`` it answers only in every third hour."""
    items = _view(spark, sf_dir, PRICE_ITEMS_SQL).filter(where)
    return _pages(
        items, "price_list", "spheron", _price_item(), lambda items: F.to_json(F.struct(items.alias("gpus")))
    )


def _page_html(body: Column, data: Column) -> Column:
    script = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>"))
    return F.concat(body, script)


def price_page_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web page has prices in the first two of three hours, below some nesting."""
    items = _view(spark, sf_dir, PRICE_ITEMS_SQL).filter("kind <= 1")

    def wrap(prices: Column) -> Column:
        nested = F.struct(F.struct(F.struct(prices.alias("gpus")).alias("pageProps")).alias("props"))
        return _page_html(F.lit("<html><script>track(0);</script>"), F.to_json(nested))

    return _pages(items, "price_page", "spheron", _price_item(), wrap)


def empty_price_payloads(spark: SparkSession, sf_dir: str, where: str = "TRUE") -> DataFrame:
    """What is landed when the service is down: an answer that is no JSON."""
    items = _view(spark, sf_dir, PRICE_ITEMS_SQL).filter(where)
    return _pages(items, "price_list", "spheron", F.col("event_id"), lambda items: F.lit("<h1>502</h1>"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [marketplace_payloads, gpu_type_payloads, monthly_payloads, provider_payloads, price_page_payloads]
    landed = [p(spark, sf_dir) for p in parts]
    landed += [price_list_payloads(spark, sf_dir, "kind = 0"), empty_price_payloads(spark, sf_dir, "kind = 2")]
    return reduce(DataFrame.unionByName, landed)


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as landed price pages: two thirds carry a price list in a script block."""
    page = F.col("page_id")
    item = F.struct(
        F.concat(F.lit("GPU "), (page % 7).cast("string")).alias("model"),
        ((page % 50 + 1) / F.lit(10.0)).alias("price"),
        F.when(page % 4 == 0, 0.0).otherwise((page % 50 + 1) / F.lit(20.0)).alias("spotPrice"),
        (page % 9 * 8).cast("double").alias("memory"),
    )
    prices = F.array(item)
    nothing = F.from_json(F.lit("[]"), "array<int>")
    first = F.struct(
        F.struct(F.lit(1).alias("other"), nothing.alias("gpuPricing")).alias("a"),
        F.array(F.struct(prices.alias("gpus"))).alias("b"),
    )
    second = F.struct(F.struct(F.struct(prices.alias("pricing")).alias("deep")).alias("a"))
    html = (
        F.when(page % 3 == 1, _page_html(F.col("html"), F.to_json(first)))
        .when(page % 3 == 2, _page_html(F.col("html"), F.to_json(second)))
        .otherwise(F.col("html"))
    )
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page_"), page.cast("string")).alias("snapshot_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("captured_at"),
        F.lit("spheron").alias("provider"),
        F.lit("price_page").alias("source"),
        html.alias("payload"),
    )
