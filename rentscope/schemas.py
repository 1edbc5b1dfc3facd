"""Declared schemas: tables, landed payloads, JSON shapes. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
TEXT, TIME, FLAG = T.StringType(), T.TimestampType(), T.BooleanType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


OFFERS = _table(
    id=LONG,
    snapshot_id=TEXT,
    captured_at=TIME,
    provider=TEXT,
    offer_id=TEXT,
    gpu_name=TEXT,
    gpu_name_raw=TEXT,
    gpu_count=INT,
    vram_gb=DOUBLE,
    price_per_gpu_hr=DOUBLE,
    price_total_hr=DOUBLE,
    interruptible=INT,
    reliability_score=DOUBLE,
    geography=TEXT,
    inet_down_mbps=DOUBLE,
    inet_up_mbps=DOUBLE,
    disk_space_gb=DOUBLE,
    gpu_utilization_pct=DOUBLE,
    extra_json=TEXT,
)

# What an ingest operator returns: an offer without its table id.
OFFER_COLUMNS = [f.name for f in OFFERS if f.name != "id"]

SNAPSHOTS = _table(
    snapshot_id=TEXT,
    started_at=TIME,
    finished_at=TIME,
    vast_offers=LONG,
    runpod_offers=LONG,
    akash_offers=LONG,
    spheron_offers=LONG,
    all_offers=LONG,
    errors=T.ArrayType(TEXT),
)

# One landed response body. `source` names its shape (see operators.ingest).
PAYLOADS = _table(
    snapshot_id=TEXT,
    captured_at=TIME,
    provider=TEXT,
    source=TEXT,
    payload=TEXT,
)

# Numbers arrive as JSON numbers or as quoted texts, so they are declared as texts and read
# with functions.scalars.to_number.
MARKETPLACE = """struct<offers:array<struct<
    id:string, gpu_name:string, num_gpus:string, gpu_ram:string, dph_total:string,
    reliability2:string, geolocation:string, inet_down:string, inet_up:string,
    disk_space:string, gpu_util:string, machine_id:bigint, cuda_max_good:double,
    compute_cap:int, verified:boolean>>>"""

GPU_TYPES = """struct<data:struct<gpuTypes:array<struct<
    id:string, displayName:string, memoryInGb:string, secureCloud:boolean, communityCloud:boolean,
    lowestPrice:struct<minimumBidPrice:string, uninterruptablePrice:string>>>>>"""

MONTHLY_PRICES = """array<struct<gpu:string, ram:string, interface:string,
    price:struct<min:string, avg:string, max:string>>>"""

PROVIDER_ITEM = """struct<owner:string, hostUri:string, uptime:string, region:string,
    leaseCount:int, isAudited:boolean, attributes:array<struct<key:string, value:string>>,
    capabilities:struct<gpu:struct<models:array<struct<model:string>>>>,
    pricing:struct<gpu:string>>"""
PROVIDER_LIST = f"struct<providers:array<{PROVIDER_ITEM}>>"
PROVIDER_ARRAY = f"array<{PROVIDER_ITEM}>"

PRICE_ITEM = """struct<name:string, gpu:string, model:string, onDemandPrice:string,
    hourlyPrice:string, price:string, spotPrice:string, interruptiblePrice:string,
    vram:string, memoryGb:string, memory:string>"""
PRICE_OBJECT = f"struct<gpus:array<{PRICE_ITEM}>>"
PRICE_ARRAY = f"array<{PRICE_ITEM}>"

SPOT_HISTORY = _table(
    az=TEXT,
    instance_type=TEXT,
    product=TEXT,
    price=DOUBLE,
    ts=TIME,
)

HOURLY_SERIES = _table(
    captured_at=TIME,
    provider=TEXT,
    gpu_name=TEXT,
    price=DOUBLE,
    offer_count=LONG,
)

PROVIDER_WINDOWS = _table(
    provider=TEXT,
    gpu_class=TEXT,
    vram_gb=DOUBLE,
    price_per_gpu_hour_p10=DOUBLE,
    price_per_gpu_hour_p50=DOUBLE,
    price_per_gpu_hour_p90=DOUBLE,
    price_volatility=DOUBLE,
    availability_probability=DOUBLE,
    interruption_probability=DOUBLE,
    n_price_samples=LONG,
)

FORECAST_WINDOWS = _table(
    provider=TEXT,
    gpu_class=TEXT,
    forecast_timestamp=TIME,
    generated_at=TIME,
    forecast_hours_ahead=INT,
    price_forecast=DOUBLE,
    price_forecast_lower=DOUBLE,
    price_forecast_upper=DOUBLE,
    last_actual_price=DOUBLE,
    price_per_gpu_hour_p10=DOUBLE,
    price_per_gpu_hour_p50=DOUBLE,
    price_per_gpu_hour_p90=DOUBLE,
    price_volatility=DOUBLE,
    availability_probability=DOUBLE,
    trend_slope_per_hour=DOUBLE,
    seasonal_strength=DOUBLE,
    predicted_offers=DOUBLE,
    n_price_samples=LONG,
    top_features=T.ArrayType(TEXT),
)

SPREAD_ALERTS = _table(
    gpu_name=TEXT,
    spread=DOUBLE,
    cheapest_provider=TEXT,
    cheapest_price=DOUBLE,
    priciest_provider=TEXT,
    priciest_price=DOUBLE,
    savings_per_100h=DOUBLE,
    prices=T.MapType(TEXT, DOUBLE),
    is_alert=FLAG,
)
