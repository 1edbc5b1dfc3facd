"""Landed provider payloads to offer rows.

Each reader takes the payload table, keeps the payloads of its own ``source`` and returns
rows with the columns of ``schemas.OFFER_COLUMNS``. All are narrow: parse, explode, project.
A payload that cannot be parsed, however it is broken, yields no rows and shows up in ``collect_log``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.functions.names import (
    attribute_number,
    attribute_place,
    parse_size_gb,
    with_gpu_name,
)
from rentscope.functions.nested import deep_find
from rentscope.functions.scalars import nonblank, nonzero, to_number
from rentscope.operators.summary import LOGGED_PROVIDERS
from rentscope.plans.saved import save

# Megabytes per gigabyte of marketplace memory, and hours per billing month.
MB_PER_GB = 1024
HOURS_PER_MONTH = 730

# What list prices do not state.
LIST_RELIABILITY = 0.99
LIST_GEOGRAPHY = "multi-region"

# Script block of a price page and the keys tried in it.
PAGE_SCRIPT = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'
PAGE_KEYS = ["gpuPricing", "gpus", "pricing"]

# Dated price table used when no live source has rows.
STATIC_SOURCE = "static_fallback_2026-04-15"
STATIC_PRICES = [
    # gpu, vram, on demand, spot
    ("RTX_4090", 24.0, 0.49, 0.20),
    ("L40S", 48.0, 0.86, 0.35),
    ("A100_80GB", 80.0, 1.07, 0.60),
    ("H100_PCIE", 80.0, 2.01, 0.80),
    ("H100_SXM", 80.0, 2.49, 1.10),
    ("H200", 141.0, 3.20, 1.45),
    ("B200", 192.0, 6.02, 2.12),
    ("B300", 288.0, 6.80, 2.45),
]

RUN = ["snapshot_id", "captured_at"]


def make_snapshot_id(started_at: Column) -> Column:
    """Run id from the start time, to the millisecond."""
    return F.date_format(started_at, "'snap_'yyyyMMdd_HHmmss_SSS")


def _of_source(payloads: DataFrame, source: str) -> DataFrame:
    return payloads.filter(F.col("source") == source)


def _side_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})


def _as_offers(rows: DataFrame, provider: str) -> DataFrame:
    """Add the label and the provider, fill absent columns with null, fix order and types."""
    named = rows if "gpu_name" in rows.columns else with_gpu_name(rows, "gpu_name_raw")
    columns = []
    for name in schemas.OFFER_COLUMNS:
        kind = schemas.OFFERS[name].dataType
        if name == "provider":
            columns.append(F.lit(provider).alias(name))
        elif name == "captured_at":
            columns.append(F.col(name))
        elif name in named.columns:
            columns.append(F.col(name).cast(kind).alias(name))
        else:
            columns.append(F.lit(None).cast(kind).alias(name))
    return named.select(*columns)


def _per_price(**priced: tuple[Column, int]) -> Column:
    """Rows for the offers of one item that have a price: suffix, price, interruptible."""
    options = F.array(
        *[
            F.struct(F.lit(suffix).alias("suffix"), price.alias("price"), F.lit(flag).alias("interruptible"))
            for suffix, (price, flag) in priced.items()
        ]
    )
    return F.explode(F.filter(options, lambda o: o["price"].isNotNull()))


def ingest_marketplace(payloads: DataFrame) -> DataFrame:
    """Marketplace listings: total price per machine, always interruptible."""
    o = F.col("o")
    zero = F.lit(0.0)

    def number(name: str) -> Column:
        return F.coalesce(to_number(o[name]), zero)

    total = number("dph_total")
    count = F.coalesce(nonzero(to_number(o["num_gpus"])).cast("int"), F.lit(1))
    listed = _of_source(payloads, "marketplace").select(
        *RUN, F.explode(F.from_json("payload", schemas.MARKETPLACE)["offers"]).alias("o")
    )
    rows = listed.select(
        *RUN,
        F.coalesce(o["id"], F.lit("")).alias("offer_id"),
        F.coalesce(o["gpu_name"], F.lit("")).alias("gpu_name_raw"),
        count.alias("gpu_count"),
        (number("gpu_ram") / MB_PER_GB).alias("vram_gb"),
        F.round(total / F.greatest(count, F.lit(1)), 6).alias("price_per_gpu_hr"),
        total.alias("price_total_hr"),
        F.lit(1).alias("interruptible"),
        number("reliability2").alias("reliability_score"),
        o["geolocation"].alias("geography"),
        number("inet_down").alias("inet_down_mbps"),
        number("inet_up").alias("inet_up_mbps"),
        number("disk_space").alias("disk_space_gb"),
        number("gpu_util").alias("gpu_utilization_pct"),
        _side_json(
            machine_id=o["machine_id"],
            cuda_vers=o["cuda_max_good"],
            compute_cap=o["compute_cap"],
            verified=o["verified"],
        ).alias("extra_json"),
    )
    return _as_offers(rows, "vast")


def ingest_gpu_types(payloads: DataFrame) -> DataFrame:
    """Price list per GPU type: a spot and an on-demand row, each only if priced."""
    g = F.col("g")
    types = _of_source(payloads, "gpu_types").select(
        *RUN, F.explode(F.from_json("payload", schemas.GPU_TYPES)["data"]["gpuTypes"]).alias("g")
    )
    priced = types.select(
        "*",
        _per_price(
            spot=(to_number(g["lowestPrice"]["minimumBidPrice"]), 1),
            ondemand=(to_number(g["lowestPrice"]["uninterruptablePrice"]), 0),
        ).alias("p"),
    )
    rows = priced.select(
        *RUN,
        F.concat(F.coalesce(g["id"], F.lit("")), F.lit("_"), F.col("p.suffix")).alias("offer_id"),
        F.coalesce(nonblank(g["displayName"]), g["id"]).alias("gpu_name_raw"),
        F.lit(1).alias("gpu_count"),
        F.coalesce(to_number(g["memoryInGb"]), F.lit(0.0)).alias("vram_gb"),
        F.col("p.price").alias("price_per_gpu_hr"),
        F.col("p.price").alias("price_total_hr"),
        F.col("p.interruptible").alias("interruptible"),
        _side_json(gpu_id=g["id"], secure_cloud=g["secureCloud"], community_cloud=g["communityCloud"]).alias(
            "extra_json"
        ),
    )
    return _as_offers(rows, "runpod")


def ingest_monthly_prices(payloads: DataFrame) -> DataFrame:
    """Monthly prices per GPU model, average before minimum, as hourly rows."""
    p = F.col("p")
    blank = F.lit("")
    low, mean, high = (to_number(p["price"][k]) for k in ("min", "avg", "max"))
    monthly = F.coalesce(nonzero(mean), low)
    models = _of_source(payloads, "monthly_prices").select(
        *RUN, F.explode(F.from_json("payload", schemas.MONTHLY_PRICES)).alias("p")
    )
    hourly = F.round(monthly / HOURS_PER_MONTH, 6)
    gpu, ram, interface = (F.coalesce(p[k], blank) for k in ("gpu", "ram", "interface"))
    rows = models.filter(monthly.isNotNull()).select(
        *RUN,
        F.concat(F.lit("akash_"), gpu, F.lit("_"), ram).alias("offer_id"),
        gpu.alias("_gpu"),
        F.trim(F.concat_ws(" ", gpu, ram, interface)).alias("gpu_name_raw"),
        F.lit(1).alias("gpu_count"),
        parse_size_gb(ram).alias("vram_gb"),
        hourly.alias("price_per_gpu_hr"),
        hourly.alias("price_total_hr"),
        F.lit(1).alias("interruptible"),
        _side_json(
            price_min_monthly=low,
            price_avg_monthly=mean,
            price_max_monthly=high,
            interface=p["interface"],
            source=F.lit("akash_console_prices"),
        ).alias("extra_json"),
    )
    return _as_offers(with_gpu_name(rows, "_gpu"), "akash")


def _array_or_field(payload: Column, array_schema: str, object_schema: str, field: str) -> Column:
    """A bare JSON array, or the array under ``field`` of an object."""
    is_array = F.ltrim(payload).startswith("[")
    return F.when(is_array, F.from_json(payload, array_schema)).otherwise(
        F.from_json(payload, object_schema)[field]
    )


def ingest_provider_list(payloads: DataFrame) -> DataFrame:
    """Providers with their attributes: one row per provider and distinct GPU model."""
    v = F.col("v")
    no_attrs = F.from_json(F.lit("[]"), "array<struct<key:string,value:string>>")
    no_models = F.from_json(F.lit("[]"), "array<struct<model:string>>")
    providers = (
        _of_source(payloads, "provider_list")
        .select(
            *RUN,
            F.explode(
                _array_or_field(F.col("payload"), schemas.PROVIDER_ARRAY, schemas.PROVIDER_LIST, "providers")
            ).alias("v"),
        )
        .withColumn("attrs", F.coalesce(v["attributes"], no_attrs))
    )
    names_model = lambda a: F.lower(a["key"]).contains("gpu") & F.lower(a["key"]).contains("model")
    from_attrs = F.transform(F.filter("attrs", names_model), lambda a: a["value"])
    from_caps = F.transform(F.coalesce(v["capabilities"]["gpu"]["models"], no_models), lambda m: m["model"])
    models = F.array_distinct(F.filter(F.concat(from_attrs, from_caps), lambda m: m != ""))
    hourly = F.round(nonzero(to_number(v["pricing"]["gpu"])) / HOURS_PER_MONTH, 6)
    # What holds for a provider is worked out once, before its models are listed, and only that is carried along.
    said = providers.select(
        *RUN,
        "v",
        "attrs",
        F.substring(F.coalesce(v["owner"], F.lit("")), 1, 16).alias("owner"),
        hourly.alias("price"),
        (F.coalesce(to_number(v["uptime"]), F.lit(0.0)) / 100).alias("reliability_score"),
        attribute_place(F.col("attrs"), v["region"]).alias("geography"),
        attribute_number(F.col("attrs"), "network-speed-down").alias("inet_down_mbps"),
        attribute_number(F.col("attrs"), "network-speed-up").alias("inet_up_mbps"),
        _side_json(
            owner=v["owner"],
            host_uri=v["hostUri"],
            active_leases=v["leaseCount"],
            audited=v["isAudited"],
            source=F.lit("akash_provider_list"),
        ).alias("extra_json"),
    )
    rows = said.select("*", F.explode(models).alias("gpu_name_raw")).select(
        *RUN,
        F.concat(F.lit("akash_prov_"), "owner", F.lit("_"), F.substring("gpu_name_raw", 1, 20)).alias("offer_id"),
        "gpu_name_raw",
        F.lit(1).alias("gpu_count"),
        F.col("price").alias("price_per_gpu_hr"),
        F.col("price").alias("price_total_hr"),
        F.lit(1).alias("interruptible"),
        "reliability_score",
        "geography",
        "inet_down_mbps",
        "inet_up_mbps",
        "extra_json",
    )
    return _as_offers(rows, "akash")


def _list_rows(items: DataFrame, source: str) -> DataFrame:
    """Rows of (run, gpu, vram, on demand, spot); prices of 0 or null give no row."""
    priced = items.select(
        "*", _per_price(od=(nonzero(F.col("on_demand")), 0), spot=(nonzero(F.col("spot")), 1)).alias("p")
    )
    rows = priced.select(
        *RUN,
        F.concat(F.lit("spheron_"), "gpu", F.lit("_"), F.col("p.suffix")).alias("offer_id"),
        F.col("gpu").alias("gpu_name_raw"),
        F.lit(1).alias("gpu_count"),
        F.coalesce("vram", F.lit(0.0)).alias("vram_gb"),
        F.col("p.price").alias("price_per_gpu_hr"),
        F.col("p.price").alias("price_total_hr"),
        F.col("p.interruptible").alias("interruptible"),
        F.lit(LIST_RELIABILITY).alias("reliability_score"),
        F.lit(LIST_GEOGRAPHY).alias("geography"),
        _side_json(source=F.lit(source)).alias("extra_json"),
    )
    return _as_offers(rows, "spheron")


def _first(g: Column, names: list[str], absent) -> Column:
    return F.coalesce(*[absent(g[n]) for n in names])


def _priced(text: Column) -> Column:
    return nonzero(to_number(text))


def ingest_price_list(payloads: DataFrame) -> DataFrame:
    """Price list whose key names vary: first usable alias wins."""
    g = F.col("g")
    items = _of_source(payloads, "price_list").select(
        *RUN,
        F.explode(
            _array_or_field(F.col("payload"), schemas.PRICE_ARRAY, schemas.PRICE_OBJECT, "gpus")
        ).alias("g"),
    )
    return _list_rows(
        items.select(
            *RUN,
            F.coalesce(_first(g, ["name", "gpu"], nonblank), F.lit("")).alias("gpu"),
            _first(g, ["vram", "memoryGb"], _priced).alias("vram"),
            _first(g, ["onDemandPrice", "hourlyPrice", "price"], _priced).alias("on_demand"),
            _first(g, ["spotPrice", "interruptiblePrice"], _priced).alias("spot"),
        ),
        "spheron_api",
    )


def _page_script(html: Column) -> Column:
    return nonblank(F.regexp_extract(html, PAGE_SCRIPT, 1))


def _script_prices(script: Column) -> Column:
    return deep_find(*PAGE_KEYS, only=list)(script)


def page_prices(html: Column) -> Column:
    """JSON text of the price list inside a page's script block; null without one, or where the script cannot be read."""
    return _script_prices(_page_script(html))


def readable(payload: Column, source: Column) -> Column:
    """Whether an answer is JSON. Of a web page it is the script block that counts, if there is one; null answers are unreadable."""
    script = _page_script(payload)
    page = payload.isNotNull() & (script.isNull() | F.try_parse_json(script).isNotNull())
    return F.when(source == "price_page", page).otherwise(F.try_parse_json(payload).isNotNull())


def _page_lists(payloads: DataFrame) -> DataFrame:
    # The script has a projection of its own: the search looks at it several times and would cut it out each time.
    scripts = _of_source(payloads, "price_page").select(*RUN, _page_script(F.col("payload")).alias("script"))
    return scripts.select(*RUN, _script_prices(F.col("script")).alias("list"))


def ingest_price_page(payloads: DataFrame) -> DataFrame:
    """Price list cut out of a web page, with the aliases used there."""
    return _page_rows(_page_items(_page_lists(payloads)))


def _page_items(found: DataFrame) -> DataFrame:
    """The listed GPUs with their prices, by the aliases used on web pages."""
    g = F.col("g")
    items = found.select(*RUN, F.explode(F.from_json("list", schemas.PRICE_ARRAY)).alias("g"))
    return items.select(
        *RUN,
        F.coalesce(_first(g, ["name", "gpu", "model"], nonblank), F.lit("")).alias("gpu"),
        _first(g, ["vram", "memory"], _priced).alias("vram"),
        _first(g, ["hourlyPrice", "onDemandPrice", "price"], _priced).alias("on_demand"),
        _first(g, ["spotPrice", "interruptiblePrice"], _priced).alias("spot"),
    )


def _page_rows(items: DataFrame) -> DataFrame:
    return _list_rows(items, "spheron_html")


def ingest_static_prices(runs: DataFrame) -> DataFrame:
    """The dated price table for each run (one row per run in, sixteen out)."""
    table = F.array(
        *[
            F.struct(
                F.lit(gpu).alias("gpu"), F.lit(vram).alias("vram"),
                F.lit(on_demand).alias("on_demand"), F.lit(spot).alias("spot"),
            )
            for gpu, vram, on_demand, spot in STATIC_PRICES
        ]
    )
    return _list_rows(runs.select(*RUN, F.inline(table)), STATIC_SOURCE)


def first_nonempty_source(sources: list[DataFrame]) -> DataFrame:
    """Per run, the rows of the first source that has any.

    The choice is made on one row per run and source, counted where the rows are parsed; rows
    are never gathered per run and never stored. The last source is only parsed for the runs
    that need it, and a source's rows are joined with the runs it won.
    """
    found = [s.groupBy("snapshot_id").agg(F.lit(i).alias("_rank")) for i, s in enumerate(sources[:-1])]
    best = reduce(DataFrame.unionByName, found).groupBy("snapshot_id").agg(F.min("_rank").alias("_rank"))
    won = [s.join(best.filter(F.col("_rank") == i), "snapshot_id", "left_semi") for i, s in enumerate(sources[:-1])]
    return reduce(DataFrame.unionByName, [*won, sources[-1].join(best, "snapshot_id", "left_anti")])


def list_price_rows(payloads: DataFrame) -> DataFrame:
    """List prices of each run: service answer, else web page, else the dated table.

    Pages are read once: the prices found in them are stored, as both the choice of sources and the rows need them.
    """
    pages = save(_page_items(_page_lists(payloads).filter(F.col("list").isNotNull())), "page-prices")
    runs = payloads.filter(F.col("provider") == "spheron").select(*RUN).distinct()
    return first_nonempty_source(
        [ingest_price_list(payloads), _page_rows(pages), ingest_static_prices(runs)]
    )


def collect_run(payloads: DataFrame, providers: Sequence[str] | None = None) -> DataFrame:
    """Offers of all providers, or of the given ones. A bad payload only loses its own rows."""
    if providers is not None:
        payloads = payloads.filter(F.col("provider").isin(list(providers)))
    return reduce(
        DataFrame.unionByName,
        [
            ingest_marketplace(payloads),
            ingest_gpu_types(payloads),
            ingest_monthly_prices(payloads),
            ingest_provider_list(payloads),
            list_price_rows(payloads),
        ],
    )


def collect_log(
    payloads: DataFrame,
    offers: DataFrame,
    finished_at: datetime | Column | None = None,
    providers: Sequence[str] = LOGGED_PROVIDERS,
) -> DataFrame:
    """Run log of a collection: start, end, rows per provider, unreadable and empty answers.

    ``finished_at`` is when the runs were written; by default a run ends with its last payload.
    ``all_offers`` also counts providers without a column.
    """
    ended = F.max("captured_at") if finished_at is None else F.max(finished_at if isinstance(finished_at, Column) else F.lit(finished_at))
    bad = ~readable(F.col("payload"), F.col("source"))
    landed = payloads.groupBy("snapshot_id", "provider").agg(
        F.min("captured_at").alias("started_at"), ended.alias("finished_at"), F.count_if(bad).alias("bad")
    )
    counted = offers.groupBy("snapshot_id", "provider").agg(F.count("*").alias("rows"))
    status = landed.join(counted, ["snapshot_id", "provider"], "left").na.fill(0, ["rows"])
    problem = F.when(
        F.col("bad") > 0, F.concat("provider", F.lit(": unreadable"))
    ).when(F.col("rows") == 0, F.concat("provider", F.lit(": no rows")))
    of_provider = [
        F.coalesce(F.sum(F.when(F.col("provider") == p, F.col("rows"))), F.lit(0)).alias(f"{p}_offers")
        for p in providers
    ]
    return status.groupBy("snapshot_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        *of_provider,
        F.sum("rows").alias("all_offers"),
        F.array_sort(F.collect_list(problem)).alias("errors"),
    )
