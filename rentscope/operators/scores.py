"""Price, availability and interruption scores per provider and GPU."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.functions.scalars import settled_round
from rentscope.plans.quantiles import exact_percentiles

PRICE = "price_per_gpu_hr"
SERIES = ["gpu_name", "provider"]

# Interruption prior per provider (lower case) and for all others.
INTERRUPTION_PRIORS = {"vast": 0.20, "runpod": 0.05, "akash": 0.10, "spheron": 0.02}
DEFAULT_INTERRUPTION = 0.15

# Weights of prior and observed share, and the rows needed to blend.
PRIOR_WEIGHT = 0.70
OBSERVED_WEIGHT = 0.30
MIN_BLEND_ROWS = 10

MIN_PRICE_SAMPLES = 3
PERCENTILES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


def interruption_prior(provider: Column) -> Column:
    known = F.create_map(*[F.lit(x) for item in INTERRUPTION_PRIORS.items() for x in item])
    return F.coalesce(F.try_element_at(known, F.lower(provider)), F.lit(DEFAULT_INTERRUPTION))


def _blend(prior: Column, rows: Column, spot_rows: Column) -> Column:
    observed = F.try_divide(spot_rows, rows)
    blended = settled_round(F.lit(PRIOR_WEIGHT) * prior + F.lit(OBSERVED_WEIGHT) * observed, 4)
    return F.when(rows < MIN_BLEND_ROWS, prior).otherwise(blended)


def _finished_runs(snapshots: DataFrame) -> Column:
    return snapshots.agg(F.count("finished_at")).scalar()


def _run_share(runs_with_offer: Column, snapshots: DataFrame) -> Column:
    share = F.try_divide(runs_with_offer, _finished_runs(snapshots))
    return F.coalesce(settled_round(share, 4), F.lit(0.0))


def _positive(offers: DataFrame) -> DataFrame:
    return offers.filter(F.col(PRICE) > 0)


def _volatility(mean: Column, std: Column) -> Column:
    return F.when(mean > 0, settled_round(std / mean, 4)).otherwise(0.0)


def price_stats(offers: DataFrame) -> DataFrame:
    """Percentiles, mean and relative deviation of positive prices, all series at once."""
    priced = _positive(offers).select(*SERIES, PRICE)
    spread = priced.groupBy(*SERIES).agg(F.avg(PRICE).alias("_mean"), F.stddev_samp(PRICE).alias("_std"))
    return (
        exact_percentiles(priced, SERIES, PRICE, PERCENTILES)
        .filter(F.col("n") >= MIN_PRICE_SAMPLES)
        .join(spread, SERIES)
        .select(
            *SERIES,
            F.col("n").alias("n_samples"),
            *[settled_round(F.col(p), 6).alias(p) for p in PERCENTILES],
            settled_round(F.col("_mean"), 6).alias("mean"),
            _volatility(F.col("_mean"), F.col("_std")).alias("volatility"),
        )
    )


def availability_score(offers: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Share of finished runs in which a series had a priced offer.

    Unfinished runs count in the numerator too, so the share can pass 1.
    """
    return (
        offers.groupBy(*SERIES)
        .agg(F.countDistinct(F.when(F.col(PRICE).isNotNull(), F.col("snapshot_id"))).alias("_runs"))
        .select(*SERIES, _run_share(F.col("_runs"), snapshots).alias("availability"))
    )


def interruption_probability(offers: DataFrame) -> DataFrame:
    """Prior per provider, blended with the observed spot share once there are enough rows."""
    priced = F.col(PRICE).isNotNull()
    return (
        offers.groupBy("provider")
        .agg(
            F.count_if(priced).alias("_rows"),
            F.count_if(priced & (F.col("interruptible") == 1)).alias("_spot"),
        )
        .select(
            "provider",
            _blend(interruption_prior(F.col("provider")), F.col("_rows"), F.col("_spot")).alias(
                "interruption_probability"
            ),
        )
    )


def provider_windows(
    offers: DataFrame,
    snapshots: DataFrame,
    budget: float | None = None,
    min_vram: float | None = None,
) -> DataFrame:
    """Scheduler windows per provider and GPU.

    ``min_vram`` picks the series and their largest memory; prices and scores still use all
    rows of a picked series. ``budget`` bounds the median price.
    """
    price = F.col(PRICE)
    priced, positive = price.isNotNull(), price > 0
    listed = priced if min_vram is None else priced & (F.col("vram_gb") >= min_vram)

    # Everything but the percentiles in one pass; the provider level is summed over its few rows.
    scored = offers.groupBy(*SERIES).agg(
        F.count_if(listed).alias("_listed"),
        F.max(F.when(listed, F.col("vram_gb"))).alias("vram_gb"),
        F.countDistinct(F.when(priced, F.col("snapshot_id"))).alias("_runs"),
        F.count_if(priced).alias("_rows"),
        F.count_if(priced & (F.col("interruptible") == 1)).alias("_spot"),
        F.avg(F.when(positive, price)).alias("_mean"),
        F.stddev_samp(F.when(positive, price)).alias("_std"),
    )
    of_provider = W.partitionBy("provider")
    scored = scored.withColumn("_provider_rows", F.sum("_rows").over(of_provider)).withColumn(
        "_provider_spot", F.sum("_spot").over(of_provider)
    )
    ranks = (
        exact_percentiles(_positive(offers).select(*SERIES, PRICE), SERIES, PRICE, PERCENTILES)
        .filter(F.col("n") >= MIN_PRICE_SAMPLES)
        .select(*SERIES, "n", *[settled_round(F.col(p), 6).alias(p) for p in PERCENTILES])
    )
    if budget is not None:
        ranks = ranks.filter(F.col("p50") <= budget)
    return (
        scored.filter(F.col("_listed") > 0)
        .join(ranks, SERIES)
        .select(
            "provider",
            F.col("gpu_name").alias("gpu_class"),
            "vram_gb",
            F.col("p10").alias("price_per_gpu_hour_p10"),
            F.col("p50").alias("price_per_gpu_hour_p50"),
            F.col("p90").alias("price_per_gpu_hour_p90"),
            _volatility(F.col("_mean"), F.col("_std")).alias("price_volatility"),
            _run_share(F.col("_runs"), snapshots).alias("availability_probability"),
            _blend(
                interruption_prior(F.col("provider")), F.col("_provider_rows"), F.col("_provider_spot")
            ).alias("interruption_probability"),
            F.col("n").alias("n_price_samples"),
        )
        .orderBy("gpu_class", "price_per_gpu_hour_p50", "provider")
    )
