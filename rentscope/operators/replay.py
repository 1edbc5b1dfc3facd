"""Spot-price history and replay of bids against it.

A job is submitted at a point of a price series, waits while the price is above the budget,
runs while it is not, and starts over when the price rises; one point counts as one hour. It
is done at the first point that ends a streak of ``hours`` affordable points lying wholly
after the submission. Streaks and costs are differences of running sums, so all submissions of
all instance types are answered by the same few windows, without stepping through jobs.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.functions.scalars import to_number
from rentscope.plans.blocks import block_count, in_ordered_blocks
from rentscope.plans.quantiles import order_statistics
from rentscope.plans.saved import save

# Instance type prefixes and products that are kept.
GPU_PREFIXES = ["p2.", "p3.", "p4.", "g3.", "g4.", "g5.", "g6."]
PRODUCTS = ["Linux/UNIX", ""]

# Rows of about 100 bytes that may be broadcast.
MOST_BROADCAST_ROWS = 100_000

# A time starts with a full date and, if it goes on, with at least hours and minutes.
FULL_TIME = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?\s*$"

TYPE = "instance_type"
ORDER = ["ts", "file", "seq"]


def gpu_instance(instance_type: Column) -> Column:
    """Whether the type has one of the GPU prefixes ('g4dn.' has not)."""
    return reduce(lambda a, b: a | b, [instance_type.startswith(p) for p in GPU_PREFIXES])


def gpu_instance_filter(points: DataFrame) -> DataFrame:
    return points.filter(gpu_instance(F.col(TYPE)))


def spot_prices(lines: DataFrame, gpu_type: str | None = None) -> DataFrame:
    """Tab-separated archive lines to price points of GPU types; malformed lines are dropped.

    ``lines`` has ``value`` and, to break ties of equal times, ``file`` and ``seq``.
    """
    # Filters are not pushed below a generator, so each line is split once.
    split = lines.select("file", "seq", F.explode(F.array(F.split("value", "\t"))).alias("field"))
    az, kind, product, price, ts = (F.get("field", F.lit(i)) for i in range(5))
    fields = split.filter(F.size("field") >= 5).select(
        az.alias("az"),
        kind.alias(TYPE),
        product.alias("product"),
        to_number(price).alias("price"),
        F.when(ts.rlike(FULL_TIME), F.try_to_timestamp(ts)).alias("ts"),
        "file",
        "seq",
    )
    return keep_gpu_points(fields, gpu_type)


def keep_gpu_points(points: DataFrame, gpu_type: str | None = None) -> DataFrame:
    """The same rules on rows that are already columns."""
    kept = gpu_instance_filter(points.filter(F.col("product").isin(PRODUCTS)))
    if gpu_type is not None:
        kept = kept.filter(F.col(TYPE) == gpu_type)
    usable = F.col("price").isNotNull() & ~F.isnan("price") & F.col("ts").isNotNull()
    return kept.filter(usable).drop("product")


def gpu_types(points: DataFrame) -> DataFrame:
    """The GPU instance types that occur."""
    return gpu_instance_filter(points).select(TYPE).distinct().orderBy(TYPE)


def densest_zone(points: DataFrame, az: str | None = None) -> DataFrame:
    """Per type the zone with most points (ties: first seen), or the given zone."""
    kept = points if az is None else points.filter(F.col("az") == az)
    zones = kept.groupBy(TYPE, "az").agg(F.count("*").alias("points"), F.min(F.struct(*ORDER)).alias("first"))
    return zones.groupBy(TYPE).agg(
        F.min_by("az", F.struct(-F.col("points"), "first")).alias("az"),
        F.max("points").alias("total_windows"),
    )


def _positions(points: DataFrame, zones: DataFrame, budget: float) -> DataFrame:
    """Points of the chosen zones with position, streak of affordable points and running sums.

    Both passes over the blocks read the same columns, so they share one shuffle.
    """
    chosen = points.join(zones.select(TYPE, "az"), [TYPE, "az"]).select(TYPE, *ORDER, "price")
    block = [TYPE, "block"]
    types, size = zones.agg(F.count("*"), F.coalesce(F.sum("total_windows"), F.lit(0))).first()
    blocks = in_ordered_blocks(chosen, [TYPE], ORDER, size)

    in_block = W.partitionBy(*block).orderBy(*ORDER)
    so_far = in_block.rowsBetween(W.unboundedPreceding, 0)
    rows = (
        blocks.withColumn("ok", F.col("price") <= budget)
        .withColumn("pos", F.row_number().over(in_block) - 1)
        .withColumn("prev_ok", F.lag("ok").over(in_block))
    )
    one = F.lit(1)
    bad, paid = F.when(~F.col("ok"), one).otherwise(0), F.when(F.col("ok"), F.col("price")).otherwise(0.0)
    broke = F.when(~F.col("ok") & F.col("prev_ok"), one).otherwise(0)
    rows = rows.withColumn("paid_to", F.sum(paid).over(so_far))

    # What each block hands on, one row per block.
    bad_there = F.when(
        F.col("last_bad").isNotNull(),
        F.struct(
            (F.col("base") + F.col("last_bad.pos")).alias("i"),
            (F.col("base_paid") + F.col("last_bad.paid_to")).alias("n_paid"),
        ),
    )
    before = W.partitionBy(TYPE).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    in_order = W.partitionBy(TYPE).orderBy("block")
    handed = (
        rows.groupBy(*block)
        .agg(
            F.count("*").alias("n"),
            F.sum(bad).alias("bad"),
            F.sum(paid).alias("paid"),
            F.sum(broke).alias("broke"),
            F.max(F.when(~F.col("ok"), F.struct("pos", "paid_to"))).alias("last_bad"),
            F.min_by("ok", "pos").alias("first_ok"),
            F.max_by("ok", "pos").alias("last_ok"),
        )
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("total_windows", F.sum("n").over(W.partitionBy(TYPE)))
        .withColumn("carry_ok", F.lag("last_ok").over(in_order))
        .withColumn("base_paid", F.coalesce(F.sum("paid").over(before), F.lit(0.0)))
        .withColumn("edge", F.when(~F.col("first_ok") & F.col("carry_ok"), one).otherwise(0))
        .select(
            *block,
            "total_windows",
            "base",
            "base_paid",
            F.coalesce(F.sum("bad").over(before), F.lit(0)).alias("base_bad"),
            (F.coalesce(F.sum(F.col("broke") + F.col("edge")).over(before), F.lit(0)) + F.col("edge")).alias(
                "base_broke"
            ),
            F.max(bad_there).over(before).alias("carry_last_bad"),
        )
    )
    # One row per block, and one more per type at most: the count decides on a broadcast.
    few = block_count(points.sparkSession, size) + types <= MOST_BROADCAST_ROWS
    placed = rows.join(F.broadcast(handed) if few else handed, block)
    i = F.col("base") + F.col("pos")
    # Paid so far does not change at an unaffordable point, so it can travel with the position.
    n_paid = F.col("base_paid") + F.col("paid_to")
    bad_here = F.max(F.when(~F.col("ok"), F.struct(i.alias("i"), F.col("n_paid")))).over(so_far)
    return (
        placed.withColumn("n_paid", n_paid)
        .select(
            *block,
            "total_windows",
            "pos",
            "ts",
            "price",
            "ok",
            i.alias("i"),
            "n_paid",
            F.greatest(bad_here, F.col("carry_last_bad")).alias("last_bad"),
            (F.col("base_bad") + F.sum(bad).over(so_far)).alias("n_bad"),
            (F.col("base_broke") + F.sum(broke).over(so_far)).alias("n_broke"),
        )
        .withColumn("streak", F.col("i") - F.coalesce(F.col("last_bad.i"), F.lit(-1)))
    )


def replay_jobs(
    points: DataFrame,
    budget: float,
    hours: float = 1.0,
    az: str | None = None,
    max_starts: int | None = None,
    zones: DataFrame | None = None,
) -> DataFrame:
    """One row per submitted job: outcome, wait, interruptions, cost and elapsed hours.

    A job is submitted at every point but the last; ``max_starts`` takes every k-th instead, so
    that about as many remain per series.

    The points are read three times (zones, range bounds, blocks): store them first if they
    come from archive lines.

    ``elapsed_hours`` is the job's own time from submission to completion;
    ``elapsed_hours_pooled`` adds, for interrupted jobs, the run time of all jobs completed
    up to then instead of the job's own lost time.
    """
    need = max(1, math.ceil(hours))
    if zones is None:
        zones = save(densest_zone(points, az), "zones")
    rows = _positions(points, zones, budget)
    step = F.lit(1) if max_starts is None else F.greatest(F.lit(1), F.floor(F.col("total_windows") / max_starts))

    def is_start(i: Column) -> Column:
        return (i >= 0) & (i < F.col("total_windows") - 1) & (i % step == 0)

    # A job submitted at i cannot finish before point i + need - 1; that point looks up its end.
    probed = F.col("i") - (need - 1)
    back_in_block = W.partitionBy(TYPE, "block").orderBy(F.desc("i")).rowsBetween(W.unboundedPreceding, 0)
    finish = F.when(F.col("streak") >= need, F.struct("i", "n_bad", "n_paid", "n_broke"))
    marked = is_start(F.col("i")) | is_start(probed) | (F.col("pos") == 0)
    # The one pass over all points ends here: a few rows per submission and per block remain.
    marks = save(
        rows.withColumn("end_here", F.min(finish).over(back_in_block)).filter(
            marked | (F.col("i") == F.col("total_windows") - 1)
        ),
        "marks",
    )

    # First finishing point at or after a probe: within its block, else in a later one.
    later = W.partitionBy(TYPE).orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    next_blocks = marks.filter("pos = 0").select(TYPE, "block", F.min("end_here").over(later).alias("end_later"))
    probes = (
        marks.filter(is_start(probed))
        .join(next_blocks, [TYPE, "block"])
        .select(TYPE, probed.alias("start"), F.coalesce("end_here", "end_later").alias("end"))
    )
    # A job that never finishes pays nothing for the affordable points after the last break.
    tails = marks.filter(F.col("i") == F.col("total_windows") - 1).select(
        TYPE, F.col("last_bad"), F.col("n_broke").alias("all_broke")
    )
    own = F.when(F.col("ok"), F.col("price")).otherwise(0.0)
    starts = marks.filter(is_start(F.col("i"))).select(
        TYPE, "block", "total_windows", F.col("i").alias("start"), "ts", "ok", "n_bad", "n_broke",
        (F.col("n_paid") - own).alias("paid_before"),
    )
    done = F.col("end").isNotNull()
    waited = F.col("end.n_bad") - F.col("n_bad") + F.when(F.col("ok"), 0).otherwise(1)
    lost = F.when(F.col("last_bad.i") >= F.col("start"), F.col("last_bad.n_paid") - F.col("paid_before"))
    breaks = F.when(done, F.col("end.n_broke")).otherwise(F.col("all_broke")) - F.col("n_broke")
    jobs = (
        starts.join(probes, [TYPE, "start"], "left")
        .join(tails, TYPE)
        .join(zones.select(TYPE, "az"), TYPE)
        .select(
            TYPE,
            "az",
            "block",
            "total_windows",
            F.col("start").alias("start_index"),
            F.col("ts").alias("submitted_at"),
            done.alias("completed"),
            F.when(done, waited).otherwise(0).alias("wait_hours"),
            breaks.alias("interruptions"),
            F.when(done, F.col("end.n_paid") - F.col("paid_before"))
            .otherwise(F.coalesce(lost, F.lit(0.0)))
            .alias("cost"),
            F.when(done, F.col("end.i") - F.col("start") + 1).alias("elapsed_hours"),
        )
    )
    # Run time of the jobs before: within the block by a window, over blocks by one row per block.
    jobs = save(jobs, "jobs")
    run = F.when(F.col("completed"), need).otherwise(0)
    lower = W.partitionBy(TYPE).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = jobs.groupBy(TYPE, "block").agg(F.sum(run).alias("run")).select(TYPE, "block", F.coalesce(F.sum("run").over(lower), F.lit(0)).alias("run_before"))
    so_far = W.partitionBy(TYPE, "block").orderBy("start_index").rowsBetween(W.unboundedPreceding, 0)
    run_so_far = F.col("run_before") + F.sum(run).over(so_far)
    pooled = F.col("wait_hours") + F.when(F.col("interruptions") > 0, run_so_far).otherwise(F.lit(need))
    return jobs.join(carried, [TYPE, "block"]).withColumn("elapsed_hours_pooled", F.when(F.col("completed"), pooled)).drop("block", "run_before")


def replay_summary(
    points: DataFrame,
    budget: float,
    hours: float = 1.0,
    az: str | None = None,
    max_starts: int | None = None,
    compat: bool = False,
) -> DataFrame:
    """Rates, mean wait and cost, and completion times per instance type, best rate first.

    Attempts are completions plus interruptions. ``compat`` takes completion times from
    ``elapsed_hours_pooled``.
    """
    zones = save(densest_zone(points, az), "zones")
    jobs = replay_jobs(points, budget, hours, az, max_starts, zones)
    elapsed = "elapsed_hours_pooled" if compat else "elapsed_hours"
    nearest = order_statistics(
        jobs, [TYPE], elapsed,
        {"p50_completion_hours": lambda n: F.floor(n * 0.5), "p90_completion_hours": lambda n: F.floor(n * 0.9)},
    )
    totals = (
        jobs.groupBy(TYPE)
        .agg(
            F.count_if("completed").alias("completed_jobs"),
            F.sum("interruptions").alias("interrupted_jobs"),
            F.sum("wait_hours").alias("_wait"),
            F.sum("cost").alias("_cost"),
        )
        .join(nearest.drop("n"), TYPE, "left")
    )
    # A type with a single point has no jobs but keeps its row.
    totals = zones.join(totals, TYPE, "left").na.fill(0, ["completed_jobs", "interrupted_jobs", "_wait", "_cost"])
    attempts = F.col("completed_jobs") + F.col("interrupted_jobs")

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return totals.select(
        TYPE,
        "az",
        "total_windows",
        "completed_jobs",
        "interrupted_jobs",
        ratio(F.col("completed_jobs"), attempts).alias("completion_rate"),
        ratio(F.col("interrupted_jobs"), attempts).alias("interruption_rate"),
        ratio(F.col("_wait"), attempts).alias("avg_wait_hours"),
        ratio(F.col("_cost"), F.col("completed_jobs")).alias("avg_actual_cost"),
        "p50_completion_hours",
        "p90_completion_hours",
    ).orderBy(F.desc("completion_rate"), TYPE)
