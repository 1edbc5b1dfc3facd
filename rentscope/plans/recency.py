"""Points in time as one-row subqueries, so that filters stay plain comparisons."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Look-back hours tried in turn until one holds rows.
TIERS_HOURS = [4, 48, 9999]

# Partition column of stored offers.
DAY = "capture_date"


def hours(n: int) -> Column:
    return F.expr(f"INTERVAL '{n}' HOUR")


def stored_days(offers: DataFrame) -> list[str]:
    """The days that stored offers have folders for, newest first: the first level of their folders is listed, no file.

    None where the rows come from anything else than one scan of stored tables.
    """
    spark, days = offers.sparkSession, set()
    leaves = offers._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation" or not hasattr(leaf.relation(), "location"):
            return []
        roots = leaf.relation().location().rootPaths()
        for k in range(roots.size()):
            root = roots.apply(k)
            files = root.getFileSystem(spark._jsc.hadoopConfiguration())
            days |= {m[1] for f in files.listStatus(root) if (m := re.fullmatch(rf"{DAY}=(\d{{4}}-\d{{2}}-\d{{2}})", f.getPath().getName()))}
    return sorted(days, reverse=True)


def latest_capture(offers: DataFrame) -> Column:
    """The newest capture; of a stored table partitioned by day only the last day is read."""
    if DAY in offers.columns and (days := stored_days(offers)):
        offers = offers.filter(F.col(DAY) == F.lit(days[0]).cast("date"))
    return offers.agg(F.max("captured_at")).scalar()


def as_of_or_latest(offers: DataFrame, as_of: datetime | Column | None) -> Column:
    """The given time, or the newest capture as a scalar subquery."""
    if as_of is None:
        return latest_capture(offers)
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return moment.cast(offers.schema["captured_at"].dataType)


def captured_since(offers: DataFrame, cutoff: Column) -> DataFrame:
    """Rows from ``cutoff`` on; a day partition column prunes the days before it."""
    recent = F.col("captured_at") >= cutoff
    if DAY in offers.columns:
        recent = (F.col(DAY) >= F.to_date(cutoff)) & recent
    return offers.filter(recent)


def within_hours(offers: DataFrame, n: int, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows of the last ``n`` hours before ``as_of``."""
    return captured_since(offers, as_of_or_latest(offers, as_of) - hours(n))


def first_nonempty_tier(offers: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows of the shortest look-back that is not empty.

    The newest row alone decides which of the shorter tiers is hit, so one aggregate over the
    longest of them and one filter do.
    """
    now = as_of_or_latest(offers, as_of)
    *shorter, widest = TIERS_HOURS
    newest = captured_since(offers, now - hours(shorter[-1])).agg(F.max("captured_at")).scalar()
    hit = [F.when(newest >= now - hours(n), now - hours(n)) for n in shorter]
    return captured_since(offers, F.coalesce(*hit, now - hours(widest)))
