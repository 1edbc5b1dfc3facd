"""Exact order statistics of groups that may be far too big for one task.

A positive value is placed by digits: a cell of its logarithm, then 65,536 parts of the cell,
then 65,536 parts of that. Per level one count per digit is combined map-side, and only the
digits that hold a wanted rank go on. So no rows are shuffled for counting, a hot band of
values is split like any other, and what is ordered in the end is at most the few thousand
doubles that agree in all digits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rentscope.plans.saved import save

# Cells per e-fold of the value: one cell is about 0.4 % wide. Parts of a cell on each further level.
CELLS_PER_EFOLD = 256
PARTS = 65_536
LEVELS = 3
# Rows that may be ordered together: cells with fewer need no further digit.
ORDERED_ROWS = 20_000
# Rows of about 60 bytes that may be broadcast.
MOST_BROADCAST_ROWS = 100_000

_DIGITS = [f"_d{i}" for i in range(LEVELS)]


def _with_digits(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys, value and its digits; products and differences here are exact, so digits order as values do."""
    rest = F.log(F.col(value)) * CELLS_PER_EFOLD
    digits = []
    for name in _DIGITS:
        digits.append(F.floor(rest).alias(name))
        rest = (rest - F.floor(rest)) * PARTS
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, value]])
    return df.select(*keys, value).filter(usable).select(*keys, value, *digits)


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Per group its size ``n`` and the values at the given ranks (0 is the smallest) of a positive column."""
    placed = _with_digits(df, keys, value)
    rank = {name: at(F.col("n")) for name, at in ranks.items()}

    def holds(start: str, size: str) -> Column:
        return reduce(lambda a, b: a | b, [(r >= F.col(start)) & (r < F.col(start) + F.col(size)) for r in rank.values()])

    found, carried = None, []
    for level in range(LEVELS):
        above, held = _DIGITS[:level], _DIGITS[: level + 1]
        inside = placed if found is None else placed.join(found, [*keys, *above])
        cells = inside.groupBy(*keys, *held, *carried).agg(F.count("*").alias("_rows"))
        before = F.sum("_rows").over(W.partitionBy(*keys, *above).orderBy(held[-1])) - F.col("_rows")
        if found is None:
            cells = cells.withColumn("_start", before).withColumn("n", F.sum("_rows").over(W.partitionBy(*keys)))
        else:
            cells = cells.withColumn("_start", F.col("_start") + before)
        carried = ["n", "_start"]
        cells = save(cells.filter(holds("_start", "_rows")).select(*keys, *held, *carried, "_rows"), "cells")
        n_cells, widest = cells.agg(F.count("*"), F.max("_rows")).first()
        found = cells.drop("_rows")
        found = F.broadcast(found) if n_cells <= MOST_BROADCAST_ROWS else found
        if (widest or 0) <= ORDERED_ROWS:
            break
    counted = placed.join(found, [*keys, *held]).groupBy(*keys, *held, *carried, value).agg(F.count("*").alias("_rows"))
    ordered = W.partitionBy(*keys, *held).orderBy(value)
    at = counted.withColumn("_at", F.col("_start") + F.sum("_rows").over(ordered) - F.col("_rows"))
    picks = [F.max(F.when((r >= F.col("_at")) & (r < F.col("_at") + F.col("_rows")), F.col(value))).alias(name) for name, r in rank.items()]
    return at.groupBy(*keys).agg(F.max("n").alias("n"), *picks)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated percentiles of a positive column per group, with the group's size as ``n``."""

    def position(p: float, n: Column) -> Column:
        return (n - 1) * F.lit(p)

    ranks = {}
    for name, p in probs.items():
        ranks[f"_{name}_lo"] = lambda n, p=p: F.floor(position(p, n))
        ranks[f"_{name}_hi"] = lambda n, p=p: F.least(F.floor(position(p, n)) + 1, n - 1)
    picked = order_statistics(df, keys, value, ranks)
    result = []
    for name, p in probs.items():
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        share = position(p, F.col("n")) - F.floor(position(p, F.col("n")))
        result.append((low + share * (high - low)).alias(name))
    return picked.select(*keys, "n", *result)
