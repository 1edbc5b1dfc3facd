"""Small column helpers with one fixed meaning across the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def settled_round(c: Column, digits: int) -> Column:
    """Round half up after dropping the last float bits.

    A mean over partitions carries noise near 1e-15 that depends on merge order; rounding
    at 9 places first makes exact halves come out the same on every run.
    """
    return F.round(F.round(c, 9), digits)


def nonzero(c: Column) -> Column:
    """Payload defaults treat 0 like an absent number."""
    return F.nullif(c, F.lit(0.0))


def nonblank(c: Column) -> Column:
    """Payload defaults treat an empty text like an absent one."""
    return F.nullif(c, F.lit(""))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number gives null."""
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def hour_of(df: DataFrame, column: str) -> Column:
    """Start of the hour, in the column's own timestamp type."""
    return F.date_trunc("hour", F.col(column)).cast(df.schema[column].dataType)


def spot_only(c: Column, flag: str = "interruptible") -> Column:
    return F.when(F.col(flag) == 1, c)
