"""GPU labels, size texts and attribute lists (expressions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.functions.scalars import to_number

# Words dropped from a raw name, wherever they stand.
VENDOR_WORDS = ["NVIDIA_", "GEFORCE_", "TESLA_", "QUADRO_"]

# Fixed values: (substrings that must all occur, label); the first match wins.
LABEL_RULES = [
    (["H100", "SXM"], "H100_SXM"),
    (["H100"], "H100_PCIE"),
    (["H200"], "H200"),
    (["B200"], "B200"),
    (["B300"], "B300"),
    (["A100", "80"], "A100_80GB"),
    (["A100"], "A100_40GB"),
    (["L40S"], "L40S"),
    (["L40"], "L40"),
    (["RTX_4090"], "RTX_4090"),
    (["RTX_3090"], "RTX_3090"),
    (["RTX_4080"], "RTX_4080"),
    (["RTX_3080"], "RTX_3080"),
    (["A40"], "A40"),
    (["A6000"], "RTX_A6000"),
    (["T4"], "T4"),
    (["V100"], "V100"),
]

# Longest label kept, and the label of a missing name.
LABEL_LENGTH = 64
UNKNOWN_LABEL = "UNKNOWN"

# Size suffix (upper case) and gigabytes (10^9 bytes) per unit, longest first.
SIZE_UNITS = [
    ("GI", 1024**3 / 1000**3),
    ("G", 1.0),
    ("MI", 1024**2 / 1000**3),
    ("M", 1 / 1000),
]

# Attribute keys that hold a place.
PLACE_KEYS = ["region", "location", "country", "geo"]


def cleaned_name(raw: Column) -> Column:
    """Upper case, blanks and dashes as underscores, vendor words removed."""
    text = F.translate(F.upper(raw), " -", "__")
    return reduce(lambda c, word: F.replace(c, F.lit(word), F.lit("")), VENDOR_WORDS, text)


def label_of(raw: Column, cleaned: Column) -> Column:
    """Label by the first rule that matches the cleaned name."""
    label = F.when(raw.isNull() | (raw == ""), F.lit(UNKNOWN_LABEL))
    for needles, name in LABEL_RULES:
        label = label.when(reduce(lambda a, b: a & b, [cleaned.contains(n) for n in needles]), F.lit(name))
    return label.otherwise(F.substring(cleaned, 1, LABEL_LENGTH))


def canonical_gpu_name(raw: Column) -> Column:
    """Canonical GPU label of a marketplace name, as one expression."""
    return label_of(raw, cleaned_name(raw))


def with_gpu_name(df: DataFrame, raw: str, out: str = "gpu_name") -> DataFrame:
    """Add the label; the cleaned name is computed once per row."""
    cleaned = df.withColumn("_cleaned", cleaned_name(F.col(raw)))
    return cleaned.withColumn(out, label_of(F.col(raw), F.col("_cleaned"))).drop("_cleaned")


def parse_size_gb(text: Column) -> Column:
    """'80Gi', '24G', '16384Mi', '500M' or a bare number to gigabytes; unreadable gives 0."""
    size = F.upper(F.trim(text))
    amount = to_number(F.regexp_replace(size, r"[^\d.]", ""))
    for suffix, factor in reversed(SIZE_UNITS):
        stem = F.substr(size, F.lit(1), F.length(size) - F.lit(len(suffix)))
        amount = F.when(size.endswith(suffix), to_number(stem) * F.lit(factor)).otherwise(amount)
    return F.coalesce(amount, F.lit(0.0))


def attribute_number(attrs: Column, key: str) -> Column:
    """Number under the first attribute with ``key`` in any letter case; null if unreadable."""
    hits = F.filter(attrs, lambda a: F.lower(a["key"]) == key.lower())
    return to_number(F.try_element_at(hits, F.lit(1))["value"])


def attribute_place(attrs: Column, region: Column) -> Column:
    """First place attribute, else the provider's region, else ''."""
    hits = F.filter(attrs, lambda a: F.lower(a["key"]).isin(PLACE_KEYS))
    return F.when(F.size(hits) > 0, F.coalesce(F.try_element_at(hits, F.lit(1))["value"], F.lit(""))).otherwise(
        F.coalesce(region, F.lit(""))
    )
