"""Mean of a measure by composite key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def avg_by_keys(df: DataFrame, keys: list[str], value: str, out: str = "avg_value") -> DataFrame:
    """``<keys>, n, <out>``: mean of ``value`` per key; rows with a missing key or value are left
    out. Sum and count travel apart, so partial results combine exactly."""
    rows = df.dropna(subset=[*keys, value])
    for key in keys:
        rows = rows.where(F.col(key).cast("string") != "")
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias(out))
