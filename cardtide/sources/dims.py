"""Lookup tables. Both are constants of about a hundred rows, so broadcasting them is safe
whatever the size of the data; they become a local relation, not a scan."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed
from ..functions.clean import jtrim


def mcc_dim(spark: SparkSession, variant: str) -> DataFrame:
    """``mcc, label``: 108 long labels or 109 short ones."""
    at = {"long": 1, "short": 2}[variant]
    rows = [(r[0], r[at]) for r in fixed.MCC_TABLE if r[at]]
    return spark.createDataFrame(pa.table({"mcc": [r[0] for r in rows], "label": [r[1] for r in rows]}))


def state_dim(spark: SparkSession) -> DataFrame:
    """``state, state_name, region`` for the 51 codes."""
    rows = fixed.STATE_TABLE
    names = ("state", "state_name", "region")
    return spark.createDataFrame(pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}))


def _lookup(df: DataFrame, code: str, dim: DataFrame, key: str) -> DataFrame:
    dim = dim.withColumnRenamed(key, "_key")
    return df.join(F.broadcast(dim), jtrim(F.col(code)) == F.col("_key"), "left")


def with_mcc_label(df: DataFrame, variant: str, code: str = "mcc", out: str = "label", known: str | None = None) -> DataFrame:
    """Add the label of a category code, with a stand-in text for unknown and blank codes.

    With ``known``, also add a flag telling whether the code is in the table.
    """
    dim = mcc_dim(df.sparkSession, variant).withColumnRenamed("label", "_label")
    blank = F.coalesce(jtrim(F.col(code)), F.lit("")) == ""
    if variant == "long":
        missing = F.when(blank, "Unknown MCC Code").otherwise(F.concat(F.lit("Unknown MCC Code: "), F.col(code)))
    else:
        missing = F.when(blank, "Unknown").otherwise(F.concat(F.lit("MCC-"), F.col(code)))
    joined = _lookup(df, code, dim, "mcc").withColumn(out, F.coalesce("_label", missing))
    if known:
        joined = joined.withColumn(known, F.col("_key").isNotNull())
    return joined.drop("_key", "_label")


def state_name_text(code: Column, name: Column) -> Column:
    """State name, or the stand-in text for a code without one."""
    return F.coalesce(
        name,
        F.when(F.length(code) == 2, F.concat(F.lit("Unknown State: "), code)).otherwise("Unknown State"),
    )


def with_state_name(df: DataFrame, code: str = "state", out: str = "state_name") -> DataFrame:
    dim = state_dim(df.sparkSession).select("state", F.col("state_name").alias("_name"))
    joined = _lookup(df, code, dim, "state")
    return joined.withColumn(out, state_name_text(F.col(code), F.col("_name"))).drop("_key", "_name")


def with_region(df: DataFrame, code: str = "state", out: str = "region") -> DataFrame:
    """Add the region of a state code, ``Unknown`` for other texts."""
    dim = state_dim(df.sparkSession).select("state", F.col("region").alias("_region"))
    joined = _lookup(df, code, dim, "state")
    return joined.withColumn(out, F.coalesce("_region", F.lit("Unknown"))).drop("_key", "_region")
