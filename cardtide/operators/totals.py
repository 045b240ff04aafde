"""Totals and counts by one key.

Where few texts occur (cities, states, types, codes), rows are reduced per raw text first (map side,
then one exchange), cleaned, and reduced once more; the second exchange moves only distinct texts.
Client ids are as many after cleaning as before, so they are cleaned first and exchanged once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean


# Filters on a cleaned key or amount would be pushed below both aggregations and run their rule on
# every row. Unusable rows are therefore kept out of the counters, and empty groups are dropped.

def _sum_by(df: DataFrame, raw: str, key: str, rule: Callable[[Column], Column]) -> DataFrame:
    """Cents per raw key text, then per cleaned key."""
    rows = df.select(F.col(raw).alias("raw"), clean.cents_exact(F.col("amount")).alias("cents"))
    by_text = rows.groupBy("raw").agg(F.count("cents").alias("n"), F.sum("cents").alias("cents"))
    cleaned = by_text.select(rule(F.col("raw")).alias(key), "n", "cents")
    usable = F.sum(F.when(F.col(key).isNotNull(), F.col("n")))
    totals = cleaned.groupBy(key).agg(usable.alias("tx"), F.sum("cents").alias("total_cents")).where("tx > 0")
    return totals.withColumn("total", F.col("total_cents") / F.lit(100.0))


def count_by_rule(df: DataFrame, raws: list[str], keys: dict[str, Column], out: str) -> DataFrame:
    """Rows per cleaned key, counted per raw texts first; keys with a NULL part are left out."""
    by_text = df.groupBy(*raws).agg(F.count("*").alias("_n"))
    cleaned = by_text.select(*[rule.alias(key) for key, rule in keys.items()], "_n")
    complete = reduce(and_, (F.col(key).isNotNull() for key in keys))
    return cleaned.groupBy(*keys).agg(F.sum(F.when(complete, F.col("_n"))).alias(out)).where(F.col(out) > 0)


def amount_by_city(df: DataFrame) -> DataFrame:
    """``city, tx, total_cents, total``; rows without a readable amount are dropped."""
    return _sum_by(df, "merchant_city", "city", clean.norm_city)


def amount_by_client(df: DataFrame) -> DataFrame:
    """``client_id, tx, total_cents, total``; rows without client or amount are dropped."""
    rows = df.select(clean.norm_client(F.col("client_id")).alias("client_id"), clean.cents_exact(F.col("amount")).alias("cents"))
    usable = F.when(F.col("client_id").isNotNull(), F.col("cents"))
    totals = rows.groupBy("client_id").agg(F.count(usable).alias("tx"), F.sum(usable).alias("total_cents")).where("tx > 0")
    return totals.withColumn("total", F.col("total_cents") / F.lit(100.0))


def count_by_txn_type(df: DataFrame) -> DataFrame:
    """``txn_type, tx`` over all rows."""
    return count_by_rule(df, ["use_chip"], {"txn_type": clean.txn_type(F.col("use_chip"))}, "tx")


def error_count_by_mcc(df: DataFrame) -> DataFrame:
    """``mcc, errors``; codes without an error do not appear."""
    with_error = df.where(clean.has_error(F.col("errors"), "no_error"))
    return count_by_rule(with_error, ["mcc"], {"mcc": clean.mcc_lenient(F.col("mcc"))}, "errors")


def count_by_state(df: DataFrame) -> DataFrame:
    """``state, tx`` with ONLINE and UNKNOWN as states; no row is dropped."""
    raws = ["merchant_state", "merchant_city"]
    return count_by_rule(df, raws, {"state": clean.norm_state(*map(F.col, raws))}, "tx")
