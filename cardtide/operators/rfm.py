"""Recency, frequency and monetary value of clients, and the roll-up by state."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..config import RfmRules
from ..functions import clean
from .profiles import Measure, bucket_counts, hotspots, owner_profile, state_rollup, with_shares


def _reference_day(rules: RfmRules) -> Column:
    """The reference date, or today in UTC where none is given."""
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", rules.reference_date or ""):
        return F.lit(rules.reference_date).cast("date")
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("date")


def rfm_client(df: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """One row per client: last transaction, frequency, mean ticket in cents, days since the last
    transaction (at least 0), predominant state and city.

    Rows need a client, a valid timestamp and a readable amount.
    """
    rows = df.select(
        clean.trim_quotes(F.col("client_id")).alias("client_id"),
        clean.nz_unknown(clean.trim_quotes(F.col("merchant_state"))).alias("state"),
        clean.nz_unknown(clean.trim_quotes(F.col("merchant_city"))).alias("city"),
        clean.parse_ts(clean.trim_quotes(F.col("date"))).alias("ts"),
        clean.cents_exact(F.col("amount")).alias("cents"),
    )
    valid = F.col("ts").isNotNull() & F.col("cents").isNotNull()
    cents = F.when(valid, F.col("cents"))
    profile = owner_profile(rows, "client_id", valid, {
        "sum_cents": Measure(F.sum(cents)),
        "last_ts": Measure(F.max(F.when(valid, F.col("ts"))), F.max),
    })
    recency = F.date_diff(_reference_day(rules), F.col("last_ts").cast("date"))
    return profile.select(
        "client_id", "last_ts",
        F.col("tx").alias("frequency"),
        clean.int_div(F.col("sum_cents"), F.col("tx")).alias("avg_cents"),
        F.greatest(recency, F.lit(0)).alias("recency_days"),
        "state", "city",
    )


def rfm_bucket(rules: RfmRules) -> Column:
    recency, frequency, mean = F.col("recency_days"), F.col("frequency"), F.col("avg_cents")
    high = (recency <= rules.recency_high_days) & (
        (frequency >= rules.frequency_high) | (mean >= rules.monetary_high_cents)
    )
    medium = (
        (recency <= rules.recency_med_days)
        | (frequency >= rules.frequency_med)
        | (mean >= rules.monetary_med_cents)
    )
    return F.when(high, "HIGH").when(medium, "MED").otherwise("LOW")


def classify_rfm(profile: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """Add the value ``bucket`` LOW, MED or HIGH."""
    return profile.withColumn("bucket", rfm_bucket(rules))


def rfm_hotspots(classified: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """``state, rank, city, clients``: cities with most HIGH-value clients per state."""
    return hotspots(classified, "bucket", rules.top_cities, "clients")


def rfm_by_state(classified: DataFrame, rules: RfmRules = RfmRules()) -> DataFrame:
    """``state, total, low, med, high``, their shares, and the hotspot cities."""
    rollup = state_rollup(classified, bucket_counts("bucket"), "bucket", rules.top_cities, "clients")
    return with_shares(rollup, ["low", "med", "high"])
