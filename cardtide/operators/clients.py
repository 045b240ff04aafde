"""Client channel profiles, their risk bucket, and the roll-up by state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ClientRiskRules
from ..functions import clean
from .profiles import Measure, bucket_counts, hotspots, owner_profile, state_rollup, with_shares


def client_channel_profile(df: DataFrame) -> DataFrame:
    """One row per client: transactions, online and error counts and rates, sum, mean and largest
    amount in cents (the largest is at least 0), predominant state and city.

    Rows without a client or a readable amount are dropped; a blank state or city is UNKNOWN.
    """
    rows = df.select(
        clean.trim_quotes(F.col("client_id")).alias("client_id"),
        clean.nz_unknown(clean.trim_quotes(F.col("merchant_state"))).alias("state"),
        clean.nz_unknown(clean.trim_quotes(F.col("merchant_city"))).alias("city"),
        clean.cents_exact(F.col("amount")).alias("cents"),
        clean.is_online(F.col("use_chip"), "phrase").alias("is_online"),
        clean.has_error(F.col("errors"), "any_text").alias("is_error"),
    )
    readable = F.col("cents").isNotNull()
    profile = owner_profile(rows, "client_id", readable, {
        "online": Measure(F.count_if(readable & F.col("is_online"))),
        "errors": Measure(F.count_if(readable & F.col("is_error"))),
        "sum_cents": Measure(F.sum("cents")),
        "max_cents": Measure(F.max("cents"), F.max),
    })
    tx = F.col("tx")
    return profile.select(
        "client_id", "tx", "online", "errors", "sum_cents",
        F.greatest(F.col("max_cents"), F.lit(0)).alias("max_cents"),
        "state", "city",
        clean.ratio(F.col("online"), tx).alias("online_rate"),
        clean.ratio(F.col("errors"), tx).alias("error_rate"),
        clean.int_div(F.col("sum_cents"), tx).alias("avg_cents"),
    )


def client_risk_bucket(rules: ClientRiskRules) -> Column:
    error, online = F.col("error_rate"), F.col("online_rate")
    high = (
        ((error >= clean.single(rules.error_high)) & (online >= clean.single(rules.online_med)))
        | (online >= clean.single(rules.online_high))
        | (F.col("avg_cents") >= rules.avg_high_cents)
        | (F.col("max_cents") >= rules.max_high_cents)
    )
    medium = (error >= clean.single(rules.error_med)) | (online >= clean.single(rules.online_med))
    return F.when(high, "HIGH").when(medium, "MED").otherwise("LOW")


def classify_client_risk(profile: DataFrame, rules: ClientRiskRules = ClientRiskRules()) -> DataFrame:
    """Add the ``risk`` bucket LOW, MED or HIGH."""
    return profile.withColumn("risk", client_risk_bucket(rules))


def client_hotspots(classified: DataFrame, k: int = 5) -> DataFrame:
    """``state, rank, city, clients``: cities with most HIGH clients per state."""
    return hotspots(classified, "risk", k, "clients")


def client_risk_by_state(classified: DataFrame, k: int = 5) -> DataFrame:
    """``state, total, low, med, high``, their shares, and the hotspot cities."""
    rollup = state_rollup(classified, bucket_counts("risk"), "risk", k, "clients")
    return with_shares(rollup, ["low", "med", "high"])
