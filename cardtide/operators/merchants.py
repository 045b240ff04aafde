"""Merchant profiles, their health and risk classes, and the roll-up by state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import MerchantRules
from ..functions import clean
from .categories import top_per_group
from .profiles import Leading, Measure, hotspots, owner_profile, state_rollup, with_shares


def merchant_profile(df: DataFrame) -> DataFrame:
    """One row per merchant: transactions, sum, mean and largest amount in cents (at least 0),
    error and online counts and rates, predominant state and city.

    Unreadable amounts are skipped; amounts and sums beyond 64 bits of cents are held to 64 bits, and
    their rows count like others. A blank state or city takes part in the vote; merchants whose
    predominant state is blank are dropped.
    """
    rows = df.select(
        clean.nz_empty(F.col("merchant_id")).alias("merchant_id"),
        clean.nz_empty(F.col("merchant_state")).alias("state"),
        clean.nz_empty(F.col("merchant_city")).alias("city"),
        clean.cents_double(F.col("amount")).alias("cents"),
        clean.is_online(F.col("use_chip"), "phrase_or_word").alias("is_online"),
        clean.has_error(F.col("errors"), "none_na").alias("is_error"),
    )
    readable = F.col("cents").isNotNull()
    ordinary, beyond = clean.wide_parts(F.col("cents"))
    profile = owner_profile(rows, "merchant_id", readable, {
        "ordinary": Measure(F.sum(ordinary)),
        "beyond": Measure(F.sum(beyond)),
        "max_cents": Measure(F.max("cents"), F.max),
        "errors": Measure(F.count_if(readable & F.col("is_error"))),
        "online": Measure(F.count_if(readable & F.col("is_online"))),
    })
    tx = F.col("tx")
    profile = profile.withColumn("sum_cents", clean.wide_total(F.col("ordinary"), F.col("beyond")))
    return profile.where(F.col("state") != "").select(
        "merchant_id", "tx", "sum_cents",
        F.greatest(F.col("max_cents"), F.lit(0)).alias("max_cents"),
        "errors", "online", "state", "city",
        clean.ratio(F.col("errors"), tx).alias("error_rate"),
        clean.ratio(F.col("online"), tx).alias("online_rate"),
        clean.int_div(F.col("sum_cents"), tx).alias("avg_cents"),
    )


def merchant_health(rules: MerchantRules) -> Column:
    revenue = F.col("sum_cents")
    steady = (F.col("tx") >= rules.tx_min_for_avg) & (F.col("avg_cents") >= rules.avg_med_cents)
    return (
        F.when(revenue >= rules.revenue_high_cents, "A")
        .when((revenue >= rules.revenue_med_cents) | steady, "B")
        .otherwise("C")
    )


def merchant_risk(rules: MerchantRules) -> Column:
    error, online = F.col("error_rate"), F.col("online_rate")
    high = (
        (error >= clean.single(rules.error_high))
        | (online >= clean.single(rules.online_high))
        | (F.col("max_cents") >= rules.max_high_cents)
    )
    medium = (error >= clean.single(rules.error_med)) | (online >= clean.single(rules.online_med))
    return F.when(high, "HIGH").when(medium, "MED").otherwise("LOW")


def classify_merchant_health(profile: DataFrame, rules: MerchantRules = MerchantRules()) -> DataFrame:
    """Add ``health``: A, B or C."""
    return profile.withColumn("health", merchant_health(rules))


def classify_merchant_risk(profile: DataFrame, rules: MerchantRules = MerchantRules()) -> DataFrame:
    """Add ``risk``: LOW, MED or HIGH."""
    return profile.withColumn("risk", merchant_risk(rules))


def classify_merchants(profile: DataFrame, rules: MerchantRules = MerchantRules()) -> DataFrame:
    return classify_merchant_risk(classify_merchant_health(profile, rules), rules)


def top_merchants_by_state(classified: DataFrame, k: int = 5) -> DataFrame:
    """``state, rank, merchant_id, sum_cents, health, risk``: largest merchants by revenue."""
    top = top_per_group(classified, ["state"], [F.desc("sum_cents"), F.asc("merchant_id")], k)
    return top.select("state", "rank", "merchant_id", "sum_cents", "health", "risk")


def merchant_hotspots(classified: DataFrame, k: int = 5) -> DataFrame:
    """``state, rank, city, merchants``: cities with most HIGH-risk merchants per state."""
    return hotspots(classified, "risk", k, "merchants")


def merchant_health_by_state(classified: DataFrame, rules: MerchantRules = MerchantRules()) -> DataFrame:
    """Health and risk counters with shares, hotspot cities and largest merchants per state.

    States with fewer than ``min_state_merchants`` merchants are left out. Counters and leading
    merchants travel through the same salted passes, so the profiles are computed once.
    """
    counts = {f"health_{h.lower()}": F.col("health") == h for h in "ABC"}
    counts |= {f"risk_{r.lower()}": F.col("risk") == r for r in ("LOW", "MED", "HIGH")}
    leading = Leading("top_merchants", "merchant_id", "sum_cents", ["merchant_id", "sum_cents", "health", "risk"], rules.top_merchants)
    rollup = state_rollup(classified, counts, "risk", 5, "merchants", leading)
    return with_shares(rollup.where(F.col("total") >= rules.min_state_merchants), list(counts))
