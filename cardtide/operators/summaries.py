"""Run summaries: one row (or a few) computed over an aggregated table.

All are global aggregates over already reduced rows, with partial results combined in one task.
Extremes take the first key in sort order on ties. A "highest" value must exceed 0, so a table
without positive values has none (NULL key, value 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean, fixed
from ..sources.dims import with_mcc_label, with_region, with_state_name


def _highest(key: str, value: str, test: Column | None = None, floor: float = 0) -> Column:
    ok = F.col(value) > floor
    ok = ok if test is None else ok & test
    return F.min_by(key, F.when(ok, F.struct(-F.col(value), F.col(key))))


def _highest_value(value: str, test: Column | None = None, floor: float = 0) -> Column:
    ok = F.col(value) > floor
    ok = ok if test is None else ok & test
    return F.coalesce(F.max(F.when(ok, F.col(value))), F.lit(0))


def _lowest(key: str, value: str, test: Column | None = None) -> Column:
    order = F.struct(F.col(value), F.col(key))
    return F.min_by(key, order if test is None else F.when(test, order))


def _lowest_value(value: str, test: Column | None = None) -> Column:
    return F.min(value if test is None else F.when(test, F.col(value)))


def _level(value: Column, above: list[tuple[float, str]], otherwise: str) -> Column:
    chain = None
    for limit, label in above:
        chain = F.when(value > limit, label) if chain is None else chain.when(value > limit, label)
    return chain.otherwise(otherwise)


def _total(c: str) -> Column:
    """Sum over all rows, 0 when there are none."""
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def _extremes(key: str, value: str, high: str, low: str) -> list[Column]:
    return [
        _highest(key, value).alias(f"{high}_{key}"),
        _highest_value(value).alias(f"{high}_{value}"),
        _lowest(key, value).alias(f"{low}_{key}"),
        _lowest_value(value).alias(f"{low}_{value}"),
    ]


def summary_amount(agg: DataFrame, key: str = "city") -> DataFrame:
    """Number of keys, grand total, mean per key, highest and lowest key."""
    row = agg.agg(F.count("*").alias("keys"), _total("total_cents").alias("grand_cents"),
                  *_extremes(key, "total_cents", "highest", "lowest"))
    return row.withColumn("avg_cents", clean.int_div(F.col("grand_cents"), F.col("keys")))


def summary_amount_client(agg: DataFrame) -> DataFrame:
    """The same per client, with transactions per client, the share of the top client and a flag
    for a negative lowest total (refunds)."""
    key = "client_id"
    row = agg.agg(F.count("*").alias("keys"), _total("total_cents").alias("grand_cents"),
                  _total("tx").alias("tx"), *_extremes(key, "total_cents", "highest", "lowest"))
    return row.withColumns({
        "avg_cents": clean.int_div(F.col("grand_cents"), F.col("keys")),
        "avg_tx": clean.ratio(F.col("tx"), F.col("keys")),
        "highest_pct": clean.pct(F.col("highest_total_cents"), F.col("grand_cents")),
        "has_refunds": F.coalesce(F.col("lowest_total_cents") < 0, F.lit(False)),
    })


def summary_types(agg: DataFrame) -> DataFrame:
    """Number of types, most and least common with share, and the balance of exactly two types."""
    row = agg.agg(F.count("*").alias("types"), _total("tx").alias("total"),
                  *_extremes("txn_type", "tx", "most", "least"))
    row = row.withColumns({
        "avg_tx": clean.ratio(F.col("total"), F.col("types")),
        "most_pct": clean.pct(F.col("most_tx"), F.col("total")),
        "least_pct": clean.pct(F.col("least_tx"), F.col("total")),
    })
    balance = _level(F.col("most_pct"), [(80, "strong"), (60, "moderate")], "balanced")
    return row.withColumn("balance", F.when(F.col("types") == 2, balance).otherwise("other"))


def summary_errors(agg: DataFrame) -> DataFrame:
    """Codes with errors, most and least error-prone code with label, share, cause and category."""
    row = agg.agg(F.count("*").alias("mccs"), _total("errors").alias("total"),
                  *_extremes("mcc", "errors", "most", "least"))
    row = row.withColumns({
        "avg_errors": clean.ratio(F.col("total"), F.col("mccs")),
        "most_pct": clean.pct(F.col("most_errors"), F.col("total")),
        "least_pct": clean.pct(F.col("least_errors"), F.col("total")),
        "most_cause": clean.mcc_error_cause(F.col("most_mcc")),
        "most_category": clean.mcc_category(F.col("most_mcc"), "long"),
    })
    spread = F.when(F.col("most_pct") > 30, "concentrated").when(F.col("most_pct") < 5, "spread").otherwise("moderate")
    row = with_mcc_label(row.withColumn("concentration", spread), "long", "most_mcc", "most_label")
    return with_mcc_label(row, "long", "least_mcc", "least_label")


def summary_states(agg: DataFrame) -> DataFrame:
    """Online and unknown shares, mean per physical state, most and least active state."""
    state, tx = F.col("state"), F.col("tx")
    physical = ~state.isin(fixed.ONLINE, fixed.UNKNOWN)
    valid = state.isin(*fixed.US_STATES)
    only = lambda name: F.coalesce(F.sum(F.when(state == name, tx)), F.lit(0).cast("bigint"))
    row = agg.agg(
        F.count("*").alias("states"), _total("tx").alias("total"),
        only(fixed.ONLINE).alias("online"), only(fixed.UNKNOWN).alias("unknown"),
        _highest("state", "tx", physical).alias("most_state"),
        _highest_value("tx", physical).alias("most_tx"),
        _lowest("state", "tx", valid).alias("least_state"),
        _lowest_value("tx", valid).alias("least_tx"),
    )
    special = (F.col("online") > 0).cast("int") + (F.col("unknown") > 0).cast("int")
    total = F.col("total")
    row = row.withColumns({
        "avg_per_state": clean.ratio(total - F.col("online") - F.col("unknown"), F.col("states") - special),
        "online_pct": clean.pct(F.col("online"), total),
        "unknown_pct": clean.pct(F.col("unknown"), total),
        "most_pct": clean.pct(F.col("most_tx"), total),
        "least_pct": clean.pct(F.col("least_tx"), total),
    })
    return with_state_name(with_state_name(row, "most_state", "most_name"), "least_state", "least_name")


def region_totals(agg: DataFrame) -> DataFrame:
    """``region, tx, pct, dominant, well_spread`` over US states; shares are of all transactions.

    The two windows see at most six rows, one per region.
    """
    by_region = with_region(agg).groupBy("region").agg(F.sum("tx").alias("tx"))
    everything = Window.partitionBy()
    known = F.col("region") != "Unknown"
    leader = F.min_by("region", F.when(known, F.struct(-F.col("tx"), F.col("region")))).over(everything)
    return by_region.select(
        "region", "tx",
        clean.pct(F.col("tx"), F.sum("tx").over(everything)).alias("pct"),
        (F.col("region") == leader).alias("dominant"),
        (F.count_if(known).over(everything) >= 4).alias("well_spread"),
    ).where(known)


def state_lookup(agg: DataFrame) -> DataFrame:
    """Every state of a count table with its name and region."""
    return with_region(with_state_name(agg)).select("state", "tx", "state_name", "region")


def summary_city_stats(agg: DataFrame, min_tx: int = 10) -> DataFrame:
    """Global means and the leading cities; mean tickets count from ``min_tx`` transactions on."""
    enough = F.col("tx") >= min_tx
    row = agg.agg(
        F.count("*").alias("cities"), _total("tx").alias("tx"), _total("total_cents").alias("grand_cents"),
        _highest("city", "tx").alias("most_tx_city"), _highest_value("tx").alias("most_tx"),
        _highest("city", "total_cents").alias("highest_total_city"),
        _highest_value("total_cents").alias("highest_total_cents"),
        _highest("city", "avg_cents", enough).alias("highest_avg_city"),
        _highest_value("avg_cents", enough).alias("highest_avg_cents"),
        _lowest("city", "avg_cents", enough).alias("lowest_avg_city"),
        _lowest_value("avg_cents", enough).alias("lowest_avg_cents"),
    )
    return row.withColumns({
        "avg_ticket_cents": clean.int_div(F.col("grand_cents"), F.col("tx")),
        "tx_per_city": clean.int_div(F.col("tx"), F.col("cities")),
        "cents_per_city": clean.int_div(F.col("grand_cents"), F.col("cities")),
    })


def summary_periods(agg: DataFrame, min_tx: int = 50) -> DataFrame:
    """Shares and peak over all cities, and the cities that lean most to one part of the day or
    are most balanced, among those with at least ``min_tx`` transactions."""
    enough = F.col("total") >= min_tx
    mean = F.col("total") / F.lit(3.0)
    off = lambda c: (F.col(c) - mean) * (F.col(c) - mean)
    names = ("morning", "afternoon", "night")
    cities = agg.withColumn("imbalance", off("morning") + off("afternoon") + off("night"))
    row = cities.agg(
        F.count("*").alias("cities"), _total("total").alias("tx"),
        *[_total(n).alias(f"{n}_tx") for n in names],
        *[_highest("city", f"{n}_pct", enough).alias(f"most_{n}_city") for n in names],
        *[_highest_value(f"{n}_pct", enough).cast("double").alias(f"most_{n}_pct") for n in names],
        _lowest("city", "imbalance", enough).alias("most_balanced_city"),
    )
    return row.withColumns({
        **{f"{n}_share": clean.pct(F.col(f"{n}_tx"), F.col("tx")) for n in names},
        **{f"{n}_per_city": clean.int_div(F.col(f"{n}_tx"), F.col("cities")) for n in names},
        "peak": clean.peak_period(*[F.col(f"{n}_tx") for n in names]),
    })


# Mean number of categories above which diversity counts as high or moderate.
_DIVERSITY = {
    "city": [(20, "high"), (10, "moderate")],
    "state": [(20, "high"), (10, "moderate")],
    "country": [(15, "high"), (8, "moderate")],
}


def summary_diversity(counts: DataFrame, by: str) -> DataFrame:
    """Number of places, categories per place, most (at least 5) and least diverse place."""
    places = counts.groupBy(by).agg(F.count("*").alias("categories"))
    row = places.agg(
        F.count("*").alias("places"), _total("categories").alias("total_categories"),
        _highest(by, "categories", floor=4).alias("most_diverse"),
        _highest_value("categories", floor=4).alias("most_categories"),
        _lowest(by, "categories").alias("least_diverse"),
        _lowest_value("categories").alias("least_categories"),
    ).withColumn("avg_categories", clean.ratio(F.col("total_categories"), F.col("places")))
    return row.withColumn("diversity", _level(F.col("avg_categories"), _DIVERSITY[by], "low"))


def summary_country(counts: DataFrame) -> DataFrame:
    """Transactions abroad, mean per country, busiest country and the volume level."""
    places = counts.groupBy("country").agg(F.sum("tx").alias("tx"))
    row = places.agg(
        F.count("*").alias("countries"), _total("tx").alias("total"),
        _highest("country", "tx").alias("busiest"), _highest_value("tx").alias("busiest_tx"),
    ).withColumn("avg_tx", clean.ratio(F.col("total"), F.col("countries")))
    volume = F.when(F.col("avg_tx") < 50, "low").when(F.col("avg_tx") > 200, "high").otherwise("normal")
    return row.withColumn("volume", volume)


def summary_city_period(counts: DataFrame) -> DataFrame:
    """City-periods, categories per city-period and the most diverse one."""
    pairs = counts.groupBy("city", "period").agg(F.count("*").alias("categories"))
    order = F.struct(-F.col("categories"), F.col("city"), clean.period_order(F.col("period")))
    row = pairs.agg(
        F.count("*").alias("city_periods"), _total("categories").alias("records"),
        F.min_by(clean.period_label(F.col("city"), F.col("period")), order).alias("most_diverse"),
        _highest_value("categories").alias("most_categories"),
    )
    return row.withColumn("avg_categories", clean.ratio(F.col("records"), F.col("city_periods")))


def period_totals(counts: DataFrame) -> DataFrame:
    """``period, tx, pct, cities``: transactions, share and number of cities per part of the day.

    The window sees three rows.
    """
    pairs = counts.groupBy("city", "period").agg(F.sum("tx").alias("tx"))
    totals = pairs.groupBy("period").agg(F.sum("tx").alias("tx"), F.count("*").alias("cities"))
    share = clean.pct(F.col("tx"), F.sum("tx").over(Window.partitionBy()))
    return totals.select("period", "tx", share.alias("pct"), "cities")


# Declared order of result rows.
ORDERS = {
    "city_statistics": lambda: [F.desc("tx"), F.desc("total_cents")],
    "city_time_period": lambda: [F.desc("total"), F.desc(F.greatest("morning", "afternoon", "night"))],
    "top_categories": lambda: [F.desc("total")],
    "client_risk_by_state": lambda: [F.desc(clean.ratio(F.col("high"), F.col("total")))],
    "client_risk_profile": lambda: [F.desc("total"), F.desc("tx"), F.asc("client_id")],
    "client_risk": lambda: [F.desc("score"), F.desc(clean.severity_rank(F.col("category"))), F.asc("client_id")],
}


def ranked(result: DataFrame, order: str) -> DataFrame:
    """A result in its declared order (a range-partitioned sort, not a single-task one)."""
    return result.orderBy(*ORDERS[order]())
