"""Category counts and the most frequent categories per place and period.

Counting comes first, so a hot place (ONLINE, UNKNOWN) is spread over (place, category) keys and
reduced on the map side. The ranking window sees one row per place and category, and its rank
filter lets Spark keep only the leaders of each partition before the window's own exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean
from ..sources.dims import with_mcc_label
from .totals import count_by_rule


# Place to group by: the raw column it comes from and its cleaning rule.
_PLACES = {
    "city": ("merchant_city", clean.norm_city),
    "state": ("merchant_state", clean.us_state),
    "country": ("merchant_state", clean.country),
}


def category_counts(df: DataFrame, by: str) -> DataFrame:
    """``<by>, mcc, tx`` for ``by`` in city, state, country; only numeric codes count."""
    raw, rule = _PLACES[by]
    return count_by_rule(df, [raw, "mcc"], {by: rule(F.col(raw)), "mcc": clean.mcc_strict(F.col("mcc"))}, "tx")


def city_period_category_counts(df: DataFrame) -> DataFrame:
    """``city, period, mcc, tx``."""
    rows = df.select("merchant_city", "mcc", clean.day_period(F.col("date")).alias("period"))
    keys = {
        "city": clean.norm_city(F.col("merchant_city")),
        "period": F.col("period"),
        "mcc": clean.mcc_strict(F.col("mcc")),
    }
    return count_by_rule(rows, ["merchant_city", "period", "mcc"], keys, "tx")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group in the given order, with their ``rank`` from 1."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def totals_with_leaders(df: DataFrame, key: str, spread_by: str, order: list[str], fields: list[str],
                        totals: dict[str, Column], k: int, keep: Column | None = None, salts: int = 256,
                        gathered: dict[str, Column] | None = None) -> DataFrame:
    """``<key>, <totals>, leaders``: additive totals and the first ``k`` rows per key, in one pass.

    A key may hold most rows, so each is split into ``salts`` parts by a hash of ``spread_by``. A
    part yields its totals and its own leaders; parts are then merged per key, which sees at most
    ``salts * k`` leaders. ``leaders`` are structs of the ``order`` columns (ascending) and the
    ``fields``; rows failing ``keep`` count in the totals but never lead. ``gathered`` are further
    aggregates that are applied to the parts and again to their results. What is gathered per key is
    bounded by ``salts`` and the callers' ``k``, which are parameters and not a matter of the data.
    """
    within = Window.partitionBy(key, "_salt").orderBy(*order)
    leads = F.col("_place") <= k
    leads = leads if keep is None else leads & keep
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    parts = salted.withColumn("_place", F.row_number().over(within)).groupBy(key, "_salt").agg(
        *[total.alias(name) for name, total in totals.items()],
        F.collect_list(F.when(leads, F.struct(*order, *fields))).alias("leaders"),
        *(gathered or {}).values(),
    )
    return parts.groupBy(key).agg(
        *[F.sum(name).alias(name) for name in totals],
        F.slice(F.array_sort(F.flatten(F.collect_list("leaders"))), 1, k).alias("leaders"),
        *(gathered or {}).values(),
    )


def numbered(leaders: str, fields: list[str]) -> Column:
    """The leaders with their ``rank`` from 1 and only the given fields."""
    return F.transform(leaders, lambda row, i: F.struct(
        (i + 1).alias("rank"), *[row[name].alias(name) for name in fields]
    ))


def top_categories(counts: DataFrame, keys: list[str], k: int = 3) -> DataFrame:
    """``<keys>, rank, mcc, label, tx``: most frequent categories, equal counts by code."""
    top = top_per_group(counts, keys, [F.desc("tx"), F.asc("mcc")], k)
    return with_mcc_label(top, "short").select(*keys, "rank", "mcc", "label", "tx")


def top_categories_by_city(df: DataFrame, k: int = 3) -> DataFrame:
    return top_categories(category_counts(df, "city"), ["city"], k)


def top_categories_by_state(df: DataFrame, k: int = 3) -> DataFrame:
    return top_categories(category_counts(df, "state"), ["state"], k)


def top_categories_by_country(df: DataFrame, k: int = 3) -> DataFrame:
    return top_categories(category_counts(df, "country"), ["country"], k)


def top_categories_by_city_period(df: DataFrame, k: int = 3) -> DataFrame:
    """Adds ``period_order`` (morning 1, afternoon 2, night 3) for sorting."""
    top = top_categories(city_period_category_counts(df), ["city", "period"], k)
    return top.withColumn("period_order", clean.period_order(F.col("period")))


def mcc_lookup(df: DataFrame) -> DataFrame:
    """Every category code in the data with its labels, general categories and error cause."""
    codes = count_by_rule(df, ["mcc"], {"mcc": clean.mcc_lenient(F.col("mcc"))}, "tx")
    labelled = with_mcc_label(codes, "long", out="label_long", known="known_long")
    labelled = with_mcc_label(labelled, "short", out="label_short", known="known_short")
    mcc = F.col("mcc")
    return labelled.select(
        mcc, "tx", "label_long", "known_long", "label_short", "known_short",
        clean.mcc_category(mcc, "long").alias("category_long"),
        clean.mcc_category(mcc, "short").alias("category_short"),
        clean.mcc_error_cause(mcc).alias("error_cause"),
    )
