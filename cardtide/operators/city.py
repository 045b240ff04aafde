"""City statistics and time-of-day profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import clean
from .totals import amount_by_city


def city_statistics(df: DataFrame) -> DataFrame:
    """``city, tx, total_cents, avg_cents``; the mean is in whole cents, truncated toward zero."""
    return amount_by_city(df).select(
        "city", "tx", "total_cents", clean.int_div(F.col("total_cents"), F.col("tx")).alias("avg_cents")
    )


def city_time_period(df: DataFrame) -> DataFrame:
    """Counts and shares of morning, afternoon and night per city, with peak and lowest period."""
    rows = df.select("merchant_city", clean.day_period(F.col("date")).alias("period"))
    in_period = lambda code: F.count_if(F.col("period") == code)
    by_text = rows.groupBy("merchant_city").agg(
        in_period("MORNING").alias("morning"),
        in_period("AFTERNOON").alias("afternoon"),
        in_period("NIGHT").alias("night"),
        F.count("period").alias("total"),
    ).where("total > 0")
    counts = by_text.groupBy(clean.norm_city(F.col("merchant_city")).alias("city")).agg(
        *[F.sum(c).alias(c) for c in ("morning", "afternoon", "night", "total")]
    )
    m, a, n, total = (F.col(c) for c in ("morning", "afternoon", "night", "total"))
    return counts.select(
        "city", m, a, n, total,
        clean.pct(m, total).alias("morning_pct"),
        clean.pct(a, total).alias("afternoon_pct"),
        clean.pct(n, total).alias("night_pct"),
        clean.peak_period(m, a, n).alias("peak"),
        clean.lowest_period(m, a, n).alias("lowest"),
    )
