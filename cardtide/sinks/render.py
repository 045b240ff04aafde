"""Result rows as report lines: ``key`` (and sort columns) plus ``text``.

Formatting is the last projection and is never parsed back. Numbers use the US format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, fixed


def _lines(df: DataFrame, key: Column, text: Column, *order: str) -> DataFrame:
    return df.select(key.alias("key"), text.alias("text"), *order)


def _share(name: str) -> list[Column]:
    return [F.col(name), F.col(f"{name}_pct")]


def _joined(items: str, text, separator: str = " | ") -> Column:
    return F.array_join(F.transform(F.col(items), text), separator)


def _spots(count: str) -> Column:
    return _joined("hotspots", lambda s: F.concat(s["city"], F.lit(": "), s[count].cast("string")))


def render_amount(df: DataFrame, key: str) -> DataFrame:
    """``1234.50``"""
    return _lines(df, F.col(key), clean.fmt_money(F.col("total_cents")))


def render_count(df: DataFrame, key: str, value: str) -> DataFrame:
    return _lines(df, F.col(key), F.col(value).cast("string"))


def render_city_statistics(df: DataFrame, compact: bool = False) -> DataFrame:
    pattern = fixed.REPORT_CITY_STATISTICS_COMPACT if compact else fixed.REPORT_CITY_STATISTICS
    dollars = [F.col(c) / F.lit(100.0) for c in ("total_cents", "avg_cents")]
    return _lines(df, F.col("city"), F.format_string(pattern, F.col("tx"), *dollars))


def render_city_time_period(df: DataFrame, compact: bool = False) -> DataFrame:
    names = ("morning", "afternoon", "night")
    if compact:
        text = F.format_string(fixed.REPORT_CITY_TIME_PERIOD_COMPACT, *[F.col(c) for c in (*names, "total", "peak")])
    else:
        shares = [c for n in names for c in _share(n)]
        text = F.format_string(fixed.REPORT_CITY_TIME_PERIOD, *shares, F.col("total"), F.col("peak"))
    return _lines(df, F.col("city"), text)


def render_top_categories(top: DataFrame, keys: list[str], compact: bool = False) -> DataFrame:
    """One line per place: ``Top-1: 5812 (Restaurants) 10 | Top-2: ...``; a (city, period) place
    is shown as ``CITY [Manhã]``. Also keeps the key columns and the ``total`` for sorting."""
    pattern = fixed.REPORT_TOP_CATEGORY_COMPACT if compact else fixed.REPORT_TOP_CATEGORY
    values = [F.col(c) for c in (("mcc", "tx") if compact else ("rank", "mcc", "label", "tx"))]
    entry = F.struct("rank", F.format_string(pattern, *values).alias("text"))
    lines = top.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.sum("tx").alias("total"))
    text = _joined("entries", lambda e: e["text"], "\t" if compact else " | ")
    order = [k for k in keys if k != "period"]
    if "period" in keys:
        lines = lines.withColumn("period_order", clean.period_order(F.col("period")))
        return _lines(lines, clean.period_label(F.col("city"), F.col("period")), text, *order, "period_order", "total")
    return _lines(lines, F.col(keys[0]), text, *order, "total")


def _client_shares() -> Column:
    return F.format_string(fixed.REPORT_CLIENT_SHARES, F.col("total"), *[c for n in ("low", "med", "high") for c in _share(n)])


def render_client_risk(df: DataFrame) -> DataFrame:
    spots = F.when(F.size("hotspots") > 0, F.concat(F.lit(fixed.REPORT_CLIENT_RISK_CITIES), _spots("clients")))
    return _lines(df, F.col("state"), F.concat(_client_shares(), F.coalesce(spots, F.lit(""))))


def render_rfm(df: DataFrame) -> DataFrame:
    return _lines(df, F.col("state"), F.concat(_client_shares(), F.lit(fixed.REPORT_RFM_CITIES), _spots("clients")))


def render_merchant_health(df: DataFrame) -> DataFrame:
    names = ("health_a", "health_b", "health_c", "risk_low", "risk_med", "risk_high")
    leaders = _joined(
        "top_merchants", lambda m: F.concat(m["merchant_id"], F.lit(":$"), clean.fmt_money(m["sum_cents"], True))
    )
    shares = [c for n in names for c in _share(n)]
    return _lines(df, F.col("state"), F.format_string(fixed.REPORT_MERCHANT_HEALTH, F.col("total"), *shares, leaders, _spots("merchants")))


def render_client_risk_profile(df: DataFrame) -> DataFrame:
    first = F.coalesce("first_ts", F.lit(fixed.REPORT_NO_FIRST))
    last = F.coalesce("last_ts", F.lit(fixed.REPORT_NO_LAST))
    before = [F.col(c) for c in ("tx", "total", "avg", "cities", "mccs", "cards")]
    after = [F.col(c) for c in ("online", "swipe", "errors", "chargebacks")]
    return _lines(df, F.col("client_id"), F.format_string(fixed.REPORT_CLIENT_RISK_PROFILE, *before, first, last, *after))


def render_client_risk_score(df: DataFrame) -> DataFrame:
    values = [F.col("client_id"), F.col("score").cast("double"), F.col("factors"), F.col("tx"), F.col("total")]
    return _lines(df, F.col("category"), F.format_string(fixed.REPORT_CLIENT_RISK_SCORE, *values), "score")


def render_risk_report(df: DataFrame) -> DataFrame:
    """A block of lines per category, with its ``severity`` for sorting."""
    names = ("category", "clients", "avg_score", "total_amount", "avg_amount", "avg_tx")
    clients = _joined("top_clients", lambda c: F.format_string(
        fixed.REPORT_RISK_CLIENT, c["rank"], c["client_id"], c["score"].cast("double"), c["tx"], c["total"], c["factors"]
    ), "")
    text = F.concat(F.format_string(fixed.REPORT_RISK_HEAD, *[F.col(n) for n in names]), clients, F.lit(fixed.REPORT_RISK_END))
    severity = (-clean.severity_rank(F.col("category"))).alias("severity")
    return df.select(F.col("category").alias("key"), text.alias("text"), severity)
