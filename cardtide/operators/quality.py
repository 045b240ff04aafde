"""Data-quality counters over raw lines: what each analysis reads, skips, accepts and rejects.

Every function reads the lines once and reduces them to counters in one global aggregate (or,
for the risk analysis, over its own profile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, fixed
from ..sources.lines import DIALECTS, drop_header, is_header, name_fields
from .risk import client_risk_profile, with_score


def _fields(lines: DataFrame, dialect: str) -> DataFrame:
    """All lines with ``header``, ``complete`` (enough fields, no header) and the named fields."""
    parts = lines.select(
        is_header(F.col("value")).alias("header"), DIALECTS[dialect](F.col("value")).alias("parts")
    )
    named = [F.get("parts", F.lit(i)).alias(n) for i, n in enumerate(fixed.COLUMNS)]
    complete = ~F.col("header") & (F.size("parts") >= len(fixed.COLUMNS))
    return parts.select("header", complete.alias("complete"), *named)


def _validity(dialect: str) -> dict[str, Column]:
    """Analyses of this dialect, with the test a complete row must pass."""
    col = F.col
    if dialect == "even_quotes":
        return {
            "amount_by_client": clean.norm_client(col("client_id")).isNotNull() & col("cents").isNotNull(),
            "error_count_by_mcc": F.lit(True),
            "transaction_count_by_state": F.lit(True),
        }
    amount, category, period = col("cents").isNotNull(), col("category").isNotNull(), col("period").isNotNull()
    return {
        "amount_by_city": amount,
        "chip_usage_count": F.lit(True),
        "city_statistics": amount,
        "city_time_period": period,
        "top_categories_by_city": category,
        "top_categories_by_state": category & clean.us_state(col("merchant_state")).isNotNull(),
        "top_categories_by_country": category & clean.country(col("merchant_state")).isNotNull(),
        "category_by_time_period": category & period,
        "client_behavior": (clean.trim_quotes(col("client_id")) != "") & amount,
    }


def quality(lines: DataFrame, dialect: str) -> DataFrame:
    """``analysis, read, header, valid, invalid, success_pct`` for the analyses of one dialect."""
    rows = _fields(lines, dialect).withColumns({
        "cents": clean.cents_exact(F.col("amount")),
        "category": clean.mcc_strict(F.col("mcc")),
        "period": clean.day_period(F.col("date")),
    })
    tests = _validity(dialect)
    counts = rows.agg(
        F.count("*").alias("read"), F.count_if("header").alias("header"),
        *[F.count_if(F.col("complete") & test).alias(name) for name, test in tests.items()],
    )
    entries = [F.struct(F.lit(name).alias("analysis"), F.col(name).alias("valid")) for name in tests]
    table = counts.select("read", "header", F.inline(F.array(*entries)))
    return table.select(
        "analysis", "read", "header", "valid",
        (F.col("read") - F.col("header") - F.col("valid")).alias("invalid"),
        clean.pct(F.col("valid"), F.col("read")).alias("success_pct"),
    )


def quality_errors(lines: DataFrame) -> DataFrame:
    """Rows with and without an error, error rate among valid rows."""
    rows = _fields(lines, "even_quotes")
    error = F.coalesce(clean.has_error(F.col("errors"), "no_error"), F.lit(False))
    counts = rows.agg(
        F.count("*").alias("read"), F.count_if("complete").alias("valid"),
        F.count_if(F.col("complete") & error).alias("with_error"),
    )
    return counts.withColumns({
        "without_error": F.col("valid") - F.col("with_error"),
        "error_pct": clean.pct(F.col("with_error"), F.col("valid")),
        "success_pct": clean.pct(F.col("valid"), F.col("read")),
    })


def quality_states(lines: DataFrame) -> DataFrame:
    """Online and unknown states, their rates among valid rows, and distinct states."""
    raws = ["merchant_state", "merchant_city"]
    by_text = _fields(lines, "even_quotes").groupBy("complete", *raws).agg(F.count("*").alias("n"))
    state = F.when(F.col("complete"), clean.norm_state(*map(F.col, raws)))
    counted = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0).cast("bigint"))
    counts = by_text.withColumn("state", state).agg(
        counted(F.lit(True)).alias("read"), counted(F.col("complete")).alias("valid"),
        counted(F.col("state") == fixed.ONLINE).alias("online"),
        counted(F.col("state") == fixed.UNKNOWN).alias("unknown"),
        F.count_distinct("state").alias("distinct_states"),
    )
    return counts.withColumns({
        "online_pct": clean.pct(F.col("online"), F.col("valid")),
        "unknown_pct": clean.pct(F.col("unknown"), F.col("valid")),
    })


def quality_periods(lines: DataFrame, numeric_mcc: bool = False) -> DataFrame:
    """Valid rows per part of the day; with ``numeric_mcc`` a numeric category is needed too."""
    rows = _fields(lines, "toggle").withColumn("period", clean.day_period(F.col("date")))
    ok = F.col("complete")
    if numeric_mcc:
        ok = ok & clean.mcc_strict(F.col("mcc")).isNotNull()
    names = [code.lower() for code, *_ in fixed.DAY_PERIODS]
    counts = rows.agg(
        F.count("*").alias("read"), F.count_if(ok & F.col("period").isNotNull()).alias("valid"),
        *[F.count_if(ok & (F.col("period") == n.upper())).alias(n) for n in names],
    )
    return counts.withColumns({f"{n}_pct": clean.pct(F.col(n), F.col("valid")) for n in names})


def quality_location(lines: DataFrame) -> DataFrame:
    """Accepted and rejected rows of the US-only and the foreign-only filter."""
    rows = _fields(lines, "toggle").withColumn("category", clean.mcc_strict(F.col("mcc")))
    usable = F.col("complete") & F.col("category").isNotNull()
    place = F.col("merchant_state")
    counts = rows.agg(
        F.count("*").alias("read"), F.count_if("header").alias("header"),
        F.count_if(usable & clean.us_state(place).isNotNull()).alias("us_accepted"),
        F.count_if(usable & clean.country(place).isNotNull()).alias("foreign_accepted"),
    )
    body = F.col("read") - F.col("header")
    return counts.withColumns({
        "us_rejected": body - F.col("us_accepted"),
        "foreign_rejected": body - F.col("foreign_accepted"),
        "us_pct": clean.pct(F.col("us_accepted"), F.col("read")),
        "foreign_pct": clean.pct(F.col("foreign_accepted"), F.col("read")),
    })


def quality_risk(lines: DataFrame) -> DataFrame:
    """Counters of the risk analysis: short lines, unreadable rows, profiles, clients per category.

    Short lines take part with all fields NULL, so they form the profile of the NULL client and
    one pass yields all counters.
    """
    value = clean.jtrim(F.col("value"))
    body = drop_header(lines, "id_prefix").select(DIALECTS["naive"](value).alias("parts"))
    complete = F.when(F.size("parts") >= len(fixed.COLUMNS), F.col("parts"))
    rows = name_fields(body.select(complete.alias("parts")))
    profiles = with_score(client_risk_profile(rows, F.count("*").alias("rows")))
    client, n = F.col("client_id"), F.col("rows")
    named = client != ""
    zero = F.lit(0).cast("bigint")
    in_category = {c.lower(): F.count_if(named & (F.col("category") == c)) for c, *_ in fixed.RISK_CATEGORIES}
    counts = profiles.agg(
        F.coalesce(F.sum(F.when(client.isNull(), n)), zero).alias("invalid_records"),
        F.coalesce(F.sum(F.when(client.isNotNull(), n)), zero).alias("valid_records"),
        F.coalesce(F.sum(F.when(client.isNotNull(), n - F.col("tx"))), zero).alias("parse_errors"),
        F.count("client_id").alias("profiles"),
        F.count_if(client == "").alias("blank_clients"),
        F.count_if(named).alias("classified"),
        *[count.alias(f"category_{c}") for c, count in in_category.items()],
    )
    reports = sum(((F.col(f"category_{c}") > 0).cast("int") for c in in_category), F.lit(0))
    return counts.withColumn("reports", reports)
