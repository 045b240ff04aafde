"""Scored client risk: behaviour profile, score, category and the report per category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean, fixed
from .categories import numbered


# Amounts below this are added up as decimals, exactly; the few others as doubles.
_EXACT_BELOW = 1e18


def risk_rows(df: DataFrame) -> DataFrame:
    """The values that the profile reads of each transaction.

    A row is valid when its timestamp and amount can be read; any amount that is a number counts.
    """
    text = lambda c: F.coalesce(clean.jtrim(F.col(c)), F.lit(""))
    rows = df.select(
        clean.jtrim(F.col("client_id")).alias("client_id"),
        text("merchant_city").alias("city"), text("mcc").alias("code"), text("card_id").alias("card"),
        clean.parse_ts_prefix(clean.jtrim(F.col("date"))).alias("ts"),
        clean.amount_double(F.col("amount")).alias("amount"),
        clean.is_online(F.col("use_chip"), "contains").alias("is_online"),
        clean.has_error(F.col("errors"), "null_na").alias("is_error"),
    )
    return rows.withColumns({
        "valid": F.col("ts").isNotNull() & F.col("amount").isNotNull(),
        "exact": F.when(F.abs("amount") < _EXACT_BELOW, F.abs("amount")).try_cast("decimal(28,10)"),
    })


def client_risk_profile(df: DataFrame, *extra: Column) -> DataFrame:
    """One row per client id, also for clients without any valid row (all counters 0).

    ``total`` (of absolute amounts) and ``avg`` are rounded half up to two decimals; the scoring
    reads them that way. Sums are decimals, so they do not depend on the order partitions are added
    up in. Cities, codes and cards are counted over (client, value) keys, which stay in hash
    aggregates and spread a client that holds most rows, before a second exchange brings the client
    together. ``extra`` are further aggregates over the rows.
    """
    valid = F.col("valid")
    distinct = lambda c, *blanks: F.count_distinct(F.when(valid & ~F.col(c).isin(*blanks), F.col(c)))
    profile = risk_rows(df).groupBy("client_id").agg(
        F.count_if(valid).alias("tx"),
        F.sum(F.when(valid, F.col("exact"))).alias("exact"),
        F.sum(F.when(valid & F.col("exact").isNull(), F.abs("amount"))).alias("huge"),
        F.min(F.when(valid, F.col("ts"))).alias("first"),
        F.max(F.when(valid, F.col("ts"))).alias("last"),
        F.count_if(valid & F.col("is_online")).alias("online"),
        F.count_if(valid & ~F.col("is_online")).alias("swipe"),
        F.count_if(valid & F.col("is_error")).alias("errors"),
        F.count_if(valid & (F.col("amount") < 0)).alias("chargebacks"),
        distinct("city", "", fixed.ONLINE).alias("cities"),
        distinct("code", "").alias("mccs"),
        F.count_distinct(F.when(valid, F.col("card"))).alias("cards"),
        *extra,
    )
    exact, tx, huge = F.coalesce("exact", F.lit(0).cast("decimal(38,10)")), F.col("tx"), F.col("huge")
    rounded = lambda value: F.round(value, 2).cast("double")
    total = F.when(huge.isNull(), rounded(exact)).otherwise(exact.cast("double") + huge)
    mean = F.when(tx == 0, F.lit(0.0)).when(huge.isNull(), rounded(exact / F.nullif(tx, F.lit(0))))
    return profile.select(
        "client_id", "tx",
        total.alias("total"),
        mean.otherwise((exact.cast("double") + huge) / F.nullif(tx, F.lit(0))).alias("avg"),
        "cities", "mccs", "cards",
        clean.epoch_ms(F.col("first")).alias("first_ts"),
        clean.epoch_ms(F.col("last")).alias("last_ts"),
        "online", "swipe", "errors", "chargebacks",
        *profile.columns[len(profile.columns) - len(extra):],  # the extra aggregates
    )


def _steps() -> list[list[tuple[Column, int, Column]]]:
    """The seven factors; each is a list of (test, points, text) of which the first hit counts."""
    col, some = F.col, F.col("tx") > 0
    error_pct = F.when(some, col("errors") * 100.0 / col("tx"))
    online_pct = F.when(some, col("online") * 100.0 / col("tx"))
    large = lambda limit: (col("avg") > limit) & ~F.isnan("avg")
    shown = F.format_string
    return [
        [
            (col("cities") > 5, 15, shown("HIGH_MOBILITY[%d_cities]", col("cities"))),
            (col("cities") > 3, 8, shown("MEDIUM_MOBILITY[%d_cities]", col("cities"))),
        ],
        [
            (col("mccs") > 10, 12, shown("DIVERSE_MCC[%d_categories]", col("mccs"))),
            (col("mccs") > 6, 6, shown("VARIED_MCC[%d_categories]", col("mccs"))),
        ],
        [
            (col("cards") > 3, 20, shown("MULTIPLE_CARDS[%d_cards]", col("cards"))),
            (col("cards") > 1, 8, shown("DUAL_CARDS[%d_cards]", col("cards"))),
        ],
        [
            (error_pct > 20, 25, shown("HIGH_ERROR_RATE[%.1f%%]", error_pct)),
            (error_pct > 10, 12, shown("MEDIUM_ERROR_RATE[%.1f%%]", error_pct)),
        ],
        [
            (col("chargebacks") > 3, 25, shown("FREQUENT_CHARGEBACKS[%d]", col("chargebacks"))),
            (col("chargebacks") > 0, 10, shown("CHARGEBACKS[%d]", col("chargebacks"))),
        ],
        [
            (large(500), 15, shown("HIGH_AVG_AMOUNT[%.2f]", col("avg"))),
            (large(200), 7, shown("MEDIUM_AVG_AMOUNT[%.2f]", col("avg"))),
        ],
        [
            ((online_pct > 80) | (online_pct < 20), 10, shown("UNBALANCED_CHANNELS[%.0f%%_online]", online_pct)),
        ],
    ]


def risk_category(score: Column) -> Column:
    chain = F.lit(fixed.RISK_CATEGORIES[-1][0])
    for name, _, lowest in reversed(fixed.RISK_CATEGORIES[:-1]):
        chain = F.when(score >= lowest, name).otherwise(chain)
    return chain


def with_score(profile: DataFrame) -> DataFrame:
    """Add ``score``, ``factors`` (NORMAL_BEHAVIOR when there are none) and ``category``."""
    score, texts = F.lit(0), []
    for steps in _steps():
        points = text = None
        for test, value, label in steps:
            points = F.when(test, value) if points is None else points.when(test, value)
            text = F.when(test, label) if text is None else text.when(test, label)
        score = score + points.otherwise(0)
        texts.append(text)
    scored = profile.withColumns({"score": score, "factors": F.array_join(F.array(*texts), "; ")})
    return scored.withColumns({
        "factors": F.when(F.col("factors") == "", "NORMAL_BEHAVIOR").otherwise(F.col("factors")),
        "category": risk_category(F.col("score")),
    })


def risk_score(profile: DataFrame) -> DataFrame:
    """``client_id, category, score, factors, tx, total`` for clients with an id."""
    named = profile.where(F.col("client_id") != "")
    return with_score(named).select("client_id", "category", "score", "factors", "tx", "total")


_LEADER = ("score", "tx", "total", "factors")


def _leading(risks: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of highest score of each category, equal scores by client id.

    The categories are fixed, so each is a bounded top-k of its own: every task keeps ``k`` rows while
    it reads, and ``k`` rows of each task are merged. No row is sorted beyond that. ``risks`` is read
    once per category, so it should be a written table.
    """
    best = [
        risks.where(F.col("category") == name).orderBy(F.desc("score"), "client_id").limit(k)
        for name, *_ in fixed.RISK_CATEGORIES]
    rows = reduce(DataFrame.unionAll, best)
    entry = F.struct((-F.col("score")).alias("worst"), "client_id", *_LEADER)
    return rows.groupBy("category").agg(F.array_sort(F.collect_list(entry)).alias("leaders"))  # k per category


def top_risk_clients(risks: DataFrame, k: int = 10) -> DataFrame:
    """``category, rank, client_id, score, tx, total, factors``: highest scores per category."""
    ranked = _leading(risks, k).select("category", F.inline(numbered("leaders", ["client_id", *_LEADER])))
    return ranked.select("category", "rank", "client_id", *_LEADER)


def risk_report(risks: DataFrame, k: int = 10) -> DataFrame:
    """Clients, mean score, total and mean amount, mean transactions and top clients per category,
    most severe category first. Totals are partial aggregates, leaders bounded lists. ``risks`` is
    read once for the totals and once per category: hand in a stage, not a plan still to be computed."""
    merged = risks.groupBy("category").agg(
        F.count("*").alias("clients"),
        F.sum("score").alias("points"),
        F.sum(F.when(F.abs("total") < _EXACT_BELOW, F.col("total")).try_cast("decimal(28,2)")).alias("dollars"),
        F.sum(F.when(~(F.abs("total") < _EXACT_BELOW), F.col("total"))).alias("huge"),
        F.sum("tx").alias("transactions"),
    ).join(_leading(risks, k), "category")
    amount = F.coalesce(F.col("dollars").cast("double"), F.lit(0.0)) + F.coalesce("huge", F.lit(0.0))
    report = merged.select(
        "category", "clients",
        (F.col("points") / F.col("clients")).alias("avg_score"),
        amount.alias("total_amount"),
        (amount / F.col("clients")).alias("avg_amount"),
        (F.col("transactions") / F.col("clients")).alias("avg_tx"),
        numbered("leaders", ["client_id", *_LEADER]).alias("top_clients"),
    )
    return report.orderBy(F.desc(clean.severity_rank(F.col("category"))))
