"""One DataFrame per analysis, over the star-schema tables of a directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardtide.functions import clean, fixed
from cardtide.operators import categories, city, clients, keyed, merchants, quality, rfm, risk, summaries, totals, words
from cardtide.operators.positions import positioned
from cardtide.sinks import files, render
from cardtide.sinks.stages import session_stages
from cardtide.sources.lines import parse_house_lines, parse_transactions, read_transactions
from cardtide.sources.star import card_lines, card_transactions, house_lines, read_table

from . import rules

Query = Callable[[SparkSession, str], DataFrame]

_CITY_AMOUNT = ("amount", "merchant_city")
_CLIENT = ("client_id", "amount", "use_chip", "merchant_city", "merchant_state", "errors")
_MERCHANT = ("merchant_id", "amount", "use_chip", "merchant_city", "merchant_state", "errors")
_RFM = ("client_id", "date", "amount", "merchant_city", "merchant_state")
_RISK = ("client_id", "card_id", "date", "amount", "use_chip", "merchant_city", "mcc", "errors")


def _on(columns: tuple[str, ...], *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies the steps to the given transaction columns."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = card_transactions(spark, sf_dir, *columns)
        for step in steps:
            df = step(df)
        return df
    return query


def _on_lines(*steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies the steps to the raw text lines."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = card_lines(spark, sf_dir)
        for step in steps:
            df = step(df)
        return df
    return query


def _parse(dialect: str) -> Callable[[DataFrame], DataFrame]:
    return lambda lines: parse_transactions(lines, dialect)


def _text(items: str, entry: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.col(items), entry), " | ").alias(items)


def _flat(df: DataFrame, **texts: Callable[[Column], Column]) -> DataFrame:
    """Array columns as text, so that results can be compared as plain values."""
    return df.withColumns({name: _text(name, entry) for name, entry in texts.items()})


def _spots(count: str) -> Callable[[Column], Column]:
    return lambda s: F.format_string("%d. %s: %d", s["rank"], s["city"], s[count])


def _leader_entry(m: Column) -> Column:
    return F.format_string("%d. %s: %d (%s, %s)", m["rank"], m["merchant_id"], m["sum_cents"], m["health"], m["risk"])


def _classified_clients(df: DataFrame) -> DataFrame:
    return clients.classify_client_risk(clients.client_channel_profile(df), rules.CLIENT)


def _classified_merchants(df: DataFrame) -> DataFrame:
    return merchants.classify_merchants(merchants.merchant_profile(df), rules.MERCHANT)


def _rfm(df: DataFrame) -> DataFrame:
    return rfm.rfm_client(df, rules.RFM)


def _classified_rfm(df: DataFrame) -> DataFrame:
    return rfm.classify_rfm(_rfm(df), rules.RFM)


def _shown_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("last_ts", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss"))


def _risks(df: DataFrame) -> DataFrame:
    return risk.risk_score(risk.client_risk_profile(df))


def _merchant_states(df: DataFrame) -> DataFrame:
    return merchants.merchant_health_by_state(df, rules.MERCHANT)


def clean_places(df: DataFrame) -> DataFrame:
    """Rows per cleaned city, state and country under every place rule."""
    city_text, state_text = F.col("merchant_city"), F.col("merchant_state")
    return totals.count_by_rule(df, ["merchant_city", "merchant_state"], {
        "city": clean.norm_city(city_text),
        "state": clean.norm_state(state_text, city_text),
        "us_state": F.coalesce(clean.us_state(state_text), F.lit("-")),
        "country": F.coalesce(clean.country(state_text), F.lit("-")),
        "state_or_unknown": clean.nz_unknown(clean.trim_quotes(state_text)),
        "state_or_empty": clean.nz_empty(state_text),
    }, "n")


def clean_channels(df: DataFrame) -> DataFrame:
    """Rows per transaction type, online flag, error flag and category code under every rule."""
    chip, errors, mcc = F.col("use_chip"), F.col("errors"), F.col("mcc")
    return totals.count_by_rule(df, ["use_chip", "errors", "mcc"], {
        "txn_type": clean.txn_type(chip),
        "truthy": clean.truthy(chip),
        **{f"online_{r}": clean.is_online(chip, r) for r in ("phrase", "phrase_or_word", "contains")},
        **{f"error_{r}": clean.has_error(errors, r) for r in ("no_error", "any_text", "none_na", "null_na")},
        "mcc_lenient": clean.mcc_lenient(mcc),
        "mcc_strict": F.coalesce(clean.mcc_strict(mcc), F.lit("-")),
    }, "n")


def clean_values(df: DataFrame) -> DataFrame:
    """Amounts under the three money rules, per part of the day and readability of the date."""
    rows = df.select(
        F.coalesce(clean.day_period(F.col("date")), F.lit("-")).alias("period"),
        clean.parse_ts(clean.jtrim(F.col("date"))).isNull().alias("no_ts"),
        clean.norm_client(F.col("client_id")).isNull().alias("no_client"),
        clean.cents_exact(F.col("amount")).alias("cents_exact"),
        clean.cents_double(F.col("amount")).alias("cents_double"),
        clean.amount_double(F.col("amount")).alias("amount_double"),
    )
    zero = F.lit(0).cast("bigint")
    return rows.groupBy("period", "no_ts", "no_client").agg(
        F.count("*").alias("n"),
        F.count("cents_exact").alias("amounts"),
        F.coalesce(F.sum("cents_exact"), zero).alias("cents_exact"),
        F.coalesce(F.sum("cents_double"), zero).alias("cents_double"),
        F.count("amount_double").alias("amounts_double"),
    )


def _house(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "part")
    return keyed.avg_by_keys(parts, ["p_brand", "p_type"], "p_retailprice", "avg_price").withColumn(
        "avg_price", F.round("avg_price", 6))


def _house_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = parse_house_lines(house_lines(spark, sf_dir))
    return keyed.avg_by_keys(sales, ["city", "status"], "price", "avg_price").withColumn("avg_price", F.round("avg_price", 6))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(read_table(spark, sf_dir, "documents"), "text")


def _staged(df: DataFrame) -> DataFrame:
    """The typed hand-off between two jobs."""
    return session_stages(df.sparkSession).keep(df, "stage")


def _ordered(order: str, *ties: str) -> Callable[[DataFrame], DataFrame]:
    """A declared order with the position of each row; equal rows go by the columns named last."""
    def step(df: DataFrame) -> DataFrame:
        by = [*summaries.ORDERS[order](), *map(F.asc, ties)]
        return positioned(df, by, session_stages(df.sparkSession)).orderBy("position")
    return step


def _report(df: DataFrame) -> DataFrame:
    """Report lines with their position: by the report's own order where it has one, else by key."""
    own = [c for c in ("severity", "city", "period_order") if c in df.columns]
    placed = positioned(df, [F.asc(c) for c in [*(own or ["key"]), "text"]], session_stages(df.sparkSession))
    return placed.select("key", "text", "position").orderBy("position")


def _from_files(dialect: str, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over real text files: the raw lines written to several files, each with a header."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = session_stages(spark).path("lines")
        files.write_lines(card_lines(spark, sf_dir), path, 6, ",".join(fixed.COLUMNS))
        df = read_transactions(spark, path, dialect=dialect)
        for step in steps:
            df = step(df)
        return df
    return query


def _written(count: int | None, again: bool = False) -> Callable[[DataFrame], DataFrame]:
    """A report written to ``count`` files (None: as many as Spark chooses) and read back; with
    ``again`` it replaces another report."""
    def step(df: DataFrame) -> DataFrame:
        path = session_stages(df.sparkSession).path("report")
        if again:
            files.write_report(df.limit(1), path, 1)
        files.write_report(df, path, count, "overwrite" if again else "errorifexists")
        back = files.read_report(df.sparkSession, path)
        return back.select("part", "line", "text") if count == 1 else back.select("position", "text")
    return step


def _counts(by: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: categories.category_counts(df, by)


_PLACE = {"city": "merchant_city", "state": "merchant_state", "country": "merchant_state"}
_STATE = ("merchant_state", "merchant_city")
_PERIOD = ("date", "merchant_city")
_CITY_PERIOD = ("date", "merchant_city", "mcc")

QUERIES: dict[str, Query] = {
    # lines and cleaning rules
    "scan_toggle": _on_lines(_parse("toggle")),
    "scan_even_quotes": _on_lines(_parse("even_quotes")),
    "scan_naive": _on_lines(_parse("naive")),
    "clean_places": _on_lines(_parse("toggle"), clean_places),
    "clean_channels": _on_lines(_parse("toggle"), clean_channels),
    "clean_values": _on_lines(_parse("toggle"), clean_values),
    "amount_by_city_from_lines": _on_lines(_parse("toggle"), totals.amount_by_city),
    "amount_by_client_from_lines": _on_lines(_parse("even_quotes"), totals.amount_by_client),
    "client_risk_from_lines": _on_lines(_parse("naive"), _risks),
    # real files
    "amount_by_city_from_files": _from_files("toggle", totals.amount_by_city),
    "amount_by_client_from_files": _from_files("even_quotes", totals.amount_by_client),
    "client_risk_from_files": _from_files("naive", _risks),
    "report_in_one_file": _on(_CITY_AMOUNT, totals.amount_by_city, lambda d: render.render_amount(d, "city"), _written(1)),
    "report_in_three_files": _on(
        ("amount", "client_id"), totals.amount_by_client, lambda d: render.render_amount(d, "client_id"), _written(3)),
    "report_in_any_files": _on(
        ("mcc", "errors"), totals.error_count_by_mcc, lambda d: render.render_count(d, "mcc", "errors"), _written(None)),
    "report_written_over": _on(_STATE, totals.count_by_state, lambda d: render.render_count(d, "state", "tx"), _written(2, again=True)),
    # two jobs with a typed stage between them
    "top_categories_by_city_period_staged": _on(
        _CITY_PERIOD, categories.city_period_category_counts, _staged, lambda d: categories.top_categories(d, ["city", "period"])),
    "client_risk_by_state_staged": _on(
        _CLIENT, _classified_clients, _staged, clients.client_risk_by_state, lambda d: _flat(d, hotspots=_spots("clients"))),
    "merchant_health_by_state_staged": _on(
        _MERCHANT, _classified_merchants, _staged, _merchant_states,
        lambda d: _flat(d, hotspots=_spots("merchants"), top_merchants=_leader_entry)),
    "rfm_by_state_staged": _on(
        _RFM, _classified_rfm, _staged, lambda d: rfm.rfm_by_state(d, rules.RFM), lambda d: _flat(d, hotspots=_spots("clients"))),
    # lookups
    "mcc_lookup": _on(("mcc",), categories.mcc_lookup),
    "state_lookup": _on(_STATE, totals.count_by_state, summaries.state_lookup),
    # totals and counts
    "amount_by_city": _on(_CITY_AMOUNT, totals.amount_by_city),
    "amount_by_client": _on(("amount", "client_id"), totals.amount_by_client),
    "count_by_txn_type": _on(("use_chip",), totals.count_by_txn_type),
    "error_count_by_mcc": _on(("mcc", "errors"), totals.error_count_by_mcc),
    "count_by_state": _on(_STATE, totals.count_by_state),
    "city_statistics": _on(_CITY_AMOUNT, city.city_statistics),
    "city_time_period": _on(_PERIOD, city.city_time_period),
    # categories
    **{f"category_counts_{by}": _on((raw, "mcc"), _counts(by)) for by, raw in _PLACE.items()},
    "city_period_category_counts": _on(_CITY_PERIOD, categories.city_period_category_counts),
    "top_categories_by_city": _on(("merchant_city", "mcc"), categories.top_categories_by_city),
    "top_categories_by_state": _on(("merchant_state", "mcc"), categories.top_categories_by_state),
    "top_categories_by_country": _on(("merchant_state", "mcc"), categories.top_categories_by_country),
    "top_categories_by_city_period": _on(_CITY_PERIOD, categories.top_categories_by_city_period),
    # clients
    "client_channel_profile": _on(_CLIENT, clients.client_channel_profile),
    "classify_client_risk": _on(_CLIENT, _classified_clients),
    "client_risk_by_state": _on(
        _CLIENT, _classified_clients, clients.client_risk_by_state, lambda d: _flat(d, hotspots=_spots("clients"))),
    "client_hotspots": _on(_CLIENT, _classified_clients, clients.client_hotspots),
    # merchants
    "merchant_profile": _on(_MERCHANT, merchants.merchant_profile),
    "classify_merchant_health": _on(
        _MERCHANT, merchants.merchant_profile, lambda d: merchants.classify_merchant_health(d, rules.MERCHANT)),
    "classify_merchant_risk": _on(
        _MERCHANT, merchants.merchant_profile, lambda d: merchants.classify_merchant_risk(d, rules.MERCHANT)),
    "merchant_health_by_state": _on(
        _MERCHANT, _classified_merchants, _merchant_states,
        lambda d: _flat(d, hotspots=_spots("merchants"), top_merchants=_leader_entry)),
    "top_merchants_by_state": _on(_MERCHANT, _classified_merchants, merchants.top_merchants_by_state),
    "merchant_hotspots": _on(_MERCHANT, _classified_merchants, merchants.merchant_hotspots),
    # recency, frequency, monetary value
    "rfm_client": _on(_RFM, _rfm, _shown_ts),
    "classify_rfm": _on(_RFM, _classified_rfm, _shown_ts),
    "rfm_by_state": _on(
        _RFM, _classified_rfm, lambda d: rfm.rfm_by_state(d, rules.RFM),
        lambda d: _flat(d, hotspots=_spots("clients"))),
    "rfm_hotspots": _on(_RFM, _classified_rfm, lambda d: rfm.rfm_hotspots(d, rules.RFM)),
    # scored risk
    "client_risk_profile": _on(_RISK, risk.client_risk_profile),
    "risk_score": _on(_RISK, _risks),
    "top_risk_clients": _on(_RISK, _risks, _staged, risk.top_risk_clients),
    "risk_report": _on(
        _RISK, _risks, _staged, risk.risk_report,
        lambda d: _flat(d, top_clients=lambda c: F.format_string(
            "%d. %s %d %d %.2f", c["rank"], c["client_id"], c["score"], c["tx"], c["total"]))),
    # text and composite keys
    "word_count": _words,
    "avg_by_keys": _house,
    "avg_by_keys_from_lines": _house_from_lines,
    # run summaries
    "summary_amount": _on(_CITY_AMOUNT, totals.amount_by_city, summaries.summary_amount),
    "summary_amount_client": _on(("amount", "client_id"), totals.amount_by_client, summaries.summary_amount_client),
    "summary_types": _on(("use_chip",), totals.count_by_txn_type, summaries.summary_types),
    "summary_errors": _on(("mcc", "errors"), totals.error_count_by_mcc, summaries.summary_errors),
    "summary_states": _on(_STATE, totals.count_by_state, summaries.summary_states),
    "region_totals": _on(_STATE, totals.count_by_state, summaries.region_totals),
    "summary_city_stats": _on(_CITY_AMOUNT, city.city_statistics, summaries.summary_city_stats),
    "summary_periods": _on(_PERIOD, city.city_time_period, summaries.summary_periods),
    **{
        f"summary_diversity_{by}": _on(
            (raw, "mcc"), _counts(by), lambda d, by=by: summaries.summary_diversity(d, by))
        for by, raw in _PLACE.items()
    },
    "summary_country": _on(("merchant_state", "mcc"), _counts("country"), summaries.summary_country),
    "summary_city_period": _on(_CITY_PERIOD, categories.city_period_category_counts, summaries.summary_city_period),
    "period_totals": _on(_CITY_PERIOD, categories.city_period_category_counts, summaries.period_totals),
    # declared orders
    "ranked_city_statistics": _on(_CITY_AMOUNT, city.city_statistics, _ordered("city_statistics", "city")),
    "ranked_city_time_period": _on(_PERIOD, city.city_time_period, _ordered("city_time_period", "city")),
    "ranked_top_categories": _on(
        ("merchant_city", "mcc"), categories.top_categories_by_city,
        lambda d: render.render_top_categories(d, ["city"]), _ordered("top_categories", "city")),
    "ranked_client_risk_by_state": _on(
        _CLIENT, _classified_clients, clients.client_risk_by_state, lambda d: d.drop("hotspots"), _ordered("client_risk_by_state", "state")),
    "ranked_client_risk_profile": _on(_RISK, risk.client_risk_profile, _ordered("client_risk_profile")),
    "ranked_client_risk": _on(_RISK, _risks, _ordered("client_risk")),
    # data quality
    "quality_toggle": _on_lines(lambda d: quality.quality(d, "toggle")),
    "quality_even_quotes": _on_lines(lambda d: quality.quality(d, "even_quotes")),
    "quality_errors": _on_lines(quality.quality_errors),
    "quality_states": _on_lines(quality.quality_states),
    "quality_periods": _on_lines(quality.quality_periods),
    "quality_periods_numeric": _on_lines(lambda d: quality.quality_periods(d, numeric_mcc=True)),
    "quality_location": _on_lines(quality.quality_location),
    "quality_risk": _on_lines(quality.quality_risk),
    # report lines
    "report_amount_by_city": _on(_CITY_AMOUNT, totals.amount_by_city, lambda d: render.render_amount(d, "city"), _report),
    "report_amount_by_client": _on(
        ("amount", "client_id"), totals.amount_by_client, lambda d: render.render_amount(d, "client_id"), _report),
    "report_type_counts": _on(
        ("use_chip",), totals.count_by_txn_type, lambda d: render.render_count(d, "txn_type", "tx"), _report),
    "report_error_counts": _on(
        ("mcc", "errors"), totals.error_count_by_mcc, lambda d: render.render_count(d, "mcc", "errors"), _report),
    "report_state_counts": _on(_STATE, totals.count_by_state, lambda d: render.render_count(d, "state", "tx"), _report),
    **{
        f"report_top_categories_by_{by}": _on(
            (raw, "mcc"), _counts(by), lambda d, by=by: categories.top_categories(d, [by]),
            lambda d, by=by: render.render_top_categories(d, [by]), _report)
        for by, raw in _PLACE.items()
    },
    "report_city_statistics": _on(_CITY_AMOUNT, city.city_statistics, render.render_city_statistics, _report),
    "report_city_time_period": _on(_PERIOD, city.city_time_period, render.render_city_time_period, _report),
    "report_top_categories_by_city_period": _on(
        _CITY_PERIOD, categories.city_period_category_counts,
        lambda d: categories.top_categories(d, ["city", "period"]),
        lambda d: render.render_top_categories(d, ["city", "period"]), _report),
    "report_client_risk": _on(
        _CLIENT, _classified_clients, clients.client_risk_by_state, render.render_client_risk, _report),
    "report_merchant_health": _on(
        _MERCHANT, _classified_merchants, _merchant_states, render.render_merchant_health, _report),
    "report_rfm": _on(
        _RFM, _classified_rfm, lambda d: rfm.rfm_by_state(d, rules.RFM), render.render_rfm, _report),
    "report_client_risk_profile": _on(
        _RISK, risk.client_risk_profile, render.render_client_risk_profile, _report),
    "report_risk_score": _on(_RISK, _risks, render.render_client_risk_score, _report),
    "report_risk": _on(_RISK, _risks, _staged, risk.risk_report, render.render_risk_report, _report),
}
