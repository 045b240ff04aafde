"""The 15 analyses end to end: read lines, compute the table, write the report.

Each entry names its CSV dialect, the profile stage shared by its outputs (if any), the result
table, the report lines and their order. Without a stage path an analysis is one lazy plan, except
where the result reads its stage several times: that is a table in the shared folder then. With a
path, the profile is written there as a typed table first and everything after reads it, which also
bounds what must be recomputed when executors are lost.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import ClientRiskRules, MerchantRules, RfmRules
from ..operators import categories, city, clients, merchants, rfm, risk, totals
from ..sinks import files as sink, render
from ..sinks.stages import session_stages
from ..sources.lines import read_transactions

Properties = Mapping[str, str]


@dataclass(frozen=True)
class Routine:
    dialect: str
    table: Callable[[DataFrame, Properties], DataFrame]
    lines: Callable[[DataFrame], DataFrame]
    stage: Callable[[DataFrame, Properties], DataFrame] | None = None
    order: tuple[str, ...] = ("key",)
    mode: str = "errorifexists"
    read_often: bool = False


def _client_stage(df: DataFrame, p: Properties) -> DataFrame:
    return clients.classify_client_risk(clients.client_channel_profile(df), ClientRiskRules.from_properties(p))


def _merchant_stage(df: DataFrame, p: Properties) -> DataFrame:
    return merchants.classify_merchants(merchants.merchant_profile(df), MerchantRules.from_properties(p))


def _rfm_stage(df: DataFrame, p: Properties) -> DataFrame:
    rules = RfmRules.from_properties(p)
    return rfm.classify_rfm(rfm.rfm_client(df, rules), rules)


def _top(by: str) -> Routine:
    return Routine(
        "toggle",
        lambda df, p: categories.top_categories(categories.category_counts(df, by), [by]),
        lambda t: render.render_top_categories(t, [by]),
    )


ROUTINES: dict[str, Routine] = {
    "amount_by_city": Routine(
        "toggle", lambda df, p: totals.amount_by_city(df), lambda t: render.render_amount(t, "city")),
    "amount_by_client": Routine(
        "even_quotes", lambda df, p: totals.amount_by_client(df), lambda t: render.render_amount(t, "client_id")),
    "chip_usage_count": Routine(
        "toggle", lambda df, p: totals.count_by_txn_type(df), lambda t: render.render_count(t, "txn_type", "tx")),
    "error_count_by_mcc": Routine(
        "even_quotes", lambda df, p: totals.error_count_by_mcc(df), lambda t: render.render_count(t, "mcc", "errors")),
    "transaction_count_by_state": Routine(
        "even_quotes", lambda df, p: totals.count_by_state(df), lambda t: render.render_count(t, "state", "tx")),
    "city_statistics": Routine("toggle", lambda df, p: city.city_statistics(df), render.render_city_statistics),
    "city_time_period": Routine("toggle", lambda df, p: city.city_time_period(df), render.render_city_time_period),
    "top_categories_by_city": _top("city"),
    "top_categories_by_state": _top("state"),
    "top_categories_by_country": _top("country"),
    "category_by_time_period": Routine(
        "toggle",
        stage=lambda df, p: categories.city_period_category_counts(df),
        table=lambda counts, p: categories.top_categories(counts, ["city", "period"]),
        lines=lambda t: render.render_top_categories(t, ["city", "period"]),
        order=("city", "period_order"),
    ),
    "client_behavior": Routine(
        "toggle", stage=_client_stage,
        table=lambda c, p: clients.client_risk_by_state(c), lines=render.render_client_risk),
    "merchant_risk": Routine(
        "toggle", stage=_merchant_stage,
        table=lambda c, p: merchants.merchant_health_by_state(c, MerchantRules.from_properties(p)),
        lines=render.render_merchant_health),
    "rfm_by_state": Routine(
        "toggle", stage=_rfm_stage,
        table=lambda c, p: rfm.rfm_by_state(c, RfmRules.from_properties(p)), lines=render.render_rfm),
    "risk_analysis": Routine(
        "naive", stage=lambda df, p: risk.risk_score(risk.client_risk_profile(df)),
        table=lambda r, p: risk.risk_report(r), lines=render.render_risk_report,
        order=("severity",), mode="overwrite", read_often=True),
}


def result_table(spark: SparkSession, name: str, *inputs: str, properties: Properties | None = None,
                 stage: str | None = None) -> DataFrame:
    """The result table of an analysis over text files."""
    routine, properties = ROUTINES[name], properties or {}
    df = read_transactions(spark, *inputs, dialect=routine.dialect)
    if routine.stage:
        df = routine.stage(df, properties)
        if stage:
            df = sink.write_table(df, stage, routine.mode)
        elif routine.read_often:
            df = session_stages(spark).keep(df, name)
    return routine.table(df, properties)


def run(spark: SparkSession, name: str, inputs: str | list[str], output: str, *, files: int | None = None,
        mode: str | None = None, properties: Properties | None = None, stage: str | None = None) -> None:
    """Run an analysis and write its report.

    An existing output is an error, except for the risk analysis, which replaces it; ``mode``
    overrides this.
    """
    routine = ROUTINES[name]
    inputs = [inputs] if isinstance(inputs, str) else inputs
    table = result_table(spark, name, *inputs, properties=properties, stage=stage)
    sink.write_report(routine.lines(table), output, files, mode or routine.mode, list(routine.order))
