"""Thresholds of the classification rules, with their standard values.

``from_properties`` accepts the property names used on the command line
(``-D risk.error.high=0.05``); names that belong to another analysis are ignored.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Mapping, TypeVar

R = TypeVar("R", bound="Rules")


def _prop(default, name: str):
    return field(default=default, metadata={"property": name})


@dataclass(frozen=True)
class Rules:
    @classmethod
    def from_properties(cls: type[R], properties: Mapping[str, str]) -> R:
        values = {}
        for f in dataclasses.fields(cls):
            name = f.metadata["property"]
            if name in properties:
                values[f.name] = type(f.default)(properties[name])
        return cls(**values)


@dataclass(frozen=True)
class ClientRiskRules(Rules):
    error_high: float = _prop(0.05, "risk.error.high")
    error_med: float = _prop(0.02, "risk.error.med")
    online_high: float = _prop(0.80, "risk.online.high")
    online_med: float = _prop(0.60, "risk.online.med")
    avg_high_cents: int = _prop(10_000, "risk.avg_amount.high_cents")
    max_high_cents: int = _prop(50_000, "risk.max_amount.high_cents")


@dataclass(frozen=True)
class MerchantRules(Rules):
    revenue_med_cents: int = _prop(500_000, "health.revenue.med_cents")
    revenue_high_cents: int = _prop(2_000_000, "health.revenue.high_cents")
    avg_med_cents: int = _prop(8_000, "health.avg.med_cents")
    tx_min_for_avg: int = _prop(100, "health.tx.min_for_avg")
    error_med: float = _prop(0.02, "risk.error.med")
    error_high: float = _prop(0.05, "risk.error.high")
    online_med: float = _prop(0.70, "risk.online.med")
    online_high: float = _prop(0.90, "risk.online.high")
    max_high_cents: int = _prop(500_000, "risk.max.high_cents")
    top_merchants: int = _prop(5, "top.merchants.k")
    min_state_merchants: int = _prop(5, "min.uf.merchants")


@dataclass(frozen=True)
class RfmRules(Rules):
    reference_date: str = _prop("2010-05-31", "rfm.reference.date")
    recency_high_days: int = _prop(30, "rfm.recency.high_days")
    recency_med_days: int = _prop(90, "rfm.recency.med_days")
    frequency_high: int = _prop(900, "rfm.freq.high")
    frequency_med: int = _prop(400, "rfm.freq.med")
    monetary_high_cents: int = _prop(20_000, "rfm.monetary.high_cents")
    monetary_med_cents: int = _prop(8_000, "rfm.monetary.med_cents")
    top_cities: int = _prop(10, "top.cities")
