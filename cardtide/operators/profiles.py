"""Building blocks of the client and merchant profiles.

A profile is reduced by owner and place first, in hash aggregates whose partial results merge, so raw
rows are never sorted and an owner with a large share of them is reduced on the map side. The
predominant state and city are then found among an owner's places, not among its rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clean
from .categories import numbered, top_per_group, totals_with_leaders

BUCKETS = ("LOW", "MED", "HIGH")
#: Parts a state is split into while its owners are reduced.
SALTS = 256


class Measure(NamedTuple):
    """An aggregate over rows, and how its results for parts of the rows are merged."""
    over_rows: Column
    merged: Callable[[Column], Column] = F.sum


def predominant(value: Column, n: Column) -> Column:
    """The value of the largest ``n`` among the rows of a group, the smallest one on ties; rows whose
    ``n`` is NULL take no part. An aggregate over rows that are counted per value already."""
    return F.min(F.when(n.isNotNull(), F.struct((-n).alias("order"), value.alias("value"))))["value"]


def owner_profile(rows: DataFrame, owner: str, counted: Column, measures: dict[str, Measure]) -> DataFrame:
    """One row per owner: ``tx`` (rows for which ``counted`` holds), the measures, and the
    predominant ``state`` and ``city`` of those rows, the smallest on ties.

    ``rows`` has the cleaned owner, state and city. Owners without a counted row or a name are left
    out. Rows are counted per (owner, state, city), these per (owner, state) and (owner, city), and
    those decide the owner's two votes; each step sees only what the one before has reduced.
    """
    measures = {"tx": Measure(F.count_if(counted)), **measures}
    named = lambda merge: [merge(name, m).alias(name) for name, m in measures.items()]
    places = rows.groupBy(owner, "state", "city").agg(*named(lambda _, m: m.over_rows))
    places = places.where((F.col("tx") > 0) & (F.col(owner) != ""))
    # Measures travel with the state; the city's entry has its number of rows alone.
    ballot = lambda kind, *values: F.struct(F.lit(kind).alias("is_state"), F.col("state" if kind else "city").alias("value"), F.col("tx").alias("n"), *values)
    by_state = ballot(True, *[F.col(name) for name in measures])
    by_city = ballot(False, *[F.lit(None).cast(places.schema[name].dataType).alias(name) for name in measures])
    votes = places.select(owner, F.inline(F.array(by_state, by_city)))
    values = votes.groupBy(owner, "is_state", "value").agg(
        F.sum("n").alias("n"), *named(lambda name, m: m.merged(F.col(name))))
    of = lambda test: predominant(F.col("value"), F.when(test, F.col("n")))
    return values.groupBy(owner).agg(
        *named(lambda name, m: m.merged(F.col(name))),
        of(F.col("is_state")).alias("state"), of(~F.col("is_state")).alias("city"))


def high_cities(classified: DataFrame, bucket: str, out: str) -> DataFrame:
    """``state, city, <out>``: owners in the HIGH bucket per predominant state and city."""
    high = classified.where((F.col(bucket) == "HIGH") & (F.col("city") != ""))
    return high.groupBy("state", "city").agg(F.count("*").alias(out))


def hotspots(classified: DataFrame, bucket: str, k: int, out: str) -> DataFrame:
    """``state, rank, city, <out>``: the ``k`` cities with most HIGH owners per state."""
    cities = high_cities(classified, bucket, out)
    return top_per_group(cities, ["state"], [F.desc(out), F.asc("city")], k).select("state", "rank", "city", out)


class Leading(NamedTuple):
    """The ``k`` owners with the largest ``value`` per state, as an array ``name`` of structs of
    ``fields`` with their ``rank``; equal values by owner. ``k`` bounds what is gathered: at most
    ``SALTS * k`` structs per state and step."""
    name: str
    owner: str
    value: str
    fields: list[str]
    k: int

    def entry(self) -> Column:
        return F.struct((-F.col(self.value)).alias("_order"), *self.fields)

    def merged(self, column: str) -> Column:
        return F.slice(F.array_sort(F.flatten(F.collect_list(column))), 1, self.k).alias(self.name)


def state_rollup(classified: DataFrame, counts: dict[str, Column], bucket: str, k: int, out: str,
                 leading: Leading | None = None) -> DataFrame:
    """Counters and hotspots per state, and leading owners where asked for, in one pass over the
    classified owners.

    Owners are reduced per (state, city) first; cities are then ranked and added up in salted
    parts of a state. ``hotspots`` is an array of at most ``k`` structs (rank, city, count). With
    ``leading``, owners go through salted parts of their own before they are reduced per city, and
    each part hands on its first owners only.
    """
    measures = {
        "total": F.count("*"),
        **{name: F.count_if(test) for name, test in counts.items()},
        out: F.count_if((F.col(bucket) == "HIGH") & (F.col("city") != "")),
    }
    extra = {}
    if leading is None:
        per_city = classified.groupBy("state", "city").agg(*[m.alias(n) for n, m in measures.items()])
    else:
        within = Window.partitionBy("state", "_salt").orderBy(F.desc(leading.value), leading.owner)
        salted = classified.withColumn("_salt", F.pmod(F.xxhash64(leading.owner), F.lit(SALTS)))
        first = F.when(F.row_number().over(within) <= leading.k, leading.entry())
        parts = salted.withColumn("_first", first).groupBy("state", "_salt", "city").agg(
            *[m.alias(n) for n, m in measures.items()], F.collect_list("_first").alias("_firsts"))
        per_city = parts.groupBy("state", "city").agg(*[F.sum(n).alias(n) for n in measures], leading.merged("_firsts"))
        extra[leading.name] = leading.merged(leading.name)
    totals = {name: F.sum(name) for name in ("total", *counts)}
    merged = totals_with_leaders(
        per_city.withColumn("coldest", -F.col(out)), "state", "city", ["coldest", "city"], [out], totals, k, F.col(out) > 0,
        salts=SALTS, gathered=extra)
    found = [] if leading is None else [numbered(leading.name, leading.fields).alias(leading.name)]
    return merged.select("state", *totals, numbered("leaders", ["city", out]).alias("hotspots"), *found)


def bucket_counts(bucket: str) -> dict[str, Column]:
    return {b.lower(): F.col(bucket) == b for b in BUCKETS}


def with_shares(rollup: DataFrame, names: list[str]) -> DataFrame:
    """Add ``<name>_pct`` of ``total`` for each counter."""
    return rollup.withColumns({f"{n}_pct": clean.pct(F.col(n), F.col("total")) for n in names})
