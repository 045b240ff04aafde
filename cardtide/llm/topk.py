"""Exact top-k search by inner product: columnar branch and bound.

Candidates lie in slabs, component by component. A batch of queries walks over a slab in blocks of
components: partial sums grow block by block, and what a candidate can still add is bounded by the
products of the lengths of query and candidate over the blocks to come (the remaining mass). A
candidate whose bound stays below a query's threshold is dropped there. Columns that no query of the
batch needs are compacted away; once few (query, candidate) pairs live, they go on as a list of pairs.

The threshold of a query is the k-th best score among candidates seen, so it never exceeds the k-th
best of all and no answer is lost. A first turn over one slab in SEED_SHARE gives thresholds to start
with. Queries are sent in blocks of BLOCK rows; every block meets all candidates, and each task hands
on at most k candidates per query, all at or above the threshold.

Sums are exact: floating-point numbers are used where every sum stays below 2^53, else Python's whole
numbers for all pairs of the slab (no bound is used then); a score beyond 64 bits becomes the nearest
long. Ties go to the smaller id, null ids last; repeated rows are candidates each, and a repeated
query is answered each time. A query never meets rows of its own id; a null id is no query. Vectors
that are null or hold a null or non-finite component take no part; shorter ones go on with zeros; an
empty vector scores 0. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import new_folder, stage
from .vectors import Slab, longest, packed, whole_vectors

#: Queries sent to all tasks at once (4 MB with 64 components of eight bytes), and compared at once.
BLOCK, BATCH = 8192, 64
#: Components added before bounds are looked at again.
STEP = 8
#: One slab in so many gives the first thresholds.
SEED_SHARE = 16
#: Share of live pairs below which they go on as a list.
SPARSE = 0.1

_FOUND = "query int, vec_id long, no_id boolean, score long"
ANSWERS = "query_id long, rank int, vec_id long, score long"
_LONG = np.iinfo(np.int64)


class Queries(NamedTuple):
    """A block of queries: ids, whole components, and the least score that is still of interest."""
    ids: np.ndarray
    x: np.ndarray
    least: np.ndarray


def masses(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows of ``x`` over each block of components."""
    starts = np.arange(0, x.shape[1], STEP)
    return np.sqrt(np.add.reduceat(np.square(x, dtype=np.float64), starts, axis=1)) if len(starts) else np.zeros((len(x), 0))


def live_pairs(q: np.ndarray, columns: np.ndarray, column_masses: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, candidate, score)`` of every pair whose score may reach the query's threshold; those
    that do are all among them. ``columns`` holds a row per component, ``column_masses`` one per block."""
    own = masses(q)
    rest = own @ column_masses
    slack = 1e-9 * (1.0 + rest.max(initial=0.0))  # rounding of the bounds; sums of scores are exact
    alive = np.arange(columns.shape[1])
    sums = np.zeros(rest.shape)
    order = np.argsort(-(own ** 2).sum(0), kind="stable")  # the heaviest block of the queries first
    for turn, b in enumerate(order):
        block = slice(b * STEP, (b + 1) * STEP)
        sums += q[:, block] @ columns[block, alive].astype(np.float64)
        rest -= np.outer(own[:, b], column_masses[b, alive])
        live = sums + rest + slack >= least[:, None]
        needed = live.any(0)
        if np.count_nonzero(live) < SPARSE * live.size:
            return _as_list(q, own, columns, column_masses, least - slack, order[turn + 1:], alive, sums, rest, live)
        if np.count_nonzero(needed) < 0.7 * len(needed):
            alive, sums, rest = alive[needed], sums[:, needed], rest[:, needed]
    which, at = np.nonzero(sums >= least[:, None])
    return which, alive[at], sums[which, at]


def _as_list(q, own, columns, column_masses, least, order, alive, sums, rest, live):
    which, at = np.nonzero(live)
    score, left, at = sums[which, at], rest[which, at], alive[at]
    for b in order:
        block = slice(b * STEP, (b + 1) * STEP)
        score += np.einsum("ij,ji->i", q[which, block], columns[block, at].astype(np.float64))
        left -= own[which, b] * column_masses[b, at]
        live = score + left >= least[which]
        which, at, score, left = which[live], at[live], score[live], left[live]
    return which, at, score


def wide_scores(q: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """All scores as longs where sums may pass 2^53."""
    exact = q.astype(object) @ columns.astype(object)
    return np.minimum(np.maximum(exact, _LONG.min), _LONG.max).astype(np.int64)


class Best:
    """The k best candidates of every query met so far; more than k where the last is tied."""

    def __init__(self, queries: Queries, k: int) -> None:
        self.queries, self.k, self.least = queries, k, queries.least.copy()
        self.rows = [np.empty(0, dtype=np.int64) for _ in range(4)]  # query, id, no id, score

    def add(self, which: np.ndarray, ids: np.ndarray, no_id: np.ndarray, score: np.ndarray) -> None:
        other = no_id | (ids != self.queries.ids[which])
        new = (which[other], ids[other], no_id[other], score[other])
        self.rows = [np.concatenate([old, n.astype(np.int64)]) for old, n in zip(self.rows, new)]
        which, ids, no_id, score = self.rows
        order = np.lexsort((ids, no_id, -score, which)) if not len(score) or score.min() > _LONG.min else np.array(
            sorted(range(len(score)), key=lambda i: (which[i], -int(score[i]), no_id[i], ids[i])), dtype=np.int64)
        place = np.arange(len(order)) - np.searchsorted(which[order], which[order])
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.least[which[last]] = np.maximum(self.least[which[last]], score[last].astype(np.float64))
        self.rows = [column[kept] for column in self.rows]


def search(slabs: Iterator[Slab], queries: Queries, k: int) -> tuple[np.ndarray, ...]:
    """``query, id, no id, score`` of at most ``k`` candidates of each query."""
    starts = range(0, len(queries.ids), BATCH)
    batches = [Best(Queries(*(part[i:i + BATCH] for part in queries)), k) for i in starts]
    largest = np.abs(queries.x.astype(np.float64)).max(initial=0.0)
    for slab in slabs:
        exact = largest * np.abs(slab.x.astype(np.float64)).max(initial=0.0) * len(slab.x) < 2.0 ** 53
        column_masses = np.ascontiguousarray(masses(slab.x.T).T) if exact else None
        for best in batches:
            if exact:
                which, at, score = live_pairs(best.queries.x.astype(np.float64), slab.x, column_masses, best.least)
            else:
                scores = wide_scores(best.queries.x, slab.x)
                which, at = np.nonzero(np.ones(scores.shape, dtype=bool))
                score = scores[which, at]
            best.add(which, slab.ids[at], slab.no_id[at], score.astype(np.int64))
    rows = [(best.rows[0] + start, *best.rows[1:]) for start, best in zip(starts, batches)]
    return tuple(np.concatenate(column) for column in zip(*rows))


def _found(slabs: DataFrame, queries: Queries, k: int) -> DataFrame:
    sent = slabs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = (Slab(row, by_column=True) for batch in batches for row in batch.itertuples())
        which, ids, no_id, score = search(read, sent.value, k)
        yield pd.DataFrame({"query": which.astype(np.int32), "vec_id": ids, "no_id": no_id.astype(bool), "score": score})
    return slabs.mapInPandas(run, _FOUND)


def _blocks(slabs: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components of the queries, at most BLOCK at a time, read from their slabs."""
    names = slabs.select("slab", "rows").orderBy("slab").collect()  # names and sizes, no vectors
    taken: list[str] = []
    size = 0
    for i, (name, rows) in enumerate(names):
        taken, size = [*taken, name], size + rows
        if i + 1 == len(names) or size + names[i + 1].rows > BLOCK:
            parts = [Slab(row, by_column=False) for row in slabs.where(F.col("slab").isin(taken)).collect()]
            yield np.concatenate([p.ids for p in parts]), np.concatenate([p.x.astype(np.int64) for p in parts])
            taken, size = [], 0


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k best rows of each query; partial lists are cut to k before they are exchanged."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "no_id", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows of ``candidates`` for each row of
    ``queries``; both hold ``vec_id, embedding``."""
    spark = candidates.sparkSession
    asked, given = whole_vectors(queries, scale).where("vec_id is not null"), whole_vectors(candidates, scale)
    dims = max(longest(asked), longest(given))
    slabs = stage(packed(given, dims, by_column=True), "columns")
    sample = slabs.where(F.pmod(F.xxhash64("slab"), F.lit(SEED_SHARE)) == 0)
    answers = new_folder(spark, "answers")
    spark.createDataFrame([], ANSWERS).write.parquet(answers)
    for ids, x in _blocks(stage(packed(asked, dims, by_column=False, rows=BLOCK // 4), "queries")):
        least = np.full(len(ids), -np.inf)
        seeds = _ranked(_found(sample, Queries(ids, x, least), k), k, "query").where(F.col("rank") == k).select("query", "score").toPandas()
        least[seeds["query"]] = seeds["score"]  # at most BLOCK rows
        # A threshold kept as a double must not lie above the score it stands for.
        least = np.where(np.abs(least) < 2.0 ** 53, least, np.nextafter(least, -np.inf))
        found = _ranked(_found(slabs, Queries(ids, x, least), k), k, "query")
        names = spark.createDataFrame(pd.DataFrame({"query": np.arange(len(ids), dtype=np.int32), "query_id": ids}), "query int, query_id long")
        named = found.join(F.broadcast(names), "query")
        named.select("query_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score").write.mode("append").parquet(answers)
    return spark.read.schema(ANSWERS).parquet(answers)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` best partners of each row whose id is divisible by ``every``, among all other rows."""
    return top_k(vectors.where(F.col("vec_id") % every == 0), vectors, k)
