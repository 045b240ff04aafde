"""Mixing to target weights with soft domain membership.

A classifier fitted on the labelled table gives every document a posterior over domains (junk, good,
toxic). A document's rate is how often it is to appear. The expected tokens of domain ``d`` are
``sum over documents of tokens * posterior_d * rate``; rates are fitted by projected gradient least
squares so that these totals match the targets: start at rate 1, step against the gradient, cut at 0.

The gradient of a document's rate is its posterior times the domains' residuals, so a round only has
to know one residual per domain. The rounds' residuals are all the state there is: a worker replays
them for its rows, and a lost executor loses nothing. With residuals scaled by the domains' sizes a
unit step never overshoots (the scaled problem's largest curvature is at most 1). Rounds carry on part
of the last move (Nesterov's momentum, dropped whenever the objective rises). They end when the targets
are reached to TOLERANCE, or when CHECKED rounds lower the objective by less than SETTLED of it: then
nonnegative rates come no closer. ``reached`` tells the totals the fit ended with; a fit that ROUNDS
do not suffice for gives a warning.

``copies`` rounds a rate by a hash of the row, so that its mean is the rate and a rerun repeats it.
Tokens are words between white space. A null or empty text has no tokens, the posterior of the bias
and a rate like any other. A domain that no document belongs to is left out. Without labelled rows of
two domains all posteriors are equal, and rates scale the table as a whole. Repeated rows get equal
rates and copies each. Extra columns are ignored by ``document_rates`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from . import nbsvm
from .common import stage, whole_row, word_hashes
from .rule_forest import labelled_sample

DOMAINS = ("junk", "good", "toxic")
_DOMAIN_OF = "case when toxic = 1 then 2 when quality = 1 then 1 when quality = 0 then 0 end"
#: Target shares of all tokens, in the order of DOMAINS.
WEIGHTS = (0.0, 0.96, 0.04)
#: Labelled rows at most from which the classifier is fitted.
SAMPLE = 8_000
#: Rounds at most, and the summed residual (of shares) at which the targets count as reached.
ROUNDS, TOLERANCE = 600, 5e-4
#: Rounds over which progress is judged, and the share of the objective they must gain.
CHECKED, SETTLED = 20, 0.01

_RATES = (("symbol", b"#*$%&|<>"), ("upper", bytes(range(65, 91))), ("bang", b"!"), ("pipe", b"|"), ("digit", b"0123456789"))
_CLASS_OF = np.zeros((len(_RATES), 256), dtype=bool)
for _i, (_, _bytes) in enumerate(_RATES):
    _CLASS_OF[_i, list(_bytes)] = True


def indicators(text: str) -> tuple[int, np.ndarray]:
    """Number of words, and hashed indicators: distinct words, and binned rates of kinds of bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0, np.array([zlib.crc32(b"empty") % nbsvm.BUCKETS], dtype=np.int32)
    hashes = word_hashes(words)
    own = np.unique((hashes % np.uint64(nbsvm.BUCKETS)).astype(np.int32))
    counts = _CLASS_OF @ np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    same = np.count_nonzero(hashes[1:] == hashes[:-1])
    marks = [f"{name}:{nbsvm._bin(c / len(raw))}" for (name, _), c in zip(_RATES, counts.tolist())]
    marks += [f"same:{nbsvm._bin(same / n)}", f"distinct:{int(10 * len(own) / n)}", f"size:{n.bit_length()}"]
    named = np.fromiter((zlib.crc32(m.encode()) % nbsvm.BUCKETS for m in marks), dtype=np.int32, count=len(marks))
    return n, np.unique(np.concatenate([named, own]))


class DomainModel(NamedTuple):
    """One calibrated linear model per domain that has labelled rows, None for the others."""
    of: tuple[nbsvm.Classifier | None, ...]

    def posterior(self, at: np.ndarray) -> list[float]:
        if not any(self.of):
            return [1.0 / len(self.of)] * len(self.of)
        margins = [c.margin(at) if c else None for c in self.of]
        odds = [1e-9 if c is None else float(c.model.scores(np.array([m]))[0]) for c, m in zip(self.of, margins)]
        # Odds against the rest, brought to sum one.
        odds = [o / (1 - o) if o < 1 - 1e-12 else 1e12 for o in odds]
        total = sum(odds)
        return [o / total for o in odds] if total > 0 else [1.0 / len(odds)] * len(odds)


def fit_domains(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DomainModel:
    sample = labelled_sample(docs, labels, bound, label=_DOMAIN_OF)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "at": [indicators(t)[1] for t in batch["text"]]})
    rows = sample.mapInPandas(read, "doc_id long, label int, at array<int>").toPandas().sort_values("doc_id", kind="stable")
    features = [np.asarray(a, dtype=np.int32) for a in rows["at"]]
    of = rows["label"].to_numpy()
    return DomainModel(tuple(nbsvm.train(features, of == d) if len(features) else None for d in range(len(DOMAINS))))


def with_posteriors(docs: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """``docs`` with ``_tokens`` and ``_p``, the posterior over DOMAINS, of the texts in column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: pd.Series) -> pd.DataFrame:
        found = [indicators(t) for t in texts]
        return pd.DataFrame({"tokens": [n for n, _ in found], "p": [shared.value.posterior(at) for _, at in found]})
    judged = F.pandas_udf(judge, "tokens long, p array<double>")(F.coalesce(text, F.lit("")))
    return docs.withColumn("_judged", judged).select(
        *docs.columns, F.col("_judged.tokens").alias("_tokens"), F.col("_judged.p").alias("_p"))


class Step(NamedTuple):
    """One round: the share of the last move that is carried on, and the scaled residual per domain."""
    momentum: float
    residual: np.ndarray


def replayed_rates(p: np.ndarray, steps: list[Step]) -> np.ndarray:
    """Rates after the given rounds."""
    rates = last = np.ones(len(p))
    for step in steps:
        rates, last = np.maximum(0.0, rates + step.momentum * (rates - last) - p @ step.residual), rates
    return rates


class Plan(NamedTuple):
    steps: list[Step]
    reached: np.ndarray  # shares of all tokens that the domains end with
    target: np.ndarray
    converged: bool = True

    def rates(self, posteriors: pd.Series) -> np.ndarray:
        return replayed_rates(np.array(posteriors.tolist()).reshape(len(posteriors), len(self.target)), self.steps)


def _shares(judged: DataFrame, steps: list[Step]) -> tuple[float, np.ndarray]:
    """All tokens, and expected tokens per domain under the rates of the rounds so far."""
    width = len(DOMAINS)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, sums = 0.0, np.zeros(width)
        for batch in batches:
            p = np.array(batch["_p"].tolist()).reshape(len(batch), width)
            tokens = batch["_tokens"].to_numpy(dtype=np.float64)
            total += tokens.sum()
            sums += (tokens * replayed_rates(p, steps)) @ p
        yield pd.DataFrame([[total, *sums]], columns=["total", *DOMAINS])
    parts = judged.select("_tokens", "_p").mapInPandas(add, "total double, " + ", ".join(f"{d} double" for d in DOMAINS))
    row = parts.agg(F.sum("total"), *[F.sum(d) for d in DOMAINS]).first()
    return float(row[0] or 0.0), np.array([float(v or 0.0) for v in row[1:]])


def fit_rates(judged: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float | None = None,
              rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Plan:
    """Rates whose expected domain totals match ``weights`` times ``total`` tokens (default: as many
    as there are), as far as nonnegative rates can."""
    all_tokens, held = _shares(judged, [])
    if not all_tokens:
        return Plan([], held, np.array(weights))
    goal = np.array(weights) / sum(weights) * (total / all_tokens if total else 1.0)
    size = held / all_tokens
    usable = size > 1e-9
    scale = np.where(usable, np.maximum(size, 1e-9), np.inf)
    objective = lambda at: float((np.square(at - goal) / scale).sum() / 2)
    steps: list[Step] = []
    reached, before, turn, values = size, size, 0, [objective(size)]
    while np.abs((reached - goal)[usable]).sum() > tolerance:
        if len(values) > CHECKED and min(values[-CHECKED:]) > (1 - SETTLED) * min(values[:-CHECKED]):
            break
        if len(steps) == rounds:
            warnings.warn(f"{rounds} rounds do not suffice to fit the rates; shares reached: {reached.tolist()}", RuntimeWarning)
            return Plan(steps, reached, goal, False)
        # Totals are linear in the rates, so those of the point ahead need no job of their own.
        momentum = turn / (turn + 3)
        ahead = reached + momentum * (reached - before)
        # Residuals are rounded, so a step is the same whatever order the parts were summed in.
        steps.append(Step(momentum, np.round((ahead - goal) / scale, 12)))
        reached, before = _shares(judged, steps)[1] / all_tokens, reached
        values.append(objective(reached))
        turn = 0 if values[-1] > values[-2] else turn + 1
    return Plan(steps, reached, goal)


def _with_copies(judged: DataFrame, plan: Plan, row_key: list[Column]) -> DataFrame:
    shared = judged.sparkSession.sparkContext.broadcast(plan)
    rate = F.pandas_udf(lambda p: pd.Series(shared.value.rates(p)), "double")
    dice = F.pmod(F.xxhash64(*row_key, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return judged.withColumn("_rate", rate("_p")).withColumn("_copies", F.floor(F.col("_rate") + dice).cast("int"))


def document_rates(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float | None = None) -> DataFrame:
    """``doc_id, tokens, p_<domain>..., rate, copies`` of every row, with ``reached_<domain>`` and
    ``target_<domain>``, the shares of all tokens that the fit ended with and aimed at."""
    own = docs.select("doc_id", "text")
    model = fit_domains(own, labels)
    judged = with_posteriors(own.withColumn("_key", F.xxhash64("text")), model).drop("text")
    judged = stage(judged, "posteriors")
    plan = fit_rates(judged, weights, total)
    done = _with_copies(judged, plan, [F.col("doc_id"), F.col("_key")])
    told = lambda name, shares: [F.lit(float(x)).alias(f"{name}_{d}") for d, x in zip(DOMAINS, shares)]
    return done.select(
        "doc_id", F.col("_tokens").alias("tokens"), *[F.col("_p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)],
        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"), *told("reached", plan.reached), *told("target", plan.target))


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...] = WEIGHTS, total: float | None = None) -> DataFrame:
    """The documents as often as their copies say, in their columns."""
    model = fit_domains(docs.select("doc_id", "text"), labels)
    judged = stage(with_posteriors(docs.select(whole_row(docs)), model, "row.text"), "posteriors")
    done = _with_copies(judged, fit_rates(judged, weights, total), [F.col("row.doc_id"), F.xxhash64("row.text")])
    repeated = done.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select("row.*")
