"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes.

A text becomes the set of its n-grams: one or two words, and one or two word shapes (runs of lower-case
letters, capitals, digits; punctuation as it is; a mark for a repeated word) together with the
power of two their share of the text falls into, so that an indicator says "this shape makes up
about a quarter of the text". Indicators are hashed, those with a share and those of words into ranges
of their own. Each is scaled by the log ratio of its smoothed class counts (0 for those that fewer than
MIN_SEEN sampled rows hold); a hinge-loss model is fitted to the scaled indicators by dual coordinate
descent; a sigmoid fitted to held-back margins turns margins into scores.

The model is fitted on at most ``SAMPLE`` labelled rows, drawn by a hash of their id; every row is
scored. Without rows of both classes every score is 0.5. A null text counts as empty and is scored
by the bias and the indicator of emptiness. Repeated rows give repeated results; extra columns are
never read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import crc_fold, documents, map_batches, shingle_hashes, word_hashes
from .rule_forest import labelled_sample

#: Labelled rows at most from which the model is fitted.
SAMPLE = 8_000
#: Rows whose ``crc32(doc_id) mod FOLDS`` is HELD_OUT never take part in learning.
FOLDS, HELD_OUT = 3, 1
#: Buckets of indicators with a share, and of all indicators.
MARKS, BUCKETS = 1 << 16, 1 << 19
#: An indicator that fewer sampled rows hold has no weight: its ratio would be chance.
MIN_SEEN = 3

_SHAPES = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


def _bin(share: float) -> int:
    return min(9, int(-np.log2(share))) if share > 0 else 10


def word_shapes(raw: bytes) -> list[bytes]:
    """One shape per word: runs of the same kind of character cut to one."""
    shapes = raw.translate(_SHAPES)
    for kind in b"aA0!*#$%&.-=":
        one = bytes([kind])
        while one + one in shapes:
            shapes = shapes.replace(one * 4, one).replace(one + one, one)
    return shapes.split()


def indicators(text: str) -> np.ndarray:
    """Distinct hashed n-gram indicators of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    grams = [b"size:%d" % int(np.log2(n + 1))]
    if not n:
        return np.array([zlib.crc32(grams[0]) % MARKS], dtype=np.int32)
    hashes = word_hashes(words)
    marked = word_shapes(raw)
    for i in np.flatnonzero(hashes[1:] == hashes[:-1]) + 1:
        marked[i] = b"="
    grams += [b"1:%s:%d" % (g, _bin(k / n)) for g, k in Counter(marked).items()]
    grams += [b"2:%s %s:%d" % (*g, _bin(k / n)) for g, k in Counter(zip(marked, marked[1:])).items()]
    own = np.unique(hashes)
    grams.append(b"distinct:%d" % int(len(own) / n * 10))
    triples = np.sort(shingle_hashes(hashes, 3))
    grams.append(b"again:%d" % _bin(np.count_nonzero(triples[1:] == triples[:-1]) / n))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    grams.append(b"lines:%d" % _bin((len(lines) - len(set(lines))) / len(lines)))
    grams.append(b"line:%d" % int(np.log2(n / len(lines) + 1)))
    named = np.fromiter((zlib.crc32(g) % MARKS for g in grams), dtype=np.int32, count=len(grams))
    of_words = np.concatenate([own, shingle_hashes(hashes, 2)]) % np.uint64(BUCKETS - MARKS) + np.uint64(MARKS)
    return np.unique(np.concatenate([named, of_words.astype(np.int32)]))


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def log_ratios(rows: list[np.ndarray], good: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = [smoothing + np.bincount(np.concatenate([r for r, g in zip(rows, good) if g == side] or [np.empty(0, int)]),
                                      minlength=BUCKETS) for side in (True, False)]
    present = [smoothing * 2 + (good == side).sum() for side in (True, False)]
    ratio = np.log(counts[0] / present[0]) - np.log(counts[1] / present[1])
    seen = counts[0] + counts[1] - 2 * smoothing
    return np.where(seen >= MIN_SEEN, ratio, 0.0)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, cost: float = 1.0,
                 epochs: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, one dual variable after the other in random order.

    The bias is the weight of one more indicator that every row has.
    """
    sign = np.where(good, 1.0, -1.0)
    w, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            at, v, y = rows[i], values[i], sign[i]
            gradient = y * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * y
            if step:
                w[at] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w, bias


def sigmoid_fit(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton steps on the smoothed log loss; the slope stays positive."""
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()]) + [1e-3 * a, 0.0]
        q = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(q * margins * margins).sum() + 1e-3, (q * margins).sum()], [(q * margins).sum(), q.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


class Classifier(NamedTuple):
    ratios: np.ndarray
    model: Model

    def margin(self, at: np.ndarray) -> float:
        v = self.ratios[at]
        return float(self.model.weights[at] @ v / max(np.sqrt(v @ v), 1e-9) + self.model.bias)

    def score(self, text: str) -> float:
        return float(self.model.scores(np.array([self.margin(indicators(text))]))[0])


def train(rows: list[np.ndarray], good: np.ndarray) -> Classifier | None:
    """Ratios and weights from four fifths of the rows, the sigmoid from the last fifth; then ratios
    and weights once more from all rows. None without rows of both classes."""
    if good.all() or not good.any():
        return None

    def once(rows: list[np.ndarray], good: np.ndarray) -> Classifier:
        ratios = log_ratios(rows, good)
        values = [(ratios[r] / max(np.sqrt(ratios[r] @ ratios[r]), 1e-9)).astype(np.float32) for r in rows]
        w, bias = dual_descent(rows, values, good)
        return Classifier(ratios, Model(w, bias, 1.0, 0.0))

    back = np.arange(len(rows)) % 5 == 4
    if good[back].all() or not good[back].any() or good[~back].all() or not good[~back].any():
        back = np.ones(len(rows), dtype=bool)
        first = once(rows, good)
    else:
        first = once([r for r, b in zip(rows, back) if not b], good[~back])
    margins = np.array([first.margin(r) for r, b in zip(rows, back) if b])
    slope, offset = sigmoid_fit(margins, good[back])
    full = once(rows, good)
    return Classifier(full.ratios, full.model._replace(slope=slope, offset=offset))


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Classifier | None:
    """A classifier from the labelled rows outside the held-out fold."""
    in_fold = f"crc32(cast(cast(doc_id as string) as binary)) % {FOLDS} <> {HELD_OUT}"
    sample = labelled_sample(docs, labels, bound, in_fold)

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"],
                             "at": [indicators(t).tobytes() for t in batch["text"]]})
    rows = map_batches(sample, read, "doc_id long, label int, at binary").toPandas().sort_values("doc_id", kind="stable")
    return train([np.frombuffer(a, dtype=np.int32) for a in rows["at"]], rows["label"].to_numpy() == 1)


def scored(docs: DataFrame, classifier: Classifier | None, *more: str) -> DataFrame:
    """``doc_id, score`` and the further columns named, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    names = ["doc_id", *more]

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        model = shared.value
        out = batch[names].copy()
        out["score"] = [model.score(t) for t in batch["text"]] if model else 0.5
        out["doc_id"] = out["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
        return out
    extra = "".join(f"{name} {docs.schema[name].dataType.simpleString()}, " for name in more)
    return map_batches(documents(docs, *more), score, f"doc_id long, {extra}score double")


def classify(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    return scored(docs, fit(docs, labels, bound)).select(
        "doc_id", (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """The rows of ``docs`` predicted good, in their columns; all of them without a classifier."""
    if classifier is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    score = F.pandas_udf(lambda texts: pd.Series([shared.value.score(t) for t in texts], dtype=float), "double")
    return docs.where(score(F.coalesce("text", F.lit(""))) >= 0.5)
