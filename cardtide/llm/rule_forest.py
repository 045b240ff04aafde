"""Quality rules as statistics, judged by an isolation forest.

Every text gets the plain rule statistics. An isolation forest over them measures how few random
splits set a document apart; the path length becomes an anomaly score in (0, 1). Labelled rows only
calibrate the threshold on that score. Words repeat more in longer texts, so the share of distinct words
is taken of at most 500 words and not at all below the 20 that the base rules ask for. The threshold has
the highest balanced accuracy among those that keep nearly all rows labelled good. Base rules (too short, too repetitive) reject on their own.

Every tree draws its ``ROWS_PER_TREE`` rows, as an isolation forest does; beyond ``POOL`` labelled rows,
as many as all trees draw, they draw from about that many, taken by a hash of the id. The threshold is
calibrated on the scores of all labelled rows; statistics and verdicts cover every row. Without labelled rows nothing but the base rules
rejects. A null text counts as empty: zero counts, ``base_failed``. Repeated rows give repeated
results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import documents, map_batches, shingle_hashes, stage, word_hashes

TREES, ROWS_PER_TREE = 150, 256
#: Labelled rows at most, about, that the trees draw from: as many as they draw.
POOL = TREES * ROWS_PER_TREE
#: Ranges of equal width into which scores are dealt while they are added up in order.
BINS = 1 << 16
#: Share of the rows labelled good that a threshold must keep.
KEEP_GOOD = 0.995

_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_FEATURES = (
    "symbol_rate", "dup_line_rate", "repeat_rate", "capital_excess", "bang_rate", "pipe_rate", "same_rate",
    "few_distinct", "long_words", "digit_excess",
)
STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(hashes: np.ndarray, width: int = 8) -> int:
    """Words covered by windows of ``width`` words that occur at least twice, the first included."""
    windows = shingle_hashes(hashes, width)
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(windows, twice))
    change = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(change) > 0))


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The contract's five counts and the forest's features of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    dup_lines = len(lines) - len(set(lines))
    hashes = word_hashes(words)
    repeats = repeated_words(hashes)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    same = int(np.count_nonzero(hashes[1:] == hashes[:-1]))
    # Rates of faults: all near 0 in ordinary text. The constants shrink rates of very short texts.
    per_word, per_char = 1.0 / (n + 10), 1.0 / (chars + 50)
    over = lambda rate, usual: max(0.0, rate - usual)
    features = [
        symbols * per_word, over(dup_lines / (len(lines) + 3), 0.3), over(repeats * per_word, 0.3),
        over(counts[65:91].sum() * per_char, 0.1), over(counts[33] * per_word, 0.02), over(counts[124] * per_word, 0.02),
        over(same * per_word, 0.05), over(0.3, len(np.unique(hashes)) / (min(n, 500) + 1e-9)) if n >= 20 else 0.0,
        over(chars / (n + 1e-9), 14.0) if n else 0.0, over(counts[48:58].sum() * per_char, 0.1),
    ]
    return [n, chars, symbols, dup_lines, repeats], [float(f) for f in features]


def with_statistics(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the five counts, ``features`` and the further columns named."""
    def measure(batch: pd.DataFrame) -> pd.DataFrame:
        measured = [statistics(text) for text in batch["text"]]
        out = pd.DataFrame([m[0] for m in measured], columns=[c.split()[0] for c in STATISTICS.split(", ")])
        out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
        out["features"] = [m[1] for m in measured]
        for name in more:
            out[name] = batch[name].to_numpy()
        return out
    extra = "".join(f", {name} {docs.schema[name].dataType.simpleString()}" for name in more)
    return map_batches(documents(docs, *more), measure, f"doc_id long, {STATISTICS}, features array<double>{extra}")


class Forest(NamedTuple):
    """Trees as flat arrays: the split feature (-1 for a leaf), its value, and the left child (the
    right one follows it); leaves hold the path length."""
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row over all trees."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left in zip(self.feature, self.value, self.left):
            at = np.zeros(len(x), dtype=np.int64)
            moving = rows
            while len(moving):
                f = feature[at[moving]]
                moving = moving[f >= 0]
                f = f[f >= 0]
                node = at[moving]
                at[moving] = left[node] + (x[moving, f] >= value[node])
            total += value[at]
        return total / len(self.feature)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 2.0 ** (-self.paths(x) / expected_path(ROWS_PER_TREE))


def expected_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary search tree of ``n`` rows."""
    return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649 if n > 2 else 0.5) - 2.0 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE, seed: int = 11) -> Forest:
    """Random trees over samples of ``rows`` rows: a random feature that still varies, a random value
    between its extremes, until rows are alone or twice the usual depth is reached."""
    rng = np.random.default_rng(seed)
    limit = 2 * int(np.ceil(np.log2(max(rows, 2))))
    size = 2 * rows
    features, values, lefts = (np.full((trees, size), -1, dtype=np.int32), np.zeros((trees, size)), np.zeros((trees, size), dtype=np.int64))
    for t in range(trees):
        pick = rng.choice(len(x), size=min(rows, len(x)), replace=False)
        todo, used = [(0, pick, 0)], 1
        while todo:
            node, members, depth = todo.pop()
            low, high = x[members].min(0), x[members].max(0)
            varied = np.flatnonzero(high > low)
            if len(members) <= 1 or depth >= limit or not len(varied):
                values[t, node] = depth + expected_path(len(members))
                continue
            f = rng.choice(varied)
            cut = rng.uniform(low[f], high[f])
            right = x[members, f] >= cut
            if right.all():  # the draw fell on the lowest value
                cut = high[f]
                right = x[members, f] >= cut
            features[t, node], values[t, node], lefts[t, node] = f, cut, used
            todo += [(used, members[~right], depth + 1), (used + 1, members[right], depth + 1)]
            used += 2
    return Forest(features, values, lefts)


def calibrate(scores: np.ndarray, good: np.ndarray, keep: float = KEEP_GOOD) -> float:
    """The threshold of the highest balanced accuracy that keeps ``keep`` of the good rows; infinite
    where one class is missing."""
    if good.all() or not good.any():
        return float("inf")
    lowest = np.quantile(scores[good], keep)
    cuts = np.unique(np.concatenate([scores[scores > lowest], [np.inf]]))
    ordered_bad = np.sort(scores[~good])
    ordered_good = np.sort(scores[good])
    caught = 1 - np.searchsorted(ordered_bad, cuts) / len(ordered_bad)
    kept = np.searchsorted(ordered_good, cuts) / len(ordered_good)
    return float(cuts[np.argmax(caught + kept)])


def calibrated(scored: DataFrame, keep: float = KEEP_GOOD) -> float:
    """``calibrate`` over a table ``score, good`` of any length, with the same result.

    Rows are counted per score and added up in the order of scores: within ranges of scores, whose
    totals, ``BINS`` rows at most, pass through the driver.
    """
    tally = stage(scored.groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"), F.floor(F.col("score") * BINS).alias("bin")), "scores")
    bins = tally.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toPandas().sort_values("bin")
    n_good, n_bad = int(bins["good"].sum()), int(bins["bad"].sum())
    if not n_good or not n_bad:
        return float("inf")
    before = pd.DataFrame({"bin": bins["bin"], **{f"{c}_before": bins[c].cumsum() - bins[c] for c in ("good", "bad")}})
    before = scored.sparkSession.createDataFrame(before, "bin long, good_before long, bad_before long")
    within = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    under = lambda c: (F.col(f"{c}_before") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_under")
    ordered = stage(tally.join(F.broadcast(before), "bin").select("score", "good", under("good"), under("bad")), "scores")
    # The quantile lies between two neighbours among the good rows.
    place = (n_good - 1) * keep
    ranks = [int(place), min(int(place) + 1, n_good - 1)]
    at = lambda rank: ordered.where(f"good_under <= {rank} and {rank} < good_under + good").first()["score"]
    lowest = float(np.quantile([at(rank) for rank in ranks], place - int(place)))
    balance = (F.lit(1) - F.col("bad_under") / n_bad) + F.col("good_under") / n_good
    best = ordered.where(F.col("score") > F.lit(lowest)).select("score", balance.alias("balance")).orderBy(F.desc("balance"), "score").first()
    return best["score"] if best and best["balance"] >= 1.0 else float("inf")  # 1: the balance of rejecting nothing


class Verdicts(NamedTuple):
    forest: Forest | None
    threshold: float


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, where: str = "true", label: str = "quality") -> DataFrame:
    """``doc_id, text, label`` of at most about ``bound`` labelled rows, drawn by a hash of the id.

    Rows without id or label are left out; of several labels of one id the largest counts, of its
    rows the one whose text has the smallest hash.
    """
    known = labels.where(f"doc_id is not null and ({where})").groupBy("doc_id").agg(
        F.max(F.expr(label)).cast("int").alias("label")).where("label is not null")
    count = known.count()
    if count > bound:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * bound / count))
    # About ``bound`` rows of two numbers, twice that at most.
    drawn = documents(docs).join(F.broadcast(known.limit(2 * bound)), "doc_id").withColumn("at", F.xxhash64("text"))

    def one_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values("at", kind="stable").drop_duplicates("doc_id")
    # An id with many rows is thinned out batch by batch, before its texts are sorted and exchanged.
    thinned = drawn.mapInPandas(one_each, drawn.schema)
    return thinned.groupBy("doc_id").agg(F.min_by("text", "at").alias("text"), F.max("label").alias("label"))


def measured(docs: DataFrame) -> DataFrame:
    """The statistics of every row and ``at``, a hash of its text, as a written table."""
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("at"))
    return stage(with_statistics(hashed, "at"), "statistics")


def fit(docs: DataFrame, labels: DataFrame, bound: int = POOL) -> Verdicts:
    return fit_measured(measured(docs), labels, bound)


def fit_measured(rows: DataFrame, labels: DataFrame, bound: int = POOL) -> Verdicts:
    """Forest and threshold from rows of ``measured``, with labels as in ``labelled_sample``."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")).where("label is not null")
    labelled = stage(rows.select("doc_id", "features", "at").join(known, "doc_id").groupBy("doc_id").agg(
        F.min_by("features", "at").alias("features"), F.max("label").alias("label")), "labelled")
    count = labelled.count()
    if count < 2:
        return Verdicts(None, float("inf"))
    pool = labelled
    if count > bound:
        pool = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * bound / count))
    pool = pool.select("doc_id", "features").toPandas().sort_values("doc_id", kind="stable")
    if len(pool) < 2:
        return Verdicts(None, float("inf"))
    forest = grow(np.array(pool["features"].tolist()))
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"score": shared.value.scores(np.array(batch["features"].tolist())), "good": batch["label"] == 1})
    return Verdicts(forest, calibrated(map_batches(labelled, score, "score double, good boolean")))


SCHEMA = f"doc_id long, {STATISTICS}, base_failed boolean, kept boolean, anomaly double"


def judge(docs: DataFrame, verdicts: Verdicts) -> DataFrame:
    """Counts, ``base_failed``, the ``anomaly`` score and ``kept`` of every row."""
    return judge_measured(with_statistics(docs), verdicts)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` by what ``fit`` learns of the same documents; each text is measured once."""
    rows = measured(docs)
    return judge_measured(rows.drop("at"), fit_measured(rows, labels))


def judge_measured(rows: DataFrame, verdicts: Verdicts) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(verdicts)

    def verdict(batch: pd.DataFrame) -> pd.DataFrame:
        v = shared.value
        out = batch.drop(columns="features")
        failed = (out["n_words"] < 20) | (100 * out["n_repeat_words"] > 30 * out["n_words"])
        x = np.array(batch["features"].tolist()).reshape(len(batch), len(_FEATURES))
        anomaly = v.forest.scores(x) if v.forest and len(x) else np.zeros(len(x))
        out["base_failed"] = failed
        out["kept"] = ~failed & (anomaly < v.threshold)
        out["anomaly"] = anomaly
        return out
    return map_batches(rows, verdict, SCHEMA)
