"""Spelling variants by dense prefix-suffix tiling.

Words lie in padded matrices, a code point per cell, once aligned at their first and once at their
last letter. Two blocks of words are compared whole: the length of the common prefix of every pair is
found column by column, likewise the common suffix, and a pair whose prefix and suffix together reach
the longer length minus one differs by one inserted, deleted or replaced code point.

Which blocks can hold such a pair follows from the same rule: of a pair whose longer word has ``L``
letters, the prefix or the suffix has at least half of ``L - 1`` (rounded up). So a word is dealt four
times: by its first and by its last half, as a word of the longer and as one of the shorter length. A
bucket holds the words of many such halves; it is sorted by half, and only tiles whose ranges of
halves overlap are compared. Buckets of more than PART_WORDS words are dealt again in parts, every two
of which meet in a task of their own, so a half that a third of all words share is no single task's
work. Every near pair is found in exactly one tile: under its prefix if that is long enough, else under
its suffix.

Words of one letter count have one length; a word is never near itself. Null and empty texts hold no
words; every row of a table counts, so repeated rows count again; a null id is written as an empty
text where ids enter; an empty table gives an empty result; extra columns are ignored. Ties between
near words of equal count go to the smallest in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import BATCH_ROWS, documents, lower_ascii, stage

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One occurrence in so many loses a letter, least letters and occurrences of a word.
MANGLED, LETTERS, TIMES = 97, 5, 3
#: A form occurs at least so many times as often as its variant.
DOMINATES = 2
#: Words dealt to a bucket on average, most words of a part, and words of a tile's side.
BUCKET_WORDS, PART_WORDS, TILE = 2048, 4096, 128
#: Most cells of a tile's matrix, and shares in which a large bucket's words are dealt.
TILE_CELLS, SALTS = 1 << 22, 64
#: Distinct words a task counts before it hands them on.
HELD = 1 << 18


def damaged(word: str, seed: int) -> str:
    """``word`` as it stands in a document whose prefix has the checksum ``seed``: one in MANGLED
    loses a letter."""
    h = zlib.crc32(word.encode(), seed)
    if h % MANGLED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def counted_words(docs: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """``word, n`` of words of at least ``letters`` code points and ``times`` occurrences. Tasks hand
    on counts, not occurrences."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: defaultdict[str, int] = defaultdict(int)
        for batch in batches:
            for start in range(0, len(batch), BATCH_ROWS):
                rows = batch.iloc[start:start + BATCH_ROWS]
                for doc_id, text in zip(rows["id"], rows["text"]):
                    seed = zlib.crc32(f"{doc_id}:".encode())
                    for word, n in Counter(_RUN.findall(lower_ascii(text).decode("utf-8", "surrogatepass"))).items():
                        if len(word) >= letters:
                            word = damaged(word, seed)
                            if len(word) >= letters:
                                held[word] += n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})
    texts = documents(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    found = texts.mapInPandas(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def halves(words: DataFrame) -> DataFrame:
    """``word, n, longer, forward, half``: each word under its first and its last half, for pairs whose
    longer word has as many letters as itself, and for those with one more."""
    size = F.length("word")
    sided = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer"))
    half = F.ceil((F.col("longer") - 1) / 2).cast("int")
    turned = sided.select("word", "n", "longer", half.alias("h"), F.explode(F.array(F.lit(True), F.lit(False))).alias("forward"))
    return turned.select(
        "word", "n", "longer", "forward",
        F.when(F.col("forward"), F.expr("substring(word, 1, h)")).otherwise(F.expr("substring(word, -h, h)")).alias("half"))


class Tile:
    """A block of words as matrices, aligned at the first and at the last letter."""

    def __init__(self, rows: pd.DataFrame, pad: int) -> None:
        words = rows["word"].tolist()
        key = list(zip(rows["forward"], rows["longer"], rows["half"]))
        self.first, self.last = key[0], key[-1]
        self.at, self.rank = rows["at"].to_numpy(), rows["rank"].to_numpy()
        self.longer, self.forward = rows["longer"].to_numpy(), rows["forward"].to_numpy()
        self.size = np.array([len(w) for w in words])
        self.left = self._matrix(words, pad)
        self.right = self._matrix([w[::-1] for w in words], pad)

    def _matrix(self, words: list[str], pad: int) -> np.ndarray:
        width = int(self.size.max())
        cells = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
        cells[np.arange(width) >= self.size[:, None]] = pad  # no code point, and another on each side
        return np.ascontiguousarray(cells.T)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every word of ``a`` with every word of ``b``."""
    same = np.ones((a.shape[1], b.shape[1]), dtype=bool)
    total = np.zeros(same.shape, dtype=np.int32)
    for x, y in zip(a, b):
        same &= x[:, None] == y[None, :]
        if not same.any():
            break
        total += same
    return total


def near_in_tiles(a: Tile, b: Tile) -> np.ndarray:
    """For every pair of two blocks whether they are one edit apart and belong to this pair of tiles."""
    longest = np.maximum(a.size[:, None], b.size[None, :])
    fits = (np.minimum(a.size[:, None], b.size[None, :]) >= longest - 1) & (a.forward[:, None] == b.forward[None, :])
    fits &= (a.longer[:, None] == longest) & (b.longer[None, :] == longest)
    if not fits.any():
        return fits
    prefix = _common(a.left, b.left)
    half = -((1 - longest) // 2)
    fits &= (prefix >= half) == a.forward[:, None]
    if not fits.any():
        return fits
    equal = (prefix == longest) & (a.size[:, None] == b.size[None, :])
    return fits & ~equal & (prefix + _common(a.right, b.right) >= longest - 1)


def _tiles(rows: pd.DataFrame, pad: int) -> list[Tile]:
    rows, out, start = rows.sort_values(["forward", "longer", "half"]), [], 0
    longer = rows["longer"].to_numpy()
    while start < len(rows):
        # Words of thousands of letters lie in smaller blocks.
        stop = start + TILE
        while stop > start + 1 and (min(stop, len(rows)) - start) * int(longer[start:stop].max()) > TILE_CELLS:
            stop = start + (stop - start) // 2
        out.append(Tile(rows.iloc[start:stop], pad))
        start = stop
    return out


_NEAR = "word string, n_near long, form string, form_n long"


def near_in_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Two parts of a bucket (or one with itself) compared tile by tile: for each word the number of
    its near words met here and the one of largest count."""
    low, high = cell["low"].iat[0], cell["high"].iat[0]
    cell = cell.assign(at=np.arange(len(cell)))
    by_worth = cell.sort_values(["n", "word"], ascending=[False, True])
    cell["rank"] = pd.Series(np.arange(len(cell)), index=by_worth.index)
    met, best = np.zeros(len(cell), dtype=np.int64), np.full(len(cell), len(cell))
    ours = _tiles(cell[cell["part"] == low], 0x110000)
    theirs = _tiles(cell[cell["part"] == high], 0x110001)
    for i, a in enumerate(ours):
        for b in theirs[i if low == high else 0:]:
            if a.last < b.first or b.last < a.first:
                continue
            near = near_in_tiles(a, b)
            if not near.any():
                continue
            met[a.at] += near.sum(1)
            best[a.at] = np.minimum(best[a.at], np.where(near, b.rank, len(cell)).min(1))
            if low != high or b is not theirs[i]:
                met[b.at] += near.sum(0)
                best[b.at] = np.minimum(best[b.at], np.where(near, a.rank[:, None], len(cell)).min(0))
    has = met > 0
    form = by_worth.iloc[best[has]]
    return pd.DataFrame({"word": cell["word"].to_numpy()[has], "n_near": met[has], "form": form["word"].to_numpy(), "form_n": form["n"].to_numpy()})


def near_words(words: DataFrame, bucket_words: int = BUCKET_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` of every word with near words: their number, and the one of
    largest count (of equal counts the smallest). ``words`` is a table of distinct ``word, n``."""
    buckets = max(1, -(-4 * words.count() // bucket_words))
    dealt = halves(words).withColumn("bucket", F.pmod(F.xxhash64("forward", "longer", "half"), F.lit(buckets)))
    large = dealt.groupBy("bucket").agg(F.ceil(F.count("*") / part_words).cast("int").alias("parts")).where("parts > 1")
    # A bucket may hold a third of all words, so its words are told the number of parts in salted shares.
    told = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cut = dealt.withColumn("salt", F.pmod(F.xxhash64("word", F.lit("salt")), F.lit(SALTS)).cast("int")).join(told, ["bucket", "salt"], "left")
    parts = F.coalesce("parts", F.lit(1))
    cells = (
        cut.withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "word", "n", "longer", "forward", "half")
    )
    met = cells.groupBy("bucket", "low", "high").applyInPandas(near_in_cell, _NEAR)
    worth = F.struct((-F.col("form_n")).alias("order"), "form")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(worth).alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.order")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word that has a form, by doubling the steps along ``word, form``.

    A form occurs DOMINATES times as often as its word, so no chain comes back or is longer than the
    logarithm of the largest count.
    """
    reached = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(reached.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        reached = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return reached


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``word, n`` (distinct words)."""
    words = stage(words.select("word", "n"), "words")
    near = stage(near_words(words), "near")
    judged = words.join(near, "word", "left").withColumn("dominated", F.coalesce(F.col("form_n") >= DOMINATES * F.col("n"), F.lit(False)))
    forms = stage(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("dominated"), F.col("form")).alias("form"),
        F.when(F.col("dominated"), F.col("form_n")).alias("form_n")), "forms")
    ends = roots(forms.where("form is not null"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``doc_id, text``."""
    return group_variants(counted_words(docs))
