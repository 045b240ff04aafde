"""Benchmark decontamination by pigeonhole edit matching.

A test item that occurs in a document with at most ``k`` edits is cut into ``k + 1`` pieces, one of
which must then occur without any. All pieces of a block of items are searched in one Aho-Corasick
pass over a text. The pieces come from halving an item and its budget again and again (the budgets of
two halves add up to one less than their whole's), so a hit climbs this tree: each larger part must
occur around it within its own, smaller budget before the whole item is compared. Every comparison is
Myers' bit-parallel edit distance.

Texts and items are compared in lower case (A-Z) with runs of white space as one space. Items shorter
than ``MIN_CHARS`` after that are left out, since they occur by chance. A null or empty text holds
nothing. Repeated rows give repeated results, repeated items one result each. Items without an id or
text are left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, lower_ascii, map_batches

#: Edits allowed per character of an item.
ERROR_RATE = 0.1
MIN_CHARS = 20
#: Characters of items that are searched at once; larger tables of items go block by block.
BLOCK_CHARS = 4 << 20


def normalized(text: str) -> str:
    return " ".join(lower_ascii(text).decode("utf-8", "surrogatepass").split())


def budget(length: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed in an item: the rate's share of its characters, rounded down. Pieces are as short
    as that makes them; a hit is verified in any case."""
    if not 0 <= rate < 1:
        raise ValueError("the rate of edits must be at least 0 and below 1")
    return int(rate * length + 1e-9)


class Part(NamedTuple):
    """A stretch of an item, the edits allowed in it, and the part it is a half of."""
    item: int
    start: int
    end: int
    errors: int
    parent: int  # -1 for the item itself


def split(length: int, errors: int, item: int = 0) -> list[Part]:
    """The tree of an item's parts; those without errors are the pieces, ``errors + 1`` of them."""
    parts = [Part(item, 0, length, errors, -1)]
    todo = [0]
    while todo:
        i = todo.pop()
        _, start, end, k, _ = parts[i]
        if k == 0:
            continue
        left = (k - 1) // 2
        right = k - 1 - left
        cut = start + (end - start) * (left + 1) // (k + 1)
        todo += [len(parts), len(parts) + 1]
        parts += [Part(item, start, cut, left, i), Part(item, cut, end, right, i)]
    return parts


class Pattern:
    """A text prepared for Myers' algorithm."""

    def __init__(self, text: str) -> None:
        self.length = len(text)
        self.all = (1 << self.length) - 1
        self.last = 1 << (self.length - 1)
        self.places: dict[str, int] = {}
        for i, c in enumerate(text):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def best(self, window: str, limit: int) -> tuple[int, int] | None:
        """Smallest distance of the pattern to any stretch of the window, and the stretch's end (the
        first among equal); None above ``limit``."""
        all_, last, places = self.all, self.last, self.places.get
        plus, minus, distance = all_, 0, self.length
        best, at = limit + 1, -1
        for j, c in enumerate(window):
            eq = places(c, 0)
            vertical = eq | minus
            horizontal = (((eq & plus) + plus) ^ plus) | eq
            up = minus | (all_ & ~(horizontal | plus))
            down = plus & horizontal
            if up & last:
                distance += 1
            elif down & last:
                distance -= 1
            if distance < best:
                best, at = distance, j + 1
                if not distance:
                    break
            up = up << 1 & all_
            down = down << 1 & all_
            plus = down | (all_ & ~(vertical | up))
            minus = up & vertical
        return (best, at) if at >= 0 else None


class Match(NamedTuple):
    item_id: int
    distance: int
    start: int
    end: int
    item_chars: int


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> None:
        self.items = [(i, t) for i, t in ((i, normalized(t)) for i, t in items) if len(t) >= min_chars]
        self.parts: list[Part] = []
        self.patterns: dict[int, Pattern] = {}
        pieces: dict[str, list[int]] = {}
        for number, (_, text) in enumerate(self.items):
            base = len(self.parts)
            for part in split(len(text), budget(len(text), rate), number):
                parent = part.parent + base if part.parent >= 0 else -1
                if part.errors == 0:
                    pieces.setdefault(text[part.start:part.end], []).append(len(self.parts))
                self.parts.append(part._replace(parent=parent))
        self.roots = [i for i, part in enumerate(self.parts) if part.parent < 0]  # one per item, in their order
        self.automaton = ahocorasick.Automaton()
        for piece, holders in pieces.items():
            self.automaton.add_word(piece, (len(piece), holders))
        if pieces:
            self.automaton.make_automaton()

    def _pattern(self, i: int) -> Pattern:
        if i not in self.patterns:
            part = self.parts[i]
            self.patterns[i] = Pattern(self.items[part.item][1][part.start:part.end])
        return self.patterns[i]

    def _climb(self, text: str, piece: int, start: int, end: int) -> tuple[int, int, int] | None:
        """Distance and place of the whole item around a piece found at ``start``, if each part on the
        way up occurs within its budget."""
        found = (0, start, end)
        i, held = self.parts[piece].parent, self.parts[piece]
        while i >= 0:
            part = self.parts[i]
            low = max(0, start - (held.start - part.start) - part.errors)
            window = text[low:end + (part.end - held.end) + part.errors]
            hit = self._pattern(i).best(window, part.errors)
            if hit is None:
                return None
            found = (hit[0], low, low + hit[1])
            i = part.parent
        return found

    def search(self, text: str) -> list[Match]:
        """The best match of every item that occurs; ``text`` is normalized, and so are the places."""
        if not self.items or not text:
            return []
        best: dict[int, tuple[int, int]] = {}
        searched: dict[int, tuple[int, int]] = {}
        for last, (length, holders) in self.automaton.iter(text):
            start, end = last + 1 - length, last + 1
            for piece in holders:
                part = self.parts[piece]
                item, root = part.item, self.roots[part.item]
                known, errors = best.get(item), self.parts[root].errors
                if known and known[0] == 0:
                    continue
                # Whatever match holds this piece lies between these two places.
                low, high = start - part.start - errors, end + len(self.items[item][1]) - part.end + errors
                done = searched.get(item)
                if done and done[0] <= low and high <= done[1]:
                    continue
                if self._climb(text, piece, start, end) is None:
                    continue
                # The least distance around, far enough for the match's other pieces to lie inside.
                low, high = low - errors, high + errors
                distance, stop = self._pattern(root).best(text[max(0, low):high], errors)
                searched[item] = (low, high)
                if known is None or distance < known[0]:
                    best[item] = (distance, max(0, low) + stop)
        out = []
        for item, (distance, end) in sorted(best.items()):
            item_id, whole = self.items[item]
            low = max(0, end - len(whole) - distance)
            back = Pattern(whole[::-1]).best(text[low:end][::-1], distance)
            out.append(Match(item_id, distance, end - back[1] if back else low, end, len(whole)))
        return out


SCHEMA = "doc_id long, item_id long, distance int, start int, end int, item_chars int"


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, read block by block."""
    known = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    chars = known.agg(F.sum(F.length("text"))).first()[0] or 0
    count = chars // block_chars + 1
    for b in range(count):
        rows = known.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == b).collect()
        yield sorted((r.item_id, r.text) for r in rows)


def _searching(docs: DataFrame, block: list[tuple[int, str]], rate: float) -> Callable[[str], list[Match]]:
    """A search for the items of a block; the searcher is built once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    built: list[Searcher] = []

    def search(text: str) -> list[Match]:
        if not built:
            built.append(Searcher(shared.value, rate))
        return built[0].search(normalized(text))
    return search


def _free_of(search: Callable[[str], list[Match]]) -> Callable[[Column], Column]:
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not search(t) for t in texts], dtype=bool)
    return clean


def contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, start, end, item_chars``: for every row and item the match of least
    distance within the budget, the first of equal ones as pieces are met; places are in the normalized text."""
    found = None
    for block in _blocks(items, block_chars):
        search = _searching(docs, block, rate)

        def find(batch: pd.DataFrame, search=search) -> pd.DataFrame:
            rows = [(doc_id, *m) for doc_id, text in zip(batch["doc_id"], batch["text"]) for m in search(text)]
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "start", "end", "item_chars"])
            out["doc_id"] = out["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
            return out
        hits = map_batches(documents(docs), find, SCHEMA)
        found = hits if found is None else found.unionAll(hits)
    return found


def clean_documents(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item, in their columns.

    Rows are judged one by one where they lie, so none is moved.
    """
    kept = docs
    for block in _blocks(items, block_chars):
        kept = kept.where(_free_of(_searching(docs, block, rate))(F.coalesce("text", F.lit(""))))
    return kept
