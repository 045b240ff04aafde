"""N-gram Jaccard join by PartEnum signatures, and the groups its links form.

A document's set holds the hashes of its distinct word n-grams. Two sets of similarity at least
``similar`` have sizes in the same or in neighbouring size bands, and differ in at most ``k``
elements, ``k`` following from the larger band. A hash cuts the feature domain into groups, and a group
into ``p`` parts; a signature is the content of all parts of a group but one. Where ``k`` is small, ``p``
is 3 and all three pairs of parts are enumerated: a group in which at most one part differs gives one
signature to both sets, so fewer groups than differences do. For larger ``k`` that would take one and a
half times the signatures, so ``p`` is 2 there and each part is a signature. Either way there are
enough groups for similar sets to agree on at least ``m + 1`` signatures (``Bands.plan``). The
margin ``m`` lets a set leave out signatures and still meet every partner:

- up to ``m`` empty signatures are left out;
- signatures shared by very many sets (heavy) are left out where empty and heavy ones together are
  at most ``m``; other sets ("stuck") keep them;
- sharing fewer signatures than the margin guarantees rules a pair out without reading its sets.

Candidates are verified on the whole sets. Large groups are joined by few pairs first (every set
against pivots of its buckets); then only pairs whose groups still differ are compared: pairs met in
light buckets one by one, stuck sets part by part inside tasks of bounded size. So every link between
different sets is verified or implied by links that are.

Texts are known by a 64-bit hash. Ties and nulls: a text without words has an empty set and links with
nothing, also not with other empty texts; a text with fewer words than n has its whole sequence as
the one element; rows with equal texts are one group from the start; a null id takes part but never
names a group. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import BATCH_ROWS, Membership, documents, lower_ascii, map_batches, mix, shingle_hashes, stage, whole_row, word_hashes

#: Words per n-gram and least similarity of a link.
WIDTH, SIMILAR = 4, Fraction(85, 100)
#: Largest difference for which pairs of parts are enumerated. A signature of two parts in three holds
#: about a third more elements than one part of as many differences, so short texts that share a
#: passage meet less often.
ENUMERATED = 64
#: Members from which a bucket counts as heavy.
HEAVY = 12
#: Rounds that join large groups by pivots before the remaining pairs are compared, and the share of
#: the buckets each of these rounds uses.
PIVOT_ROUNDS, PIVOT_SHARE = 2, 8
#: Sets that share common signatures are compared in parts of a cluster: about so many elements a part
#: in up to PARTS parts, and at most so many in more.
PART_ELEMENTS, PARTS, MAX_PART_ELEMENTS = 1 << 15, 24, 1 << 20
SALTS = 64
#: Nodes whose groups a task remembers while it drops edges that close circles.
FOREST_NODES = 1 << 18


class Plan(NamedTuple):
    """How a size band is enumerated: ``groups`` of ``parts`` parts, a signature for all parts of a group
    but one. Sets that differ in at most ``difference`` elements agree on more than ``margin`` signatures."""
    difference: int
    margin: int
    groups: int
    parts: int


class Bands:
    """Size bands and the plan of each."""

    def __init__(self, similar: Fraction) -> None:
        self.similar = similar
        self.last: list[int] = []  # largest size of each band

    def band(self, size: int) -> int:
        while not self.last or self.last[-1] < size:
            low = self.last[-1] + 1 if self.last else 1
            self.last.append(int(low / self.similar))
        return bisect_left(self.last, size)

    def largest(self, band: int) -> int:
        while len(self.last) <= band:
            self.band(self.last[-1] + 1 if self.last else 1)
        return self.last[band]

    def plan(self, band: int) -> Plan:
        k = int(2 * self.largest(band) * (1 - self.similar) / (1 + self.similar))
        parts = 3 if k <= ENUMERATED else 2
        # Of p signatures a group loses p - 1 to the first part that differs in it and the last one to the
        # second. At worst each group has one such part, then some have two: p * g - (p - 2) * g - k are left.
        groups = -(-(k + int(0.15 * (k + 1)) + 3) // 2)
        return Plan(k, 2 * groups - k - 1, groups, parts)


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams."""
    words = lower_ascii(text).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = word_hashes(words)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"short " + b" ".join(words))], dtype=np.uint64)
    return np.unique(shingle_hashes(hashes, width))


def fingerprint(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def signatures(shingles: np.ndarray, bands: Bands) -> list[tuple[int, int, np.ndarray]]:
    """(tag, spare, signatures) for the set's own band and the next. ``spare`` is how many further
    signatures may be left out; -1 where none may."""
    size = len(shingles)
    if not size:
        return []
    own, out = bands.band(size), []
    for tag in (own, own + 1):
        plan = bands.plan(tag)
        if not plan.difference:  # only equal sets can link here
            if tag == own:
                out.append((tag, 0, mix(np.array([fingerprint(shingles)], dtype=np.uint64))))
            continue
        scattered = mix(shingles + np.uint64(tag * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        n = plan.groups * plan.parts
        part = ((scattered >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
        content = np.zeros(n, dtype=np.uint64)
        np.add.at(content, part, mix(scattered))
        held = np.bincount(part, minlength=n)
        if plan.parts > 2:  # all parts of a group but one
            by_group = lambda cells: (cells.reshape(-1, plan.parts).sum(1, dtype=cells.dtype, keepdims=True) - cells.reshape(-1, plan.parts)).ravel()
            content, held = by_group(content), by_group(held)
        marks = mix(content + np.arange(n, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(tag))
        filled = held > 0
        empty = n - int(np.count_nonzero(filled))
        out.append((tag, plan.margin - empty, marks[filled]) if empty <= plan.margin else (tag, -1, marks))
    return out


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, text``; texts are known by a 64-bit hash."""
    return documents(docs).withColumn("text_key", F.xxhash64("text"))


#: ``info`` holds the tag and the spare of a set under that tag: tag * 2^20 + spare + 1. One more row
#: per text carries the size of its set, as -1 - size.
_SPARE = 1 << 20
_SIGNATURES = "sig long, key long, info int"


def signature_table(docs: DataFrame, width: int, similar: Fraction) -> DataFrame:
    """A row per signature and one with the size of the set. A task emits equal texts once, so exact
    copies hardly add up."""
    def run(batches):
        bands, seen = Bands(similar), set()
        for batch in batches:
            for start in range(0, len(batch), BATCH_ROWS):
                rows = batch.iloc[start:start + BATCH_ROWS]
                sigs, keys, infos = [np.empty(0, np.uint64)], [], []
                for key, text in zip(rows["text_key"].tolist(), rows["text"]):
                    if key in seen:
                        continue
                    seen.add(key)
                    shingles = shingle_set(text, width)
                    sigs.append(mix(np.array([key], dtype=np.int64).view(np.uint64)))
                    keys.append(np.array([key], dtype=np.int64))
                    infos.append(np.array([-1 - len(shingles)], dtype=np.int32))
                    for tag, spare, marks in signatures(shingles, bands):
                        sigs.append(marks)
                        keys.append(np.full(len(marks), key, dtype=np.int64))
                        infos.append(np.full(len(marks), tag * _SPARE + spare + 1, dtype=np.int32))
                if keys:
                    yield pd.DataFrame({"sig": np.concatenate(sigs).view(np.int64), "key": np.concatenate(keys), "info": np.concatenate(infos)})
    return keyed_documents(docs).select("text_key", "text").mapInPandas(run, _SIGNATURES)


def buckets(docs: DataFrame, width: int, similar: Fraction) -> tuple[DataFrame, DataFrame]:
    """``(rows, sizes)``. Rows are ``sig, key, info, spare, members, pivot`` of every signature that at
    least two texts share, for texts that share enough of them to have a partner; the pivot is the
    member whose signatures are shared most. Sizes are ``key, n_shingles`` of every text."""
    emitted = signature_table(docs, width, similar).repartition("sig").dropDuplicates(["sig", "key"])
    of_sig, of_set = Window.partitionBy("sig"), Window.partitionBy("key", "info")
    shared = stage(emitted.select("*", F.count("*").over(of_sig).alias("members")).where("members > 1 or info < 0"), "shared")
    sizes = shared.where("info < 0").select("key", (-1 - F.col("info")).cast("long").alias("n_shingles"))
    # Similar sets share more signatures than either could leave out.
    spare = (F.pmod("info", F.lit(_SPARE)) - 1).alias("spare")
    judged = shared.where("info >= 0").select("*", spare).select(
        "*", (F.count("*").over(of_set) > F.col("spare")).alias("enough"), F.sum("members").over(of_set).alias("weight"))
    enough = stage(judged.where("enough").select("sig", "key", "info", "spare", "members", "weight"), "enough")
    totals = enough.groupBy("sig").agg(F.count("*").alias("members"), F.max_by("key", F.struct("weight", "key")).alias("pivot"))
    again = told(enough.select("sig", "key", "info", "spare", "members"), totals.where("members > 1"))
    return stage(again.select("sig", "key", "info", "spare", "members", "pivot"), "buckets"), sizes


#: Rows of a signature that one share of it holds, about, and the most shares.
SHARE_ROWS, SHARES = 1024, 256


def told(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``totals``, one row per ``sig``, in place of their own ``members``.

    A signature that very many rows share is dealt in shares by ``members`` (an upper bound known from
    an earlier step), and its total is handed to each share, so none of its rows meet in one task.
    """
    shares = lambda members: F.least(F.floor(members / SHARE_ROWS) + 1, F.lit(SHARES))
    most = rows.groupBy("sig").agg(F.max("members").alias("most"))
    copies = totals.join(most, "sig").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares(F.col("most")) - 1))).drop("most")
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("key", F.lit("share")), shares(F.col("members")))).drop("members")
    return dealt.join(copies, ["sig", "share"]).drop("share")


def sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``key, shingles`` of the texts named in ``wanted``. Texts that cannot be among them are passed
    over by a filter of fixed size before their sets are computed again."""
    filter_ = docs.sparkSession.sparkContext.broadcast(Membership.build(wanted, "key"))

    def read(batches):
        seen = set()
        for batch in batches:
            hit = batch[filter_.value(batch["text_key"].to_numpy()) & ~batch["text_key"].isin(seen) & ~batch["text_key"].duplicated()]
            seen.update(hit["text_key"].tolist())
            for start in range(0, len(hit), BATCH_ROWS):
                rows = hit.iloc[start:start + BATCH_ROWS]
                yield pd.DataFrame({"key": rows["text_key"], "shingles": [shingle_set(t, width).view(np.int64) for t in rows["text"]]})
    rows = keyed_documents(docs).select("text_key", "text").mapInPandas(read, "key long, shingles array<long>")
    return stage(rows.join(wanted, "key", "left_semi").dropDuplicates(["key"]), "sets")


def verified(pairs: DataFrame, shingles: DataFrame, similar: Fraction) -> DataFrame:
    """The ``a, b`` whose whole sets reach the similarity."""
    one = shingles.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    two = shingles.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    num, den = similar.numerator, similar.denominator
    both = pairs.join(two, "b").join(one, "a").where(den * F.least(F.size("sa"), F.size("sb")) >= num * F.greatest(F.size("sa"), F.size("sb")))
    same = F.size(F.array_intersect("sa", "sb"))
    checked = both.select("a", "b", same.alias("same"), (F.size("sa") + F.size("sb")).alias("sum"))
    return checked.where(den * F.col("same") >= num * (F.col("sum") - F.col("same"))).select("a", "b")


def forest(edges: DataFrame) -> DataFrame:
    """The edges ``a, b`` of each partition without those that close a circle in it, so that what is
    exchanged grows with the nodes. Memory is bounded: after FOREST_NODES nodes a new forest begins."""
    def run(batches):
        above: dict[int, int] = {}

        def root(n: int) -> int:
            while (up := above.get(n, n)) != n:
                above[n] = above.get(up, up)
                n = up
            return n
        for batch in batches:
            if len(above) > FOREST_NODES:
                above.clear()
            kept = []
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
                low, high = sorted((root(a), root(b)))
                if low != high:
                    above[high] = low
                    kept.append((a, b))
            if kept:
                yield pd.DataFrame(kept, columns=["a", "b"], dtype=np.int64)
    return edges.select("a", "b").mapInPandas(run, "a long, b long")


def _roots(parents: DataFrame) -> DataFrame:
    """``node, label`` with the end of each chain of ``node, label``, where labels never grow; the ends
    have themselves as label."""
    while True:
        onward = parents.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stage(parents.join(onward, "label").select("node", F.col("further").alias("label"), (F.col("further") < F.col("label")).alias("moved")), "roots")
        parents = moved.select("node", "label")
        if not moved.where("moved").limit(1).count():
            return parents


def _through(labels: DataFrame | None, step: DataFrame) -> DataFrame:
    """``node, label`` after ``step`` renames the labels of ``labels``; nodes new in ``step`` are added."""
    if labels is None:
        return step
    renamed = step.select(F.col("node").alias("label"), F.col("label").alias("lower"))
    moved = labels.join(renamed, "label", "left").select("node", F.coalesce("lower", "label").alias("label"))
    return stage(moved.unionAll(step.join(labels, "node", "left_anti").select("node", "label")), "labels")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node of each connected component.

    Contraction: every node points to its smallest neighbour, chains of pointers are followed to their
    ends, and edges are carried over to the ends; those inside one group go. A later round sees only
    what still joins groups, so the joined rows of all rounds add up to a small multiple of the edges.
    """
    live = stage(forest(edges.where("a <> b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while live.limit(1).count():
        ends = live.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(live.select("b", "a"))
        step = _roots(ends.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")))
        lower = lambda end: step.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        carried = live.join(lower("a"), "a").join(lower("b"), "b").where("a_label <> b_label").select(
            F.least("a_label", "b_label").alias("a"), F.greatest("a_label", "b_label").alias("b"))
        labels = _through(labels, step)
        live = stage(forest(carried).distinct(), "edges")
    return labels if labels is not None else edges.sparkSession.createDataFrame([], "node long, label long")


def clusters(rows: DataFrame) -> DataFrame:
    """``node, label`` with the smallest key of all sets that ``sig, key, members`` connect.

    In a round every set points to one other, the smallest that any of its signatures knows; signatures
    that one group is left of are done.
    """
    live, labels = rows.select("sig", "key", "members"), None
    while True:
        ends = live.groupBy("sig").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        open_rows = stage(told(live.select("*", F.col("members").alias("most")), ends.where("low < high")).select(
            "sig", "key", F.col("most").alias("members"), "low"), "open-signatures")
        if not open_rows.limit(1).count():
            break
        step = _roots(open_rows.groupBy(F.col("key").alias("node")).agg(F.min("low").alias("label")))
        labels = _through(labels, step)
        live = stage(open_rows.join(step, F.col("key") == F.col("node")).groupBy("sig", F.col("label").alias("key")).agg(
            F.max("members").alias("members")), "open-rows")
    return labels if labels is not None else rows.sparkSession.createDataFrame([], "node long, label long")


def _grouped(labels: DataFrame | None, rows: DataFrame, column: str, out: str) -> DataFrame:
    """``rows`` with the group of ``column``: its label, or itself."""
    if labels is None:
        return rows.withColumn(out, F.col(column))
    named = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
    return rows.join(named, F.col(column) == F.col("_n"), "left").withColumn(out, F.coalesce("_l", F.col(column))).drop("_n", "_l")


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Groups after more links, which join groups of ``labels``."""
    ends = _grouped(labels, _grouped(labels, links, "a", "ga"), "b", "gb").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    ends = stage(ends.where("a <> b").distinct(), "links")
    if not ends.limit(1).count():
        return labels
    return _through(labels, components(ends))


def _pivot_pairs(rows: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Pairs of a text and a pivot of one of its buckets, where their groups differ: in the first turn
    the pivot it shares most buckets with, later every one, with pivots drawn anew."""
    part = rows.where(F.pmod(F.xxhash64("sig"), F.lit(PIVOT_SHARE)) == turn)
    if turn:
        chosen = part.groupBy("sig").agg(F.min_by("key", F.xxhash64("key", F.lit(turn))).alias("pivot"))
        part = part.drop("pivot").join(chosen, "sig")
    pairs = part.where("key <> pivot").groupBy("key", "pivot").agg(F.count("*").alias("n"))
    cross = _grouped(labels, _grouped(labels, pairs, "key", "ga"), "pivot", "gb").where("ga <> gb")
    if not turn:
        cross = cross.groupBy("key").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("pivot"))
    return cross.select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b")).distinct()


def _open_rows(rows: DataFrame, labels: DataFrame | None, heavy: int) -> DataFrame:
    """``sig, key, g, members, left, spare, tag`` of buckets that still hold several groups. ``left`` is
    how many light signatures more a set could leave out; -1 for a stuck set, which keeps all."""
    of_set = Window.partitionBy("key", "info")
    left = F.greatest(F.col("spare") - F.count_if(F.col("members") > heavy).over(of_set), F.lit(-1))
    kept = rows.select("sig", "key", "members", left.alias("left"), F.shiftright("info", 20).alias("tag"))
    used = kept.where((F.col("members") <= heavy) | (F.col("left") < 0))
    named = stage(_grouped(labels, used, "key", "g"), "named")
    mixed = named.groupBy("sig").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.max("members").alias("members"))
    return stage(told(named, mixed.where("low <> high").drop("low", "high")), "open")


def _light_pairs(open_rows: DataFrame, heavy: int) -> DataFrame:
    """Pairs in different groups, at least one of them not stuck, that share enough light signatures.

    A bucket has at most ``heavy`` members here.
    """
    light = open_rows.where(F.col("members") <= heavy)
    side = lambda end: light.select("sig", *[F.col(c).alias(f"{c}_{end}") for c in ("key", "g", "left", "tag")])
    met = side("a").join(side("b"), "sig").where("key_a < key_b and g_a <> g_b and (left_a >= 0 or left_b >= 0)")
    counted = met.groupBy("key_a", "key_b", "tag_a").agg(F.count("*").alias("n"), F.max(F.greatest("left_a", "left_b")).alias("left"))
    return counted.where("n > left").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def linked_in_block(block: pd.DataFrame, similar: Fraction) -> pd.DataFrame:
    """Links between rows of parts ``low`` and ``high`` (or within the one part) whose groups differ, by
    counting common bits of the elements that occur more than once. All pairs are compared; a link
    between groups that links found before have joined already adds nothing and is left out."""
    sets, groups = block["shingles"].tolist(), block["g"].to_numpy()
    first = block["part"].to_numpy() == block["low"].to_numpy()
    second = block["part"].to_numpy() == block["high"].to_numpy()
    keys, sizes = block["key"].to_numpy(), np.array([len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column, twice = np.where(often >= 2, np.cumsum(often >= 2) - 1, -1)[column], int((often >= 2).sum())
    owner = np.repeat(np.arange(len(sets)), sizes)[column >= 0]
    column = column[column >= 0]
    bits = np.zeros((len(sets), twice // 64 + 1), dtype=np.uint64)
    np.bitwise_or.at(bits, (owner, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    num, den = similar.numerator, similar.denominator
    found, joined = [], {}

    def group_of(g: int) -> int:
        while joined.get(g, g) != g:
            joined[g] = joined.get(joined[g], joined[g])
            g = joined[g]
        return g
    for i in np.flatnonzero(first):
        fits = second & (groups != groups[i]) & (den * np.minimum(sizes, sizes[i]) >= num * np.maximum(sizes, sizes[i]))
        if block["low"].iat[0] == block["high"].iat[0]:
            fits[:i + 1] = False
        others = np.flatnonzero(fits)
        same = np.bitwise_count(bits[others] & bits[i]).sum(1, dtype=np.int64)
        for j in others[den * same >= num * (sizes[others] + sizes[i] - same)]:
            a, b = group_of(groups[i]), group_of(groups[j])
            if a != b:
                joined[max(a, b)] = min(a, b)
                found.append((keys[i], keys[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def _stuck_links(open_rows: DataFrame, shingles: DataFrame, similar: Fraction) -> DataFrame:
    """Links among stuck sets: those connected by buckets form a cluster, which is cut into parts of
    bounded size; every two parts are compared in a task of their own. Only links leave it."""
    stuck = open_rows.where("left < 0").select("sig", "key", "g", "members")
    found = clusters(stuck)
    if not found.limit(1).count():
        return found.select(F.col("node").alias("a"), F.col("label").alias("b"))
    members = stuck.select("key", "g").distinct().join(found.select(F.col("node").alias("key"), F.col("label").alias("cluster")), "key")
    sized = stage(members.join(shingles, "key"), "stuck")
    total = F.sum(F.size("shingles"))
    parts = F.greatest(F.least(F.ceil(total / PART_ELEMENTS), F.lit(PARTS)), F.ceil(total / MAX_PART_ELEMENTS)).cast("int")
    # A cluster may hold most stuck sets, so its sets are told the number of parts in salted shares.
    counted = sized.groupBy("cluster").agg(parts.alias("parts")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    salted = sized.withColumn("salt", F.pmod(F.xxhash64("key", F.lit("salt")), F.lit(SALTS)))
    cut = salted.join(counted, ["cluster", "salt"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    cells = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "cluster", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "key", "g", "shingles")
    return cells.groupBy("cluster", "low", "high").applyInPandas(lambda block: linked_in_block(block, similar), "a long, b long")


def similar_groups(docs: DataFrame, width: int = WIDTH, similar: Fraction = SIMILAR, heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """``(sizes, groups)``: ``key, n_shingles`` of all texts, and ``node, label`` for all texts linked
    with another one. Both are tables in the shared folder."""
    rows, sizes = buckets(docs, width, similar)
    shingles = sets_of(docs, rows.select("key").distinct(), width)
    labels: DataFrame | None = None
    for turn in range(PIVOT_ROUNDS):
        labels = _merged(labels, stage(verified(_pivot_pairs(rows, labels, turn), shingles, similar), "verified"))
    rest = _open_rows(rows, labels, heavy)
    labels = _merged(labels, stage(verified(_light_pairs(rest, heavy), shingles, similar), "verified").unionAll(
        stage(_stuck_links(rest, shingles, similar), "stuck-links")))
    if labels is None:
        labels = docs.sparkSession.createDataFrame([], "node long, label long")
    return sizes, labels


def jaccard_groups(docs: DataFrame, width: int = WIDTH, similar: Fraction = SIMILAR, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the smallest id reachable by links."""
    sizes, labels = similar_groups(docs, width, similar, heavy)
    ids = stage(keyed_documents(docs).select("doc_id", "text_key"), "ids")
    smallest = ids.groupBy(F.col("text_key").alias("key")).agg(F.min("doc_id").alias("own"))
    named = stage(_grouped(labels, smallest.join(sizes, "key"), "key", "g"), "named")
    of_group = named.groupBy("g").agg(F.min("own").alias("component_id"))
    per_text = stage(named.select("key", "n_shingles", "g").join(of_group, "g").select("key", "n_shingles", "component_id"), "components")
    return ids.join(per_text, F.col("text_key") == F.col("key")).select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, width: int = WIDTH, similar: Fraction = SIMILAR) -> DataFrame:
    """One row of each group, in the columns of ``docs``: the one with the smallest id (null ids last),
    then the smallest text hash; of rows equal in both, any one. Rows with empty sets all stay."""
    sizes, labels = similar_groups(docs, width, similar)
    ids = stage(keyed_documents(docs).select("doc_id", "text_key"), "ids")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = ids.groupBy(F.col("text_key").alias("key")).agg(F.min(rank).alias("best"), F.count("*").alias("n"))
    filled = best.join(sizes.where("n_shingles > 0").select("key"), "key")
    named = stage(_grouped(labels, filled, "key", "g").select("key", "g", "best", "n"), "named")
    winners = named.groupBy("g").agg(F.min("best").alias("winner"), F.sum("n").alias("n")).where("n > 1")
    members = ids.join(named.select("key", "g").join(winners.select("g", "winner"), "g"), F.col("text_key") == F.col("key"))
    in_groups = members.select("text_key", "doc_id", (rank == F.col("winner")).alias("wins")).groupBy(
        "text_key", "doc_id", "wins").agg(F.count("*").alias("n"))
    # A row that wins alone needs no decision; the others are dropped, or kept once of several.
    decided = stage(in_groups.where("not wins or n > 1").select(
        F.col("text_key").alias("key"), F.col("doc_id").alias("id"), "wins"), "decided")
    filter_ = docs.sparkSession.sparkContext.broadcast(Membership.build(decided, "key"))
    maybe = F.pandas_udf(lambda keys: pd.Series(filter_.value(keys.to_numpy())), "boolean")
    keyed = docs.select(whole_row(docs), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    flagged = keyed.withColumn("maybe", maybe("text_key"))
    doubtful = flagged.where("maybe").join(decided, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    once = doubtful.where("wins").dropDuplicates(["doc_id", "text_key"])
    return (
        flagged.where("not maybe").select("row.*")
        .unionAll(doubtful.where("wins is null").select("row.*"))
        .unionAll(once.select("row.*"))
    )
