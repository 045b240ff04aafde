"""Personal data: patterns, and terms that disclose them by co-occurrence.

Base findings are emails, IP addresses, payment cards and phone numbers. The values found are the
protected entities. A term near an entity reveals it as far as the corpus says so: with counts over
distinct texts, ``disclosure(t, e) = pmi(t, e) / ic(e)``, which is 1 when the term occurs in no text
without the entity beside it. Terms at or above ``GENERALISE`` are replaced by their kind, those at
or above ``REMOVE`` are removed; both need ``MIN_SUPPORT`` distinct texts as evidence.

A null text counts as empty and has no findings. Repeated rows and copies of a text are evidence
only once and are all sanitised alike. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Membership, documents, map_batches, quoted, stage, whole_row

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that count as its context.
WINDOW = 12
MIN_SUPPORT, GENERALISE, REMOVE = 3, 0.9, 0.97

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that begins inside a run of digits would end as one from the start of the run does, so
# looking behind changes nothing but keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]{3,}")
_DIGITS = re.compile(r"[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    value: str


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards, so long runs cost nothing twice."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(Span("email", start, domain.end(), text[start:domain.end()].lower()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)
    return found


def base_spans(text: str) -> list[Span]:
    """All base findings by kind, then place."""
    found = _emails(text) if "@" in text else []
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append(Span("ip", *m.span(), m.group()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(Span("card", *m.span(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = "".join(_DIGITS.findall(m.group()))
            if 8 <= len(digits) <= 15:
                found.append(Span("phone", *m.span(), digits))
    return found


def term_hash(term: str) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(term.lower())).astype(np.int64).item()


def context_terms(text: str, spans: list[Span]) -> set[tuple[int, int]]:
    """(entity, term) pairs: words within ``WINDOW`` words of a finding, those that touch findings aside."""
    words = list(_WORD.finditer(text))
    starts, ends = [m.start() for m in words], [m.end() for m in words]
    free = [True] * len(words)
    for span in spans:
        for i in range(bisect_right(ends, span.start), bisect_left(starts, span.end)):
            free[i] = False
    terms: dict[int, int] = {}
    pairs = set()
    for span in spans:
        entity = term_hash(f"{span.kind}:{span.value}")
        left, right = bisect_right(ends, span.start), bisect_left(starts, span.end)
        for i in (*range(max(0, left - WINDOW), left), *range(right, min(right + WINDOW, len(words)))):
            if free[i]:
                if i not in terms:
                    terms[i] = term_hash(words[i].group())
                pairs.add((entity, terms[i]))
    return pairs


_A = ("doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base string, "
      "base_sha256 string, entities array<long>, terms array<long>")


def _text_of(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("text_hash", F.xxhash64("text"))


def base_findings(docs: DataFrame) -> DataFrame:
    """Per document its base findings, and the parallel arrays of (entity, term) context pairs."""
    def find(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc_id, key, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
            spans = base_spans(text)
            listed = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)
            pairs = sorted(context_terms(text, spans)) if spans else []
            counts = [sum(s.kind == k for s in spans) for k in KINDS]
            rows.append((doc_id, key, *counts, listed, hashlib.sha256(listed.encode()).hexdigest(),
                         [e for e, _ in pairs], [t for _, t in pairs]))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _A.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
        return out
    return map_batches(_text_of(docs), find, _A)


_TERMS, _PLACES = "text_hash long, term long", "text_hash long, term long, start int, end int, kind string"


def _hashes(text: str) -> np.ndarray:
    """Hashes of the words in order, each lowered by itself: a lowered text can have other words."""
    words = _WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in _WORD.findall(text)]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def _terms_of(texts: DataFrame, wanted: Membership) -> DataFrame:
    """``text_hash, term``, once per row, for terms that may be wanted."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def find(batch: pd.DataFrame) -> pd.DataFrame:
        keys, terms = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for key, text in zip(batch["text_hash"], batch["text"]):
            hashes = _hashes(text)
            hits = np.unique(hashes[shared.value(hashes)])
            keys.append(np.full(len(hits), key, dtype=np.int64))
            terms.append(hits)
        return pd.DataFrame({"text_hash": np.concatenate(keys), "term": np.concatenate(terms)})
    return map_batches(texts, find, _TERMS)


def _places(texts: DataFrame, wanted: Membership) -> DataFrame:
    """Places of the terms that may be wanted, with the kind that would replace them."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def find(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for key, text in zip(batch["text_hash"], batch["text"]):
            hashes = _hashes(text)
            hits = np.flatnonzero(shared.value(hashes))
            words = list(_WORD.finditer(text)) if len(hits) else []
            for i in hits:
                first = words[i].group()[0]
                rows.append((key, int(hashes[i]), *words[i].span(), "number" if first.isdigit() else "name" if first.isupper() else "word"))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _PLACES.split(", ")])
    return map_batches(texts, find, _PLACES)


#: Shares of the texts (one of so many, by hash) on which frequent candidates are ruled out before
#: all texts are searched.
PRUNING = (64, 8)


def _candidates(pairs: DataFrame, texts: int, support: int, generalise: float) -> DataFrame:
    """``term, most``: terms with enough evidence beside an entity, and the number of texts beyond
    which they could not reach the disclosure that counts."""
    joint = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    known = joint.join(_entities(pairs), "entity")
    most = F.col("n_te") * F.pow(F.lit(float(max(texts, 2))) / F.col("n_e"), F.lit(1.0 - generalise))
    return known.groupBy("term").agg(F.max(most + 1e-6).alias("most"))


def _plausible(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates less those found in too many distinct texts already of a share of the table.

    Exact: a share can only count fewer texts than the whole.
    """
    for share in PRUNING:
        part = _text_of(docs).select("text_hash", "text").where(F.pmod("text_hash", F.lit(share)) == 0)
        found = _terms_of(part, Membership.build(candidates, "term")).distinct().groupBy("term").agg(F.count("*").alias("n"))
        candidates = stage(candidates.join(found, "term", "left").where("n is null or n <= most").select("term", "most"), "candidates")
    return candidates


def _entities(pairs: DataFrame) -> DataFrame:
    return pairs.select("text_hash", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))


def disclosing_terms(pairs: DataFrame, term_counts: DataFrame, texts: int, support: int = MIN_SUPPORT) -> DataFrame:
    """``term, disclosure``: the strongest disclosure of any entity, with enough evidence."""
    joint = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    known = joint.join(_entities(pairs), "entity").join(term_counts, "term")
    ic = F.log(F.lit(float(max(texts, 2))) / F.col("n_e"))
    pmi = F.log(F.col("n_te") * F.lit(float(max(texts, 2))) / (F.col("n_t") * F.col("n_e")))
    return known.groupBy("term").agg(F.max(F.when(ic > 0, pmi / ic)).alias("disclosure"))


def _context_pairs(findings: DataFrame) -> DataFrame:
    """``text_hash, entity, term``, once per distinct text."""
    zipped = F.explode(F.arrays_zip("entities", "terms"))
    return findings.where(F.size("terms") > 0).select("text_hash", zipped.alias("p")).select(
        "text_hash", F.col("p.entities").alias("entity"), F.col("p.terms").alias("term")).distinct()


def find_personal_data(docs: DataFrame, support: int = MIN_SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per row: ``doc_id, text_hash``, the base counts and digest, ``n_terms``, and ``spans``, all
    findings as ``kind:start:end``. Kinds of terms are ``term_name``, ``term_number``, ``term_word``
    (generalised) and ``term_removed``."""
    findings = stage(base_findings(docs), "pii")
    pairs = stage(_context_pairs(findings), "pairs")
    texts = findings.select("text_hash").distinct().count()
    candidates = _plausible(docs, _candidates(pairs, texts, support, generalise))
    places = stage(_places(_text_of(docs).select("text_hash", "text"), Membership.build(candidates, "term")), "terms")
    term_counts = places.select("text_hash", "term").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    strong = disclosing_terms(pairs, term_counts, texts, support).where(F.col("disclosure") >= generalise)
    named = F.when(F.col("disclosure") >= remove, "term_removed").otherwise(F.concat(F.lit("term_"), F.col("kind")))
    spans = (
        places.distinct().join(strong, "term").groupBy("text_hash")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", named.alias("name")))).alias("found"))
        .select(F.col("text_hash").alias("key"), F.size("found").cast("long").alias("n"), F.array_join(F.transform(
            "found", lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",").alias("more"))
    )
    joined = findings.join(spans, F.col("text_hash") == F.col("key"), "left")
    return joined.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.array_join(F.filter(F.array("base", "more"), lambda s: s != ""), ",").alias("spans"),
        F.coalesce("n", F.lit(0)).alias("n_terms"), "text_hash",
    )


def sanitise(text: str, spans: str) -> str:
    """``text`` with each finding replaced by its kind, removed terms by nothing."""
    cut = sorted((int(a), int(b), kind) for kind, a, b in (s.rsplit(":", 2) for s in spans.split(",") if s))
    out, done = [], 0
    for start, end, kind in cut:
        if end <= done:
            continue
        out.append(text[done:max(start, done)])
        if kind != "term_removed":
            out.append(f"<{kind.removeprefix('term_')}>")
        done = end
    return "".join(out) + text[done:]


def sanitised_documents(docs: DataFrame) -> DataFrame:
    """The documents with sanitised texts, in their columns; a null text stays null."""
    found = find_personal_data(docs).where("spans <> ''").select("text_hash", "spans").dropDuplicates(["text_hash"])
    rows = docs.select(whole_row(docs), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))

    def apply(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([sanitise(t, s) if t and s else t for t, s in zip(texts, spans)], dtype=object)
    clean = F.pandas_udf(apply, "string")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(clean("row.text", "spans"))
    joined = rows.join(found, "text_hash", "left").withColumn("clean", text)
    return joined.select(*[(F.col("clean") if name == "text" else F.col(f"row.{quoted(name)}")).alias(name) for name in docs.columns])
