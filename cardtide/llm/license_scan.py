"""License scan: ordered signature rules behind a keyword filter.

A rule is a regular expression over lower-cased text with a label, a priority and the keywords one
of which must occur before the expression is tried. Keywords of all rules are searched in one
Aho-Corasick pass; most texts hold none and cost nothing more. Detections are resolved in order of
priority: one that lies inside an accepted detection is suppressed; detections that overlap in part
say different things and both stay. Base phrases (three fixed labels) are found at all their places and always kept.

Nulls count as empty texts; empty texts have zero counts, null places and empty labels. Repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import documents, lower_ascii, map_batches

#: Fixed phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Names of licenses: label, pattern of the name, keyword that must occur. Written by hand.
_NAMES = (
    ("mit", r"(?:the )?(?:mit|expat)", "mit|expat"), ("apache-1.1", r"(?:the )?apache(?: software)?,? (?:license,? )?(?:version )?1\.1", "apache"),
    ("apache-2.0", r"(?:the )?apache(?: software)?(?: license)?,? ?(?:version |v)?2(?:\.0)?", "apache"), ("apache", r"(?:the )?apache", "apache"),
    ("bsd-2-clause", r"(?:the )?(?:simplified bsd|freebsd|(?:2|two)[- ]clause bsd|bsd[- ](?:2|two)[- ]clause)", "bsd"),
    ("bsd-3-clause", r"(?:the )?(?:new bsd|modified bsd|revised bsd|(?:3|three)[- ]clause bsd|bsd[- ](?:3|three)[- ]clause)", "bsd"),
    ("bsd-4-clause", r"(?:the )?(?:original bsd|(?:4|four)[- ]clause bsd|bsd[- ](?:4|four)[- ]clause)", "bsd"), ("bsd", r"(?:the )?bsd", "bsd"),
    ("gpl-1.0", r"(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)[, ]*(?:version |v\.? ?)1(?:\.0)?", "gpl|general public"),
    ("gpl-2.0", r"(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)[, -]*(?:version |v\.? ?)?2(?:\.0)?", "gpl|general public"),
    ("gpl-3.0", r"(?:the )?(?:gnu )?(?:gpl|general public licen[cs]e)[, -]*(?:version |v\.? ?)?3(?:\.0)?", "gpl|general public"),
    ("gpl", r"(?:the )?(?:gnu )?(?:gpl|general public)", "gpl|general public"),
    ("lgpl-2.1", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)[, -]*(?:version |v\.? ?)?2\.1", "lgpl|lesser"),
    ("lgpl-3.0", r"(?:the )?(?:gnu )?(?:lgpl|lesser general public licen[cs]e)[, -]*(?:version |v\.? ?)?3(?:\.0)?", "lgpl|lesser"),
    ("lgpl", r"(?:the )?(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "lgpl|lesser|library"),
    ("agpl-3.0", r"(?:the )?(?:gnu )?(?:agpl|affero general public licen[cs]e)[, -]*(?:version |v\.? ?)?3(?:\.0)?", "agpl|affero"),
    ("agpl", r"(?:the )?(?:gnu )?(?:agpl|affero(?: general public)?)", "agpl|affero"), ("gfdl", r"(?:the )?(?:gnu )?(?:gfdl|free documentation)", "gfdl|free documentation"),
    ("mpl-1.1", r"(?:the )?(?:mpl|mozilla public licen[cs]e)[, -]*(?:version |v)?1\.1", "mpl|mozilla"),
    ("mpl-2.0", r"(?:the )?(?:mpl|mozilla public licen[cs]e)[, -]*(?:version |v)?2(?:\.0)?", "mpl|mozilla"), ("mpl", r"(?:the )?(?:mpl|mozilla public)", "mpl|mozilla"),
    ("epl-1.0", r"(?:the )?(?:epl|eclipse public licen[cs]e)[, -]*(?:version |v)?1(?:\.0)?", "epl|eclipse"),
    ("epl-2.0", r"(?:the )?(?:epl|eclipse public licen[cs]e)[, -]*(?:version |v)?2(?:\.0)?", "epl|eclipse"), ("epl", r"(?:the )?(?:epl|eclipse public)", "epl|eclipse"),
    ("cddl", r"(?:the )?(?:cddl|common development and distribution)", "cddl|common development"), ("cpl", r"(?:the )?common public", "common public"),
    ("eupl", r"(?:the )?(?:eupl|european union public)", "eupl|european union"), ("isc", r"(?:the )?isc", "isc"), ("zlib", r"(?:the )?zlib(?:/libpng)?", "zlib"),
    ("unlicense", r"(?:the )?unlicense", "unlicense"), ("wtfpl", r"(?:the )?wtfpl", "wtfpl"), ("bsl-1.0", r"(?:the )?boost(?: software)?", "boost"),
    ("artistic-2.0", r"(?:the )?artistic(?: licen[cs]e)?,? ?(?:version )?2(?:\.0)?", "artistic"), ("artistic", r"(?:the )?(?:perl )?artistic", "artistic"),
    ("php", r"(?:the )?php", "php"), ("python", r"(?:the )?(?:python(?: software foundation)?|psf)", "python|psf"), ("ruby", r"(?:the )?ruby", "ruby"),
    ("postgresql", r"(?:the )?postgresql", "postgresql"), ("openssl", r"(?:the )?openssl", "openssl"), ("ofl", r"(?:the )?(?:sil )?open font", "open font"),
    ("odbl", r"(?:the )?(?:odbl|open database)", "odbl|open database"), ("ms-pl", r"(?:the )?(?:ms-pl|microsoft public)", "ms-pl|microsoft"),
    ("afl", r"(?:the )?academic free", "academic free"), ("osl", r"(?:the )?open software", "open software"), ("0bsd", r"(?:the )?(?:0bsd|zero[- ]clause bsd)", "0bsd|zero"),
    ("cc0", r"cc0(?: 1\.0)?", "cc0"),
    ("cc-by-nc-nd", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)-(?:nd|noderiv\w*)", "cc|creative commons"),
    ("cc-by-nc-sa", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)-(?:sa|sharealike)", "cc|creative commons"),
    ("cc-by-nc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)", "cc|creative commons"),
    ("cc-by-nd", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nd|noderiv\w*)", "cc|creative commons"),
    ("cc-by-sa", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:sa|sharealike)", "cc|creative commons"),
    ("cc-by", r"(?:cc|creative commons)[ -](?:by|attribution)", "cc|creative commons"),
)

# Sentences a name can stand in: pattern around {}, priority, confidence. Every name with every
# sentence gives one rule; a name alone is no license statement unless it ends in a version.
_SENTENCES = (
    (r"spdx-license-identifier:\s*{}(?:[ -](?:only|or-later))?", 90, 1.0),
    (r"(?:is |are |be )?(?:re)?licen[cs]ed under (?:the terms of )?(?:a |an )?{}(?: (?:public )?licen[cs]e)?(?:,? ?(?:version |v)?[0-9](?:\.[0-9])?)?", 80, 0.95),
    (r"(?:re)?(?:released|distributed|available|provided|published|covered) (?:by|under|according to) (?:the terms of )?(?:a |an )?{}(?: (?:public )?licen[cs]e)?(?:,? ?(?:version |v)?[0-9](?:\.[0-9])?)?", 75, 0.9),
    (r"under the (?:terms|conditions) of {} licen[cs]e", 70, 0.9),
    (r"licen[cs]e:\s*{}(?: licen[cs]e)?", 65, 0.85),
    (r"permission is granted .{{0,80}}under {} licen[cs]e", 60, 0.85),
    (r"{}(?: licen[cs]e|(?<=[0-9]))(?:,? (?:version |v)[0-9](?:\.[0-9])?)?", 40, 0.7),
)

# Statements that name no license family in a sentence of the kinds above.
_NOTICES = (
    ("cc-by-nc", r"creativecommons\.org/licenses/by-nc/[0-9.]+", 85, 0.95, "creativecommons"),
    ("cc-by-sa", r"creativecommons\.org/licenses/by-sa/[0-9.]+", 85, 0.95, "creativecommons"),
    ("cc-by", r"creativecommons\.org/licenses/by/[0-9.]+", 85, 0.95, "creativecommons"),
    ("cc0", r"creativecommons\.org/publicdomain/zero/[0-9.]+", 85, 0.95, "creativecommons"),
    ("apache-2.0", r"apache\.org/licenses/license-2\.0", 85, 0.95, "apache.org"),
    ("gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl", 85, 0.95, "gnu.org"),
    ("lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl", 85, 0.95, "gnu.org"),
    ("mit", r"opensource\.org/licenses/mit", 85, 0.95, "opensource.org"),
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", 88, 1.0, "hereby granted"),
    ("isc", r"permission to use, copy, modify, and/?(?:or)? distribute this software for any purpose", 88, 1.0, "permission to use"),
    ("bsd", r"redistribution and use in source and binary forms", 88, 1.0, "redistribution"),
    ("public-domain", r"(?:released|placed|dedicated) (?:in)?to the public domain", 70, 0.9, "public domain"),
    ("proprietary", r"proprietary and confidential", 60, 0.8, "proprietary"),
    ("copyright", r"(?:copyright|\(c\)|©)(?: \(c\)| ©)? (?:19|20)[0-9]{2}", 30, 0.5, "copyright|(c)|©"),
    ("reserved", r"(?:no|some) rights reserved", 35, 0.6, "rights reserved"),
    ("warranty", r"without warranty of any kind", 20, 0.4, "warranty"),
)


class Rule(NamedTuple):
    label: str
    pattern: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]


class Detection(NamedTuple):
    start: int
    end: int
    label: str
    priority: int
    confidence: float
    order: int = 0  # place of the rule among all rules


@lru_cache(1)
def default_rules() -> tuple[Rule, ...]:
    """The rules in order: sentences by priority, more exact names before their families."""
    rules = [Rule(label, p, priority, conf, tuple(keys.split("|"))) for label, p, priority, conf, keys in _NOTICES]
    for sentence, priority, conf in _SENTENCES:
        for label, name, keys in _NAMES:
            pattern = sentence.replace("{{", "{").replace("}}", "}").replace("{}", f"(?:{name})")
            rules.append(Rule(label, pattern, priority, conf, tuple(keys.split("|"))))
    return tuple(sorted(rules, key=lambda r: -r.priority))


class Scanner:
    """Compiled rules with their keyword automaton; built once per worker."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.compiled: dict[int, re.Pattern[str]] = {}
        self.by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for keyword in rule.keywords:
                self.by_keyword.setdefault(keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[Detection]:
        """All matches of the rules whose keyword occurs, before suppression."""
        tried = sorted({i for _, keyword in self.automaton.iter(text) for i in self.by_keyword[keyword]})
        found = []
        for i in tried:
            rule = self.rules[i]
            pattern = self.compiled.get(i) or self.compiled.setdefault(i, re.compile(rf"(?<!\w){rule.pattern}(?!\w)"))
            found += [Detection(*m.span(), rule.label, rule.priority, rule.confidence, i) for m in pattern.finditer(text)]
        return found

    def scan(self, text: str) -> list[Detection]:
        return suppress(self.detections(text))


def suppress(found: list[Detection]) -> list[Detection]:
    """Accepts detections by priority, then length, then order of the rules; one that lies inside an
    accepted one goes.

    Kept in mind are the accepted intervals that lie in no other: their starts and ends rise together,
    so only the last one that starts in time has to be looked at.
    """
    starts: list[int] = []
    ends: list[int] = []
    accepted: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.order, d.start)):
        at = bisect_right(starts, d.start)
        if at and ends[at - 1] >= d.end:
            continue
        accepted.append(d)
        low, high = bisect_left(starts, d.start), bisect_right(ends, d.end)
        starts[low:high], ends[low:high] = [d.start], [d.end]
    return sorted(accepted)


@lru_cache(1)
def _default_scanner() -> Scanner:
    return Scanner(default_rules())


_WORD = rb"[0-9a-z\x80-\xff]"
_BASE = [
    (label, phrase.split()[0].encode(), re.compile(
        rb"(?<!" + _WORD + rb")(?=" + rb"[^0-9a-z\x80-\xff]+".join(w.encode() for w in phrase.split()) + rb"(?!" + _WORD + rb"))"))
    for phrase, label in BASE_PHRASES.items()
]
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def base_scan(lowered: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and (word index, label) of every base place."""
    inside = _IS_WORD[np.frombuffer(lowered, dtype=np.uint8)]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    hits = [(m.start(), label) for label, first, pattern in _BASE if first in lowered for m in pattern.finditer(lowered)]
    before = np.cumsum(starts)  # a hit begins at a word, which is the last one counted there
    return int(np.count_nonzero(starts)), [(int(before[at]) - 1, label) for at, label in hits]


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_detections long, spans string")


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """One row per document: words, base places and labels, all labels, ``score`` (1 minus the
    product of the doubts of all detections; base places are certain), and the accepted spans as
    ``label:start:end`` in code points."""
    def scan(batch: pd.DataFrame) -> pd.DataFrame:
        scanner = Scanner(rules) if rules else _default_scanner()
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            lowered = lower_ascii(text)
            n_words, places = base_scan(lowered)
            found = scanner.scan(lowered.decode("utf-8", "surrogatepass"))
            base = sorted({label for _, label in places})
            doubt = 0.0 if places else float(np.prod([1 - d.confidence for d in found]))
            at = [i for i, _ in places]
            rows.append((
                doc_id, n_words, len(places), min(at, default=None), max(at, default=None), ",".join(base),
                ",".join(sorted({*base, *(d.label for d in found)})), 1.0 - doubt, len(found),
                ",".join(f"{d.label}:{d.start}:{d.end}" for d in found)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype(
            {c: "Int64" for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "n_detections")})
    return map_batches(documents(docs), scan, SCHEMA)
