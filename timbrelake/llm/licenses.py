"""License scans: ordered signature rules behind keyword filters, overlaps settled by priority and containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timbrelake.llm.text import Slice, WordHashes, arrow_map, slices
from timbrelake.session import ship_package

#: Phrases that always count, with their labels (fixed values).
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Words around a keyword in which signatures are looked for.
REACH = 40

#: Label, pattern of the name over words set apart by single blanks, keywords. Every match has a word
#: that begins with one of the keywords. More special names come first.
NAMES = (
    ("mit-0", "mit (?:no attribution|0)", "mit"),
    ("mit", "(?:mit|expat)(?: x11)?", "mit expat"),
    ("apache-1", "apache(?: software)?(?: foundation)?(?: license)?(?: version)?(?: v)? ?1 [01]", "apache"),
    ("apache-2", "apache(?: software)?(?: foundation)?(?: license)?(?: version)?(?: v)? ?2(?: 0)?", "apache"),
    ("apache", "apache(?: software)?(?: foundation)?", "apache"),
    ("agpl-3", "(?:gnu )?(?:affero general public|agpl)(?: license)?(?: version)?(?: v)? ?v?3(?: 0)?", "affero agpl"),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", "affero agpl"),
    ("lgpl-2.1", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)(?: license)?(?: version)?(?: v)? ?v?2 1", "lesser library lgpl"),
    ("lgpl-2", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)(?: license)?(?: version)?(?: v)? ?v?2(?: 0)?", "lesser library lgpl"),
    ("lgpl-3", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)(?: license)?(?: version)?(?: v)? ?v?3(?: 0)?", "lesser library lgpl"),
    ("lgpl", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)", "lesser library lgpl"),
    ("gpl-1", "(?:gnu )?(?:general public|gpl)(?: license)?(?: version)?(?: v)? ?v?1(?: 0)?", "general gpl"),
    ("gpl-2", "(?:gnu )?(?:general public|gpl)(?: license)?(?: version)?(?: v)? ?v?2(?: 0)?", "general gpl"),
    ("gpl-3", "(?:gnu )?(?:general public|gpl)(?: license)?(?: version)?(?: v)? ?v?3(?: 0)?", "general gpl"),
    ("gpl", "(?:gnu )?(?:general public|gpl)", "general gpl"),
    ("fdl-1.3", "(?:gnu )?(?:free documentation|gfdl|fdl)(?: license)?(?: version)?(?: v)? ?1 3", "documentation gfdl fdl"),
    ("fdl", "(?:gnu )?(?:free documentation|gfdl)", "documentation gfdl"),
    ("bsd-0", "(?:zero clause bsd|0bsd|bsd zero clause)", "bsd 0bsd"),
    ("bsd-2", "(?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd)", "bsd freebsd"),
    ("bsd-3", "(?:(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd)", "bsd"),
    ("bsd-4", "(?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)", "bsd"),
    ("bsd", "bsd(?: style)?", "bsd"),
    ("isc", "isc", "isc"),
    ("mpl-1.1", "(?:mozilla public|mpl)(?: license)?(?: version)?(?: v)? ?1 1", "mozilla mpl"),
    ("mpl-2", "(?:mozilla public|mpl)(?: license)?(?: version)?(?: v)? ?2(?: 0)?", "mozilla mpl"),
    ("mpl", "(?:mozilla public|mpl)", "mozilla mpl"),
    ("epl-1", "(?:eclipse public|epl)(?: license)?(?: version)?(?: v)? ?1(?: 0)?", "eclipse epl"),
    ("epl-2", "(?:eclipse public|epl)(?: license)?(?: version)?(?: v)? ?2(?: 0)?", "eclipse epl"),
    ("epl", "(?:eclipse public|epl)", "eclipse epl"),
    ("cddl-1.1", "(?:common development and distribution|cddl)(?: license)?(?: version)?(?: v)? ?1 1", "cddl development"),
    ("cddl-1", "(?:common development and distribution|cddl)(?: license)?(?: version)?(?: v)? ?1(?: 0)?", "cddl development"),
    ("cc0", "(?:cc0|cc 0|creative commons (?:zero|cc0))(?: 1 0)?(?: universal)?", "cc0 cc creative"),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative|ativ)?e?s?)(?: [1-4] [05])?", "cc creative"),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)(?: [1-4] [05])?", "cc creative"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by nc|attribution non ?commercial)(?: [1-4] [05])?", "cc creative"),
    ("cc-by-nd", "(?:cc|creative commons) (?:by nd|attribution no ?derivatives)(?: [1-4] [05])?", "cc creative"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by sa|attribution share ?alike)(?: [1-4] [05])?", "cc creative"),
    ("cc-by", "(?:cc|creative commons) (?:by|attribution)(?: [1-4] [05])?", "cc creative"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", "wtfpl fuck"),
    ("zlib", "zlib(?: libpng)?", "zlib"),
    ("boost-1", "boost software(?: license)?(?: version)?(?: 1 0)?", "boost"),
    ("artistic-2", "artistic(?: license)?(?: version)? 2(?: 0)?", "artistic"),
    ("artistic", "artistic", "artistic"),
    ("psf-2", "(?:python software foundation|psf)(?: license)?(?: version)?(?: 2)?", "python psf"),
    ("eupl-1.2", "(?:european union public|eupl)(?: licen[cs]e)?(?: version)?(?: v)? ?1 2", "european eupl"),
    ("ofl-1.1", "(?:sil )?open font(?: license)?(?: version)?(?: 1 1)?", "font"),
    ("ms-pl", "(?:microsoft public|ms pl)", "microsoft ms"),
    ("ms-rl", "(?:microsoft reciprocal|ms rl)", "microsoft ms"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ruby", "ruby", "ruby"),
    ("php-3", "php(?: license)?(?: version)? 3 ?0?1?", "php"),
    ("vim", "vim", "vim"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("odbl-1", "(?:open (?:data commons open )?database|odbl)(?: license)?(?: 1 0)?", "database odbl"),
)

#: What may stand around a name: pattern with NAME in it, priority (lower goes first) and confidence.
FRAMES = (
    ("spdx license identifier NAME", 0, 1.0),
    ("(?:re)?licensed (?:to you )?(?:solely )?under (?:the )?(?:terms of )?(?:the )?NAME(?: public)?(?: licen[cs]e)?", 1, 0.98),
    ("(?:released|distributed|available|provided|published|shared|offered|covered) (?:under|by|as) (?:the )?(?:terms of )?(?:the )?NAME(?: licen[cs]e)?", 2, 0.95),
    ("(?:subject to|terms of|conditions of|governed by) (?:the )?NAME(?: licen[cs]e)?", 3, 0.9),
    ("NAME (?:public )?licen[cs]e", 4, 0.8),
    ("licen[cs]e (?:is )?(?:the )?NAME", 5, 0.7),
)

#: Statements without a license name: label, pattern, keywords, priority, confidence.
PLAIN = (
    ("proprietary", "all rights reserved", "rights", 8, 0.5),
    ("proprietary", "(?:unauthorized|unauthorised) (?:copying|use|distribution)(?: of this \\w+)? is (?:strictly )?prohibited", "unauthorized unauthorised", 7, 0.7),
    ("proprietary", "proprietary and confidential", "proprietary", 7, 0.8),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain", 6, 0.9),
    ("public-domain", "is in the public domain", "domain", 7, 0.7),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby", 0, 1.0),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution", 0, 0.95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission", 0, 0.95),
    ("wtfpl", "do what the fuck you want to", "fuck", 1, 0.9),
    ("no-ai-training", "(?:may not|must not|shall not) be used (?:for|to) (?:the )?train(?:ing)?", "train training", 5, 0.8),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keywords: tuple[bytes, ...]
    priority: int
    confidence: float


def _rules() -> list[Rule]:
    """Every name in every frame, then the plain statements, by priority, then in the order given."""
    made = [
        (label, frame.replace("NAME", name), keys, priority, confidence)
        for label, name, keys in NAMES for frame, priority, confidence in FRAMES
    ]
    return [
        Rule(label, re.compile(f"(?<= )(?:{pattern})(?= )".encode()), tuple(k.encode() for k in keys.split()), priority, confidence)
        for label, pattern, keys, priority, confidence in sorted([*made, *PLAIN], key=lambda r: r[3])
    ]


RULES = _rules()
KEYWORDS = sorted({k for rule in RULES for k in rule.keywords})
#: Near one of these words a signature may stand; elsewhere none can match.
ANCHORS = (
    "license", "licence", "licensed", "relicensed", "released", "distributed", "available", "provided",
    "published", "shared", "offered", "covered", "subject", "terms", "conditions", "governed", "spdx", "rights",
    "unauthorized", "unauthorised", "proprietary", "domain", "hereby", "redistribution", "permission", "fuck",
    "train", "training",
)


def detections(words: list[bytes]) -> list[tuple[int, int, Rule]]:
    """Places ``(first word, word behind the last, rule)`` of rules in some words, overlaps settled.

    Rules go by priority, longer places first within one; a place inside one that was kept is
    dropped.
    """
    text = b" " + b" ".join(words) + b" "
    there = {k for k in KEYWORDS if b" " + k in text}
    starts = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    found = []
    for order, rule in enumerate(RULES):
        if there.isdisjoint(rule.keywords):
            continue
        for match in rule.pattern.finditer(text):
            first, last = np.searchsorted(starts, [match.start() - 1, match.end()]).tolist()
            found.append((rule.priority, first - last, order, first, last, rule))
    kept: list[tuple[int, int, Rule]] = []
    for _, _, _, first, last, rule in sorted(found, key=lambda x: x[:5]):
        if not any(a <= first and last <= b for a, b, _ in kept):
            kept.append((first, last, rule))
    return kept


class Scanner:
    """Base phrases and rules over slices of texts."""

    def __init__(self) -> None:
        self.hashes = WordHashes()
        part = Slice([" ".join([*BASE, *ANCHORS]).encode()])
        h = dict(zip(part.words(0, len(part.starts)), self.hashes(part.data, part.starts, part.ends)))
        self.phrases = [([h[w.encode()] for w in phrase.split()], phrase.encode().split(), label) for phrase, label in BASE.items()]
        self.anchors = np.sort(np.array([h[a.encode()] for a in ANCHORS], np.uint64))

    def base(self, part: Slice, h: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """First words of each phrase, and its label; hashes propose, bytes decide."""
        out = []
        for keys, words, label in self.phrases:
            at = np.flatnonzero(h[: max(len(h) - len(keys) + 1, 0)] == keys[0])
            for k, key in enumerate(keys[1:], 1):
                at = at[h[at + k] == key]
            text = np.searchsorted(part.first, at, "right") - 1
            at = at[at + len(keys) <= part.first[text + 1]]
            out.append((np.array([a for a in at.tolist() if part.words(a, a + len(keys)) == words], np.int64), label))
        return out

    def __call__(self, texts: list[bytes]) -> list[tuple]:
        part = Slice(texts)
        h = self.hashes(part.data, part.starts, part.ends)
        base = self.base(part, h)
        place = np.minimum(np.searchsorted(self.anchors, h), len(self.anchors) - 1)
        anchors = np.flatnonzero(self.anchors[place] == h)
        rows = []
        for t in range(len(texts)):
            low, high = int(part.first[t]), int(part.first[t + 1])
            own = [(at[np.searchsorted(at, low) : np.searchsorted(at, high)] - low, label) for at, label in base]
            starts = np.concatenate([at for at, _ in own])
            labels = {label for at, label in own if len(at)}
            kept = []
            near = anchors[np.searchsorted(anchors, low) : np.searchsorted(anchors, high)]
            if len(near):  # anchors whose surroundings meet are looked at together
                gaps = np.flatnonzero(np.diff(near) > 2 * REACH)
                for a, b in zip(np.append(near[0], near[gaps + 1]).tolist(), np.append(near[gaps], near[-1]).tolist()):
                    kept += detections(part.words(max(low, a - REACH), min(high, b + REACH)))
            score = max([0.0, *(rule.confidence for _, _, rule in kept), *([0.9] if labels else [])])
            rows.append((
                high - low, len(starts), int(starts.min()) if len(starts) else None, int(starts.max()) if len(starts) else None,
                ",".join(sorted(labels)), ",".join(sorted(labels | {rule.label for _, _, rule in kept})), score,
            ))
        return rows


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """Words, base phrases, labels and confidence of every row (columns as in SCHEMA).

    A-Z are lower-cased; words are runs of digits, letters and characters beyond ASCII. Null and
    empty texts have no words, no labels (empty strings) and score 0. ``score`` is the greatest
    confidence of what is kept; base phrases count 0.9. Rules look at the 40 words on either side
    of a keyword, at all keywords of a text of any length. Repeated rows and null ids stay; other
    columns are ignored; an empty table gives no rows. Texts are read in place, without a shuffle.
    """

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for start, texts in slices(batch):
            columns = zip(*scanner(texts))
            yield pa.record_batch(
                [batch.column("doc_id").slice(start, len(texts)), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    ship_package(docs.sparkSession)
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of, SCHEMA)
