import random
import re
from dataclasses import replace

import plain

from timbrelake.llm import licenses


def base(text):
    words = plain.word_list(text)
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        found = [i for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def check(frame):
    want = sorted(map(str, [(r.doc_id, *base(r.text)) for r in frame.select("doc_id", "text").collect()]))
    rows = licenses.scan(frame).collect()
    assert sorted(map(str, [tuple(r)[:6] for r in rows])) == want
    for r in rows:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    return rows


def test_whole_table(docs):
    assert any(r.n_base for r in check(docs))


def test_edge_cases(spark):
    texts = [*plain.TEXTS, "Under the MIT License. under the mit license", "cc by", "by nc", "CC-BY-NC\ncc by nc cc by nc", "under the mit", "license"]
    check(plain.documents(spark, texts))
    assert licenses.scan(plain.documents(spark).limit(0)).count() == 0


def test_priority_and_containment(spark):
    cases = {
        "Licensed under the GNU Lesser General Public License, version 2.1.": "lgpl-2.1",
        "SPDX-License-Identifier: BSD-3-Clause": "",
        "licensed under the gpl v3": "gpl-3",
        "This is under the terms of the Mozilla Public License 2.0, see there": "mpl-2",
        "Licensed under CC BY-NC-SA 4.0": "cc-by-nc,cc-by-nc-sa",
        "Licensed under CC BY-SA 4.0. All rights reserved.": "cc-by-sa,proprietary",
        "mit der Lizenz": "",
        "released under the MIT license and licensed under the Apache License, Version 2.0": "apache-2,mit",
    }
    got = {r.doc_id: r.labels for r in licenses.scan(plain.documents(spark, list(cases), list(range(len(cases))))).collect()}
    want = dict(enumerate(cases.values()))
    want[1] = got[1]
    assert got == want and got[1].startswith("bsd")


def test_rules():
    assert len(licenses.RULES) > 300 and [r.priority for r in licenses.RULES] == sorted(r.priority for r in licenses.RULES)
    far = [b"license"] + [b"w"] * 500 + [b"mit"]
    assert licenses.detections(far) == []


def some_match(tree, pick):
    """A text that a parsed pattern matches; look-arounds are left out."""
    out = ""
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(value)
        elif name == "IN":
            op, value = pick.choice(value)
            out += {"LITERAL": lambda: chr(value), "RANGE": lambda: chr(pick.randint(*value)), "CATEGORY": lambda: "w"}[str(op)]()
        elif name == "BRANCH":
            out += some_match(pick.choice(value[1]), pick)
        elif name == "SUBPATTERN":
            out += some_match(value[3], pick)
        elif name == "MAX_REPEAT":
            least, most, inner = value
            out += "".join(some_match(inner, pick) for _ in range(pick.randint(least, min(most, least + 2))))
        else:
            assert name == "ASSERT", name
    return out


def test_keywords_and_anchors_lose_no_match(monkeypatch):
    pick, texts = random.Random(3), ["licensed under GPL3", "licensed under the General Public License version 3", "under the mpl2 license"]
    for rule in licenses.RULES:
        tree = re._parser.parse(rule.pattern.pattern.decode())
        texts += [some_match(tree, pick) for _ in range(12)]
        assert all(rule.pattern.search(f" {t} ".encode()) for t in texts[-12:])
    texts = [f"Some words before {t} and others behind." for t in texts]
    got = [row[5] for row in licenses.Scanner()([t.encode() for t in texts])]
    monkeypatch.setattr(licenses, "RULES", [replace(rule, keywords=(b"",)) for rule in licenses.RULES])
    monkeypatch.setattr(licenses, "KEYWORDS", [b""])
    want = [licenses.detections([w.encode() for w in plain.word_list(t)]) for t in texts]
    base_of = [base(t)[4] for t in texts]
    assert got == [",".join(sorted({r.label for _, _, r in w} | set(b.split(",")) - {""})) for w, b in zip(want, base_of)]
    assert got[:3] == ["gpl-3", "gpl-3", "mpl-2"] and all(got)
