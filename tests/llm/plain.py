"""Plain versions of the operators, one row after the other, and the small tables that tests share."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

#: Null, empty, blank, one word, repeated rows, ties, a long text, text beyond ASCII.
TEXTS = [
    None, "", "  \n\t ", "word", "Word", "one two three", "one two three four five six seven eight",
    "one two three four five six seven eight", "Ä ö ü ß 😀 é. Ein Satz! Noch einer? Ja.\n\nNeue Zeile.",
    "lorem ipsum dolor sit amet " * 3000, "x" * 50_000, "a\x1cb c d.", "é́. it's 'tis. 12,5!", "é. x",
]


def documents(spark, texts=TEXTS, ids=None):
    """A table with columns of documents, one that clashes with results, and a null id."""
    ids = ids or [None if i == 3 else 7 if i in (6, 7) else i for i in range(len(texts))]
    rows = [(d, t, "en", "src0", len(t or ""), "old") for d, t in zip(ids, texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    return spark.createDataFrame(rows, schema).coalesce(1)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values, linked):
    """Root index of each value under pairwise links."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def shingles(words):
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def leaks(docs, items):
    """(doc row, item row) pairs: some item-sized window is similar to the item."""
    out = set()
    for d, text in enumerate(docs):
        words = word_list(text)
        for k, item in enumerate(items):
            own = word_list(item)
            n = min(len(own), len(words))
            if n:
                for i in range(len(words) - n + 1):
                    a, b = shingles(words[i : i + n]), shingles(own)
                    shared = sum((a & b).values())
                    if shared / (sum(a.values()) + sum(b.values()) - shared) >= 0.8:
                        out.add((d, k))
    return out


def personal(text):
    """Counts of the four base kinds and their spans as text."""
    t, out = text or "", {}

    def luhn(m):
        d = [int(c) for c in m if c.isdigit()]
        twice = [x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))]
        return 13 <= len(d) <= 19 and sum(twice) % 10 == 0

    out["email"] = list(re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t))
    out["ip"] = [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    out["card"] = [m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if luhn(m.group())]
    out["phone"] = [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    listed = ",".join(f"{k}:{m.start()}:{m.end()}" for k in ("email", "ip", "card", "phone") for m in out[k])
    return [len(out[k]) for k in ("email", "ip", "card", "phone")], listed, hashlib.sha256(listed.encode()).hexdigest()
