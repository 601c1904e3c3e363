import hashlib
import json
from collections import Counter, defaultdict

import plain
import public_tokenizers
import pytest

from timbrelake.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = (*alignment.MEASURES, "groups_sha256")


@pytest.fixture(scope="module")
def groups():
    """Groups of a text as lists of ids of both tokenizers, by the libraries alone."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(FILES[0])
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=FILES[1])
    letters = json.load(open(FILES[0]))["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    name = {i: t for t, i in letters.items()}

    def of(text):
        if not text:
            return []
        a = [(i, bytes(byte[c] for c in name[i])) for i in one.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in two.encode(text):
            p = two.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return []
        ends = [set(), set()]
        for k, side in enumerate((a, b)):
            at = 0
            for _, x in side:
                at += len(x)
                ends[k].add(at)
        cuts, out = sorted(ends[0] & ends[1]), []
        places = [0, 0]
        offsets = [0, 0]
        for cut in cuts:
            group = []
            for k, side in enumerate((a, b)):
                own = []
                while offsets[k] < cut:
                    own.append(side[places[k]][0])
                    offsets[k] += len(side[places[k]][1])
                    places[k] += 1
                group.append(own)
            out.append(group)
        return out

    return of


def brute(texts, groups):
    made = {t: groups(t) for t in set(texts)}
    links = {t: Counter((a, b) for g in gs for a in g[0] for b in g[1]) for t, gs in made.items()}
    count = Counter(p for t in texts for p in links[t])
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for t in texts:
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in made[t])
        out.append((
            sum(len(g[0]) for g in made[t]), sum(len(g[1]) for g in made[t]), len(made[t]), sum(links[t].values()),
            sum(n for p, n in links[t].items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links[t].items()),
            hashlib.sha256(shown.encode()).hexdigest() if shown else "",
        ))
    return out


def check(frame, groups):
    docs = frame.select("doc_id", "text").collect()
    want = sorted(str((d.doc_id, *m)) for d, m in zip(docs, brute([d.text for d in docs], groups)))
    got = alignment.align(frame, *FILES)
    assert got.columns == [c for c in frame.columns if c not in FIELDS] + list(FIELDS)
    assert sorted(str((r.doc_id, *(r[f] for f in FIELDS))) for r in got.collect()) == want


def test_whole_table(docs, groups):
    check(docs, groups)


ODD = [
    "<|endoftext|> <s> </s> <unk> x", "a▁b", "   ", "\n\n x  y ", "日本語 テキスト 😀👍🏽 ñandú œuvre", " x y\u0000z", "x" * 5000,
    "it's 12,5 — “quoted” 'S", " lead", "tail ", "ȩ́", "؀\U0001f9ff�",
]


def test_edge_cases(spark, groups):
    texts = [*plain.TEXTS, *ODD, *["the same text"] * 40, None]
    frame = plain.documents(spark, texts).withColumnRenamed("score", "n_a").repartition(3)
    for c in ("key", "n", "salt", "hot", "block", "c1"):
        frame = frame.withColumn(c, frame.lang)
    check(frame, groups)
    assert alignment.align(frame.limit(0), *FILES).count() == 0


def test_many_blocks_and_wide_groups(spark, docs, groups, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    monkeypatch.setattr(alignment, "WIDE", 0)
    few = docs.where("doc_id < 20").unionByName(docs.where("doc_id < 5"))
    texts = [r.text for r in few.collect()]
    align = alignment.Aligner(*FILES)
    _, shown, text, link, times = align([t.encode() for t in texts])
    links = [Counter((a, b) for g in groups(t) for a in g[0] for b in g[1]) for t in texts]
    found = [Counter() for _ in texts]
    for i, pair, n in zip(text.tolist(), link.tolist(), times.tolist()):
        found[i][pair >> alignment.B_BITS, pair & (1 << alignment.B_BITS) - 1] += n
    assert found == links and shown[0] == ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups(texts[0]))
    check(few, groups)


def test_fast_merger_agrees_where_it_is_used():
    tokens = alignment.ByteTokens(FILES[0])
    for c in map(chr, range(1, 0x240)):
        for text in (f"a{c}1{c} {c}{c} b", f"{c}a {c}", f"'{c}s{c}", f"{c}{c}\n {c}"):
            assert max(text.encode()) < alignment.PLAIN
            assert tokens.fast.encode_ordinary(" " + text) == tokens.slow.encode(" " + text, add_special_tokens=False).ids
