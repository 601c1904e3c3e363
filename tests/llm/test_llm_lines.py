import random

import plain

from timbrelake.llm import line_dedup as ld
from timbrelake.llm.text import WordHashes

PASSAGE = " ".join(f"w{i}" for i in range(60)) + "."
SHORT = "\n".join(f"Line {i} of a passage with several words here." for i in range(14))


def result(frame):
    return {r.doc_id: r for r in ld.deduplicate_lines(frame).collect()}


def test_repeated_passages_go_wherever_they_stand(spark):
    texts = [
        f"First one.\n{PASSAGE}\nEnd of it.", f"Something else before. And more.\n{PASSAGE}", f"{PASSAGE}\nOther end. Yes.",
        f"Alpha.\nBeta gamma.\n{SHORT}\nOmega.", f"Delta.\n{SHORT}\nPsi. Chi.", "A clean document.\nWith two lines.",
    ]
    got = result(plain.documents(spark, texts, list(range(6))))
    assert got[0].text == texts[0] and got[3].text == texts[3] and got[5].text == texts[5]
    assert got[1].text == "Something else before. And more.\n" and got[2].text == "Other end. Yes."
    assert SHORT not in got[4].text and got[4].removed_words >= 80 and got[4].text.startswith("Delta.")
    assert [got[i].removed_chunks > 0 for i in range(6)] == [False, True, True, False, True, False]


def test_copies_become_empty_and_the_first_stays(spark, pdocs, docs):
    got = result(docs)
    first = {}
    for d, t in sorted(zip(pdocs.doc_id, pdocs.text)):
        assert got[d].removed_words <= len(t.split())
        if t in first and len(t.split()) >= 60:
            assert len(got[d].text.split()) < 25
        first.setdefault(t, d)
    assert len(got) == len(pdocs) and got[0].text == pdocs.set_index("doc_id").text[0]


def test_chunks_are_the_text():
    hashes = WordHashes()
    texts = [(t or "").encode() for t in plain.TEXTS]
    c = ld.Chunks(texts, hashes)
    for t, text in enumerate(texts):
        import numpy as np

        n = c.first[t + 1] - c.first[t]
        assert c.without(t, np.zeros(n, bool)) == text
        words = sum(c.words[c.first[t] : c.first[t + 1]])
        assert words == len(text.split())
        one = ld.Chunks([text], hashes)
        assert one.keys.tolist() == c.keys[c.first[t] : c.first[t + 1]].tolist()


def test_edge_cases(spark):
    frame = plain.documents(spark).withColumnRenamed("score", "removed_words")
    out = ld.deduplicate_lines(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "removed_chunks", "removed_words"]
    texts = [r.text for r in out.collect()]
    assert sorted(map(str, texts)) == sorted(map(str, plain.TEXTS))  # repeats of fewer than 25 words stay
    assert ld.deduplicate_lines(frame.limit(0)).count() == 0


def test_a_repeated_paragraph_alone(spark):
    text = f"{PASSAGE}\n"
    frame = plain.documents(spark, [text, text, text + text], [1, 2, 3])
    assert {d: r.text for d, r in result(frame).items()} == {1: text, 2: "", 3: ""}


def test_whole_passages_go_between_any_neighbours(spark):
    pick, texts, passages = random.Random(2), [], []

    def line(tag, n):
        return " ".join(f"{tag}{pick.randrange(10**6)}" for _ in range(n)) + "."

    for k in range(90):
        n, size = [(3, 20), (4, 15), (5, 13), (2, 26), (9, 6), (17, 5)][k % 6]
        passages.append(pick.choice([" ", "\n"]).join(line(f"p{k}x", size) for _ in range(n)))
        for side in "ab":
            around = [" ".join(line(f"{side}{k}x", pick.randint(3, 25)) for _ in range(3)) for _ in range(2)]
            texts.append(f"{around[0]}\n{passages[-1]}\n{around[1]}")
    got = result(plain.documents(spark, texts, list(range(len(texts)))))
    for k, passage in enumerate(passages):
        assert got[2 * k].text == texts[2 * k]
        assert got[2 * k + 1].text == texts[2 * k + 1].replace(passage + "\n", "")


def test_what_overlaps_its_first_place_stays(spark):
    line = " ".join(f"w{i}" for i in range(15)) + "."
    texts = ["\n".join([line] * n) for n in (4, 8)]
    assert result(plain.documents(spark, texts[:1], [0]))[0].text == texts[0]
    assert result(plain.documents(spark, texts[1:], [0]))[0].text == texts[0] + "\n"
