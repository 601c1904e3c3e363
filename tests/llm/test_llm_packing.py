import zlib

import numpy as np
import plain
import public_tokenizers
import pytest

from timbrelake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, frame, ids, length):
    want = []
    for r in frame.select("doc_id", "text").collect():
        own = ids(r.text)
        for p, at in enumerate(range(0, len(own), length)):
            part = np.array(own[at : at + length], "<u4")
            want.append((str(r.doc_id), p, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    places = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == places.get(r.sequence_id, 0)
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values(), default=0) <= length
    return len(places), sum(places.values())


def test_whole_table(spark, docs, ids):
    sequences, tokens = check(packing.pack_documents(docs, PATH).collect(), docs, ids, 2048)
    assert sequences <= 1.01 * tokens / 2048 + 1


@pytest.mark.parametrize("length", [1, 7, 2048])
def test_edge_cases(spark, ids, length):
    few = plain.documents(spark, [t for t in plain.TEXTS if len(t or "") < 1000] + ["w. " * 900])
    check(packing.pack_documents(few, PATH, length).collect(), few, ids, length)
    assert packing.pack_documents(few.limit(0), PATH, length).count() == 0


def test_long_words_and_a_full_memory(ids):
    tokens = packing.WordTokens(PATH, remembered=8)
    for texts in ([t or "" for t in plain.TEXTS if len(t or "") < 60_000][:9], ["a b c", "c d e f g h i j k", "a"], ["", ""]):
        got, ends = tokens([t.encode() for t in texts])
        assert got.tolist() == [x for t in texts for x in ids(t)]
        assert ends.tolist() == np.cumsum([len(ids(t)) for t in texts]).tolist()


def test_best_fit_bounds_open_bins():
    bins = packing.BestFit(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 8, 4, 2)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (2, 8)]
    assert [bins.put(n) for n in (5, 6, 7, 3)] == [(3, 0), (4, 0), (5, 0), (4, 6)]  # the bin of 7 closed


def test_many_packers_stay_valid(spark):
    table = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "1 + id * 37 % 2048 AS length")
    rows = packing.pack(table, 2048, open_bins=4, sequences=300).collect()
    total = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == total.get(r.sequence_id, 0)
        total[r.sequence_id] = r.offset + r.length
    assert max(total.values()) <= 2048 and len(rows) == 5000


def test_pieces_hold_their_ids(spark, docs, ids):
    rows = packing.pieces(docs.limit(20), PATH).orderBy("doc_id", "piece").collect()
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
