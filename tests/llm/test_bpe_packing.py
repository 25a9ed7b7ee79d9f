"""Ids against the tokenizers library, on odd texts and whole tables; packing against its own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from marketloom.llm import bpe, packing
from marketloom.llm.queries import QUERIES, vocabulary
from tests.llm.brute import sha

PATH = vocabulary()
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["a<|endoftext|>b <|startoftext|> <|endoftext|", "ΑΣΣΑΣ ΟΔΟΣ", "é x", "İstanbul ǅ ﬁ", "\x1c a\x1db", "don't it'll's 'S",
       "日本語 123 ½", "﻿a", "a b\u0085c", "x" * 5000, "́a ́", "´ ¨a", "ſt K Å", "", " \n", "###", "a###b!?", "_a_ b_"]


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def by(encoder, text):
    return np.frombuffer(encoder.encode(text.encode()), "<i4").tolist()


@pytest.mark.parametrize("encoder", [bpe.load(PATH), packing.library_ids(PATH)])
def test_same_ids_as_the_library(encoder, monkeypatch):
    monkeypatch.setattr(encoder, "remembered", 50)  # so that words are forgotten, too
    draw = random.Random(3)
    marks = [32, 9, 0x41, 0x301, 0xE9, 0x27, 0x73, 0x130, 0x3A3, 0x2028, 0xA0, 0x200B, 0x1F600, 60, 124, 101, 0x345, 0x212B, 0x1E9E]
    texts = ODD + ["".join(chr(draw.choice(marks)) for _ in range(30)) for _ in range(1500)]
    texts += [f"a{chr(c)}b {chr(c)}" for c in range(0x21, 0x3000) if not 0xD800 <= c < 0xE000]
    for text in texts:
        assert by(encoder, text) == ids(text), repr(text)


def test_decoding_equals_the_library():
    own = bpe.load(PATH)
    lists = [ids(t) for t in ODD] + [[49407, 5, 60_000, -1, 7], []]
    offsets = np.cumsum([0, *map(len, lists)])
    got = own.decode(np.array([i for x in lists for i in x], np.int64), offsets).to_pylist()
    want = [LIBRARY.decode([i for i in x if 0 <= i < 49408], skip_special_tokens=False) for x in lists]
    assert got == want


def test_encode_query_on_a_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_bpe_encode_decode"](spark, sf_dir).collect()}
    want = {}
    for d, text in docs.items():
        i = ids(text)
        want[d] = (len(i), sha(" ".join(map(str, i))), sha(LIBRARY.decode(i, skip_special_tokens=False)))
    assert got == want


def test_small_cases(spark):
    docs = spark.createDataFrame([(None, "a b", 1), (1, None, 2), (2, "", 3), (2, "", 4), (3, "word " * 100_000, 5)],
                                 "doc_id long, text string, ids int")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, len(r.ids)) for r in got) == [(0, 2), (1, 0), (2, 0), (2, 0), (3, 100_000)]
    assert {r.doc_id: r.decoded for r in got if r.doc_id != 3} == {None: "a</w> b</w>", 1: "", 2: ""}
    none = bpe.decode(spark.createDataFrame([(1, None), (2, [7, None])], "doc_id long, ids array<int>"), PATH)
    assert [r.decoded for r in none.orderBy("doc_id").collect()] == ["", LIBRARY.decode([7])]
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def check_packing(rows, length):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(places)


def test_packing_query_on_a_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op7_best_fit_packing"](spark, sf_dir).collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = []
    for d, text in docs.items():
        i = [*ids(text), 0]
        want += [(d, k, k * 2048, len(i[k * 2048:(k + 1) * 2048]), zlib.crc32(np.array(i[k * 2048:(k + 1) * 2048], "<u4").tobytes()))
                 for k in range(-(-len(i) // 2048))]
    assert got == sorted(want)
    used = check_packing(rows, 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.03 + 3


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (4, 3, 6, 7)] == [(0, 0), (0, 4), (1, 0), (2, 0)]
    assert bins.put(3) == (0, 7)  # of the two that were left with a space of 3, one has closed as the fullest
    assert bins.put(4) == (1, 6) and bins.bits == 0
    draw, bins, left = random.Random(1), packing.OpenBins(100, 10_000), {}
    for _ in range(5000):
        n = draw.randint(1, 100)
        fits = [f for f in left.values() if f >= n]
        b, at = bins.put(n)
        assert left.get(b, 100) == (min(fits) if fits else 100) == 100 - at
        left[b] = 100 - at - n


def test_packing_small_cases(spark):
    docs = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (5, "word " * 30, "x"), (5, "word " * 30, "x")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, offset string")
    cut = packing.pieces(docs, PATH, length=16)
    rows = packing.pack(cut, length=16, per_task=3).collect()
    assert sorted(r.length for r in rows) == [1, 1, 1, 15, 15, 16, 16] and check_packing(rows, 16) <= 5
    whole = packing.sequences(packing.pack(cut, length=16)).collect()
    assert sorted(x for r in whole for x in r.ids) == sorted(3 * [0] + 2 * (30 * ids("word") + [0]))
    assert packing.pack(packing.pieces(docs.limit(0), PATH)).count() == 0
