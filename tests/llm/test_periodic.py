"""Runs of periodic words against brute force, whatever the parts in which words arrive."""

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from marketloom.llm import periodic
from marketloom.llm.queries import QUERIES
from tests.llm.brute import sha, words_of


def all_runs(words, exponent=3, least=24):
    """Longest stretches of every period; of equal ones the smallest period."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        x = p
        while x < n:
            if words[x] != words[x - p]:
                x += 1
                continue
            s = x
            while x < n and words[x] == words[x - p]:
                x += 1
            if x - s + p >= max(least, exponent * p):
                found.setdefault((s - p, x), p)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def online(words, exponent, least, part):
    finder = periodic.RunFinder(exponent, least)
    for i in range(0, len(words), part):
        finder.append(np.array(words[i:i + part], np.int32))
    return finder.close()


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def texts(draw):
    block = [draw.randrange(60) for _ in range(draw.randrange(1, 120))]
    noise = [draw.randrange(2) for _ in range(draw.randrange(40))]
    steps = [0] * draw.randrange(1, 40) + [1] * draw.randrange(1, 40)
    nested = ([0] * draw.randrange(1, 9) + [1]) * draw.randrange(1, 6) + [0, 1, 1] * draw.randrange(1, 6)
    yield [draw.randrange(draw.randrange(1, 4)) for _ in range(draw.randrange(250))]
    yield noise + block * draw.randrange(2, 7) + noise
    yield steps * draw.randrange(1, 9) + [0] * draw.randrange(60)
    yield nested * draw.randrange(1, 7)
    yield fibonacci(draw.randrange(300)) + noise
    yield [bin(i).count("1") % 2 for i in range(draw.randrange(400))] + noise


@pytest.mark.parametrize("seed", range(60))
def test_equals_brute_force(seed):
    draw = random.Random(seed)
    for words in texts(draw):
        exponent, least = draw.choice([3, 3, 4]), draw.choice([1, 3, 8, 24, 40])
        want = all_runs(words, exponent, least)
        for part in (5, 64, 10_000):
            assert online(words, exponent, least, part) == want, (words, exponent, least, part)


def test_long_degenerate_texts_stay_cheap():
    assert online([0] * 60_000, 3, 24, 4096) == [(0, 60_000, 1)]
    got = online(([0] * 100 + [1] * 77) * 300, 3, 24, 4096)
    assert got[:2] == [(0, 100, 1), (0, 177 * 300, 177)] and len(got) == 601


def test_refuses_squares():
    with pytest.raises(ValueError):
        periodic.RunFinder(2)


def test_pieces_cut_at_white_space():
    text = ("ab cde\t" * 50 + "x" * 100 + "\n" * 40 + "é").encode()
    for size in (1, 7, 64, 10_000):
        assert [w for part in periodic._pieces(text, size) for w in part] == text.split()


def expected(doc_id, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found, gone = all_runs(words), set()
    for start, length, period in found:
        gone.update(range(start + period, start + length))
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert got.keys() == texts.keys() and sum(r[1] > 0 for r in got.values()) > 50
    for doc_id, text in texts.items():
        if len(text or "") < 2500:  # brute force is quadratic
            assert got[doc_id] == expected(doc_id, text)


def test_odd_rows(spark):
    long = "a b " * 40_000
    rows = [(None, "x " * 30), (1, None), (1, None), (2, ""), (3, " \t\n"), (4, "  " * 24), (5, long), (6, "A a " * 12)]
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, runs int, `Text ` string")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.runs(docs).collect()))
    assert got == [(0, 30, [(0, 30, 1)], "x"), (1, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""),
                   (4, 24, [(0, 24, 1)], " "), (5, 80_000, [(0, 80_000, 2)], "a b"), (6, 24, [(0, 24, 2)], "A a")]
    assert periodic.runs(docs.limit(0)).count() == 0
