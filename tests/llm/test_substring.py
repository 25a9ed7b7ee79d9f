"""Substring dedup against every window written out."""

import random

import pytest

from marketloom.llm import substring
from marketloom.llm.queries import QUERIES, SQL
from tests.llm import brute
from tools import compare

LONG = "doc_id long, text string"


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def result(spark, docs, **how):
    from pyspark.sql import functions as F

    df = substring.repeats(spark.createDataFrame(docs, LONG), **how)
    return got(df.select("doc_id", "n_words", "n_removed", F.sha2("clean_text", 256)))


def test_query_on_a_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op8_substring_dedup"](spark, sf_dir)) == sorted(brute.substring(docs), key=str)


def test_query_equals_sql(spark, sf_dir):
    assert compare.mismatch(QUERIES["op8_substring_dedup"](spark, sf_dir), compare.duck(sf_dir), SQL["op8_substring_dedup"]) is None


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    """Few different words, copied and shifted passages, periodic texts, repeated ids, NULLs."""
    draw = random.Random(seed)
    phrases = [[draw.choice("ab cd efg hi".split()) for _ in range(draw.randint(10, 160))] for _ in range(6)]
    docs = [(None, " ".join(phrases[0])), (3, None), (4, ""), (5, " \t\n ")]
    for i in range(60):
        parts = [p[draw.randint(0, 5):] for p in draw.choices(phrases, k=draw.randint(1, 4))]
        parts += [[draw.choice("xyz")] * draw.randint(0, 120)]
        draw.shuffle(parts)
        docs.append((draw.randint(0, 45), draw.choice([" ", "\n", " \t"]).join(w for p in parts for w in p)))
    assert result(spark, docs) == sorted(brute.substring(docs), key=str)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 50, 72, 130, 200])
def test_windows_of_any_size(spark, n):
    """Long shared stretches, stretches a word too short, and texts of few different words."""
    draw = random.Random(n)
    shared = [[f"w{draw.randrange(4000)}" for _ in range(k)] for k in (n, n + 1, 2 * n + 3, max(1, n - 1), 500)]
    docs = []
    for i in range(30):
        parts = draw.sample(shared, 2) + [[f"own{i}x{j}" for j in range(draw.randrange(2 * n))], [draw.choice("ab")] * draw.randrange(n + 20)]
        draw.shuffle(parts)
        docs.append((draw.randrange(25), " ".join(w for p in parts for w in p)))
    assert result(spark, docs, n=n) == sorted(brute.substring(docs, n), key=str)


def test_windows_need_a_word(spark):
    with pytest.raises(ValueError):
        result(spark, [(1, "a")], n=0)


def test_small_cases(spark):
    passage = " ".join(f"w{i}é" for i in range(50))
    docs = [(2, f"x {passage} y"), (1, passage), (3, passage[:-3]), (1, passage), (7, f"A\x85b {passage}")]
    assert result(spark, docs) == sorted(brute.substring(docs), key=str)
    assert result(spark, []) == []
    spans = {r.doc_id: r.removed for r in substring.repeats(spark.createDataFrame(docs, LONG)).collect()}
    assert [tuple(s) for s in spans[2]] == [(1, 51)] and spans[3] == []


def test_very_long_text(spark):
    words = [f"w{i % 977}" for i in range(60_000)]
    docs = [(1, " ".join(words[500:900])), (2, " ".join(words)), (3, "q " * 30_000), (4, "q " * 20_000)]
    assert result(spark, docs) == sorted(brute.substring(docs), key=str)


def test_extra_columns_stay(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage, "a", 1), (2, f"a\nb {passage}", "b", 2), (3, "keep\n  this", None, 3)],
                                 "doc_id long, text string, clean string, provider long").toDF("doc_id", "text", "TEXT", "provider")
    done = substring.without_repeats(docs)
    assert done.columns == docs.columns
    assert got(done) == [(1, passage, "a", 1), (2, "a b", "b", 2), (3, "keep\n  this", None, 3)]


def test_bitmap_lets_all_wanted_rows_pass(spark):
    rows, ids = spark.range(20_000).withColumnRenamed("id", "doc_id"), spark.range(0, 20_000, 37).withColumnRenamed("id", "doc_id")
    passed = substring.likely(rows, "doc_id", ids)
    assert passed.columns == ["doc_id"] and ids.join(passed, "doc_id", "left_anti").count() == 0
    assert passed.count() < 1.05 * ids.count()
    assert substring.likely(rows, "doc_id", ids.limit(0)).count() == 0
