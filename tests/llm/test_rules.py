"""Quality rules: counts by brute force, bounds by exact fractions, the promise by simulation."""

import random
from fractions import Fraction
from math import comb

import duckdb
import pytest

from marketloom.llm import rules
from marketloom.llm.queries import QUERIES, SQL
from tests.llm import brute
from tools import compare


def test_query_counts_every_text(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op10_quality_rules"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        want = brute.base_rules(docs[r.doc_id])
        assert tuple(r)[1:6] == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("seed", range(3))
def test_counts_of_odd_texts(seed):
    draw = random.Random(seed)
    for _ in range(400):
        text = "".join(draw.choice(["a", "b", "é", " ", "\n", "\t", "#", "|", "\x85", " ", "AB "]) for _ in range(draw.randint(0, 60)))
        assert rules.count(text.encode())[:5] == brute.base_rules(text), repr(text)


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 0, 0.1), (50, 3, 0.05), (400, 1, 0.004), (30, 30, 0.5)]:
        q = Fraction(p)
        want = sum(comb(n, i) * q**i * (1 - q)**(n - i) for i in range(k + 1))
        assert rules.binomial_tail(k, n, p) == pytest.approx(float(want), rel=1e-9)
    assert rules.safe_steps([0, 0, 1, 0], 1000, 0.005, 0.01) == 2  # stops at the first unsafe step
    assert rules.safe_steps([0], 100, 0.005, 0.01) == 0


def test_promise_holds():
    """Ladders whose steps reject exactly at or above the limit are taken too far at most as often as allowed."""
    draw, limit, level, wrong = random.Random(5), 0.02, 0.1, 0
    for _ in range(400):
        seen = sum(draw.random() < limit * 1.0001 for _ in range(800))
        wrong += rules.safe_steps([0, seen], 800, limit, level) == 2
    assert wrong <= 400 * level * 1.5


def texts(n, junk):
    word = iter(range(10**9))
    good = lambda: " ".join(f"w{next(word)}" for _ in range(60))
    return [(i, good() if i % 5 else " ".join(f"w{next(word)}{junk}" for _ in range(60)), "en", int(i % 5 > 0)) for i in range(n)]


def test_cutoffs_follow_labels(spark):
    rows = texts(4000, "###")
    # in the second language symbols are usual in good documents, in the third there are few labels
    rows += [(i + 10_000, t, "de", 1) for i, t, _, _ in texts(3000, "###")]
    rows += [(i + 20_000, t, None, q) for i, t, _, q in texts(100, "###")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    kept = {r.doc_id: r.kept for r in rules.judge(docs.drop("quality"), docs.select("doc_id", "quality")).collect()}
    assert all(kept[i] == bool(q) for i, _, lang, q in rows if lang == "en")
    assert all(kept[i] for i, _, lang, _ in rows if lang != "en")


def test_query_equals_sql(spark, sf_dir):
    assert compare.mismatch(QUERIES["op10_quality_rules"](spark, sf_dir), compare.duck(sf_dir), SQL["op10_quality_rules"]) is None


def test_chosen_cutoffs_equal_sql(spark):
    rows = texts(3000, "###") + [(i + 10_000, t, "de", 1) for i, t, _, _ in texts(2500, "|")]
    rows += [(i + 20_000, t.upper() if i % 4 else t, "fr", int(i % 4 == 0)) for i, t, _, _ in texts(5000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    con = duckdb.connect()
    con.register("given", docs.toArrow())
    con.execute("CREATE VIEW documents AS SELECT doc_id, text, lang FROM given; CREATE VIEW labels AS SELECT doc_id, quality FROM given")
    got = rules.judge(docs.drop("quality"), docs.select("doc_id", "quality")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert compare.mismatch(got, con, rules.judge_sql()) is None
    assert 0 < got.where("not kept and not base_failed").count() < len(rows) / 2


def test_small_cases(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(None, long, "en"), (1, None, None), (2, "", "en"), (2, "", "en"), (3, "x " * 200_000, "en"), (4, long, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(4, None), (None, 1), (4, 1), (4, 0)], "doc_id long, quality int")
    for table in (labels, labels.limit(0)):
        got = sorted([(r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in rules.judge(docs, table).collect()])
        assert got == [(0, 60, False, True), (1, 0, True, False), (2, 0, True, False), (2, 0, True, False),
                       (3, 200_000, True, False), (4, 60, False, True)]
    assert rules.judge(docs.limit(0), labels).count() == 0


def test_extra_columns_stay(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, long, "en", 7, True), (2, "x", "en", 8, None)],
                                 "doc_id long, text string, lang string, n_words int, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int, n_words int")
    done = rules.accepted(docs, labels)
    assert done.columns == docs.columns and [tuple(r) for r in done.collect()] == [(1, long, "en", 7, True)]
