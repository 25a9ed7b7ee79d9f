"""The classifier: counts and posteriors by hand, and accuracy on labels it never sees."""

import itertools
import random

import numpy as np

from marketloom.llm import classifier
from marketloom.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    """Hand labels are not used in training, so all of them are held out."""
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r.doc_id: r.kept for r in QUERIES["op2_quality_classifier"](spark, folder).collect()}
    assert len(got) == 1000
    good = [got[d] for d, q in labels.items() if q == 1]
    junk = [not got[d] for d, q in labels.items() if q == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) >= 0.95 * len(junk)


def test_estimate_finds_planted_accuracies():
    draw, m = random.Random(2), len(classifier.HEURISTICS)
    right = [0.95 - 0.03 * k for k in range(m)]
    counts = {}
    for _ in range(30_000):
        good = draw.random() < 0.8
        votes = [classifier.NOTHING if draw.random() < 0.2 else classifier.GOOD if (draw.random() < p) == good else classifier.JUNK
                 for p in right]
        pattern = sum(v * 3**k for k, v in enumerate(votes))
        counts[pattern] = counts.get(pattern, 0) + 1
    found = classifier.estimate(counts)
    assert abs(found.good - 0.8) < 0.02
    for p, (on_good, on_junk) in zip(right, found.accuracies().values()):
        assert abs(on_good - p) < 0.02 and abs(on_junk - p) < 0.04


def test_votes_and_shapes():
    assert classifier.shapes("Das WAR é1234, ok?! \t x###y".encode()) == [b"Aa", b"A", b"a0,", b"a?!", b"a###a"]
    bounds = list(classifier.HEURISTICS.values())
    values = tuple(good if k % 3 == 0 else junk if k % 3 == 1 else (good + junk) / 2 for k, (good, junk) in enumerate(bounds))
    pattern = classifier.votes(values)
    assert [pattern // 3**k % 3 for k in range(len(bounds))] == list(itertools.islice(itertools.cycle([1, 2, 0]), len(bounds)))


def test_training_separates():
    rows = [(float(i % 2), [i % 2, 7], [1.0, 0.5]) for i in range(50)]
    w = classifier.train(rows)
    assert w[1] - w[0] > 2 and np.array_equal(w, classifier.train(rows))
    assert np.isfinite(classifier.train([])).all()


def test_small_cases(spark):
    prose = "The quick brown fox jumps over the lazy dog and then it rests, as dogs do, near old trees by the river. It sleeps."
    rows = [(None, prose, 1.0), (1, None, 2.0), (2, "", 3.0), (2, "", 3.0), (3, "x### y%%% | $$$ " * 60_000, 4.0), (4, prose, None)]
    rows += [(i, prose + f" Word{i} went home.", 0.5) for i in range(5, 30)]
    rows += [(i, f"a{i}### b&&& | c$$$ $$$ ||| " * 10, 0.5) for i in range(30, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = classifier.classify(docs).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[None] and kept[4] and kept[5] and not kept[3] and not kept[35]
    stay = classifier.accepted(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in stay.collect()) == sorted(d or 0 for d, _, _ in rows if kept[d])
    assert classifier.classify(docs.limit(0)).count() == 0
    few = classifier.fit(docs, fit_rows=5)  # the bound holds, and all rows are still scored
    assert few.labellers.good == classifier.fit(docs).labellers.good
