"""Operator 2: a quality classifier without hand labels.

Nine overlapping heuristics each call a text good, junk, or say nothing. Expectation-maximisation
over the counts of their vote patterns estimates how often each is right in each class, and so a
posterior for each pattern. The posteriors of a bounded sample train a linear scorer on hashed word
shapes, which then scores every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import numbered, pick, place, raw, steps
from marketloom.session import stored

#: Bound of the sample that trains the scorer: the rows with the least hashes. All rows are voted on,
#: counted in the expectation-maximisation, and scored.
FIT_ROWS = 8192
#: Weights of the scorer.
SLOTS = 2048
#: Texts that score less are rejected.
KEEP = 0.5

#: Heuristics: a measure up to the first bound votes good, from the second on junk, and between them
#: nothing. Each kind of junk moves several of them, so that they can be held against each other.
HEURISTICS: dict[str, tuple[float, float]] = {
    "marks_per_word": (0.1, 0.4),
    "odd_shapes": (0.15, 0.4),
    "sentence_ends": (0.35, 0.6),
    "repeated_pairs": (0.2, 0.5),
    "no_letters": (0.05, 0.08),
    "same_neighbours": (0.05, 0.25),
    "top_word": (0.12, 0.25),
    "capitals": (0.4, 0.7),
    "compressible": (0.75, 0.85),
}
#: Shares are taken of at least so many words.
FEW = 20
GOOD, JUNK, NOTHING = 1, 2, 0
_MARKS = b"#*$%&|<>@^~{}[]!"
_ASCII_SIGNS = bytes(b for b in range(128) if not chr(b).isalpha())
_SPACES = b" \t\n\r\x0b\x0c"
_PROSE = re.compile(rb"""[("']*(A|Aa|a|0|a'a|Aa'a|a-a|Aa-Aa|Aa-a)[.,;:?)"']*""")
#: The kind of each byte: letters, capitals, digits and punctuation that stands for itself.
_KINDS = bytes(0x30 if 48 <= b < 58 else 0x41 if 65 <= b < 91 else 0x61 if 97 <= b < 123 or b >= 128 else b for b in range(256))


def shapes(text: bytes) -> list[bytes]:
    """Words with each run of letters, capitals or digits reduced to one sign."""
    kinds = text.translate(_KINDS)
    for sign in (b"a", b"A", b"0"):
        while sign * 2 in kinds:
            kinds = kinds.replace(sign * 8, sign).replace(sign * 4, sign).replace(sign * 2, sign)
    return kinds.split()


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def measures(text: bytes, words: list[bytes], shaped: Counter) -> tuple[float, ...]:
    """One number for each heuristic; the larger, the more like junk."""
    n = max(len(words), FEW)  # a few odd words make no junk
    count = lambda chars: len(text) - len(text.translate(None, chars))
    visible = len(text) - count(_SPACES)
    ends = _share(sum(c for s, c in shaped.items() if s[-1] in b".!?"), n)
    return (_share(count(_MARKS), n),
            _share(sum(c for s, c in shaped.items() if not _PROSE.fullmatch(s)), n),
            1.0 if n >= 30 and ends < 0.003 else ends,
            _share(len(words) - 1 - len(set(zip(words, words[1:]))), n),
            _share(count(_ASCII_SIGNS) - count(_SPACES), visible),
            _share(sum(map(eq, words, islice(words, 1, None))), n),
            _share(max(Counter(words).values(), default=1) - 1, n),
            _share(sum(c for s, c in shaped.items() if s[0] == 0x41), n),
            1 - _share(len(zlib.compress(text, 1)), len(text)) if n >= 30 else 0.0)


def votes(values: tuple[float, ...]) -> int:
    """The votes as one number, three values to each heuristic. A text without words is given no vote."""
    pattern = 0
    for value, (good, junk) in zip(reversed(values), reversed(HEURISTICS.values())):
        pattern = pattern * 3 + (JUNK if value >= junk else GOOD if value <= good else NOTHING)
    return pattern


def observe(text: bytes) -> tuple[int, list[int], list[float]]:
    """Vote pattern, and slots and values of the hashed features."""
    words, signs = text.split(), shapes(text)
    shaped = Counter(signs)
    if not words:
        return 0, [], []
    values = measures(text, words, shaped)
    found: dict[int, float] = {}
    n = max(len(words), FEW)
    for s, c in shaped.items():
        slot = zlib.crc32(s) % SLOTS
        found[slot] = found.get(slot, 0.0) + c / n
    for (a, b), c in Counter(zip(signs, signs[1:])).items():
        slot = zlib.crc32(a + b" " + b) % SLOTS
        found[slot] = found.get(slot, 0.0) + c / n
    for k, value in enumerate(values):
        slot = zlib.crc32(b"%d=%d" % (k, int(min(value, 20.0) * 10))) % SLOTS
        found[slot] = found.get(slot, 0.0) + 1.0
    return votes(values), list(found), [v ** 0.5 for v in found.values()]


@dataclass
class Labellers:
    """What expectation-maximisation finds: share of good texts, accuracies, posterior of each pattern."""

    good: float
    #: [class (junk, good), heuristic, vote (good, junk)]: how often a vote is given, where one is given
    rates: np.ndarray
    posterior: np.ndarray

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often each heuristic's vote is right on good and on junk texts."""
        return {h: (float(self.rates[1, k, 0]), float(self.rates[0, k, 1])) for k, h in enumerate(HEURISTICS)}


def estimate(counts: dict[int, int], rounds: int = 200) -> Labellers:
    """Expectation-maximisation over pattern counts (at most 3 ** 9 of them).

    It starts from "two junk votes make junk". Silence says nothing about the class. A heuristic counts as
    if it had been right nine times in ten before.
    """
    m = len(HEURISTICS)
    every = np.arange(3 ** m)
    digits = every[:, None] // 3 ** np.arange(m) % 3
    cast = np.stack([digits == GOOD, digits == JUNK], axis=2).astype(float)  # pattern, heuristic, vote
    weight = np.zeros(len(every))
    weight[list(counts)] = list(counts.values())
    good = 1 / (1 + np.exp(4.0 * cast[:, :, 1].sum(1) - 6.0))
    before = np.array([[1.0, 9.0], [9.0, 1.0]])[:, None, :]
    for _ in range(rounds):
        share = np.stack([weight * (1 - good), weight * good])
        rates = np.einsum("cp,phv->chv", share, cast) + before
        rates /= rates.sum(axis=2, keepdims=True)
        prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.einsum("phv,chv->cp", cast, np.log(rates)) + np.log(prior)[:, None]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return Labellers(float(prior[1]), rates, good)


def train(rows: list[tuple[float, list[int], list[float]]], rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights (SLOTS, then a constant) of a logistic scorer on soft labels; full gradients, so no chance."""
    x = np.zeros((len(rows), SLOTS + 1), np.float32)
    x[:, -1] = 1
    for i, (_, slots, values) in enumerate(rows):
        x[i, slots] = values
    y = np.array([r[0] for r in rows], np.float32)
    w = np.zeros(SLOTS + 1, np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / max(1, len(rows)) + ridge * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        w -= 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return w.astype(np.float64)


def _observed(rows: DataFrame, with_features: bool) -> DataFrame:
    """Replace ``raw`` by the vote pattern and, if asked for, slots and values."""
    others = [f for f in rows.schema.fields if f.name != "raw"]
    names = [f.name for f in others]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "raw"):
            columns = [batch.column(c) for c in names]
            texts = batch.column("raw").to_pylist()
            if with_features:
                seen = [observe(t) for t in texts]
                more = {"pattern": pa.array([s[0] for s in seen], pa.int32()),
                        "slots": pa.array([s[1] for s in seen], pa.list_(pa.int32())),
                        "values": pa.array([s[2] for s in seen], pa.list_(pa.float64()))}
            else:
                own = []
                for t in texts:
                    words = t.split()
                    own.append(votes(measures(t, words, Counter(shapes(t)))) if words else 0)
                more = {"pattern": pa.array(own, pa.int32())}
            yield pa.RecordBatch.from_arrays([*columns, *more.values()], [*names, *more])

    shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return rows.mapInArrow(run, shape + "pattern int" + ", slots array<int>, values array<double>" * with_features)


@dataclass
class Model:
    labellers: Labellers
    weights: np.ndarray


def fit(docs: DataFrame, *, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Estimate the heuristics on all rows, and train the scorer on at most ``fit_rows`` of them.

    To the driver go one count per vote pattern and the sample's features (at most SLOTS per row).
    Equal rows count in the estimate each time, but once in the sample.
    """
    rows = (pick(docs, doc_id=id_col, text=text_col)
            .select(F.xxhash64("doc_id", "text").alias("key"), raw("text").alias("raw")))
    seen = stored(_observed(rows, False), "votes")
    counts = {r["pattern"]: r["n"] for r in seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    labellers = estimate(counts)
    bound = seen.select("key").distinct().orderBy("key").limit(fit_rows).agg(F.max("key")).first()[0]
    sample = []
    if bound is not None:
        drawn = _observed(rows.where(F.col("key") <= bound).dropDuplicates(["key"]), True).limit(fit_rows)
        sample = sorted((r["key"], float(labellers.posterior[r["pattern"]]), r["slots"], r["values"]) for r in drawn.toLocalIterator())
    return Model(labellers, train([s[1:] for s in sample]))


def _scored(rows: DataFrame, model: Model, threshold: float) -> DataFrame:
    """Replace ``raw`` by posterior, score and kept."""
    others = [f for f in rows.schema.fields if f.name != "raw"]
    names = [f.name for f in others]
    weights, posterior = model.weights, model.labellers.posterior

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "raw"):
            soft, scores = [], []
            for text in batch.column("raw").to_pylist():
                pattern, slots, values = observe(text)
                soft.append(posterior[pattern])
                sum_ = weights[-1] + float(weights[slots] @ values) if slots else weights[-1]
                scores.append(1 / (1 + np.exp(-np.clip(sum_, -500, 500))))
            score = np.array(scores, np.float64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(soft, pa.float64()), pa.array(score), pa.array(score >= threshold)],
                [*names, "posterior", "score", "kept"])

    shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    return rows.mapInArrow(run, shape + "posterior double, score double, kept boolean")


def classify(docs: DataFrame, *, fit_rows: int = FIT_ROWS, threshold: float = KEEP, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, ``posterior`` (of being good, by the votes), ``score`` (by the scorer) and ``kept`` of every row.

    Whole texts are read. NULL and empty texts get no vote and no feature, so their posterior is the
    share of good texts and their score the scorer's constant. Repeated rows are scored each; NULL ids stay.
    """
    model = fit(docs, fit_rows=fit_rows, id_col=id_col, text_col=text_col)
    rows = pick(docs, doc_id=id_col, raw=text_col).withColumn("raw", raw("raw"))
    return _scored(rows, model, threshold)


def accepted(docs: DataFrame, *, fit_rows: int = FIT_ROWS, threshold: float = KEEP, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    model = fit(docs, fit_rows=fit_rows, id_col=id_col, text_col=text_col)
    names = docs.columns
    rows = numbered(docs).withColumn("raw", raw(f"c{place(names, text_col)}"))
    return _scored(rows, model, threshold).where("kept").select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
