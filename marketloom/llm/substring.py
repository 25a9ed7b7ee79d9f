"""Operator 8: remove passages that also start in a document with a smaller id.

A window is ``n`` consecutive words. Which windows recur is found without shuffling all of them:

1. Each window is named by its *seed*, the ``GRAM`` words in it with the least hash (the leftmost on
   ties). Equal windows have equal seeds. Windows of a document that share a seed's place form a
   run; about one word in 22 starts one. Only seeds found in two documents go on.
2. A run whose whole text is found in an earlier document is settled: that document provides it. Of
   each distinct run text the first holder alone looks closer, window by window, and only where
   its seed occurs with several run texts.
3. Confirmed passages are read from their providers in chunks and sent to the documents that hold
   them. A task compiles the passages sent to a shard of documents into an Aho-Corasick automaton of
   aligned blocks, streams those documents through it, and compares the words around every
   occurrence. Hashes thus only propose; text decides.

All groupings are sums or minima that combine before the shuffle; nothing is gathered but lists
within one document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import likely, numbered, pick, place, raw, remembers, steps
from marketloom.session import stored

#: Words of a window, and of the seed that names it.
WINDOW, GRAM = 50, 8
#: Window starts for which one chunk of a provider's text serves.
CHUNK = 128
#: Characters of passages compiled into one automaton.
SHARD_CHARS = 1 << 19
#: Word hashes a worker remembers.
REMEMBERED = 150_000

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they have an inverse modulo 2**64
_remembered: dict[bytes, int] = {}
_powers: dict[int, np.ndarray] = {}
remembers("words", _remembered.clear)
remembers("words", _powers.clear)


def word_hashes(words: list[bytes]) -> np.ndarray:
    known, hashed = _remembered, xxhash.xxh64_intdigest
    if len(known) > REMEMBERED:
        known.clear()
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = hashed(w)
            if len(w) <= 64:
                known[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 4096), base, np.uint64)
        factors[0] = 1
        have = np.cumprod(factors)
        if n <= 1 << 20:
            _powers[base] = have
    return have[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def span_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of the words in each span, from running sums."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(base, len(h)), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return _mixed((sums[ends] - sums[starts]) * _power(inverse, len(h) + 1)[starts] + (ends - starts).astype(np.uint64))


def _gram(n: int) -> int:
    """Words of a seed: fewer in short windows."""
    return min(GRAM, max(1, n // 2))


def _base(n: int) -> int:
    """Above the number of windows that can share a seed's place, so that one number holds a place and a count."""
    return 1 << max(6, (n - 1).bit_length())


def runs_of(words: list[bytes], n: int = WINDOW):
    """Seed, whole-run hash, first window and number of windows of each distinct run of a text."""
    h, gram = word_hashes(words), _gram(n)
    grams = len(h) - gram + 1
    powers = _power(_BASES[0], gram)
    g = np.zeros(grams, np.uint64)
    for j in range(gram):
        g += h[j:j + grams] * powers[j]
    g = _mixed(g)
    windows = len(h) - n + 1
    seed_at = np.lib.stride_tricks.sliding_window_view(g, n - gram + 1).argmin(axis=1) + np.arange(windows)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(seed_at)) + 1])
    counts = np.diff(np.concatenate([starts, [windows]]))
    whole = span_hashes(h, starts, starts + counts + n - 1, _BASES[1])
    _, once = np.unique(whole, return_index=True)
    return g[seed_at[starts[once]]], whole[once], starts[once], counts[once]


def _runs(rows: DataFrame, n: int) -> DataFrame:
    """doc_id, seed, run, at (first window times ``_base(n)``, plus windows - 1). Rows without an id take no part."""
    kind, base = rows.schema["doc_id"].dataType.simpleString(), _base(n)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", holder="words"):
            found, origin = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.split()
                if len(words) >= n:
                    seeds, whole, starts, counts = runs_of(words, n)
                    found.append((seeds, whole, starts * base + counts - 1))
                    origin.append(np.full(len(seeds), i))
            if found:
                seeds, whole, at = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(np.concatenate(origin))), pa.array(seeds.view(np.int64)),
                     pa.array(whole.view(np.int64)), pa.array(at.astype(np.int64))], ["doc_id", "seed", "run", "at"])

    return (rows.where("doc_id is not null").select("doc_id", raw("text").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, seed bigint, run bigint, at bigint"))


def _windows(texts: DataFrame, n: int) -> DataFrame:
    """doc_id, w1, w2 (128 bits of hash) and start of the windows in the runs listed in ``ats``."""
    kind, base = texts.schema["doc_id"].dataType.simpleString(), _base(n)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", 2 << 20, "words"):
            found, origin = [], []
            for i, (text, ats) in enumerate(zip(batch.column("text").to_pylist(), batch.column("ats").to_pylist())):
                h = word_hashes(text.split())
                ats = np.array(ats, np.int64)
                first, count = ats // base, ats % base + 1
                starts = np.unique(np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
                starts = starts[starts + n <= len(h)]  # a repeated id may stand before another text
                w1 = span_hashes(h, starts, starts + n, _BASES[0])
                w2 = span_hashes(_mixed(h), starts, starts + n, _BASES[1])
                _, once = np.unique(w1, return_index=True)
                found.append((w1[once], w2[once], starts[once]))
                origin.append(np.full(len(once), i))
            w1, w2, at = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(np.concatenate(origin))), pa.array(w1.view(np.int64)),
                 pa.array(w2.view(np.int64)), pa.array(at.astype(np.int64))], ["doc_id", "w1", "w2", "start"])

    return texts.mapInArrow(run, f"doc_id {kind}, w1 bigint, w2 bigint, start bigint")


def routes(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, provider (a smaller id) and chunk (of the provider's text) wherever windows are shared.

    Every shared window of a document lies in a chunk that the first document with this window provides.
    """
    runs = stored(_runs(rows, n), "runs")
    texts = stored(runs.groupBy("seed", "run").agg(
        F.min("doc_id").alias("first"), F.min_by("at", "doc_id").alias("first_at"), F.count(F.lit(1)).alias("holders")), "run_texts")
    # What is grouped by a key is kept before it is joined by that key, so that the join can split a key that very
    # many runs or windows share.
    contested = stored(texts.groupBy("seed").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("seed"), "contested")

    # Whole runs seen in an earlier document.
    known = texts.where("holders > 1").select("seed", "run", "first", "first_at")
    base = _base(n)
    chunks = f"sequence(first_at div {base} div {CHUNK}, (first_at div {base} + first_at % {base}) div {CHUNK})"
    settled = (runs.select("seed", "run", "doc_id").join(known, ["seed", "run"]).where("doc_id > first")
               .select("doc_id", F.col("first").alias("provider"), F.explode(F.expr(chunks)).alias("chunk"))
               .distinct())

    # Windows of runs that differ around a shared seed, from the first holder of each.
    holders = stored(texts.select("seed", "first", "first_at").join(contested, "seed")
                     .groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("first_at").alias("ats")), "holders")
    closer = likely(rows.select("doc_id", raw("text").alias("text")), "doc_id", holders).join(holders, "doc_id")
    windows = stored(_windows(closer, n), "windows")
    least = stored(windows.groupBy("w1", "w2").agg(
        F.min("doc_id").alias("first"), F.min_by("start", "doc_id").alias("first_start"), F.count(F.lit(1)).alias("holders"))
        .where("holders > 1").drop("holders"), "recurring")
    single = (windows.select("w1", "w2", "doc_id").join(least, ["w1", "w2"]).where("doc_id > first")
              .select("doc_id", F.col("first").alias("provider"), F.floor(F.col("first_start") / CHUNK).alias("chunk"))
              .distinct())
    return settled.unionByName(single).distinct()


def _chunks(texts: DataFrame, n: int) -> DataFrame:
    """provider, chunk and its words (joined by a space) of the chunks listed in ``chunks``."""
    kind = texts.schema["provider"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", holder="words"):
            origin, number, cut = [], [], []
            for i, (text, chunks) in enumerate(zip(batch.column("text").to_pylist(), batch.column("chunks").to_pylist())):
                words = text.split()
                origin += [i] * len(chunks)
                number += chunks
                cut += [b" ".join(words[c * CHUNK:(c + 1) * CHUNK + n - 1]) for c in chunks]
            yield pa.RecordBatch.from_arrays(
                [batch.column("provider").take(pa.array(origin, pa.int64())), pa.array(number, pa.int64()),
                 pa.array(cut, pa.binary())], ["provider", "chunk", "words"])

    return texts.mapInArrow(run, f"provider {kind}, chunk bigint, words binary")


class Shard:
    """Passages compiled into an automaton; finds in a text every stretch of ``n`` words or more of them.

    The automaton holds the passages' aligned blocks of ``n // 2`` words: any n - 1 words of a passage
    hold a whole block. The words around a block are then compared one by one.
    """

    def __init__(self, passages: dict[bytes, int], n: int = WINDOW):
        self.n, self.block = n, max(1, n // 2)
        self.words = [p.split() for p in passages]
        self.provider = list(passages.values())
        self.places: list[list[tuple[int, int]]] = []
        self.automaton = ahocorasick.Automaton()
        numbers: dict[str, int] = {}
        for p, words in enumerate(self.words):
            for k in range(0, len(words) - self.block + 1, self.block):
                key = self._key(words[k:k + self.block])
                at = numbers.setdefault(key, len(numbers))
                if at == len(self.places):
                    self.places.append([])
                    self.automaton.add_word(key, (at, len(key)))
                self.places[at].append((p, k))
        if numbers:
            self.automaton.make_automaton()

    @staticmethod
    def _key(words: list[bytes]) -> str:
        return f" {b' '.join(words).decode('latin-1')} "  # one character for each byte

    def covered(self, doc_id: int, words: list[bytes]) -> bytearray:
        """1 for each word in a shared window of a passage provided by a smaller id."""
        n, block, size = self.n, self.block, len(words)
        marks = bytearray(size)
        if not self.places or size < n:
            return marks
        starts = (np.cumsum(np.fromiter(map(len, words), np.int64, size) + 1) - [len(w) for w in words]).tolist()
        done: dict[tuple[int, int], int] = {}
        for end, (at, length) in self.automaton.iter(self._key(words)):
            q = bisect_left(starts, end - length + 2)
            if marks.find(0, max(0, q + block - n), min(size, q + n)) < 0:
                continue  # every window around this block is covered
            for p, k in self.places[at]:
                if self.provider[p] >= doc_id or done.get((p, q - k), 0) > q:
                    continue
                passage = self.words[p]
                left = 0
                while left < min(q, k) and words[q - left - 1] == passage[k - left - 1]:
                    left += 1
                right, most = block, min(size - q, len(passage) - k)
                while right < most and words[q + right] == passage[k + right]:
                    right += 1
                done[p, q - k] = q + right
                if left + right >= n:
                    marks[q - left:q + right] = b"\x01" * (left + right)
        return marks


def _spans(marks: bytearray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\x00" + bytes(marks) + b"\x00", np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]


def _strip(rows: DataFrame, n: int) -> DataFrame:
    """Replace ``passages`` by n_words, n_removed, removed (word spans) and clean (bytes)."""
    others = [f for f in rows.schema.fields if f.name != "passages"]
    names = [f.name for f in others]
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()
        lists = batch.column("passages").to_pylist()
        first: dict[bytes, int] = {}
        for provided in lists:
            for p in provided or ():
                first[p["words"]] = min(p["provider"], first.get(p["words"], p["provider"]))
        shard = Shard(first, n)
        n_words, n_removed, removed, clean = [], [], [], []
        for doc_id, text, provided in zip(ids, texts, lists):
            words = text.split()
            marks = shard.covered(doc_id, words) if provided else bytearray(0)
            gone = marks.count(1)
            n_words.append(len(words))
            n_removed.append(gone)
            removed.append(_spans(marks) if gone else [])
            clean.append(b" ".join([w for w, m in zip(words, marks) if not m] if gone else words))
        kept = [batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, spans),
             pa.array(clean, pa.binary())], [*names, "n_words", "n_removed", "removed", "clean"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "raw", holder="words"):
            sizes = [sum(len(p["words"]) for p in x or ()) for x in step.column("passages").to_pylist()]
            start = size = 0
            for i, own in enumerate(sizes):
                size += own
                if size >= SHARD_CHARS:
                    yield strip(step.slice(start, i + 1 - start))
                    start, size = i + 1, 0
            if start < len(sizes):
                yield strip(step.slice(start))

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(run, f"{shape}, n_words bigint, n_removed bigint, "
                                "removed array<struct<start:int,end:int>>, clean binary")


def _with_passages(rows: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, text and others) with the passages that earlier documents provide for them."""
    if n < 1:
        raise ValueError("a window has one word or more")
    sent = stored(routes(rows.select("doc_id", "text"), n), "routes")
    wanted = stored(sent.groupBy("provider").agg(F.collect_set("chunk").alias("chunks")), "wanted")
    sources = (likely(rows.select(F.col("doc_id").alias("provider"), raw("text").alias("text")), "provider", wanted)
               .join(wanted, "provider"))
    provided = (sent.join(_chunks(sources, n), ["provider", "chunk"])
                .groupBy("doc_id").agg(F.collect_list(F.struct("provider", "words")).alias("passages")))
    return rows.withColumn("raw", raw("text")).join(provided, "doc_id", "left")


def repeats(docs: DataFrame, *, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, ``removed`` (spans of word numbers, end exclusive) and ``clean_text``
    (kept words joined by one space) of every row.

    A word goes if a window of ``n`` words around it also starts in a row with a smaller doc_id. NULL texts
    have no words. Rows without an id lose nothing and take nothing from others; rows that repeat an
    id do not take from each other. Windows are judged on the input. ``n`` may be any number from 1.

    Hashes say which passages a document may share, so its automaton holds these alone instead of all recurring
    passages, whose automata would have to see every document. Every shared window is among them, and
    what the hashes name wrongly the words around an occurrence refute.
    """
    rows = _with_passages(pick(docs, doc_id=id_col, text=text_col), n).drop("text")
    return _strip(rows, n).select("doc_id", "n_words", "n_removed", "removed", F.col("clean").cast("string").alias("clean_text"))


def without_repeats(docs: DataFrame, *, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with such words taken out of the text, all other columns and untouched texts as they were."""
    names = docs.columns
    id_at, text_at = (f"c{place(names, c)}" for c in (id_col, text_col))
    rows = numbered(docs).withColumnsRenamed({id_at: "doc_id", text_at: "text"})
    done = _strip(_with_passages(rows, n), n)
    text = F.when(F.col("n_removed") > 0, F.col("clean").cast("string")).otherwise(F.col("text"))
    return (done.withColumn("text", text).withColumnsRenamed({"doc_id": id_at, "text": text_at})
            .select(*[f"c{i}" for i in range(len(names))]).toDF(*names))
