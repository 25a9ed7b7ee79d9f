"""Operator 11: runs of periodic words, found online by catchers over power-of-two blocks.

Words are appended one after the other (or many at a time, with the same outcome). Whenever a block of
``m`` words that starts at a multiple of ``m`` is complete, its earlier occurrences ``p`` words back, for
the periods that belong to ``m``, are looked up by hash. Each sets a catcher for period ``p``: it compares
words with those ``p`` places before, first backwards from the block, then onwards with every word that
is appended. Once the words that agree number ``p``, the text holds a square, and further ones merge into
the same run until a word differs.

A run of ``exponent`` periods, three or more, has at least ``2 p`` words that equal the word ``p`` places
before, and any ``2 m - 1`` consecutive places hold a whole block. So blocks of ``m`` words catch all
periods from ``m`` to ``2 m - 1``, and the smallest blocks all periods below.
"""

from __future__ import annotations

import re
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import pick, raw, steps

#: A run has at least this many periods and this many words.
EXPONENT, LEAST = 3, 24
#: Bytes of text that are split into words and appended at once.
PIECE_BYTES = 1 << 18
#: A block without a period of at most half its words has at most this many occurrences in reach.
FEW = 3
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

Run = tuple[int, int, int]  # start, length, period


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring stretches as one."""
    h = left + right * _ODD
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


class Level:
    """Hashes of all stretches of ``m`` words near the end of the text, and the next block to complete."""

    def __init__(self, m: int):
        self.m, self.base, self.hashes, self.next = m, 0, np.empty(0, np.uint64), m
        self.waiting: deque[tuple[int, np.ndarray]] = deque()

    @property
    def end(self) -> int:
        return self.base + len(self.hashes)

    def extend(self, more: np.ndarray) -> None:
        self.hashes = np.concatenate([self.hashes, more]) if len(self.hashes) else more

    def forget(self, n: int) -> None:
        """Keep what blocks and stretches of twice the length still need."""
        first = max(self.base, n - 4 * self.m)
        self.hashes, self.base = self.hashes[first - self.base:], first


class RunFinder:
    """The runs of a growing sequence of word numbers."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 3 or least < 1:
            raise ValueError("a run has three periods or more, and a word or more")
        self.exponent, self.least = exponent, least
        self.smallest = 1 << max(0, ((least + 2) // 3).bit_length() - 1)
        self.words, self.n = np.empty(0, np.int32), 0
        self.levels = [Level(1)]
        self.last: dict[int, tuple[int, int]] = {}  # period: the latest stretch that equals the words p before
        self.live: set[int] = set()  # periods whose latest stretch ends with the text
        self.found: dict[tuple[int, int], int] = {}  # start, end: smallest period

    def append(self, words: np.ndarray) -> None:
        """Take further words; open catchers advance, and completed blocks set new ones."""
        if not len(words):
            return
        if self.n + len(words) > len(self.words):
            grown = np.empty(max(self.n + len(words), 2 * self.n), np.int32)
            grown[:self.n] = self.words[:self.n]
            self.words = grown
        self.words[self.n:self.n + len(words)] = words
        self.n += len(words)
        for p in sorted(self.live):
            self._advance(p)
        singles = words.astype(np.uint64)
        self.levels[0].extend(_joined(singles, singles))
        for k, level in enumerate(self.levels):
            if k:
                half = self.levels[k - 1]
                places = slice(level.end - half.base, self.n - level.m + 1 - half.base)
                if places.stop > places.start:
                    level.extend(_joined(half.hashes[places], half.hashes[places.start + half.m:places.stop + half.m]))
            if k == len(self.levels) - 1 and 2 * level.m <= self.n:
                self.levels.append(Level(2 * level.m))  # taken up by this very loop
            if level.m >= self.smallest:
                self._complete(level)
        for level in self.levels:
            level.forget(self.n)

    def close(self) -> list[Run]:
        """The text ends here: all its runs by start, then period."""
        for level in self.levels:
            self._resume(level, True)
        for p in sorted(self.live):
            self._keep(p)
        self.live.clear()
        return sorted(((a, b - a, p) for (a, b), p in self.found.items()), key=lambda r: (r[0], r[2]))

    def _complete(self, level: Level) -> None:
        """Look up every block that has become complete among the stretches before it."""
        self._resume(level, False)
        m, first = level.m, level.next
        blocks = (self.n - first) // m
        if blocks <= 0:
            return
        level.next += blocks * m
        nearest = 1 if m == self.smallest else m
        reach = 2 * m - nearest  # how many distances, from nearest to 2 m - 1
        before = first - 2 * m + 1
        seen = level.hashes[max(before, 0) - level.base:first + (blocks - 1) * m - nearest + 1 - level.base]
        if before < 0:
            seen = np.concatenate([np.zeros(-before, np.uint64), seen])
        own = level.hashes[first - level.base:first + (blocks - 1) * m + 1 - level.base:m]
        same = np.lib.stride_tricks.sliding_window_view(seen, reach)[::m] == own[:, None]
        rows = np.flatnonzero(same.any(axis=1))
        for row in rows.tolist():
            block = first + row * m
            distances = (2 * m - 1 - np.flatnonzero(same[row]))[::-1]
            distances = distances[distances <= block]
            if len(distances) <= FEW:
                for p in distances.tolist():
                    self._catch(block, m, p)
            else:
                level.waiting.append((block, distances))
        self._resume(level, False)

    def _resume(self, level: Level, closing: bool) -> None:
        """Periodic blocks wait for the words after them that their occurrences could reach."""
        while level.waiting and (closing or level.waiting[0][0] + 4 * level.m <= self.n):
            block, distances = level.waiting.popleft()
            for p in self._aligned(block, level.m, distances):
                self._catch(block, level.m, p)

    def _aligned(self, block: int, m: int, distances: np.ndarray) -> list[int]:
        """The few distances of a periodic block that can be the smallest period of a run.

        Many occurrences mean that the block has a period ``r`` of half its words or less, and lies in a
        longest stretch of that period. A run of a larger smallest period shares less than ``p + r`` words with
        the stretch, so an end of the stretch lies within the run, and with it the same end of the
        stretch that holds the occurrence.
        """
        gaps = np.diff(distances)
        r = int(gaps.min())
        left, right = self._stretch(block, r, 3 * m)
        fit = [r] if distances[0] == r else []
        others = distances[block - distances < left]
        for group in np.split(others, np.flatnonzero(np.diff(others) > r) + 1):
            if len(group):
                ends = self._stretch(block - int(group[-1]), r, 3 * m)
                members = set(group.tolist())
                fit += [p for p in {left - ends[0], right - ends[1]} if p in members]
        return sorted(set(fit))

    def _stretch(self, at: int, r: int, most: int) -> tuple[int, int]:
        """Where the stretch of period r around ``at`` starts and ends, as far as ``most`` words either way."""
        end = at + r + self._agree(at + r, at, most)
        return at - self._agree_back(at, at + r, most), end

    def _agree(self, x: int, y: int, most: int) -> int:
        """How many words from x on equal those from y on, where y < x."""
        w, done, step, most = self.words, 0, 64, min(most, self.n - x)
        while done < most:
            k = min(step, most - done)
            differ = w[x + done:x + done + k] != w[y + done:y + done + k]
            at = int(differ.argmax())
            if differ[at]:
                return done + at
            done, step = done + k, min(2 * step, 1 << 16)
        return most

    def _agree_back(self, x: int, y: int, most: int) -> int:
        """How many words before x equal those before y, where x < y."""
        w, done, step, most = self.words, 0, 64, min(most, x)
        while done < most:
            k = min(step, most - done)
            differ = (w[x - done - k:x - done] != w[y - done - k:y - done])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                return done + at
            done, step = done + k, min(2 * step, 1 << 16)
        return most

    def _catch(self, block: int, m: int, p: int) -> None:
        """Set a catcher for period p at a block, unless one holds the block already."""
        start, end = self.last.get(p, (0, 0))
        if start <= block and block + m <= end:
            return
        if p in self.live:  # another stretch of the same period is still open
            return self._also(block, p)
        self.last[p] = (block - self._agree_back(block - p, block, block), block)
        self.live.add(p)
        self._advance(p)

    def _also(self, block: int, p: int) -> None:
        """A block that waited, before the open stretch of its period: its own stretch has ended."""
        kept = self.last[p]
        self.last[p] = (block - self._agree_back(block - p, block, block), block + self._agree(block, block - p, self.n))
        self._keep(p)
        self.last[p] = kept

    def _advance(self, p: int) -> None:
        """Compare on to the end of the text; a word that differs ends the stretch."""
        start, end = self.last[p]
        end += self._agree(end, end - p, self.n)
        self.last[p] = (start, end)
        if end < self.n:
            self.live.discard(p)
            self._keep(p)

    def _keep(self, p: int) -> None:
        """A stretch that has ended is a run if long enough. Of equal stretches the smallest period counts."""
        start, end = self.last[p]
        length = end - start + p
        if length >= max(self.least, self.exponent * p):
            self.found[start - p, end] = min(p, self.found.get((start - p, end), p))


def _pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a bounded part at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def find(text: bytes, exponent: int = EXPONENT, least: int = LEAST) -> tuple[int, list[Run], bytes]:
    """Number of words, runs, and the words outside all repetitions, joined by one space."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    finder = RunFinder(exponent, least)
    for words in _pieces(text):
        finder.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    runs = finder.close()
    edge = np.zeros(finder.n + 1, np.int32)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    gone, at, kept = np.cumsum(edge[:-1]) > 0, 0, []
    for words in _pieces(text):
        here = gone[at:at + len(words)]
        at += len(words)
        kept.append(b" ".join([w for w, g in zip(words, here.tolist()) if not g] if here.any() else words))
    return finder.n, runs, b" ".join(k for k in kept if k)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def runs(docs: DataFrame, *, exponent: int = EXPONENT, least: int = LEAST, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """doc_id, ``n_words``, ``runs``, ``best`` and ``collapsed`` of each row, in one pass over whole texts.

    ``runs`` lists start, length and period of every longest stretch of at least ``least`` words and
    ``exponent`` of its smallest periods, by start, then period. ``best`` has the greatest length by period
    (ties: smallest start, then period). ``collapsed`` is the text without the words that follow the first
    period of a run. A NULL or empty text has no words, no runs, a NULL ``best`` and an empty ``collapsed``.
    Rows with a NULL or repeated id are judged like any other; an empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            done = [find(t, exponent, least) for t in batch.column("text").to_pylist()]
            listed = [[dict(zip(("start", "length", "period"), r)) for r in found] for _, found, _ in done]
            best = [max(each, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)
                    for each in listed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _, _ in done], pa.int64()), pa.array(listed, pa.list_(_RUN)),
                 pa.array(best, _RUN), pa.array([c for _, _, c in done], pa.binary())],
                ["doc_id", "n_words", "runs", "best", "collapsed"])

    shape = "struct<start: bigint, length: bigint, period: bigint>"
    found = rows.withColumn("text", raw("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<{shape}>, best {shape}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
