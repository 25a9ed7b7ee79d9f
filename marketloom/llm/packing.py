"""Operator 7: pack documents into sequences of a fixed length.

Bounded-space online best fit: a task keeps a fixed number of open sequences in a bitset keyed by
free space. A piece goes where the least space stays free; if it fits nowhere, a sequence is opened,
and if too many are open, the fullest closes first.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.bpe import WordBpe, id_lists
from marketloom.llm.common import pick, raw, remembers, steps
from marketloom.session import stored

#: Tokens of a sequence.
LENGTH = 2048
#: The id that ends a document.
END = 0
#: Sequences that a task keeps open.
OPEN = 1024
#: Pieces that one task packs; their number sets the number of tasks.
PIECES_PER_TASK = 200_000


class LibraryIds(WordBpe):
    """Ids by the ``tokenizers`` library, asked once for each piece of text that is not remembered."""

    remembered = 250_000

    def ids_of(self, piece: bytes) -> list[int]:
        letters = piece.decode() if piece.isalpha() else "".join([self.letters[b] for b in piece])
        return [t.id for t in self.model.tokenize(letters)]


@lru_cache(maxsize=4)
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


remembers("tokens", library_ids.cache_clear)


class OpenBins:
    """A fixed number of open bins in a bitset keyed by free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits = self.count = self.made = 0
        self.at: list[list[int]] = [[] for _ in range(size + 1)]

    def _open(self, number: int, free: int) -> None:
        if free:
            self.at[free].append(number)
            self.bits |= 1 << free
            self.count += 1

    def _take(self, free: int) -> int:
        number = self.at[free].pop()
        if not self.at[free]:
            self.bits ^= 1 << free
        self.count -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """The bin for a piece of this length, and the place in it."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.made, self.size
            self.made += 1
        self._open(number, free - length)
        if self.count > self.most:
            self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        return number, self.size - free


def pieces(docs: DataFrame, path: str, *, length: int = LENGTH, end: int = END, keep_ids: bool = True,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as ids, ended by ``end``, cut into pieces of at most ``length`` tokens.

    Columns: doc_id, piece (from 0), start, length, ids_crc32 (of 32-bit little-endian ids) and, if
    asked for, ids. A NULL or empty text is the end token alone. Repeated rows are documents of
    their own; a NULL id stays NULL.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    ending, cut = np.array([end], "<i4").tobytes(), 4 * length

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = library_ids(path)
        for batch in steps(batches, "text", holder="tokens"):
            origin, number, parts = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = bpe.encode(text) + ending
                own = [ids[k:k + cut] for k in range(0, len(ids), cut)]
                origin += [i] * len(own)
                number += range(len(own))
                parts += own
            columns = [batch.column("doc_id").take(pa.array(origin, pa.int64())), pa.array(number, pa.int32()),
                       pa.array([k * length for k in number], pa.int64()),
                       pa.array([len(p) // 4 for p in parts], pa.int64()),
                       pa.array([zlib.crc32(p) for p in parts], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, id_lists(parts)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select("doc_id", raw("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids)


def pack(parts: DataFrame, *, length: int = LENGTH, most_open: int = OPEN,
         per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``length``.

    The rows are kept once as a table, then dealt evenly to as many tasks as their number asks for,
    which each pack a stream in an order drawn by hash (sorted input would keep small pieces from
    large gaps). A task that runs again sees the same rows in the same order and so repeats its
    numbers. A task wastes at most its open sequences' free space. Without rows there are none.
    """
    table = stored(parts, "pieces")
    tasks = max(1, math.ceil(table.count() / per_task))
    keys = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    dealt = table.repartition(tasks).sortWithinPartitions(F.xxhash64(*keys), *keys)
    names = table.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(length, most_open), TaskContext.get().partitionId() << 40
        for batch in batches:
            put = [bins.put(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + n for n, _ in put], pa.int64()), pa.array([o for _, o in put], pa.int64())],
                [*names, "sequence_id", "offset"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    return dealt.mapInArrow(run, f"{shape}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids of each sequence in place: sequence_id, ids, n_documents. A group holds at most
    one sequence's tokens."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id")
            .agg(F.flatten(F.transform(placed, lambda p: p["ids"])).alias("ids"), F.count(F.lit(1)).alias("n_pieces")))
