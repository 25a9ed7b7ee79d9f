"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text that one step in a Python worker handles at once; Spark's own Arrow batches hold 64 MB at most.
STEP_BYTES = 4 << 20

#: Bits that tell rows of wanted keys from most others: 8 MB.
BITMAP = 1 << 26

#: What separates words: the ASCII white space, which ``bytes.split()`` splits on as well.
SPACE = r"[\x20\x09-\x0D]+"


def place(names: list[str], wanted: str) -> int:
    """Position of the column with exactly this name, else of the one that differs only in case."""
    if wanted in names:
        return names.index(wanted)
    like = [i for i, n in enumerate(names) if n.lower() == wanted.lower()]
    if len(like) != 1:
        raise ValueError(f"no column {wanted!r} among {names}")
    return like[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``new=old``. Others may have any names, repeated ones included."""
    names = df.columns
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"c{place(names, old)}").alias(new) for new, old in columns.items()])


def numbered(df: DataFrame) -> DataFrame:
    """The same rows with columns c0, c1, ..., so that no added name can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def raw(text: Column | str) -> Column:
    """The bytes of a text; NULL is the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


_memories: dict[str, list[Callable[[], None]]] = {}
_holder = ""


def remembers(holder: str, forget: Callable[[], None]) -> None:
    """Name an operator whose worker processes remember things between tasks, and how they let go of them."""
    _memories.setdefault(holder, []).append(forget)


def _hand_over(holder: str) -> None:
    """A worker that turns to another operator gives back what earlier ones remember."""
    global _holder
    if holder != _holder:
        for name, forgets in _memories.items():
            if name != holder:
                for forget in forgets:
                    forget()
        _holder = holder
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library, which returns memory by itself or not at all


def steps(batches: Iterable[pa.RecordBatch], column: str, most: int = STEP_BYTES, holder: str = "") -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named column holds about ``most`` bytes (or 4-byte numbers) in each.

    Operators that remember things between tasks say so by ``holder``; what others remember is let go.
    """
    _hand_over(holder)
    for batch in batches:
        values = batch.column(column)
        length, unit = (pc.list_value_length, 4) if pa.types.is_list(values.type) else (pc.binary_length, 1)
        sizes = pc.multiply(pc.fill_null(length(values), 0), unit).to_pylist()
        start = size = 0
        for i, n in enumerate(sizes):
            size += n
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < len(sizes):
            yield batch.slice(start)


def maybe_among(rows: DataFrame, column: str, ids: DataFrame, flag: str = "maybe") -> DataFrame:
    """The rows with a flag: true for all rows whose id is among ``ids`` (a column of the same name), and for a few others.

    One bit for each of BITMAP hash values tells most other rows apart before anything is shuffled. The
    bitmap is broadcast; its size is fixed, whatever the number of ids: as they grow beyond it, more
    rows are flagged, and a join that follows still decides.
    """
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(BITMAP))
    width = 8 * 4096  # bits of one bitmap of Spark's
    bitmaps = (ids.select(slot.alias("_slot"))
               .groupBy(F.floor(F.col("_slot") / width).alias("_part"))
               .agg(F.bitmap_construct_agg(F.col("_slot") % width).alias("_bits")))
    at = F.col("_at") % width
    byte = F.ascii(F.decode(F.col("_bits").substr((at / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    met = rows.withColumn("_at", slot).join(F.broadcast(bitmaps), F.floor(F.col("_at") / width) == F.col("_part"), "left")
    return met.withColumn(flag, F.coalesce(F.bit_get(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_at", "_part", "_bits")


def likely(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids`` (a column of the same name), and a few others."""
    return maybe_among(rows, column, ids, "_maybe").where("_maybe").drop("_maybe")
