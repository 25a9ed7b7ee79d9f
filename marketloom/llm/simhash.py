"""Operator 6: near duplicates by SimHash, compared exactly in tiles.

Distinct fingerprints are sorted into cells by the bit counts of their four 16-bit quarters. Two
fingerprints that differ in at most ``radius`` bits have quarter counts that differ by at most
``radius`` in sum, so a cell meets only the few cells within that distance; all other tile pairs
are skipped. Large cells are cut into tiles of bounded size. A pair of tiles is compared in numpy with
exclusive-or and bit counts, and gives back a forest of links, at most one per fingerprint, so that
no group is written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import numbered, pick, place, raw, steps
from marketloom.llm.components import components
from marketloom.session import stored

#: Words of a shingle, and the bits in which linked fingerprints may differ.
SHINGLE, RADIUS = 3, 2
SEED = 42
#: Fingerprints of a tile, on average; a tile is one array in one row.
TILE = 1 << 14
#: Fingerprints compared at once within a task.
BLOCK = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit k is set if it is set in over half the shingles' hashes. No words: 0."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    hashes = np.array([hashed(joined[a:b], SEED) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # bounded however long the text
        bits = np.unpackbits(hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Replace the column ``text`` by ``fp`` (the 64 bits as a signed long), in one pass over whole texts.

    A NULL text counts as empty. Repeated rows stay.
    """
    others = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in others]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(fps.view(np.int64))],
                                             [*names, "fp"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.withColumn("text", raw("text")).mapInArrow(run, f"{shape}, fp bigint")


def steps_between(radius: int) -> list[tuple[int, int, int, int]]:
    """One of each two opposite moves between cells whose quarter counts differ by at most ``radius``."""
    near = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= (0, 0, 0, 0)]


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links within ``radius`` between two tiles, thinned to a forest: what they connect stays connected."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            nxt = up[x]
            if nxt in up:
                up[x] = up[nxt]
            x = nxt
        return x

    kept = []
    for i in range(0, len(a), BLOCK):
        for j in range(i if same else 0, len(b), BLOCK):
            x, y = a[i:i + BLOCK], b[j:j + BLOCK]
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            for p in np.flatnonzero(near.any(axis=1)).tolist():  # a row at a time, as a dense block has very many links
                u = int(x[p])
                s = root(u)
                for v in y[np.flatnonzero(near[p])].tolist():
                    t = root(v)
                    if s != t:
                        low, high = (s, t) if s < t else (t, s)
                        up[high] = s = low
                        kept.append((u, v))
    return kept


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links a, b between distinct fingerprints (column ``fp``) that connect all within ``radius`` bits."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF)) for k in range(4)]
    cell = sum((quarter[k] * (100 ** k) for k in range(1, 4)), quarter[0])  # two digits for each quarter
    placed = distinct.select("fp", cell.cast("int").alias("cell"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    tiles = stored(
        placed.join(sizes, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .groupBy("cell", "tile", "tiles").agg(F.collect_list("fp").alias("fps")), "tiles")
    grid = tiles.select("cell", "tiles").distinct()
    moves = [sum(d[k] * 100 ** k for k in range(4)) for d in steps_between(radius)]
    # Every tile of a cell meets every tile of the same cell and of half the cells around it.
    meetings = (
        tiles.select("cell", "tile")
        .withColumn("other", F.explode(F.array(*[F.col("cell") + F.lit(m) for m in moves])))
        .join(grid.select(F.col("cell").alias("other"), "tiles"), "other")
        .withColumn("other_tile", F.explode(F.sequence(
            F.when(F.col("other") == F.col("cell"), F.col("tile")).otherwise(F.lit(0)), F.col("tiles") - 1))))
    pairs = (meetings.join(tiles.select("cell", "tile", F.col("fps").alias("left")), ["cell", "tile"])
             .join(tiles.select(F.col("cell").alias("other"), F.col("tile").alias("other_tile"), F.col("fps").alias("right")),
                   ["other", "other_tile"])
             .select(((F.col("cell") == F.col("other")) & (F.col("tile") == F.col("other_tile"))).alias("same"),
                     "left", "right"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            left, right = batch.column("left"), batch.column("right")
            for i, same in enumerate(batch.column("same").to_pylist()):
                a, b = (x[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (left, right))
                found += forest(a, b, same, radius)
            got = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def classes(printed: DataFrame, *, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``fp``, ``root`` (names its component) and ``least`` (the component's smallest doc_id), a row for
    each distinct fingerprint.

    ``printed`` has doc_id and fp. Exact copies share a fingerprint and so are one node; only the
    smallest id of each is shuffled.
    """
    first = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "fps")
    roots = stored(components(links(first.select("fp"), radius, tile), F.col("a"), F.col("b"))
                   .withColumnRenamed("node", "fp"), "roots")
    # Only fingerprints that have links meet again; any other is its own component. Kept, so that the join can
    # split a component of very many fingerprints: a side grouped by the root would pin each root to one task.
    least = stored(first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("least")), "root_least")
    return (first.join(roots.join(least, "root"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("least")))


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest doc_id reachable) of each row.

    NULL and word-less texts have fingerprint zero and are linked like any other. A row without id is
    linked too; its component's id is the smallest id that is not NULL, or NULL if there is none.
    Repeated rows stay. An empty table gives an empty result.
    """
    printed = stored(fingerprints(pick(docs, doc_id=id_col, text=text_col), shingle), "fingerprints")
    # Kept, so that the join can split a fingerprint that very many rows share.
    named = stored(classes(printed, radius=radius, tile=tile), "classes")
    return (printed.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id")))


def _hashable(name: str, kind: T.DataType) -> Column:
    """A column in a form that can be hashed. Maps count by their entries, whatever their order."""
    if isinstance(kind, T.MapType) and "map<" not in kind.keyType.simpleString() + kind.valueType.simpleString():
        return F.to_json(F.array_sort(F.map_entries(name)))
    return F.to_json(F.struct(name)) if "map<" in kind.simpleString() else F.col(name)


def keep_one(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row left of each component, all columns as they were: the row of the smallest
    id, then of the smallest row hash. A row without an id stays only if its component has no id.

    Rows are named by 128 bits of hash over all columns, maps included, so that ids that are NULL or repeat do no
    harm; of rows that are equal throughout, one stays.
    """
    names = docs.columns
    rows = numbered(docs)
    hashable = [_hashable(f.name, f.dataType) for f in rows.schema.fields]
    keyed = rows.withColumns({"k1": F.xxhash64(*hashable), "k2": F.xxhash64(F.lit(1), *hashable)})
    id_at, text_at = (f"c{place(names, c)}" for c in (id_col, text_col))
    printed = stored(fingerprints(keyed.select(F.col(id_at).alias("doc_id"), F.col(text_at).alias("text"), "k1", "k2"),
                                  shingle), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    # Copies share a fingerprint, and map tasks hand on the least row of each; only that one meets the classes.
    least = stored(printed.groupBy("fp").agg(F.min(rank).alias("rank")), "least")
    kept = (least.join(classes(printed, radius=radius, tile=tile), "fp").groupBy("root").agg(F.min("rank").alias("kept"))
            .select("kept.k1", "kept.k2"))
    return (keyed.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
            .drop("k1", "k2").toDF(*names))
