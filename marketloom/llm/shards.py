"""Operator 4: place keys on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, a permutation
given by an offset and a stride. Shards take turns, each claiming its next free slot, until all are
taken: shares differ by at most one slot, and losing a shard moves few of the other slots. The table is
broadcast (its size is a parameter), so a key finds its shard by one hash and one lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import numbered, place

#: Slots of the table: a prime, and at least a hundred times the shards for even shares.
SLOTS = 65_537
#: A table may not be larger; that bounds what is broadcast (16 bytes a slot).
MOST_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """First slot and stride of a shard's order of preference."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard in ``shards``; each name once, at most one per slot."""
    if not _is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"{slots} is not a prime of at most {MOST_SLOTS}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, and each a slot")
    at = [preference(s, slots) for s in shards]
    following = [first for first, _ in at]
    owner = [-1] * slots
    free = slots
    while free:
        for shard, (_, stride) in enumerate(at[:free]):
            slot = following[shard]
            while owner[slot] >= 0:
                slot = (slot + stride) % slots
            owner[slot] = shard
            following[shard] = (slot + stride) % slots
        free -= min(free, len(at))
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 15 hex digits of its MD5, modulo the table's size. NULL keys
    count as the empty text, as one key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(slots))


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS, name: str = "shard") -> DataFrame:
    """The lookup table as rows slot, ``name``."""
    owners = lookup_table(shards, slots)
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(owners)], f"slot bigint, `{name}` string")


def assign(df: DataFrame, key: str, shards: Sequence[str], *, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of each row put behind its columns, in one pass without a shuffle.

    Equal keys share a shard, repeated rows too; NULL keys are one key. An empty table stays empty.
    Existing columns keep their names and places, even if they are called slot or shard.
    """
    names = df.columns
    spread = numbered(df)
    own = spread.withColumn("own_slot", slot_of(F.col(f"c{place(names, key)}"), slots))
    table = table_frame(df.sparkSession, shards, slots).withColumnsRenamed({"slot": "own_slot", "shard": "own_shard"})
    joined = own.join(F.broadcast(table), "own_slot")
    return joined.select(*[f"c{i}" for i in range(len(names))], "own_slot", "own_shard").toDF(*names, "slot", "shard")


def balance(placed: DataFrame, weight: Column | None = None) -> DataFrame:
    """Rows and weight (by default rows) of each shard; one row per shard that has any."""
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum(weight if weight is not None else F.lit(1)).alias("weight"))


def write(placed: DataFrame, path: str, *, files_per_shard: int = 1, key: str | None = None) -> None:
    """Write each shard to a folder of its own. Rows go out by shard and, to spread a large shard, by a hash of
    the rows among ``files_per_shard`` tasks; each task streams what it gets."""
    columns = [f.name for f in placed.schema.fields if "map<" not in f.dataType.simpleString()]
    part = F.pmod(F.xxhash64(*([key] if key else columns)), F.lit(files_per_shard))
    placed.repartition(F.col("shard"), part).write.partitionBy("shard").parquet(path)
