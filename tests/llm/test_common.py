"""What worker processes remember, and rows told apart by a bitmap."""

import pyarrow as pa

from marketloom.llm import common, packing, substring
from marketloom.llm.queries import vocabulary


def test_a_worker_remembers_for_one_operator_at_a_time():
    batch = pa.RecordBatch.from_arrays([pa.array([b"some words"], pa.binary())], ["text"])
    list(common.steps([batch], "text", holder="words"))
    substring.word_hashes([b"some", b"words"])
    list(common.steps([batch], "text", holder="words"))
    assert len(substring._remembered) >= 2
    packing.library_ids(vocabulary())
    list(common.steps([batch], "text", holder="tokens"))
    assert not substring._remembered and packing.library_ids.cache_info().currsize == 1
    list(common.steps([batch], "text"))
    assert packing.library_ids.cache_info().currsize == 0


def test_flags_by_bitmap(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    ids = spark.range(0, 20_000, 37).withColumnRenamed("id", "k")
    flagged = common.maybe_among(rows, "k", ids)
    assert flagged.columns == ["k", "maybe"] and flagged.count() == 20_000
    assert flagged.where("k % 37 = 0 and not maybe").count() == 0 and flagged.where("maybe").count() < 1.05 * ids.count()
    assert common.maybe_among(rows, "k", ids.limit(0)).where("maybe").count() == 0
