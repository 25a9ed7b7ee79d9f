"""Joining children to one parent row each when one key, or NULL, holds much of the children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(child: DataFrame, parent: DataFrame, key: str, spread_by: str, how: str = "inner") -> DataFrame:
    """``child`` joined (inner or left) to ``parent``, which has at most one row per key.

    Adaptive execution splits a heavy key if both sides come straight from a shuffle. A side that is
    itself grouped or ranked by the key would not be shuffled again, so the join has a second key that
    no earlier step can have dealt the rows by. It also deals out children whose key is NULL, by
    ``spread_by``, a column that tells children of one key apart.
    """
    dealt = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.xxhash64(key))
    return (child.withColumn("_deal", dealt).join(parent.withColumn("_deal", F.xxhash64(key)), [key, "_deal"], how)
            .drop("_deal"))
