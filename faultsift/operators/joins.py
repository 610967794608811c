"""A join helper for large and for skewed sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join led by a hash of its keys, for large or skewed sides.

    Sorting compares the hashes and not long keys with equal beginnings. And a
    side that was just aggregated by ``keys`` gets an exchange of its own: AQE
    splits a hot key only between two exchanges made for the join. There is no
    hint: Spark compares the real size of a side with its threshold.
    """
    key_hash = F.xxhash64(*keys)
    return (
        left.withColumn("_hash", key_hash)
        .join(right.withColumn("_hash", key_hash), ["_hash", *keys], how)
        .drop("_hash")
    )
