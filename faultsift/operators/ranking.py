"""Newest-row selection and top-k.

Each "newest per key" is a ``row_number`` filtered to 1. Catalyst turns that
into a group limit on both sides of the exchange: every map task sends at most
one row per key, so a key holding a third of all rows does not burden a reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultsift.operators.filters import first_message

def dedup_key(message: Column | None = None) -> Column:
    """``service|endpoint|first message``; absent parts count as empty text."""
    message = first_message() if message is None else message
    parts = [F.col("service_name"), F.col("endpoint_uuid"), message]
    return F.concat_ws("|", *[F.coalesce(part, F.lit("")) for part in parts])


def _newest_order(row_id: str) -> list[Column]:
    """Newest first; equal times are decided by id and pointer, so a repeated
    task gives the same rows."""
    return [F.desc("timestamp"), F.asc(row_id), F.asc("s3_pointer")]


def _newest_per(rows: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    newest = Window.partitionBy(*keys).orderBy(*_newest_order(row_id))
    return rows.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def newest_per_key(investigations: DataFrame, message: Column | None = None) -> DataFrame:
    """The newest row per dedup key (service, endpoint, first message).

    A hash leads the key, so that sorting compares numbers and not long texts
    with equal beginnings.
    """
    keyed = investigations.withColumn("_key", dedup_key(message))
    keyed = keyed.withColumn("_hash", F.xxhash64("_key"))
    return _newest_per(keyed, ["_hash", "_key"], "session_id").drop("_hash", "_key")


def newest_per_day(candidates: DataFrame, day: str) -> DataFrame:
    """The newest candidate per dedup key and day; such rows may be merged in any order."""
    keyed = candidates.withColumn("_key", dedup_key(F.col("first_message")))
    keyed = keyed.withColumn("_hash", F.xxhash64("_key"))
    return _newest_per(keyed, [day, "_hash", "_key"], "session_id").drop("_hash", "_key")


def newest_per_fingerprint(incidents: DataFrame) -> DataFrame:
    """The newest row per root-cause fingerprint."""
    return _newest_per(incidents, ["root_cause_hash"], "id")


def newest_first(rows: DataFrame, row_id: str = "session_id") -> DataFrame:
    return rows.orderBy(*_newest_order(row_id))


def newest(rows: DataFrame, cap: int | None = None, row_id: str = "session_id") -> DataFrame:
    """All rows, newest first, or the ``cap`` newest of them."""
    ordered = newest_first(rows, row_id)
    return ordered if cap is None else ordered.limit(cap)
