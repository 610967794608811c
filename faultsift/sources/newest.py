"""The newest candidate of each key and day, kept from run to run.

A key's newest row of a look-back is the newest of its newest rows by day: the
row that is newest on the first, partial day is inside the look-back, or none
of that day is. So a run merges one row a key and day instead of reading all
investigations again, and late rows only add to their day.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultsift.operators.filters import DEFAULT_DAYS, NOISE, actionable, lookback
from faultsift.operators.ranking import newest_per_day, newest_per_key
from faultsift.plans.triage import slim
from faultsift.schemas import CANDIDATE_COLUMNS, CANDIDATES
from faultsift.sources.increments import (
    MERGE_EVERY,
    checkpoint_of,
    init_increments,
    read_increments,
    write_increment,
)

DAY = "seen_on"
ROWS = f"{CANDIDATES}, {DAY} DATE"


def start_newest(
    stream: DataFrame, table: str, noise: tuple[str, ...] = NOISE, every: int = MERGE_EVERY
) -> StreamingQuery:
    """Add the investigations that are new since the last call; rows without a time are left out."""
    init_increments(stream.sparkSession, table)
    found = slim(actionable(stream, noise)).where("timestamp IS NOT NULL")
    found = found.withColumn(DAY, F.to_date("timestamp"))

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        write_increment(batch, ROWS, table, batch_id, lambda rows: newest_per_day(rows, DAY), (DAY,), every)

    return (
        found.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint_of(table))
        .trigger(availableNow=True)
        .start()
    )


def read_candidates(
    spark: SparkSession, table: str, days: int = DEFAULT_DAYS, as_of: datetime | Column | None = None
) -> DataFrame:
    """The newest actionable row per key of the last ``days`` days; only their folders are read."""
    rows = lookback(read_increments(spark, ROWS, table), days, as_of, DAY)
    return newest_per_key(rows, F.col("first_message")).select(*CANDIDATE_COLUMNS)
