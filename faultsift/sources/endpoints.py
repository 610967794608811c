"""Endpoint versions, and a stored table of their merged states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faultsift.operators.endpoints import endpoint_states, merge_states
from faultsift.schemas import ENDPOINT_STATES, ENDPOINT_VERSIONS
from faultsift.sources.increments import (
    MERGE_EVERY,
    checkpoint_of,
    init_increments,
    read_increments,
    write_increment,
)


def read_endpoint_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENDPOINT_VERSIONS).parquet(path)


def start_endpoint_states(
    spark: SparkSession, versions: str, table: str, every: int = MERGE_EVERY
) -> StreamingQuery:
    """Merge the version files that are new since the last call into the stored states.

    Only the new files are read, and the rows of the table only when a
    generation is due. Files may come in any order, as states are maxima.
    """
    init_increments(spark, table)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        states = endpoint_states(batch)
        write_increment(states, ENDPOINT_STATES, table, batch_id, merge_states, every=every)

    return (
        spark.readStream.schema(ENDPOINT_VERSIONS)
        .parquet(versions)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint_of(table))
        .trigger(availableNow=True)
        .start()
    )


def read_endpoint_states(spark: SparkSession, table: str) -> DataFrame:
    """The stored states; an endpoint may have several rows, for ``merge_states``."""
    return read_increments(spark, ENDPOINT_STATES, table)
