"""Tables of mergeable rows: what each batch added, and from time to time all of it merged.

A batch writes only its own increment, so its cost follows the new rows. After
every ``MERGE_EVERY`` batches all rows so far are merged into a new generation;
it counts from when its marker is written, and what it replaced is removed one
generation later, so readers under way are not disturbed. A repeated batch
replaces its own increment with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.sources.files import make_folder, names_in, put_marker, remove
from faultsift.sources.runs import read_runs

MERGE_EVERY = 16


def _generations(spark: SparkSession, table: str) -> list[int]:
    return [int(name) for name in names_in(spark, f"{table}/complete")]


def checkpoint_of(table: str) -> str:
    """Batches are numbered by one checkpoint, which belongs to the table."""
    return f"{table}/checkpoint"


def init_increments(spark: SparkSession, table: str) -> None:
    for name in ("new", "merged", "complete"):
        make_folder(spark, f"{table}/{name}")


def read_increments(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """The rows of the last generation and of the increments after it, not merged with each other."""
    last = max(_generations(spark, table), default=-1)
    rows = read_runs(spark, schema, f"{table}/new").where(F.col("run") > last)
    if last >= 0:
        merged = read_runs(spark, schema, f"{table}/merged").where(F.col("run") == last)
        rows = rows.unionByName(merged)
    return rows.drop("run")


def write_increment(
    rows: DataFrame,
    schema: str,
    table: str,
    batch: int,
    merge: Callable[[DataFrame], DataFrame],
    partitions: tuple[str, ...] = (),
    every: int = MERGE_EVERY,
) -> None:
    """Adds the merged rows of a batch, and a generation where one is due."""
    spark = rows.sparkSession

    def write(frame: DataFrame, name: str) -> None:
        out = frame.write.mode("overwrite")
        out = out.partitionBy(*partitions) if partitions else out
        out.parquet(f"{table}/{name}/run={batch}")

    write(merge(rows), "new")
    older = _generations(spark, table)
    if (batch + 1) % every or batch in older:
        return
    write(merge(read_increments(spark, schema, table)), "merged")
    put_marker(spark, f"{table}/complete/{batch:012d}")
    if older:
        replaced = max(older)
        for name in names_in(spark, f"{table}/new"):
            if name.startswith("run=") and int(name[4:]) <= replaced:
                remove(spark, f"{table}/new/{name}")
        for number in older[:-1]:
            remove(spark, f"{table}/complete/{number:012d}")
            remove(spark, f"{table}/merged/run={number}")
