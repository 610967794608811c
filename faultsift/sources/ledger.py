"""Ledger of drafted and posted issues: a log of runs, and a snapshot of the finished ones.

A run adds one directory and replaces only its own. ``snapshot_ledger`` writes
the rows of all finished runs anew, by beginnings of the fingerprint, while
other runs go on: a snapshot counts from when its marker is written, and names
the runs that it does not hold.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.operators.ledger import HASH, duplicate_fingerprints, latest_per_hash, lookup, posted_rows
from faultsift.schemas import LEDGER, LEDGER_COLUMNS
from faultsift.sources.files import names_in, remove
from faultsift.sources.runs import (
    DONE,
    OWN,
    SNAPSHOT,
    WANT,
    Marker,
    carry_claims,
    claim_run,
    create_if_absent,
    finish_run,
    mark,
    markers,
    new_marker,
    read_runs,
    unmark,
    write_run,
)

# Letters of the fingerprint that a snapshot's folders have: 256 folders.
PREFIX = 2

# A snapshot's rows: ``first_run`` is the first run that recorded the fingerprint.
ROWS = LEDGER + ", first_run BIGINT, prefix STRING"

# Runs up to ``upto`` are in the snapshot, but for those left out: under way, or numbers no run had then.
HELD = "upto BIGINT, left_out ARRAY<BIGINT>"


@dataclass(frozen=True)
class Snapshot:
    path: str
    seconds: int
    upto: int
    left_out: tuple[int, ...]

    def holds(self, run: int) -> bool:
        return run <= self.upto and run not in self.left_out


def init_ledger(spark: SparkSession, path: str) -> None:
    create_if_absent(spark, path)


def _snapshot_path(path: str, marker: Marker) -> str:
    return f"{path.rstrip('/')}-snapshots/{marker.number}-{marker.token}"


def current_snapshot(spark: SparkSession, path: str, found: list[Marker] | None = None) -> Snapshot | None:
    """The last one; of several of one number, made at the same time, always the same one."""
    found = markers(spark, path) if found is None else found
    made = [m for m in found if m.kind == SNAPSHOT]
    if not made:
        return None
    own = _snapshot_path(path, made[-1])
    row = spark.read.schema(HELD).parquet(f"{own}/held").first()
    return Snapshot(own, made[-1].seconds, row.upto, tuple(row.left_out))


def _after(snapshot: Snapshot | None, rows: DataFrame) -> DataFrame:
    """The rows of a log that a snapshot does not hold; whole directories are left unread."""
    if snapshot is None:
        return rows
    return rows.where((F.col("run") > snapshot.upto) | F.col("run").isin(list(snapshot.left_out)))


def _snapshot_rows(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    return spark.read.schema(ROWS).parquet(f"{snapshot.path}/rows")


def read_ledger_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """All rows, replaced ones included as far as no snapshot holds their run.

    Enough to look fingerprints up and to find the last id, and cheaper than
    the current ledger. ``before`` leaves out fingerprints first recorded by
    later runs.
    """
    snapshot = current_snapshot(spark, path)
    log = _after(snapshot, read_runs(spark, LEDGER, path, before)).select(*LEDGER_COLUMNS)
    if snapshot is None:
        return log
    held = _snapshot_rows(spark, snapshot)
    if before is not None:
        held = held.where(F.col("first_run") < before)
    return held.select(*LEDGER_COLUMNS).unionByName(log)


def read_ledger(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Current ledger: the newest row per fingerprint."""
    return latest_per_hash(read_ledger_log(spark, path, before))


def find_posted(spark: SparkSession, path: str, hashes: list[str]) -> DataFrame:
    """The current rows of given fingerprints that have an issue number.

    Of a snapshot only the folders of their beginnings are opened, and in them
    only files whose Bloom filter has one of them.
    """
    snapshot = current_snapshot(spark, path)
    wanted = F.col(HASH).isin(hashes)
    rows = _after(snapshot, read_runs(spark, LEDGER, path)).where(wanted).select(*LEDGER_COLUMNS)
    if snapshot is not None:
        held = _snapshot_rows(spark, snapshot)
        held = held.where(F.col("prefix").isin(sorted({h[:PREFIX] for h in hashes})) & wanted)
        rows = rows.unionByName(held.select(*LEDGER_COLUMNS))
    return lookup(latest_per_hash(rows), hashes)


def append_ledger(rows: DataFrame, path: str, run: int) -> None:
    """Insert or replace by fingerprint, as the rows of one run.

    Rows need an id, a fingerprint, a time and a text, and fingerprints must be
    unique: a violation fails the write, or is found in what was written, which
    is then emptied. A finished run that a snapshot holds is not written again.
    """
    needed = ["id", HASH, "created_at", "error_pattern"]
    checked = rows.select(*LEDGER_COLUMNS)
    for name in needed:
        value = F.when(F.col(name).isNotNull(), F.col(name))
        message = F.lit(f"ledger rows need {name}")
        checked = checked.withColumn(name, F.coalesce(value, F.raise_error(message).cast(checked.schema[name].dataType)))
    spark = rows.sparkSession
    snapshot = current_snapshot(spark, path)
    if snapshot is not None and snapshot.holds(run):
        return
    write_run(checked, path, run)
    written = spark.read.schema(LEDGER).parquet(f"{path}/run={run}")
    if not duplicate_fingerprints(written).isEmpty():
        write_run(spark.createDataFrame([], LEDGER), path, run)
        raise ValueError(f"fingerprints repeat in the ledger rows of run {run}")


def record_posted(
    spark: SparkSession, posted: DataFrame, path: str, writer: str, batch: int = 0
) -> None:
    """Give causes the numbers of their posted issues, as a run of its own."""
    init_ledger(spark, path)
    claim = claim_run(spark, path, writer, batch)
    log = read_ledger_log(spark, path, before=claim.run)
    rows = posted_rows(posted, latest_per_hash(log), log, claim.claimed_at)
    append_ledger(rows, path, claim.run)
    finish_run(spark, path, claim.run)


def compact_ledger(spark: SparkSession, path: str, new_path: str) -> None:
    """Write the current ledger to a new path as one run, with the last claims.

    For a time when no run is under way; later runs go on with the new path.
    ``snapshot_ledger`` needs neither.
    """
    init_ledger(spark, new_path)
    append_ledger(read_ledger(spark, path), new_path, carry_claims(spark, path, new_path))


def snapshot_ledger(spark: SparkSession, path: str) -> Snapshot | None:
    """Write the newest row of each fingerprint of all finished runs anew; runs may be under way.

    A run that is claimed and not finished is left out and stays in the log. The
    old snapshot and the log stay as they are, and readers see the new snapshot
    once all of it is written. Claims that no writer needs any more are removed,
    so a claim looks at one file a writer and one a run since. Two snapshots at
    a time do no harm: one of them counts. Returns the one that counts, or None
    if there is nothing to hold.
    """
    found = markers(spark, path)
    old = current_snapshot(spark, path, found)
    done = {m.number for m in found if m.kind == DONE}
    claimed = {m.number for m in found if m.kind in (WANT, OWN)}
    listed = {int(name[4:]) for name in names_in(spark, path) if name.startswith("run=")}
    if old is not None:
        listed = {run for run in listed if not old.holds(run)}
    held = {run for run in listed if run in done or run not in claimed}
    if not held:
        return old
    upto = max([*held, old.upto if old else 0])
    left_out = [n for n in range(upto) if n not in held and not (old and old.holds(n))]
    number = max((m.number for m in found if m.kind == SNAPSHOT), default=0) + 1
    marker = new_marker(number, SNAPSHOT, batch=upto)
    new = _snapshot_path(path, marker)
    rows = read_runs(spark, LEDGER, path).where(F.col("run").isin(sorted(held)))
    rows = rows.withColumnRenamed("run", "first_run")
    if old is not None:
        rows = rows.unionByName(_snapshot_rows(spark, old).drop("prefix"))
    first = F.min("first_run").over(Window.partitionBy(HASH))
    rows = latest_per_hash(rows.withColumn("first_run", first))
    rows = rows.withColumn("prefix", F.substring(HASH, 1, PREFIX))
    (
        rows.select(*LEDGER_COLUMNS, "first_run", "prefix")
        .repartition("prefix")
        .sortWithinPartitions("prefix", HASH)
        .write.option(f"parquet.bloom.filter.enabled#{HASH}", "true")
        .partitionBy("prefix")
        .parquet(f"{new}/rows")
    )
    spark.createDataFrame([(upto, left_out)], HELD).coalesce(1).write.parquet(f"{new}/held")
    mark(spark, path, marker)
    snapshot = current_snapshot(spark, path)
    last = {m.writer: m.number for m in found if m.kind == OWN}
    for m in found:
        needed = m.kind == OWN and last[m.writer] == m.number
        if m.kind != SNAPSHOT and not needed and snapshot.holds(m.number):
            unmark(spark, path, m)
    return snapshot


def vacuum_ledger(spark: SparkSession, path: str, seconds: int = 86_400) -> None:
    """Remove what the current snapshot replaced, if it is that old: no reader may still use it."""
    found = markers(spark, path)
    snapshot = current_snapshot(spark, path, found)
    if snapshot is None or snapshot.seconds > time.time() - seconds:
        return
    for name in names_in(spark, path):
        if name.startswith("run=") and snapshot.holds(int(name[4:])):
            remove(spark, f"{path}/{name}")
    for m in found:
        if m.kind == SNAPSHOT and _snapshot_path(path, m) != snapshot.path:
            unmark(spark, path, m)
            remove(spark, _snapshot_path(path, m))
