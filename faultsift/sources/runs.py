"""Tables kept as one directory per run, and the numbers of runs.

A run reads the directories of earlier runs and overwrites only its own, so
repeating a failed run gives the same rows and never reads what it replaces.
Numbers are claimed beside the ledger that the runs share, by empty files in
one folder, so a claim costs no Spark job.
"""

from __future__ import annotations

import hashlib
import random
import time
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.sources.files import make_folder, names_in, put_marker, remove

# Kinds of marker files.
WANT, OWN, DONE, SNAPSHOT = "want", "own", "done", "snapshot"

# Numbers that writers in each other's way draw from, at most.
MOST_SPREAD = 256


def create_if_absent(spark: SparkSession, path: str) -> None:
    """An empty table, unless the path exists already; any number of writers may do so at once."""
    make_folder(spark, path)


def write_run(rows: DataFrame, path: str, run: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def read_runs(
    spark: SparkSession, schema: str, path: str, before: int | None = None
) -> DataFrame:
    """All rows with their run number, or those of runs before ``before``."""
    rows = spark.read.schema(f"{schema}, run BIGINT").parquet(path)
    return rows if before is None else rows.where(F.col("run") < before)


def read_run(spark: SparkSession, schema: str, path: str, run: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/run={run}")


@dataclass(frozen=True)
class Claim:
    """A run number, when it was claimed, and the writer's run before it."""

    run: int
    claimed_at: datetime
    previous: int | None


@dataclass(frozen=True, order=True)
class Marker:
    """What the name of a marker file says; ``writer`` is a hash, and times are seconds.

    The number is that of a run, or of a snapshot, which has the last run that
    it knows as its ``batch``.
    """

    number: int
    writer: str
    batch: int
    seconds: int
    token: str
    kind: str

    @property
    def name(self) -> str:
        return f"{self.number:012d}.{self.writer}.{self.batch}.{self.seconds}.{self.token}.{self.kind}"

    @classmethod
    def of(cls, name: str) -> Marker | None:
        parts = name.split(".")
        if len(parts) != 6:
            return None
        number, writer, batch, seconds, token, kind = parts
        return cls(int(number), writer, int(batch), int(seconds), token, kind)


def new_marker(number: int, kind: str, writer: str = "-", batch: int = 0) -> Marker:
    return Marker(number, writer, batch, int(time.time()), uuid.uuid4().hex, kind)


def _folder(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}-runs"


def markers(spark: SparkSession, ledger_path: str) -> list[Marker]:
    found = (Marker.of(name) for name in names_in(spark, _folder(ledger_path)))
    return sorted(marker for marker in found if marker)


def mark(spark: SparkSession, ledger_path: str, marker: Marker) -> None:
    put_marker(spark, f"{_folder(ledger_path)}/{marker.name}")


def unmark(spark: SparkSession, ledger_path: str, marker: Marker) -> None:
    remove(spark, f"{_folder(ledger_path)}/{marker.name}")


def _last(found: list[Marker]) -> int:
    """The largest run number that was ever wanted."""
    return max((m.batch if m.kind == SNAPSHOT else m.number for m in found), default=0)


def _writer_key(writer: str) -> str:
    return hashlib.sha256(writer.encode()).hexdigest()[:32]


def claim_run(spark: SparkSession, ledger_path: str, writer: str, batch: int = 0) -> Claim:
    """The run of a writer's batch: the one it has already, or a new, larger number.

    All jobs and streams that share a ledger take their numbers from it, and
    only the same writer and batch gets the same number again, to overwrite
    what it wrote. A writer says that it wants a number and looks again: it
    owns the number if no one else wants it, otherwise all who do leave it
    for good and draw from a wider range. Of two who want one number the later
    one sees the earlier, so no two can own it; nothing is ever overwritten
    or renamed, so any store that lists what was written will do.
    """
    make_folder(spark, _folder(ledger_path))
    key, spread = _writer_key(writer), 1
    while True:
        found = markers(spark, ledger_path)
        own = [m for m in found if m.kind == OWN and m.writer == key]
        for m in own:
            if m.batch == batch:
                before = max(((o.batch, o.number) for o in own if o.batch < batch), default=None)
                claimed_at = datetime.fromtimestamp(m.seconds)
                return Claim(m.number, claimed_at, before[1] if before else None)
        want = new_marker(_last(found) + 1 + random.randrange(spread), WANT, key, batch)
        mark(spark, ledger_path, want)
        found = markers(spark, ledger_path)
        rivals = [m for m in found if m.kind == WANT and m.number == want.number]
        # A snapshot that knows the number may have removed who wanted it before.
        if rivals == [want] and _last([m for m in found if m.kind == SNAPSHOT]) < want.number:
            mark(spark, ledger_path, Marker(want.number, key, batch, want.seconds, want.token, OWN))
        else:
            spread = min(MOST_SPREAD, 4 * spread)


def finish_run(spark: SparkSession, ledger_path: str, run: int) -> None:
    """Says that a run's ledger rows are all written, so that a snapshot may hold them."""
    mark(spark, ledger_path, new_marker(run, DONE))


def carry_claims(spark: SparkSession, ledger_path: str, new_path: str) -> int:
    """Puts each writer's last claim beside another ledger; returns the last run."""
    own = [m for m in markers(spark, ledger_path) if m.kind == OWN]
    make_folder(spark, _folder(new_path))
    for m in {m.writer: m for m in own}.values():
        mark(spark, new_path, m)
    return own[-1].number if own else 0
