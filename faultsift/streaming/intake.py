"""Streams of investigations: incremental triage and bounded-memory dedup."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultsift.operators.filters import DEFAULT_DAYS, NOISE, actionable, cutoff, positive_days
from faultsift.operators.payloads import (
    MISSING,
    LandedTable,
    is_located,
    to_incidents,
    with_fingerprint,
    with_landed_bodies,
    with_outcome,
    with_uri,
)
from faultsift.operators.ranking import newest_per_key
from faultsift.plans.run import run_triage
from faultsift.plans.triage import slim
from faultsift.schemas import CANDIDATE_COLUMNS, CANDIDATES, INCIDENTS, MET, OUTCOMES, WAITING
from faultsift.sources.files import make_folder
from faultsift.sources.payloads import open_payload_table, read_landing_stream
from faultsift.sources.runs import claim_run, read_run, write_run

SALTS = 32

# What tells one waiting candidate from another.
SEEN_KEY = ["session_id", "s3_pointer", "timestamp"]


def intake(stream: DataFrame, noise: tuple[str, ...] = NOISE) -> DataFrame:
    """Actionable investigations in slim form; stateless."""
    return slim(actionable(stream, noise))


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the runs of a checkpoint; a new checkpoint has a new name."""
    path = f"{checkpoint.rstrip('/')}-writer"
    name = spark.createDataFrame([(f"stream-{uuid.uuid4().hex}",)], "writer STRING")
    name.coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema("writer STRING").parquet(path).first()["writer"]


def still_waiting(rows: DataFrame, days: int, now: datetime) -> DataFrame:
    """Candidates first seen at most ``days`` days before ``now``, by the clock of the runs.

    The times of the data have no say: one row with a clock far ahead would
    otherwise end the wait of all others.
    """
    return rows.where(F.col("first_seen") >= cutoff(days, now))


def start_triage(
    stream: DataFrame,
    payloads: Callable[[], DataFrame | LandedTable],
    endpoint_versions: Callable[[], DataFrame],
    out: str,
    ledger_path: str,
    checkpoint: str,
    days: int = DEFAULT_DAYS,
) -> StreamingQuery:
    """One triage run per micro-batch over all files that are new.

    The static sides are re-read for every batch. A candidate whose payload
    object is still missing is tried again with every batch for ``days`` days
    after it was first seen; the summary counts those given up. Run numbers come
    from the ledger, so batch jobs and other streams may share it. A replayed
    batch sees only the tables of earlier runs and overwrites its own drafts
    and ledger rows with the same content. The batch is written once, and only
    the tables of the stream's last run are read.
    """
    writer = writer_of(stream.sparkSession, checkpoint)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claim = claim_run(spark, ledger_path, writer, batch_id)
        write_run(batch, f"{out}/arrived", claim.run)
        arrived = read_run(spark, CANDIDATES, f"{out}/arrived", claim.run)
        earlier = spark.createDataFrame([], WAITING)
        if claim.previous is not None:
            earlier = read_run(spark, WAITING, f"{out}/waiting", claim.previous)
        again = still_waiting(earlier, days, claim.claimed_at)
        expired = earlier.count() - again.count()
        # What waits was the newest of its key once, and competes with none.
        found = newest_per_key(arrived, F.col("first_message"))
        found = found.unionByName(again.select(*CANDIDATE_COLUMNS))
        run_triage(
            found, payloads(), endpoint_versions(), out, ledger_path, writer, batch_id,
            expired=expired,
        )
        done = read_run(spark, OUTCOMES, f"{out}/outcomes", claim.run)
        missing = done.where(F.col("outcome") == MISSING).withColumnRenamed("id", "session_id")
        seen = again.groupBy(*SEEN_KEY).agg(F.min("first_seen").alias("first_seen"))
        waiting = missing.select(*CANDIDATE_COLUMNS).join(seen, SEEN_KEY, "left")
        first = F.coalesce("first_seen", F.lit(claim.claimed_at))
        waiting = waiting.select(*CANDIDATE_COLUMNS, first.alias("first_seen"))
        write_run(waiting, f"{out}/waiting", claim.run)

    return (
        intake(stream)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _first(rows: DataFrame, keys: list[str], salts: int) -> DataFrame:
    """The first row of a key within the watermark.

    Repeats go per (key, salt) first, so the task that owns a very frequent
    key sees at most ``salts`` rows of it per window.
    """
    salt = F.pmod(F.xxhash64("session_id", "s3_pointer", "timestamp"), F.lit(salts))
    return (
        rows.withColumn("salt", salt)
        .dropDuplicatesWithinWatermark([*keys, "salt"])
        .drop("salt")
        .dropDuplicatesWithinWatermark(keys)
    )


def meetings(stream: DataFrame, landings: DataFrame, days: int, salts: int = SALTS) -> DataFrame:
    """Candidates with the object they wait for: (candidate columns, obj_uri, landed_at).

    ``landings`` is a stream of (obj_uri, landed_at). Candidates and objects wait
    for each other up to ``days`` days, so either may come first; rows later
    than the watermark are dropped. The state holds keys, times and candidates,
    and no bodies. A fingerprint follows from message, functions and payload,
    so of the candidates that share them only the first waits: a pointer shared
    by very many candidates meets its object a few times.
    """
    delay = f"{positive_days(days)} days"
    located = with_uri(intake(stream)).where(is_located()).withWatermark("timestamp", delay)
    asked = _first(located, ["obj_uri", "first_message", "function_names"], salts)
    objects = landings.withWatermark("landed_at", delay).withColumnRenamed("obj_uri", "uri")
    window = F.expr(f"INTERVAL {positive_days(days)} DAYS")
    met = asked.join(
        objects,
        (F.col("obj_uri") == F.col("uri"))
        & (F.col("landed_at") >= F.col("timestamp") - window)
        & (F.col("landed_at") <= F.col("timestamp") + window),
    )
    return met.select(*CANDIDATE_COLUMNS, "obj_uri", "landed_at")


def first_arrivals(incidents: DataFrame, days: int, salts: int = SALTS) -> DataFrame:
    """The first arrived incident per fingerprint, remembered for ``days`` days.

    Unlike the batch rule this keeps the first to arrive, not the newest.
    """
    rows = incidents.withWatermark("timestamp", f"{positive_days(days)} days")
    first = _first(rows.withColumnRenamed("id", "session_id"), ["root_cause_hash"], salts)
    return first.withColumnRenamed("session_id", "id")


def start_first_arrivals(
    stream: DataFrame, payload_table: str, days: int, out: str, checkpoint: str
) -> StreamingQuery:
    """Write the first incident of each cause among new investigations and newly landed objects.

    Two queries, one after the other. The first lets candidates meet the keys
    of landed objects; the bodies of those that met are then read from the
    landed table, where the landing day, the bucket and the URI name few files,
    and become incidents. The second keeps the first incident per fingerprint.
    A batch replaces what it wrote before; an incident that is read twice is
    no first one. Returns the second query.
    """
    spark = stream.sparkSession
    folder = f"{checkpoint.rstrip('/')}-met"

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        write_run(batch, f"{folder}/keys", batch_id)
        met = read_run(batch.sparkSession, MET, f"{folder}/keys", batch_id)
        found = with_landed_bodies(met, open_payload_table(batch.sparkSession, payload_table))
        incidents = to_incidents(with_fingerprint(with_outcome(found)))
        write_run(incidents, f"{folder}/incidents", batch_id)

    make_folder(spark, f"{folder}/incidents")
    met = meetings(stream, read_landing_stream(spark, payload_table), days)
    (
        met.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{checkpoint}/meet")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    incidents = spark.readStream.schema(f"{INCIDENTS}, run BIGINT").parquet(f"{folder}/incidents")
    return (
        first_arrivals(incidents.drop("run"), days)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/first")
        .trigger(availableNow=True)
        .start(out)
    )
