"""Ledger of solved issues: lookups and replace-by-fingerprint."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultsift.schemas import LEDGER_COLUMNS

HASH = "root_cause_hash"


def unsolved(incidents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Incidents whose fingerprint the ledger does not hold.

    Deduplicated incidents are already partitioned by fingerprint, so a large
    ledger costs one shuffle of the ledger only.
    """
    return incidents.join(ledger.select(HASH), HASH, "left_anti")


def already_solved(incidents: DataFrame, ledger: DataFrame) -> DataFrame:
    return incidents.join(ledger.select(HASH), HASH, "left_semi")


def known_fingerprints(incidents: DataFrame, ledger: DataFrame) -> DataFrame:
    """Fingerprints of the incidents that the ledger holds, each once.

    The ledger is filtered by the fingerprints, so that few of them, of staged
    incidents, may be broadcast and a large ledger is then not shuffled.
    """
    wanted = incidents.select(HASH).distinct()
    return ledger.select(HASH).join(wanted, HASH, "left_semi").distinct()


def approved(incidents: DataFrame, approvals: DataFrame) -> DataFrame:
    """Incidents somebody approved; NULL approvals select nothing."""
    return incidents.join(approvals.select(HASH), HASH, "left_semi")


def lookup(ledger: DataFrame, hashes: list[str]) -> DataFrame:
    """The ledger rows of given fingerprints that have an issue number."""
    return ledger.where(F.col(HASH).isin(hashes) & F.col("github_issue_number").isNotNull())


def is_solved(ledger: DataFrame, root_cause_hash: str) -> bool:
    """Point lookup of one fingerprint: whether an issue was posted for it."""
    return not lookup(ledger, [root_cause_hash]).limit(1).isEmpty()


def latest_per_hash(rows: DataFrame) -> DataFrame:
    """The newest ledger row per fingerprint."""
    newest = Window.partitionBy(HASH).orderBy(F.desc("created_at"), F.desc("id"))
    return rows.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def upsert(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger after inserting ``rows`` or replacing rows of equal fingerprint."""
    both = ledger.select(*LEDGER_COLUMNS).unionByName(rows.select(*LEDGER_COLUMNS))
    return latest_per_hash(both)


def duplicate_fingerprints(ledger: DataFrame) -> DataFrame:
    """Fingerprints breaking the unique key; empty for a sound ledger."""
    return ledger.groupBy(HASH).agg(F.count("*").alias("rows")).where("rows > 1")


def posted_rows(
    posted: DataFrame, ledger: DataFrame, log: DataFrame, created_at: datetime | Column
) -> DataFrame:
    """Ledger rows that give drafted causes the numbers of their posted issues.

    ``posted`` has fingerprints and issue numbers; the newest number counts. A
    cause that the ledger does not hold is recorded too, without a message.
    """
    numbers = posted.where(F.col(HASH).isNotNull() & F.col("github_issue_number").isNotNull())
    numbers = numbers.groupBy(HASH).agg(F.max("github_issue_number").alias("github_issue_number"))
    known = ledger.select(HASH, F.col("error_pattern").alias("error_message"))
    issues = numbers.join(known, HASH, "left").withColumn(
        "error_message", F.coalesce("error_message", F.lit(""))
    )
    return solved_rows(issues.withColumn("id", F.lit(None)), log, created_at)


def newest_ledger_rows_first(ledger: DataFrame) -> DataFrame:
    return ledger.orderBy(F.desc("created_at"), F.desc("id"))


def last_id(ledger: DataFrame) -> Column:
    """Largest id as a scalar subquery, 0 for an empty ledger."""
    return F.coalesce(ledger.agg(F.max("id")).scalar(), F.lit(0))


def with_ids(rows: DataFrame, after: Column) -> DataFrame:
    """Number rows ``after + 1, after + 2, ...`` in order of fingerprint.

    Rows are counted and numbered within groups of one three-digit hash prefix,
    which SHA-256 fills evenly; only the 4096 prefix counts are ever in one
    task, and the numbers equal those of one global sort.
    """
    grouped = rows.withColumn("_prefix", F.substring(HASH, 1, 3))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        grouped.groupBy("_prefix")
        .agg(F.count("*").alias("n"))
        .select("_prefix", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_prefix").orderBy(HASH))
    return (
        grouped.join(F.broadcast(offsets), "_prefix")
        .withColumn("id", after + F.col("_before") + within)
        .drop("_prefix", "_before")
    )


def solved_rows(
    issues: DataFrame, ledger: DataFrame, created_at: datetime | Column
) -> DataFrame:
    """Ledger rows for issues holding a fingerprint, message and issue number.

    Without a number, or where it is NULL, an issue was drafted but not posted.
    """
    numbered = with_ids(issues.withColumnRenamed("id", "incident_id"), last_id(ledger))
    if "github_issue_number" not in numbered.columns:
        numbered = numbered.withColumn("github_issue_number", F.lit(None).cast("bigint"))
    created = created_at if isinstance(created_at, Column) else F.lit(created_at)
    return numbered.select(
        "id", HASH, "github_issue_number", created.alias("created_at"),
        F.col("error_message").alias("error_pattern"),
    )
