"""One triage run with its written outputs.

Outputs are tables with one directory per run: ``candidates``, ``outcomes``,
``skipped``, ``fresh``, ``choices``, ``drafts`` and ``summary`` below the output
folder, and the ledger. Each step is written before the next one reads it, so
nothing is computed twice, Spark knows the real size of every side of a join, a
lost executor costs one step at most, and repeating a run replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from faultsift.functions.issue import choice_label, choice_short
from faultsift.operators.ledger import approved, known_fingerprints, solved_rows, unsolved
from faultsift.operators.payloads import LandedTable, to_incidents, with_fingerprint
from faultsift.operators.ranking import newest_per_fingerprint
from faultsift.plans.report import SUMMARY, run_summary
from faultsift.plans.triage import outcomes, with_endpoints
from faultsift.schemas import (
    CANDIDATE_COLUMNS,
    CANDIDATES,
    CHOICES,
    FRESH,
    INCIDENT_COLUMNS,
    OUTCOMES,
    SKIPPED,
)
from faultsift.sources.drafts import DRAFTS, issue_drafts
from faultsift.sources.ledger import append_ledger, init_ledger, read_ledger_log
from faultsift.sources.runs import claim_run, finish_run, read_run, write_run


def run_triage(
    found: DataFrame,
    payloads: DataFrame | LandedTable,
    endpoint_versions: DataFrame,
    out: str,
    ledger_path: str,
    writer: str,
    batch: int = 0,
    approvals: DataFrame | None = None,
    cut: int | Callable[[], int] = 0,
    expired: int = 0,
) -> DataFrame:
    """Draft issues for the incidents among candidates ``found`` that the ledger lacks.

    Returns the one-row summary, also of a run without candidates. ``writer``
    and ``batch`` name the run: the same ones replace all of its tables, with
    the same number and time, whatever else used the ledger meanwhile. Drafts
    are written before the ledger: an interrupted run may draft an issue again
    but never records one that was not drafted. The ledger gets drafted causes
    without an issue number; ``record_posted`` adds it. Without ``approvals`` all
    new incidents are drafted. ``cut`` and ``expired`` are candidates that a cap
    or an age left out, for the summary; ``cut`` may be a function that is
    called once ``found`` has been written.
    """
    spark = found.sparkSession
    init_ledger(spark, ledger_path)
    claim = claim_run(spark, ledger_path, writer, batch)

    def staged(rows: DataFrame, schema: str, name: str) -> DataFrame:
        write_run(rows, f"{out}/{name}", claim.run)
        return read_run(spark, schema, f"{out}/{name}", claim.run)

    found = staged(found.select(*CANDIDATE_COLUMNS), CANDIDATES, "candidates")
    processed = staged(with_fingerprint(outcomes(found, payloads)), OUTCOMES, "outcomes")
    incidents = to_incidents(processed)

    ledger = read_ledger_log(spark, ledger_path, before=claim.run)
    skipped = staged(known_fingerprints(incidents, ledger), SKIPPED, "skipped")
    unknown = unsolved(newest_per_fingerprint(incidents), skipped).select(*INCIDENT_COLUMNS)
    fresh = staged(with_endpoints(unknown, endpoint_versions), FRESH, "fresh")
    choices = fresh.select(
        "root_cause_hash", choice_label().alias("label"), choice_short().alias("short")
    )
    staged(choices, CHOICES, "choices")
    chosen = fresh if approvals is None else approved(fresh, approvals)
    drafts = staged(issue_drafts(chosen), DRAFTS, "drafts")

    append_ledger(solved_rows(drafts, ledger, claim.claimed_at), ledger_path, claim.run)
    finish_run(spark, ledger_path, claim.run)
    summary = run_summary(processed, skipped, approvals, cut() if callable(cut) else cut, expired)
    return staged(summary, SUMMARY, "summary")
