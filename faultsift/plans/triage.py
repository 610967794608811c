"""The triage steps as lazy DataFrame functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultsift.functions.fingerprint import named_functions
from faultsift.operators.endpoints import (
    endpoint_info,
    endpoint_states,
    enrich,
    merge_states,
    wanted_versions,
)
from faultsift.operators.filters import DEFAULT_DAYS, NOISE, actionable, first_message, lookback
from faultsift.operators.ledger import unsolved
from faultsift.operators.payloads import (
    LandedTable,
    join_payloads,
    left_join_payloads,
    to_incidents,
    with_fingerprint,
    with_outcome,
)
from faultsift.operators.ranking import newest, newest_per_fingerprint, newest_per_key
from faultsift.schemas import CANDIDATE_COLUMNS, INVESTIGATION_COLUMNS


def recent_investigations(
    investigations: DataFrame,
    days: int = DEFAULT_DAYS,
    as_of: datetime | Column | None = None,
    cap: int | None = None,
    noise: tuple[str, ...] = NOISE,
    date_column: str | None = None,
) -> DataFrame:
    """Newest actionable investigation per key, newest first, all 16 columns.

    All of them, or the ``cap`` newest.
    """
    recent = actionable(lookback(investigations, days, as_of, date_column), noise)
    return newest(newest_per_key(recent), cap).select(*INVESTIGATION_COLUMNS)


def slim(investigations: DataFrame) -> DataFrame:
    """What later steps read; nested data shrinks before the first shuffle."""
    slimmed = {
        "first_message": first_message(),
        "function_names": named_functions(F.col("function_ids")),
    }
    return investigations.select(
        *[slimmed.get(name, F.col(name)).alias(name) for name in CANDIDATE_COLUMNS]
    )


def candidates(
    investigations: DataFrame,
    days: int = DEFAULT_DAYS,
    as_of: datetime | Column | None = None,
    cap: int | None = None,
    noise: tuple[str, ...] = NOISE,
    date_column: str | None = None,
) -> DataFrame:
    """The rows of ``recent_investigations`` in slim form and in no order."""
    recent = actionable(lookback(investigations, days, as_of, date_column), noise)
    found = newest_per_key(slim(recent), F.col("first_message"))
    return found if cap is None else newest(found, cap)


def incidents(found: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """Fingerprinted incidents of candidates whose payload is usable."""
    return to_incidents(with_fingerprint(with_outcome(join_payloads(found, payloads))))


def outcomes(found: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """Every candidate with what became of its payload."""
    return with_outcome(left_join_payloads(found, payloads))


def distinct_incidents(found: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """The newest incident per fingerprint."""
    return newest_per_fingerprint(incidents(found, payloads))


def with_endpoints(rows: DataFrame, endpoint_versions: DataFrame) -> DataFrame:
    """Rows with the newest path and methods of their endpoint.

    Versions, or the rows of a table of states instead, are filtered by the
    wanted endpoints before they are aggregated. ``rows`` is used twice; stage
    it where it is costly.
    """
    versions = wanted_versions(endpoint_versions, rows)
    stored = "path_state" in versions.columns
    states = merge_states(versions) if stored else endpoint_states(versions)
    return enrich(rows, endpoint_info(states))


def new_incidents(
    found: DataFrame,
    payloads: DataFrame | LandedTable,
    endpoint_versions: DataFrame,
    ledger: DataFrame,
) -> DataFrame:
    """Distinct unsolved incidents with their endpoint.

    The ledger is checked before enrichment: the result is the same, it reuses
    the partitioning by fingerprint, and fewer rows are enriched.
    """
    unique = distinct_incidents(found, payloads)
    return with_endpoints(unsolved(unique, ledger), endpoint_versions)
