"""Issue drafts, written instead of posting issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultsift.functions.issue import (
    DETECTED_BY,
    ISSUE_LABELS,
    issue_body,
    issue_title,
    progress_text,
)

DRAFTS = """
    root_cause_hash STRING, id STRING, error_message STRING, title STRING,
    body STRING, labels ARRAY<STRING>, progress STRING
"""


def issue_drafts(
    incidents: DataFrame, detected_by: str = DETECTED_BY, preamble: str = ""
) -> DataFrame:
    """One draft per enriched incident, keyed by its fingerprint."""
    return incidents.select(
        "root_cause_hash", "id", "error_message",
        issue_title().alias("title"),
        issue_body(detected_by, preamble).alias("body"),
        F.array(*[F.lit(label) for label in ISSUE_LABELS]).alias("labels"),
        progress_text().alias("progress"),
    )
