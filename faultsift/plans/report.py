"""Run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultsift.operators.ledger import HASH
from faultsift.operators.payloads import INVALID, MISSING, NON_STRING, TOO_LARGE, UNLOCATABLE

REASONS = (MISSING, UNLOCATABLE, INVALID, TOO_LARGE, NON_STRING)

SUMMARY = """
    total BIGINT, cut BIGINT, expired BIGINT, processed BIGINT, successful BIGINT,
    missing BIGINT, unlocatable BIGINT, invalid BIGINT, too_large BIGINT, non_string BIGINT,
    unique_incidents BIGINT, skipped BIGINT, new BIGINT, created BIGINT, percent BIGINT
"""


def run_summary(
    fingerprinted: DataFrame,
    ledger: DataFrame,
    approvals: DataFrame | None = None,
    cut: int = 0,
    expired: int = 0,
) -> DataFrame:
    """One row of counters over all fingerprinted outcomes of a run.

    ``processed`` are the candidates whose payload was found, ``successful``
    those that gave an incident, ``percent`` is successful of total (NULL without
    candidates), and each reject is counted by its reason. Rows are counted per
    fingerprint and outcome before they meet the ledger (rejects share the NULL
    fingerprint), so each map task shuffles at most one row per fingerprint.
    Without ``approvals`` every new incident counts as created.
    """
    per_hash = fingerprinted.groupBy(HASH, "outcome").agg(F.count("*").alias("n"))
    solved = ledger.select(HASH).distinct().withColumn("solved", F.lit(True))
    flagged = per_hash.join(solved, HASH, "left")
    if approvals is None:
        flagged = flagged.withColumn("approved", F.lit(True))
    else:
        wanted = approvals.select(HASH).distinct().withColumn("approved", F.lit(True))
        flagged = flagged.join(wanted, HASH, "left")
    usable = F.col(HASH).isNotNull()
    fresh = usable & F.col("solved").isNull()

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    absent = F.col("outcome").isin(MISSING, UNLOCATABLE)
    return flagged.agg(
        rows_where(F.lit(True)).alias("total"),
        F.lit(cut).cast("bigint").alias("cut"),
        F.lit(expired).cast("bigint").alias("expired"),
        rows_where(~absent).alias("processed"),
        rows_where(usable).alias("successful"),
        *[rows_where(F.col("outcome") == reason).alias(reason) for reason in REASONS],
        F.count_if(usable).alias("unique_incidents"),
        F.count_if(usable & F.col("solved").isNotNull()).alias("skipped"),
        F.count_if(fresh).alias("new"),
        F.count_if(fresh & F.col("approved").isNotNull()).alias("created"),
    ).withColumn(
        "percent",
        F.round(F.try_divide(100 * F.col("successful"), F.col("total"))).cast("bigint"),
    )
