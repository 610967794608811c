"""Latest path and methods per endpoint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultsift.operators.joins import hashed_join
from faultsift.schemas import ENDPOINT_KEY

# Fixed value: path of an endpoint that never had one.
UNKNOWN_PATH = "Unknown path"


def _state(value: str) -> Column:
    """Largest (ver, value) among rows that have the value.

    A maximum of structs merges in any order and any number of steps, and is
    deterministic when versions tie.
    """
    state = F.struct(F.col("ver"), F.col(value).alias("value"))
    return F.max(F.when(F.col(value).isNotNull(), state))


def endpoint_states(versions: DataFrame) -> DataFrame:
    """One mergeable state row per endpoint."""
    return versions.groupBy(*ENDPOINT_KEY).agg(
        _state("path").alias("path_state"), _state("methods").alias("methods_state")
    )


def merge_states(*parts: DataFrame) -> DataFrame:
    """Combine state tables, for example yesterday's and today's."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*ENDPOINT_KEY).agg(
        F.max("path_state").alias("path_state"),
        F.max("methods_state").alias("methods_state"),
    )


def endpoint_info(states: DataFrame) -> DataFrame:
    """Endpoint path and methods, with defaults for what no version had."""
    path = F.nullif(F.col("path_state.value"), F.lit(""))
    methods = F.col("methods_state.value")
    return states.select(
        *ENDPOINT_KEY,
        F.coalesce(path, F.lit(UNKNOWN_PATH)).alias("endpoint_path"),
        F.coalesce(methods, F.array().cast("array<string>")).alias("endpoint_methods"),
    )


def wanted_endpoints(incidents: DataFrame) -> DataFrame:
    """Distinct endpoint keys of the incidents."""
    return incidents.select(*ENDPOINT_KEY).distinct()


def wanted_versions(versions: DataFrame, incidents: DataFrame) -> DataFrame:
    """Version rows of the endpoints the incidents name; none for no incidents."""
    return hashed_join(versions, wanted_endpoints(incidents), ENDPOINT_KEY, "left_semi")


def endpoints_by_id(
    versions: DataFrame, account_id: str, environment_name: str, endpoint_ids: list[int]
) -> DataFrame:
    """Path and methods of given endpoints; no ids give no rows."""
    chosen = versions.where(
        (F.col("account_id") == account_id)
        & (F.col("environment_name") == environment_name)
        & F.col("endpoint_id").isin(endpoint_ids)
    )
    return endpoint_info(endpoint_states(chosen)).select(
        F.col("endpoint_id").alias("id"),
        F.col("endpoint_path").alias("path"),
        F.col("endpoint_methods").alias("methods"),
    )


def enrich(incidents: DataFrame, info: DataFrame) -> DataFrame:
    """Attach path and methods; both stay NULL for an unknown endpoint."""
    return hashed_join(incidents, info, ENDPOINT_KEY, "left")


def incidents_by_account_env(incidents: DataFrame) -> DataFrame:
    """Incident and distinct-endpoint counts per account and environment.

    Counted per endpoint first, so no set of endpoint ids is held for a group.
    """
    per_endpoint = incidents.groupBy(*ENDPOINT_KEY).agg(F.count("*").alias("n"))
    return per_endpoint.groupBy("account_id", "environment_name").agg(
        F.sum("n").alias("incidents"), F.count("*").alias("endpoints")
    )
