"""Small tables for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from faultsift.schemas import ENDPOINT_VERSIONS, INVESTIGATIONS, PAYLOADS

START = datetime(2024, 1, 10, tzinfo=timezone.utc)


def investigation(number, message="boom", minutes=0, **changes):
    """One investigation row as a dict; ``message=None`` means no exceptions."""
    exceptions = [] if message is None else [(message, ["f"]), ("second", [])]
    row = {
        "account_id": "acct", "stable_runtime_scope_id": "scope", "session_id": f"s-{number}",
        "environment_id": 1, "environment_name": "prod", "service_id": 1, "service_name": "svc",
        "endpoint_id": 1, "endpoint_uuid": "ep-1", "flow_type": "http", "version": "v1",
        "s3_pointer": f"s3://b/{number}.json", "timestamp": START + timedelta(minutes=minutes),
        "exceptions_data": exceptions, "function_ids": {"f": 1, " ": 2},
        "exceptions_data_enriched": [] if message is None else [(message, [1])],
    }
    return {**row, **changes}


def investigations(spark, rows):
    return spark.createDataFrame([tuple(row.values()) for row in rows], INVESTIGATIONS)


def payloads(spark, bodies):
    """``bodies`` maps object numbers to texts."""
    rows = [(f"s3a://b/{number}.json", body) for number, body in bodies.items()]
    return spark.createDataFrame(rows, PAYLOADS)


def endpoint_versions(spark, rows=()):
    return spark.createDataFrame(list(rows), ENDPOINT_VERSIONS)


def by_id(frame, key="id"):
    return {row[key]: row for row in frame.collect()}
