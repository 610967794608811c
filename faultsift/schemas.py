"""Declared schemas of every table; nothing is inferred."""

from __future__ import annotations

# Newest-error table, one row per investigated flow.
INVESTIGATIONS = """
    account_id STRING, stable_runtime_scope_id STRING, session_id STRING,
    environment_id BIGINT, environment_name STRING,
    service_id BIGINT, service_name STRING,
    endpoint_id BIGINT, endpoint_uuid STRING,
    flow_type STRING, version STRING, s3_pointer STRING, timestamp TIMESTAMP,
    exceptions_data ARRAY<STRUCT<message: STRING, functions: ARRAY<STRING>>>,
    function_ids MAP<STRING, BIGINT>,
    exceptions_data_enriched ARRAY<STRUCT<message: STRING, ids: ARRAY<BIGINT>>>
"""

INVESTIGATION_COLUMNS = [
    "account_id", "stable_runtime_scope_id", "session_id",
    "environment_id", "environment_name", "service_id", "service_name",
    "endpoint_id", "endpoint_uuid", "flow_type", "version", "s3_pointer",
    "timestamp", "exceptions_data", "function_ids", "exceptions_data_enriched",
]

# The same rows as a JSON-lines extract: 64-bit integers may be quoted, tuples
# are unnamed JSON arrays, timestamps are text.
INVESTIGATION_JSON = """
    account_id STRING, stable_runtime_scope_id STRING, session_id STRING,
    environment_id STRING, environment_name STRING,
    service_id STRING, service_name STRING,
    endpoint_id STRING, endpoint_uuid STRING,
    flow_type STRING, version STRING, s3_pointer STRING, timestamp STRING,
    exceptions_data ARRAY<ARRAY<STRING>>,
    function_ids MAP<STRING, STRING>,
    exceptions_data_enriched ARRAY<ARRAY<STRING>>
"""

PAYLOADS = "obj_uri STRING, body STRING"

ENDPOINT_VERSIONS = """
    account_id STRING, environment_name STRING, endpoint_id BIGINT,
    ver BIGINT, path STRING, methods ARRAY<STRING>
"""

# The newest path and methods of an endpoint with their versions.
ENDPOINT_STATES = """
    account_id STRING, environment_name STRING, endpoint_id BIGINT,
    path_state STRUCT<ver: BIGINT, value: STRING>,
    methods_state STRUCT<ver: BIGINT, value: ARRAY<STRING>>
"""

ENDPOINT_KEY = ["account_id", "environment_name", "endpoint_id"]

INCIDENT_COLUMNS = [
    "id", "service_name", "endpoint_uuid", "endpoint_id", "account_id",
    "environment_name", "error_message", "stack_trace", "throwing_functions",
    "timestamp", "s3_pointer", "root_cause_hash",
]

INCIDENTS = """
    id STRING, service_name STRING, endpoint_uuid STRING, endpoint_id BIGINT, account_id STRING,
    environment_name STRING, error_message STRING, stack_trace STRING,
    throwing_functions ARRAY<STRING>, timestamp TIMESTAMP, s3_pointer STRING,
    root_cause_hash STRING
"""

LEDGER_COLUMNS = [
    "id", "root_cause_hash", "github_issue_number", "created_at", "error_pattern",
]

LEDGER = """
    id BIGINT, root_cause_hash STRING, github_issue_number BIGINT,
    created_at TIMESTAMP, error_pattern STRING
"""

APPROVALS = "root_cause_hash STRING"

# Staged tables of a run.
CANDIDATES = """
    session_id STRING, service_name STRING, endpoint_uuid STRING, endpoint_id BIGINT,
    account_id STRING, environment_name STRING, s3_pointer STRING, timestamp TIMESTAMP,
    first_message STRING, function_names ARRAY<STRING>
"""

CANDIDATE_COLUMNS = [
    "session_id", "service_name", "endpoint_uuid", "endpoint_id", "account_id",
    "environment_name", "s3_pointer", "timestamp", "first_message", "function_names",
]

# Candidates that met a landing of their object.
MET = CANDIDATES + ", obj_uri STRING, landed_at TIMESTAMP"

SKIPPED = "root_cause_hash STRING"

# Candidates whose payload object is missing, and when a stream first saw them.
WAITING = CANDIDATES + ", first_seen TIMESTAMP"

# New incidents with their endpoint.
FRESH = """
    id STRING, service_name STRING, endpoint_uuid STRING, endpoint_id BIGINT,
    account_id STRING, environment_name STRING, error_message STRING, stack_trace STRING,
    throwing_functions ARRAY<STRING>, timestamp TIMESTAMP, s3_pointer STRING,
    root_cause_hash STRING, endpoint_path STRING, endpoint_methods ARRAY<STRING>
"""

# What a person chooses from, and the numbers of the issues posted afterwards.
CHOICES = "root_cause_hash STRING, label STRING, short STRING"

POSTED = "root_cause_hash STRING, github_issue_number BIGINT"

OUTCOMES = """
    id STRING, service_name STRING, endpoint_uuid STRING, endpoint_id BIGINT,
    account_id STRING, environment_name STRING, s3_pointer STRING, timestamp TIMESTAMP,
    first_message STRING, function_names ARRAY<STRING>, obj_uri STRING, outcome STRING,
    payload_message STRING, stack_trace STRING, error_message STRING,
    throwing_functions ARRAY<STRING>, root_cause_hash STRING
"""
