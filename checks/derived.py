"""Triage inputs as Spark views over the ``events`` table.

Every event becomes one investigation. Payload objects are missing for every
13th error, every 23rd pointer is no URL and endpoints 10 and 11 have no
versions, so that the unmatched cases of the joins occur. Every 11th event names
more functions than are kept, payloads hold contexts and values of other types,
endpoint 8 never has methods, endpoint 9 an empty list, and the newest version
of endpoint 3 has two paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.operators.payloads import once
from faultsift.schemas import INVESTIGATION_COLUMNS

EVENTS = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
    value DOUBLE, props STRING
"""

CONVERSATIONS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"

EXCEPTIONS = "array<struct<message:string,functions:array<string>>>"
ENRICHED = "array<struct<message:string,ids:array<bigint>>>"

# Both engines evaluate these.
OWNER = {
    "account_id": "concat('acct-', user_id % 5)",
    "environment_name": "CASE user_id % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'staging' ELSE 'dev' END",
    "endpoint_id": "event_id % 12",
}

SCALARS = {
    **OWNER,
    "stable_runtime_scope_id": "concat('scope-', user_id % 9)",
    "session_id": "concat('s-', event_id)",
    "environment_id": "user_id % 3",
    "service_id": "user_id % 7",
    "service_name": "concat('svc-', user_id % 7)",
    "endpoint_uuid": "concat('ep-', event_id % 12)",
    "flow_type": "event_type",
    "version": "concat('v', event_id % 4)",
    "s3_pointer": """CASE WHEN event_id % 17 = 0 THEN ''
        WHEN event_id % 23 = 0 THEN 'not a url'
        WHEN event_id % 2 = 0 THEN concat('s3://incidents/flows/', event_id, '.json')
        ELSE concat('https://incidents.storage.example.com/flows/', event_id, '.json')
        END""",
}

MESSAGE = """CASE k % 8
    WHEN 0 THEN concat('Request Timeout after ', event_id, 'ms')
    WHEN 1 THEN 'operation cancelled by user'
    WHEN 2 THEN 'Connection ABORTED by peer'
    WHEN 3 THEN ''
    WHEN 4 THEN concat('Cannot read property "id" of undefined at index ', event_id)
    WHEN 5 THEN concat('Order   ', event_id, ' not found')
    WHEN 6 THEN concat('Null value in column ', chr(39), 'price', chr(39))
    ELSE 'Division by zero' END"""

FUNCTION = "concat('fn', user_id % 40, '.run')"

URI = "concat('s3a://incidents/flows/', event_id, '.json')"

# ``{raw}`` is r for Spark SQL and empty for SQL without backslash escapes.
BODY = r"""CASE WHEN event_id % 29 = 0 THEN 'not json'
    WHEN event_id % 31 = 0 THEN '{{"message":7}}'
    WHEN event_id % 37 = 0 THEN '{{"error":"Fell through","error_message":0,"message":false}}'
    WHEN event_id % 41 = 0 THEN '{{"message":"listed","stack_trace":[1]}}'
    WHEN event_id % 43 = 0 THEN concat('{{"x":', repeat('[', 1500), repeat(']', 1500),
        ',"context":{{"c":1}},"message":"deep ', event_id, '"}}')
    WHEN event_id % 47 = 0 THEN concat('{{"error":"long number","context":{{"b":2}},"n":1', repeat('0', 1200), '}}')
    WHEN event_id % 53 = 0 THEN concat(repeat('[', 1100), '{{"message":"unclosed"')
    WHEN event_id % 4 = 0 THEN concat({raw}'{{"error_message":"DB error ', event_id,
        {raw}'","stack_trace":"Error: x\n    at repo.find (r.js:1)\n    at async load\n    at repo.find (r.js:9)"}}')
    WHEN event_id % 4 = 1 THEN concat({raw}'{{"message":"Bad  \"input\" ', event_id,
        {raw}'","stackTrace":"E\n at Svc.call (s.js:3)"}}')
    WHEN event_id % 4 = 2 THEN '{{"error":"","message":null}}'
    WHEN event_id % 3 = 0 THEN '{{"context":{{"a":1}},"x":2}}'
    ELSE '{{}}' END"""

HAS_OBJECT = "event_type = 'error' AND event_id % 13 <> 0"

PART = "event_id % 3"

VER = "cast(floor(event_id / 12) AS bigint) % 5"

# Version 4 of endpoint 3 is listed twice.
PATH = """CASE WHEN endpoint_id = 7 OR (ver + endpoint_id) % 4 = 3 AND NOT twice THEN NULL
    ELSE concat('/api/', endpoint_id, '/v', ver, CASE WHEN twice THEN 'b' ELSE '' END) END"""

TWICE = "endpoint_id = 3 AND ver = 4"

# More names than the ten that are kept, for every 11th event.
MORE = 12
MORE_NAMES = ", ".join(f"concat('more{n}.f', user_id % 7)" for n in range(MORE))
MORE_IDS = ", ".join(f"cast({n} AS bigint)" for n in range(MORE))
HAS_MORE = "event_id % 11 = 0"


def _exprs(columns: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in columns.items()]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, folder: str, files_a_batch: int = 1000) -> DataFrame:
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_a_batch)
    return rows.parquet(folder)


def parted_events(events: DataFrame, folder: str) -> None:
    """The events in three files, dealt by their number."""
    dealt = events.withColumn("part", F.expr(PART))
    dealt.repartition("part").write.partitionBy("part").parquet(folder)


def investigations(events: DataFrame) -> DataFrame:
    is_error = F.col("event_type") == "error"
    # Evaluated once per row, as if it were a stored column.
    rows = once(events, "k", F.get_json_object("props", "$.k").cast("int"))
    rows = rows.withColumns({"f1": F.expr(FUNCTION), "timestamp": F.col("ts").cast("timestamp")})
    rows = once(rows, "msg", F.expr(MESSAGE))
    exceptions = F.array(
        F.struct(F.col("msg").alias("message"), F.array("f1").alias("functions"))
    )
    enriched = F.array(
        F.struct(F.col("msg").alias("message"), F.array("event_id").alias("ids"))
    )
    nested = [
        F.when(is_error, exceptions).otherwise(F.array().cast(EXCEPTIONS)).alias("exceptions_data"),
        F.expr(
            f"""CASE WHEN {HAS_MORE}
                THEN map_from_arrays(array(f1, ' ', {MORE_NAMES}), array(event_id, 0L, {MORE_IDS}))
                ELSE map(f1, event_id, ' ', 0L) END"""
        ).alias("function_ids"),
        F.when(is_error, enriched)
        .otherwise(F.array().cast(ENRICHED))
        .alias("exceptions_data_enriched"),
    ]
    return rows.select(*_exprs(SCALARS), "timestamp", *nested).select(*INVESTIGATION_COLUMNS)


def payloads(events: DataFrame) -> DataFrame:
    return events.where(HAS_OBJECT).select(
        F.expr(URI).alias("obj_uri"), F.expr(BODY.format(raw="r")).alias("body")
    )


def endpoint_versions(events: DataFrame) -> DataFrame:
    keys = events.select(*_exprs(OWNER), F.expr(VER).alias("ver"))
    once_each = keys.where("endpoint_id < 10").distinct()
    rows = once_each.withColumn("twice", F.lit(False)).unionByName(
        once_each.where(TWICE).withColumn("twice", F.lit(True))
    )
    get, post = F.lit("GET"), F.lit("POST")
    methods = (
        F.when(F.col("endpoint_id") == 8, F.lit(None).cast("array<string>"))
        .when(F.col("endpoint_id") == 9, F.array().cast("array<string>"))
        .when(F.col("ver") % 2 == 0, F.array(get, post))
        .otherwise(F.array(get))
    )
    return rows.withColumns({"path": F.expr(PATH), "methods": methods}).drop("twice")


def landed(events: DataFrame) -> DataFrame:
    """The payloads as landed at the time of their event."""
    landed_at = F.col("ts").cast("timestamp").alias("landed_at")
    body = F.expr(BODY.format(raw="r")).alias("body")
    return events.where(HAS_OBJECT).select(F.expr(URI).alias("obj_uri"), body, landed_at)


def as_of(events: DataFrame) -> Column:
    """Newest event time, as a scalar subquery."""
    return events.agg(F.max("ts").cast("timestamp")).scalar()


def event_id() -> Column:
    return F.substr("id", F.lit(3)).cast("bigint")


def ledger(incidents: DataFrame) -> DataFrame:
    """Distinct incidents with a fingerprint beginning 0 to 7, as solved issues."""
    return incidents.where(F.substring("root_cause_hash", 1, 1) < "8").select(
        event_id().alias("id"),
        "root_cause_hash",
        event_id().alias("github_issue_number"),
        F.col("timestamp").alias("created_at"),
        F.col("error_message").alias("error_pattern"),
    )


def posted_issues(incidents: DataFrame) -> DataFrame:
    """Distinct incidents with a fingerprint ending 0 to 3, as newly posted issues."""
    posted = incidents.where(F.substring("root_cause_hash", -1, 1) < "4")
    return posted.withColumn("github_issue_number", event_id() + 1000000)


def approvals(incidents: DataFrame) -> DataFrame:
    """Fingerprints whose last digit is even."""
    even = F.substring("root_cause_hash", -1, 1).isin(*"02468ace")
    return incidents.where(even).select("root_cause_hash")
