"""DuckDB SQL of every registered query, over the same events.

Fixed values, as in the library: the frame pattern, the order of normalisation,
the payload's field names, and the issues' headings, labels and lengths.
"""

from __future__ import annotations

from checks.derived import (
    BODY,
    FUNCTION,
    HAS_MORE,
    HAS_OBJECT,
    MESSAGE,
    MORE_IDS,
    MORE_NAMES,
    OWNER,
    PART,
    PATH,
    SCALARS,
    TWICE,
    URI,
    VER,
)

# The look-back of the queries about it, and all of the test data.
DAYS, ALL_DAYS = 20, 31

FIELDS = ("error_message", "message", "error", "stack_trace", "stackTrace")


def _kind(field: str) -> str:
    """'s' for a string that counts, 'n' for any other value that does, else NULL."""
    text = f"doc->>'$.{field}'"
    return f"""CASE json_type(doc, '$.{field}') WHEN 'VARCHAR' THEN CASE WHEN {text} <> '' THEN 's' END
    WHEN 'BOOLEAN' THEN CASE WHEN {text} = 'true' THEN 'n' END
    WHEN 'OBJECT' THEN 'n' WHEN 'ARRAY' THEN 'n' WHEN 'NULL' THEN NULL
    ELSE CASE WHEN TRY_CAST({text} AS double) <> 0 THEN 'n' END END AS kind_{field}"""


def _text(field: str) -> str:
    return f"CASE WHEN kind_{field} = 's' THEN doc->>'$.{field}' END"


def _select(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{text} AS {name}" for name, text in columns.items())


TIME = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
TS = TIME.format('"timestamp"') + " AS ts"

STEPS = {
    "rows_of_events": f"""
SELECT *, CAST(json_extract_string(props, '$.k') AS int) AS k, {FUNCTION} AS f1 FROM events""",
    "messages": f"""
SELECT *, {MESSAGE} AS msg FROM rows_of_events""",
    "investigations": f"""
SELECT {_select(SCALARS)},
  ts AS "timestamp",
  CASE WHEN event_type = 'error' THEN [{{'message': msg, 'functions': [f1]}}] ELSE [] END AS exceptions_data,
  CASE WHEN {HAS_MORE} THEN MAP([f1, ' ', {MORE_NAMES}], [event_id, 0, {MORE_IDS}])
    ELSE MAP([f1, ' '], [event_id, 0]) END AS function_ids,
  {PART} AS part,
  CASE WHEN event_type = 'error' THEN [{{'message': msg, 'ids': [event_id]}}] ELSE [] END AS exceptions_data_enriched
FROM messages""",
    "payloads": f"""
SELECT {URI} AS obj_uri, {BODY.format(raw="")} AS body FROM events WHERE {HAS_OBJECT}""",
    "endpoint_keys": f"""
SELECT DISTINCT {_select({**OWNER, "ver": VER})} FROM events""",
    "endpoint_versions": f"""
SELECT *, {PATH} AS path,
  CASE WHEN endpoint_id = 8 THEN NULL WHEN endpoint_id = 9 THEN CAST([] AS varchar[])
    WHEN ver % 2 = 0 THEN ['GET', 'POST'] ELSE ['GET'] END AS methods
FROM (SELECT *, false AS twice FROM endpoint_keys
  UNION ALL SELECT *, true AS twice FROM endpoint_keys WHERE {TWICE})
WHERE endpoint_id < 10""",
    "with_message": """
SELECT *, exceptions_data[1].message AS first_message,
  concat(service_name, '|', endpoint_uuid, '|', coalesce(exceptions_data[1].message, '')) AS dedup_key
FROM investigations""",
    "actionable": r"""
SELECT * FROM with_message
WHERE len(exceptions_data) > 0 AND s3_pointer <> '' AND first_message <> ''
  AND NOT regexp_matches(first_message, '(?i)timeout|cancelled|aborted')""",
    "recent": f"""
SELECT * FROM actionable
WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL {ALL_DAYS} DAY""",
    "latest": """
SELECT * FROM recent
QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY "timestamp" DESC, session_id) = 1""",
    "candidates": """
SELECT * FROM latest""",
    "located": r"""
SELECT *, CASE WHEN s3_pointer LIKE 's3://%' THEN 's3a://' || substr(s3_pointer, 6)
  WHEN s3_pointer LIKE 'https://%' THEN
    regexp_replace(s3_pointer, '^https://([^./]+)[^/]*/([^?#]*).*$', 's3a://\1/\2')
  END AS obj_uri
FROM candidates""",
    "matched": """
SELECT located.*, body, TRY_CAST(body AS JSON) AS doc
FROM located LEFT JOIN payloads USING (obj_uri)""",
    "kinds": f"""
SELECT *, {", ".join(_kind(field) for field in FIELDS)} FROM matched""",
    "outcomes": """
SELECT *, CASE WHEN obj_uri IS NULL THEN 'unlocatable' WHEN body IS NULL THEN 'missing'
  WHEN doc IS NULL THEN 'invalid'
  WHEN coalesce(kind_error_message, kind_message, kind_error) = 'n'
    OR coalesce(kind_stack_trace, "kind_stackTrace") = 'n' THEN 'non_string'
  ELSE 'ok' END AS outcome
FROM kinds""",
    "usable": """
SELECT * FROM outcomes WHERE outcome = 'ok'""",
    "fields": f"""
SELECT *,
  coalesce({_text("error_message")}, {_text("message")}, {_text("error")},
    nullif(first_message, ''), '') AS error_message,
  coalesce({_text("stack_trace")}, {_text("stackTrace")}, '') AS stack_trace
FROM usable""",
    "frames": r"""
SELECT *, list_filter(
    list_transform(string_split(stack_trace, chr(10)),
      lambda line: regexp_extract(line, 'at (\w+(?:\.\w+)*)', 1)),
    lambda name: name <> '') AS stack_functions,
  list_filter(map_keys(function_ids), lambda name: trim(name) <> '') AS named_functions
FROM fields""",
    "functions": """
SELECT *, list_concat(named_functions, stack_functions) AS all_functions,
  list_filter(all_functions, lambda name, i: list_position(all_functions, name) = i)[1:10]
    AS throwing_functions
FROM frames""",
    "normalized": r"""
SELECT *, trim(regexp_replace(replace(replace(
    regexp_replace(lower(error_message), '\d+', 'N', 'g'), chr(39), ''), '"', ''),
  '\s+', ' ', 'g')) AS normalized_error
FROM functions""",
    "incidents": """
SELECT *, session_id AS id, sha256(concat(normalized_error, '|',
  array_to_string(list_sort(throwing_functions[1:5]), '|'))) AS root_cause_hash
FROM normalized""",
    "unique_incidents": """
SELECT * FROM incidents
QUALIFY row_number() OVER (PARTITION BY root_cause_hash ORDER BY "timestamp" DESC, id) = 1""",
    "endpoints": """
SELECT account_id, environment_name, endpoint_id,
  coalesce((max({'ver': ver, 'value': path}) FILTER (path IS NOT NULL)).value, 'Unknown path')
    AS endpoint_path,
  coalesce((max({'ver': ver, 'value': methods}) FILTER (methods IS NOT NULL)).value, [])
    AS endpoint_methods
FROM endpoint_versions GROUP BY ALL""",
    "enriched": """
SELECT unique_incidents.*, endpoint_path, endpoint_methods
FROM unique_incidents LEFT JOIN endpoints USING (account_id, environment_name, endpoint_id)""",
    "ledger": """
SELECT CAST(substr(id, 3) AS bigint) AS id, root_cause_hash,
  CAST(substr(id, 3) AS bigint) AS github_issue_number,
  "timestamp" AS created_at, error_message AS error_pattern
FROM unique_incidents WHERE root_cause_hash[1] < '8'""",
    "approvals": """
SELECT root_cause_hash FROM unique_incidents
WHERE contains('02468ace', right(root_cause_hash, 1))""",
    "fresh": """
SELECT * FROM enriched
WHERE root_cause_hash NOT IN (SELECT root_cause_hash FROM ledger)""",
    "approved": """
SELECT * FROM fresh
WHERE root_cause_hash IN (SELECT root_cause_hash FROM approvals)""",
    "posted": """
SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY root_cause_hash) AS id,
  root_cause_hash, CAST(substr(id, 3) AS bigint) + 1000000 AS github_issue_number,
  (SELECT max(ts) FROM events) AS created_at, error_message AS error_pattern
FROM unique_incidents WHERE right(root_cause_hash, 1) < '4'""",
    "upserted": """
SELECT * FROM (SELECT * FROM ledger UNION ALL SELECT * FROM posted)
QUALIFY row_number() OVER (PARTITION BY root_cause_hash ORDER BY created_at DESC, id DESC) = 1""",
}

LOOKBACK = {"recent": f"""
SELECT * FROM actionable
WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL {DAYS} DAY"""}

CAPPED = {**LOOKBACK, "candidates": """
SELECT * FROM latest ORDER BY "timestamp" DESC, session_id LIMIT 500"""}


def _sql(final: str, **steps: str) -> str:
    chain = ",\n".join(f"{name} AS ({text})" for name, text in {**STEPS, **steps}.items())
    return f"WITH {chain}\n{final}"


INCIDENT = f"""id, service_name, endpoint_uuid, endpoint_id, account_id, environment_name,
  error_message, stack_trace, array_to_string(throwing_functions, ',') AS throwing_functions,
  {TS}, s3_pointer, root_cause_hash"""

ENRICHED = INCIDENT + """, endpoint_path,
  array_to_string(endpoint_methods, ',') AS endpoint_methods"""

LEDGER = f"""id, root_cause_hash, github_issue_number,
  {TIME.format("created_at")} AS created_at, error_pattern"""

INVESTIGATION = f"""account_id, stable_runtime_scope_id, session_id, environment_id,
  environment_name, service_id, service_name, endpoint_id, endpoint_uuid, flow_type, version,
  s3_pointer, {TS}, exceptions_data[1].message AS first_message,
  array_to_string(exceptions_data[1].functions, ',') AS first_functions,
  array_to_string(map_keys(function_ids), ',') AS function_names,
  CAST(list_sum(map_values(function_ids)) AS bigint) AS function_id_sum,
  coalesce(exceptions_data_enriched[1].ids[1], -1) AS first_id"""

METHODS = "coalesce(nullif(array_to_string(endpoint_methods, '{}'), ''), 'ANY')"

LOCATION = f"""CASE WHEN endpoint_path IS NULL THEN service_name
  ELSE concat(service_name, ' ', {METHODS.format(",")}, ' ', endpoint_path) END"""


def _short(size: int) -> str:
    return f"""CASE WHEN length(error_message) > {size}
  THEN concat(error_message[1:{size}], '...') ELSE error_message END"""


TITLE = f"concat('🚨 ', {LOCATION}, ': ', {_short(50)})"

BODY_TEXT = f"""concat_ws(chr(10), '## Bug Report', '**Detected by:** Incident triage',
  concat('**Timestamp:** ', strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ')),
  '**Severity:** High', '', '## Description', '',
  concat('**Service:** ', service_name),
  concat('**Endpoint:** ', CASE WHEN endpoint_path IS NULL THEN 'Unknown endpoint'
    ELSE concat({METHODS.format(", ")}, ' ', endpoint_path) END),
  concat('**Environment:** ', environment_name),
  concat('**Error:** ', error_message), '', '## Additional Context',
  concat('- **Account ID:** ', account_id), concat('- **Incident ID:** ', id),
  concat('- **Root Cause Hash:** ', root_cause_hash),
  concat('- **S3 Pointer:** ', s3_pointer))"""

LABEL = f"""concat('[', service_name, '] [', environment_name, '] ',
  CASE WHEN endpoint_path IS NULL THEN endpoint_uuid
    ELSE concat({METHODS.format(",")}, ' ', endpoint_path) END,
  chr(10), '    🚨 ', {_short(60)},
  chr(10), '    ⏰ ', strftime("timestamp", '%Y-%m-%d %H:%M:%S'))"""

DRAFT = f"""root_cause_hash, id, error_message, {TITLE} AS title, {BODY_TEXT} AS body,
  'bug,production,auto-created' AS labels,
  concat('Drafting ', service_name, ' - ', error_message[1:60], '...') AS progress"""

SUMMARY = """
SELECT (SELECT count(*) FROM outcomes) AS total, CAST({cut} AS bigint) AS cut,
  CAST(0 AS bigint) AS expired,
  (SELECT count(*) FROM outcomes WHERE outcome NOT IN ('missing', 'unlocatable')) AS processed,
  (SELECT count(*) FROM incidents) AS successful,
  (SELECT count(*) FROM outcomes WHERE outcome = 'missing') AS missing,
  (SELECT count(*) FROM outcomes WHERE outcome = 'unlocatable') AS unlocatable,
  (SELECT count(*) FROM outcomes WHERE outcome = 'invalid') AS invalid,
  (SELECT count(*) FROM outcomes WHERE outcome = 'too_large') AS too_large,
  (SELECT count(*) FROM outcomes WHERE outcome = 'non_string') AS non_string,
  (SELECT count(*) FROM unique_incidents) AS unique_incidents,
  (SELECT count(*) FROM unique_incidents WHERE root_cause_hash IN (SELECT root_cause_hash FROM ledger)) AS skipped,
  (SELECT count(*) FROM fresh) AS new,
  (SELECT count(*) FROM approved) AS created,
  CAST(round(100 * (SELECT count(*) FROM incidents) / nullif((SELECT count(*) FROM outcomes), 0))
    AS bigint) AS percent"""

# Each of three files is a batch of its own.
DEALT = {"latest": """
SELECT * FROM recent
QUALIFY row_number() OVER (PARTITION BY part, dedup_key ORDER BY "timestamp" DESC, session_id) = 1""",
         "recent": "SELECT * FROM actionable"}

NONE = {"candidates": "SELECT * FROM latest WHERE false"}

DIVISIONS = ", ".join(f"sha256('division by zero|fn{n}.run')" for n in range(40))

ORACLES = {
    "lookback_filter": _sql(f"""SELECT session_id, service_name, {TS} FROM investigations
        WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY"""),
    "noise_filter": _sql("SELECT session_id, s3_pointer, first_message FROM actionable"),
    "dedup_key": _sql("SELECT session_id, dedup_key FROM with_message"),
    "latest_per_key": _sql(f"SELECT session_id, dedup_key, {TS} FROM latest"),
    "days_argument": _sql(f"""SELECT session_id, service_name, {TS} FROM investigations
        WHERE "timestamp" >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"""),
    "recent_candidates": _sql(f"SELECT {INVESTIGATION} FROM candidates", **CAPPED),
    "recent_candidates_all": _sql(f"SELECT {INVESTIGATION} FROM candidates", **LOOKBACK),
    "pointer_to_uri": _sql("SELECT session_id, s3_pointer, obj_uri FROM located",
                           candidates="SELECT * FROM investigations"),
    "jsonrow_decode": _sql(f"SELECT {INVESTIGATION} FROM investigations"),
    "payload_join": _sql("SELECT session_id, obj_uri, body FROM outcomes WHERE body IS NOT NULL"),
    "payload_fields": _sql("SELECT session_id, error_message, stack_trace FROM fields"),
    "payload_context": _sql("""SELECT session_id,
        CAST(coalesce(doc->'$.context', doc) AS varchar) AS context
        FROM matched WHERE doc IS NOT NULL"""),
    "payload_rejects": _sql("""SELECT session_id, s3_pointer, obj_uri, outcome AS reason
        FROM outcomes WHERE outcome <> 'ok'"""),
    "stack_functions": _sql("""SELECT session_id,
        array_to_string(stack_functions, ',') AS stack_functions
        FROM frames WHERE len(stack_functions) > 0"""),
    "throwing_functions": _sql("""SELECT session_id,
        array_to_string(throwing_functions, ',') AS throwing_functions FROM functions"""),
    "normalized_error": _sql("SELECT session_id, normalized_error FROM normalized"),
    "root_cause_hash": _sql("SELECT id, root_cause_hash FROM incidents"),
    "incidents": _sql(f"SELECT {INCIDENT} FROM incidents"),
    "incident_dedup": _sql(f"SELECT {INCIDENT} FROM unique_incidents"),
    "endpoint_latest": _sql("""SELECT account_id, environment_name, endpoint_id, endpoint_path,
        array_to_string(endpoint_methods, ',') AS endpoint_methods FROM endpoints"""),
    "endpoint_wanted": _sql("""SELECT account_id, environment_name, endpoint_id, ver, path,
        array_to_string(methods, ',') AS methods FROM endpoint_versions
        WHERE (account_id, environment_name, endpoint_id) IN
          (SELECT (account_id, environment_name, endpoint_id) FROM unique_incidents)"""),
    "incidents_by_account_env": _sql("""SELECT account_id, environment_name,
        count(*) AS incidents, count(DISTINCT endpoint_id) AS endpoints
        FROM unique_incidents GROUP BY ALL"""),
    "enriched_incidents": _sql(f"SELECT {ENRICHED} FROM enriched"),
    "new_incidents": _sql(f"SELECT {ENRICHED} FROM fresh", **LOOKBACK),
    "new_incidents_capped": _sql(f"SELECT {ENRICHED} FROM fresh", **CAPPED),
    "landed_payload_join": _sql(
        "SELECT session_id, obj_uri, body FROM outcomes WHERE body IS NOT NULL"),
    "payload_objects_join": _sql(
        "SELECT session_id, body || chr(10) AS body FROM outcomes WHERE body IS NOT NULL"),
    "triage_run": _sql(f"SELECT {DRAFT} FROM approved", **LOOKBACK),
    "triage_run_capped": _sql(f"SELECT {DRAFT} FROM approved", **CAPPED),
    "choices": _sql(f"""SELECT root_cause_hash, {LABEL} AS label,
        concat(service_name, ': ', error_message[1:50], '...') AS short FROM fresh"""),
    "posted_ledger": _sql("""SELECT root_cause_hash, CASE WHEN right(root_cause_hash, 1) < '4'
          THEN CAST(substr(id, 3) AS bigint) + 1000000 END AS github_issue_number,
        error_message AS error_pattern FROM unique_incidents"""),
    "ledger_mixed_runs": _sql("""SELECT root_cause_hash, CAST(1 AS bigint) AS drafts
        FROM (SELECT DISTINCT root_cause_hash FROM incidents)""", recent="SELECT * FROM actionable"),
    "ledger_lookup": _sql(f"""SELECT {LEDGER} FROM ledger
        WHERE root_cause_hash IN ({DIVISIONS})"""),
    "endpoints_by_id": _sql("""SELECT endpoint_id AS id, endpoint_path AS path,
        array_to_string(endpoint_methods, ',') AS methods FROM endpoints
        WHERE account_id = 'acct-1' AND environment_name = 'prod' AND endpoint_id IN (1, 3, 7, 8, 9, 11)"""),
    "empty_run": _sql(SUMMARY.format(cut=0), **NONE),
    "skipped_incidents": _sql(f"""SELECT {INCIDENT} FROM unique_incidents
        WHERE root_cause_hash IN (SELECT root_cause_hash FROM ledger)"""),
    "ledger_upsert": _sql(f"SELECT {LEDGER} FROM upserted"),
    "ledger_recent": _sql(f"SELECT {LEDGER} FROM ledger ORDER BY ledger.created_at DESC, id DESC"),
    "issue_titles": _sql(f"SELECT root_cause_hash, {TITLE} AS title FROM enriched"),
    "issue_bodies": _sql(f"SELECT root_cause_hash, {BODY_TEXT} AS body FROM enriched"),
    "choice_labels": _sql(f"""SELECT root_cause_hash, {LABEL} AS label,
        concat(service_name, ': ', error_message[1:50], '...') AS short FROM enriched"""),
    "approved_drafts": _sql(f"SELECT {DRAFT} FROM approved"),
    "run_summary": _sql(SUMMARY.format(cut=0)),
    # A sharp s has no single upper-case letter: Spark gives SS.
    "upper_text": """SELECT conv_id, turn, upper(replace(text, 'ß', 'SS')) AS text
        FROM conversations""",
    "stream_new_incidents": _sql("""SELECT root_cause_hash, CAST(1 AS bigint) AS drafts
        FROM (SELECT DISTINCT root_cause_hash FROM incidents)
        WHERE root_cause_hash NOT IN (SELECT root_cause_hash FROM batch_ledger)""",
        **DEALT, batch_ledger="""
SELECT DISTINCT root_cause_hash FROM incidents WHERE root_cause_hash[1] < '8'"""),
    "stream_dedup": _sql("SELECT DISTINCT root_cause_hash FROM incidents", latest="SELECT * FROM actionable"),
}
ORACLES["endpoint_state_merge"] = ORACLES["endpoint_states_stored"] = ORACLES["endpoint_latest"]
ORACLES["latest_per_key_stored"] = _sql(f"SELECT session_id, dedup_key, {TS} FROM latest", **LOOKBACK)
