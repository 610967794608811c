"""Filters, ranking, payload joins, endpoints and ledger on small tables."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from faultsift.operators import endpoints, filters, ledger, ranking
from faultsift.operators.joins import hashed_join
from faultsift.operators.payloads import rejects, to_incidents, with_context, with_fingerprint
from faultsift.plans import triage
from faultsift.plans.report import run_summary
from faultsift.schemas import APPROVALS, INVESTIGATION_COLUMNS, LEDGER
from faultsift.operators.payloads import join_payloads
from tests.builders import START, by_id, endpoint_versions, investigation, investigations, payloads

AS_OF = START + timedelta(days=1)


def ids(frame, column="session_id"):
    return sorted(row[column] for row in frame.select(column).collect())


@pytest.mark.parametrize("value,days", [("1", 1), (7, 7), (" 3 ", 3)])
def test_positive_days(value, days):
    assert filters.positive_days(value) == days


@pytest.mark.parametrize("value", ["0", -1, "x", "", "1.5"])
def test_other_days_are_refused(value):
    with pytest.raises(ValueError):
        filters.positive_days(value)


def test_lookback_includes_the_cutoff(spark):
    rows = [
        investigation(1, timestamp=AS_OF - timedelta(days=3)),
        investigation(2, timestamp=AS_OF - timedelta(days=3, microseconds=1)),
        investigation(3, timestamp=AS_OF + timedelta(days=9)),
    ]
    assert ids(filters.lookback(investigations(spark, rows), 3, AS_OF)) == ["s-1", "s-3"]
    assert ids(filters.lookback(investigations(spark, rows), 3)) == []


def test_actionable(spark):
    rows = [
        investigation(1), investigation(2, None), investigation(3, ""),
        investigation(4, s3_pointer=""), investigation(5, s3_pointer=None),
        investigation(6, "Gateway TimeOut!"), investigation(7, "cancelled"),
        investigation(8, "was ABORTED by"), investigation(9, "canceled"),
        investigation(10, exceptions_data=None), investigation(11, "100% t.meout"),
    ]
    assert ids(filters.actionable(investigations(spark, rows))) == ["s-1", "s-11", "s-9"]
    plain = filters.actionable(investigations(spark, rows), noise=("t.meout", "100%"))
    assert "s-11" not in ids(plain) and "s-6" in ids(plain)
    assert "s-7" in ids(filters.actionable(investigations(spark, rows), noise=()))


def test_newest_per_key_breaks_ties_by_session(spark):
    rows = [
        investigation(1, minutes=1), investigation(2, minutes=5), investigation(3, minutes=5),
        investigation(4, "other"), investigation(5, service_name="b"),
        investigation(6, endpoint_uuid="ep-2"),
    ]
    found = ranking.newest_per_key(investigations(spark, rows))
    assert ids(found) == ["s-2", "s-4", "s-5", "s-6"]


def test_newest_keeps_the_cap(spark):
    rows = [investigation(i, f"m{chr(97 + i)}", minutes=i % 4) for i in range(8)]
    frame = investigations(spark, rows)
    found = triage.recent_investigations(frame, 3, AS_OF, cap=3)
    assert found.columns == INVESTIGATION_COLUMNS
    assert [row.session_id for row in found.collect()] == ["s-3", "s-7", "s-2"]
    every = [row.session_id for row in triage.recent_investigations(frame, 3, AS_OF).collect()]
    assert every == ["s-3", "s-7", "s-2", "s-6", "s-1", "s-5", "s-0", "s-4"]
    assert triage.candidates(frame, 3, AS_OF).count() == 8
    assert ids(triage.candidates(frame, 3, AS_OF, cap=3)) == ["s-2", "s-3", "s-7"]


DEEP = '{"x":' + "[" * 1500 + "]" * 1500

BODIES = {
    1: ("not json", "invalid"), 2: ("null", "invalid"), 3: ("[1]", "boom"), 4: ("5", "boom"),
    5: ("{}", "boom"), 6: ('{"message":0}', "boom"), 7: ('{"message":{"a":1}}', "non_string"),
    8: ('{"message":7}', "non_string"), 9: ('{"message":true}', "non_string"),
    10: ('{"message":"0"}', "0"), 11: ('{"message":"a","message":"b"}', "b"),
    12: ('{"error_message":"","message":"m"}', "m"), 13: ('{"message":false,"error":"e"}', "e"),
    14: ('{"message":null,"error":"e"}', "e"), 15: ('{"message":0e5,"error":0.0}', "boom"),
    16: ('{"message":"x"} trailing', "invalid"), 17: ('{"message":"x"}{}', "invalid"),
    18: ('1,2', "invalid"), 19: ('{"message":"x"}] [1', "invalid"), 20: ("", "invalid"),
    21: (" {\"message\":\"spaced\"}\n", "spaced"), 22: ('{"stack_trace":[]}', "non_string"),
    23: ('{"stack_trace":0,"stackTrace":"at a.b"}', "boom"), 24: ('"text"', "boom"),
    25: ("false", "boom"), 26: ('{"message":[]}', "non_string"), 27: ('{"a":1,}', "invalid"),
    28: ('{"message":-0}', "boom"), 29: (None, "missing"), 30: ('{"message":"tab\\tx"}', "tab\tx"),
    31: ('{"Message":"upper"}', "boom"), 33: ("[" * 5000 + "]" * 5000, "boom"),
    34: ('{"message":' + "9" * 400 + "}", "non_string"), 35: ("9" * 2000, "boom"), 32: ('{"message":1e-5}', "non_string"),
    # Beyond the limits of the VARIANT parser.
    40: ('{"message":"real error","x":' + "[" * 1000 + "]" * 1000 + "}", "real error"),
    41: ('{"message":"real error","n":' + "1" * 1001 + "}", "real error"),
    42: ('{"message":"real error","s":"' + "s" * 20_000_001 + '"}', "real error"),
    43: ("[" * 1100 + '{"message":"x"', "invalid"), 44: (f'{DEEP},"message":"x"}} y', "invalid"),
    45: (f'{DEEP},"message":"x"}},"d":{{"message":"y"}}', "invalid"), 46: (f'{DEEP}}}] [{{"a":1', "invalid"),
    47: (f'{DEEP},"message":7}}', "non_string"), 48: (f'{DEEP},"message":0,"error":"e"}}', "e"),
    49: (f'{DEEP},"message":false,"error":null}}', "boom"), 50: (f'{DEEP},"message":true}}', "non_string"),
    51: (f'{DEEP},"message":[1]}}', "non_string"), 52: (f'{DEEP},"error":{{"a":1}}}}', "non_string"),
    53: (f'{DEEP},"message":"7","stackTrace":"at q.r"}}', "7"), 54: (f'{DEEP},"message":"true"}}', "true"),
    55: (f'{DEEP},"message":"[x"}}', "[x"), 56: (f'{DEEP},"message":"a","message":"b"}}', "b"),
    57: ('{"message":' + "[" * 1500 + "]" * 1500 + "}", "too_large"),
    58: ('{"error":"e","message":' + '{"a":' * 1500 + "1" + "}" * 1501, "too_large"),
    59: (f'{DEEP},"message":"NaN"}}', "NaN"), 60: (f'{DEEP},"message":NaN}}', "invalid"),
    61: (f"{DEEP},'message':'x'}}", "invalid"), 62: (f'{DEEP},"message":"é\\n\\u00e9"}}', "é\né"),
    63: ('{"message":' + "9" * 1500 + "}", "non_string"), 64: (f'{DEEP},"message":""}}', "boom"),
    65: ("[" * 1500 + '{"message":"inner"}' + "]" * 1500, "boom"),
}


def test_payload_cases(spark):
    rows = [investigation(number, "boom") for number in [*BODIES, 98]]
    rows.append(investigation(99, s3_pointer="not a url"))
    found = triage.slim(investigations(spark, rows))
    objects = payloads(spark, {number: body for number, (body, _) in BODIES.items()})
    processed = with_fingerprint(triage.outcomes(found, objects))
    result = {
        row.id: row.error_message if row.outcome == "ok" else row.outcome
        for row in processed.collect()
    }
    expected = {f"s-{number}": want for number, (_, want) in BODIES.items()}
    assert result == {**expected, "s-98": "missing", "s-99": "unlocatable"}

    inner = by_id(triage.incidents(found, objects))
    outer = by_id(to_incidents(processed))
    assert inner == outer
    assert inner["s-23"].throwing_functions == ["f", "a.b"]
    assert inner["s-23"].stack_trace == "at a.b"
    assert inner["s-53"].stack_trace == "at q.r"

    left = by_id(rejects(triage.outcomes(found, objects)), "session_id")
    assert set(left) | set(inner) == set(result)
    assert left["s-99"].obj_uri is None


def test_sessions_and_payloads_may_repeat(spark):
    rows = [
        investigation(1, "a", session_id="same", s3_pointer="s3://b/1.json"),
        investigation(2, "b", session_id="same", s3_pointer="s3://b/2.json"),
        investigation(3, "c", s3_pointer="s3://b/1.json"),
        investigation(4, "d", session_id="same", s3_pointer="s3://b/9.json"),
    ]
    found = triage.slim(investigations(spark, rows))
    objects = payloads(spark, {1: '{"message":"one"}', 2: '{"message":"two"}'})
    objects = objects.unionByName(payloads(spark, {1: '{"message":"a smaller text"}'}))
    result = triage.outcomes(found, objects).select(
        "first_message", "outcome", "payload_message"
    )
    assert sorted(tuple(row) for row in result.collect()) == [
        ("a", "ok", "one"), ("b", "ok", "two"), ("c", "ok", "one"), ("d", "missing", "")
    ]
    inner = triage.incidents(found, objects)
    assert sorted(row.error_message for row in inner.collect()) == ["one", "one", "two"]


def test_context(spark):
    bodies = {1: '{"context":{"a":1},"x":2}', 2: '{"context":"","x":2}', 3: "[1, 2]", 4: "{"}
    found = triage.slim(investigations(spark, [investigation(n) for n in bodies]))
    joined = join_payloads(found, payloads(spark, bodies))
    shown = with_context(joined).select("session_id", F.to_json("context").alias("context"))
    assert {row.session_id: json.loads(row.context) for row in shown.collect()} == {
        "s-1": {"a": 1}, "s-2": {"context": "", "x": 2}, "s-3": [1, 2]
    }


def test_one_incident_per_fingerprint_is_the_newest(spark):
    rows = [investigation(n, f"order {n} lost", minutes=n % 3) for n in range(6)]
    found = triage.slim(investigations(spark, rows))
    objects = payloads(spark, {n: "{}" for n in range(6)})
    unique = triage.distinct_incidents(found, objects)
    assert ids(unique, "id") == ["s-2"]


VERSIONS = [
    ("acct", "prod", 1, 1, "/old", ["GET"]), ("acct", "prod", 1, 2, "/new", ["GET", "POST"]),
    ("acct", "prod", 1, 3, None, None), ("acct", "prod", 2, 1, None, None),
    ("acct", "prod", 3, 1, "", []), ("acct", "dev", 1, 9, "/dev", ["PUT"]),
]


def test_endpoint_info_skips_missing_values(spark):
    info = endpoints.endpoint_info(endpoints.endpoint_states(endpoint_versions(spark, VERSIONS)))
    found = {
        (row.environment_name, row.endpoint_id): (row.endpoint_path, row.endpoint_methods)
        for row in info.collect()
    }
    assert found == {
        ("prod", 1): ("/new", ["GET", "POST"]), ("prod", 2): ("Unknown path", []),
        ("prod", 3): ("Unknown path", []), ("dev", 1): ("/dev", ["PUT"]),
    }


def test_endpoints_by_id(spark):
    versions = endpoint_versions(spark, VERSIONS)
    found = endpoints.endpoints_by_id(versions, "acct", "prod", [1, 2, 99])
    assert sorted(tuple(row) for row in found.collect()) == [
        (1, "/new", ["GET", "POST"]), (2, "Unknown path", [])
    ]
    assert endpoints.endpoints_by_id(versions, "acct", "prod", []).isEmpty()


@pytest.mark.parametrize("split", range(len(VERSIONS) + 1))
def test_states_merge_at_any_split(spark, split):
    whole = endpoints.endpoint_states(endpoint_versions(spark, VERSIONS))
    parts = [
        endpoints.endpoint_states(endpoint_versions(spark, part))
        for part in (VERSIONS[:split], VERSIONS[split:])
    ]
    assert sorted(endpoints.merge_states(*parts).collect()) == sorted(whole.collect())


def test_enrichment(spark):
    rows = [
        investigation(1), investigation(2, "no default path", endpoint_id=2),
        investigation(3, "no such endpoint", endpoint_id=77),
        investigation(4, "no such account", account_id="other"),
        investigation(5, "bar in name", environment_name="de|v"),
    ]
    found = triage.slim(investigations(spark, rows))
    unique = triage.distinct_incidents(found, payloads(spark, {n: "{}" for n in range(1, 6)}))
    versions = endpoint_versions(spark, [*VERSIONS, ("acct", "de|v", 1, 1, "/bar", ["GET"])])
    enriched = by_id(triage.with_endpoints(unique, versions))
    assert {key: (row.endpoint_path, row.endpoint_methods) for key, row in enriched.items()} == {
        "s-1": ("/new", ["GET", "POST"]), "s-2": ("Unknown path", []), "s-3": (None, None),
        "s-4": (None, None), "s-5": ("/bar", ["GET"]),
    }
    wanted = endpoints.wanted_versions(versions, unique)
    assert wanted.count() == 5
    assert endpoints.wanted_versions(versions, unique.limit(0)).isEmpty()
    counts = by_id(endpoints.incidents_by_account_env(unique), "environment_name")
    assert (counts["de|v"].incidents, counts["de|v"].endpoints) == (1, 1)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hashed_join_is_the_plain_join(spark, how):
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(3, 9).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, ["k"], how)
    split = hashed_join(left, right, ["k"], how)
    assert sorted(split.collect()) == sorted(plain.select(split.columns).collect())


def ledger_rows(spark, rows):
    when = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(i, h, n, when(day), text) for i, h, n, day, text in rows], LEDGER
    )


def test_upsert_replaces_by_fingerprint_and_repeats_safely(spark):
    old = ledger_rows(spark, [(1, "a", 10, 1, "x"), (2, "b", 11, 1, "y")])
    new = ledger_rows(spark, [(3, "b", 12, 2, "y2"), (4, "c", 13, 2, "z")])
    once = ledger.upsert(old, new)
    assert sorted((row.id, row.root_cause_hash) for row in once.collect()) == [
        (1, "a"), (3, "b"), (4, "c")
    ]
    twice = ledger.upsert(once, new)
    assert sorted(twice.collect()) == sorted(once.collect())
    assert ledger.duplicate_fingerprints(once).isEmpty()
    assert ledger.duplicate_fingerprints(old.unionByName(new)).count() == 1
    assert ledger.is_solved(once, "c") and not ledger.is_solved(once, "q")
    recent = [row.id for row in ledger.newest_ledger_rows_first(once).collect()]
    assert recent == [4, 3, 1]


def test_ids_follow_the_fingerprints(spark):
    hashes = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("root_cause_hash"))
    numbered = ledger.with_ids(hashes, F.lit(100)).collect()
    expected = {h: 101 + i for i, h in enumerate(sorted(row.root_cause_hash for row in numbered))}
    assert {row.root_cause_hash: row.id for row in numbered} == expected


def test_empty_ledger_has_no_last_id(spark):
    empty = spark.createDataFrame([], LEDGER)
    assert spark.range(1).select(ledger.last_id(empty)).first()[0] == 0


def test_summary_counts_everything_once(spark):
    rows = [investigation(n, f"m{chr(97 + n)}") for n in range(6)]
    found = triage.slim(investigations(spark, rows))
    objects = payloads(spark, {0: "{}", 1: "{}", 2: "{}", 3: "oops"})
    processed = with_fingerprint(triage.outcomes(found, objects))
    hashes = sorted(row.root_cause_hash for row in to_incidents(processed).collect())
    solved = ledger_rows(spark, [(1, hashes[0], 1, 1, "x"), (2, "unrelated", 2, 1, "y")])
    approvals = spark.createDataFrame([(hashes[0],), (hashes[1],), (hashes[1],), (None,)], APPROVALS)
    row = run_summary(processed, solved, approvals).first().asDict()
    assert row == {
        "total": 6, "cut": 0, "expired": 0, "processed": 4, "successful": 3, "missing": 2,
        "unlocatable": 0, "invalid": 1, "too_large": 0, "non_string": 0, "unique_incidents": 3,
        "skipped": 1, "new": 2, "created": 1, "percent": 50,
    }
    assert run_summary(processed, solved).first().created == 2
    none = run_summary(processed.limit(0), solved).first()
    assert (none.total, none.successful, none.new, none.percent) == (0, 0, 0, None)
    known = ledger.known_fingerprints(to_incidents(processed), solved)
    assert [row.root_cause_hash for row in known.collect()] == hashes[:1]
    assert run_summary(processed, solved, cut=7, expired=2).first()[1:3] == (7, 2)
    fresh = ledger.unsolved(to_incidents(processed), solved)
    skipped = ledger.already_solved(to_incidents(processed), solved)
    assert (fresh.count(), skipped.count()) == (2, 1)
    assert ledger.approved(fresh, approvals).count() == 1
