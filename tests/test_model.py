"""A whole triage against a plain Python model, on random rows with hot keys.

Fixed values, as in the library: the frame pattern, the order of normalisation,
the payload's field names and the two function limits.
"""

import hashlib
import json
import random
import re
from datetime import timedelta
from urllib.parse import urlsplit

import pytest

from faultsift.operators.endpoints import endpoint_info, endpoint_states
from faultsift.operators.payloads import to_incidents, with_fingerprint
from faultsift.operators.ranking import newest_per_fingerprint
from faultsift.plans import triage
from tests.builders import START, endpoint_versions, investigation, investigations, payloads

AS_OF = START + timedelta(days=2)

MESSAGES = [
    "boom", "Boom 1", "boom 22", "BOOM '3'", "a\u00a0b", "a b", "  a\tb ", "Timeout", "x|y", "x", "",
    "request cancelled", "naïve ÉTÉ", "12", "'\"", "price 1.5 or 2", None,
    *[f"cause {letter} {i}" for i, letter in enumerate("abcdefghijklmnopqrstuvwxyz")],
]
BODIES = [
    "{}", "{", "null", "[]", '"s"', "0", '{"message":"from body 1"}', '{"message":""}',
    '{"error":"e1","message":0}', '{"error_message":{"a":1}}', '{"error_message":false,"error":"e2"}',
    '{"stack_trace":"at a.b\\nno\\n at c.d.e (f) at g"}', '{"stackTrace":"x at y\\n\\nat y"}',
    '{"stack_trace":"","stackTrace":"at z"}', '{"stack_trace":3}', '{"message":"m"} x', None,
]
NAMES = [{}, {"f1": 1}, {"f2": 1, "f1": 2}, {" ": 1, "g h": 2}, {f"n{i}": i for i in range(12)}]


def random_rows(rng, count):
    rows = []
    for number in range(count):
        hot = rng.random() < 1 / 3
        choose = (lambda values: values[0]) if hot else rng.choice
        target = 0 if rng.random() < 1 / 3 else rng.randrange(count)
        good = [f"s3://b/{target}.json", f"https://b.s3.amazonaws.com/{target}.json?v=1"]
        pointer = rng.choice([*good, *good, *good, "no url", ""])
        rows.append(
            investigation(
                number, choose(MESSAGES), minutes=rng.randrange(4 * 24 * 60),
                service_name=choose(["svc", "svc|a", "b"]), endpoint_uuid=choose(["ep", "a|ep"]),
                account_id=choose(["acct", "other"]), endpoint_id=choose([1, 2, 3]),
                function_ids=rng.choice(NAMES), s3_pointer=pointer,
            )
        )
    return rows


def uri(pointer):
    if pointer.startswith("s3://"):
        return "s3a://" + pointer[5:]
    parts = urlsplit(pointer)
    return f"s3a://{parts.hostname.split('.')[0]}{parts.path}" if parts.hostname else None


def truthy_text(data, names):
    values = [data.get(name) for name in names] if isinstance(data, dict) else []
    value = next((value for value in values if value or value in ([], {})), "")
    if value is False or value is None or value == 0 and not isinstance(value, (list, dict, str)):
        return ""
    if not isinstance(value, str):
        raise TypeError
    return value


def model(rows, bodies, versions, cap):
    """The incidents one run finds, by fingerprint."""
    start = AS_OF - timedelta(days=3)
    kept = {}
    order = lambda row: (-row["timestamp"].timestamp(), row["session_id"])
    for row in sorted(rows, key=order):
        message = row["exceptions_data"][0][0] if row["exceptions_data"] else ""
        noisy = any(token in message.lower() for token in ("timeout", "cancelled", "aborted"))
        if row["timestamp"] >= start and message and row["s3_pointer"] and not noisy:
            key = "|".join([row["service_name"], row["endpoint_uuid"], message])
            kept.setdefault(key, row)
    found = {}
    for row in sorted(kept.values(), key=order)[:cap]:
        body = bodies.get(uri(row["s3_pointer"]))
        try:
            data = json.loads(body)
            if data is None:
                continue
            message = truthy_text(data, ("error_message", "message", "error"))
            stack = truthy_text(data, ("stack_trace", "stackTrace"))
        except (TypeError, ValueError):
            continue
        message = message or row["exceptions_data"][0][0]
        names = [name for name in row["function_ids"] if name.strip()]
        for line in stack.split("\n"):
            frame = re.search(r"at (\w+(?:\.\w+)*)", line)
            names += [frame.group(1)] if frame else []
        names = list(dict.fromkeys(names))[:10]
        text = re.sub(r"\d+", "N", message.lower())
        text = " ".join(re.sub("['\"]", "", text).split())
        plain = f"{text}|{'|'.join(sorted(names[:5]))}"
        fingerprint = hashlib.sha256(plain.encode()).hexdigest()
        endpoint = [v for v in versions if (v[0], v[2]) == (row["account_id"], row["endpoint_id"])]
        paths = sorted((v[3], v[4]) for v in endpoint if v[4])
        methods = sorted((v[3], v[5]) for v in endpoint if v[5] is not None)
        found.setdefault(
            fingerprint,
            (
                row["session_id"], message, stack, tuple(names),
                (paths[-1][1] if paths else "Unknown path") if endpoint else None,
                tuple(methods[-1][1] if methods else ()) if endpoint else None,
            ),
        )
    return found


VERSIONS = [
    ("acct", "prod", 1, 1, "/one", ["GET"]), ("acct", "prod", 1, 2, None, ["PUT"]),
    ("acct", "prod", 2, 1, None, None), ("other", "prod", 1, 7, "/other", []),
]


@pytest.mark.parametrize("seed,cap", [(1, None), (2, None), (3, 150), (4, 150)])
def test_triage_equals_the_model(spark, seed, cap):
    rng = random.Random(seed)
    rows = random_rows(rng, 900)
    bodies = {number: rng.choice(BODIES) for number in range(0, 900) if rng.random() < 0.9}
    bodies[0] = BODIES[6]
    expected = model(
        rows, {f"s3a://b/{n}.json": body for n, body in bodies.items()}, VERSIONS, cap
    )
    found = triage.candidates(investigations(spark, rows), 3, AS_OF, cap)
    objects = payloads(spark, bodies)
    versions = endpoint_versions(spark, VERSIONS)

    def shown(frame):
        return {
            row.root_cause_hash: (
                row.id, row.error_message, row.stack_trace, tuple(row.throwing_functions),
                row.endpoint_path,
                None if row.endpoint_methods is None else tuple(row.endpoint_methods),
            )
            for row in frame.collect()
        }

    unique = triage.distinct_incidents(found, objects)
    assert shown(triage.with_endpoints(unique, versions)) == expected
    assert len(expected) > 15
    through_outcomes = newest_per_fingerprint(
        to_incidents(with_fingerprint(triage.outcomes(found, objects)))
    )
    assert shown(triage.enrich(through_outcomes, endpoint_info(endpoint_states(versions)))) == expected
