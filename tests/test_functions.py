"""Golden rows of the column expressions."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultsift.functions import fingerprint, issue
from faultsift.functions.pointers import listed_uri, storage_uri
from faultsift.functions.text import upper_text


def one_column(spark, values, expression, dtype="string"):
    rows = [(i, value) for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, v {dtype}")
    found = frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row.out for row in found]


GOLDEN = [
    ("Order   9091 not found", ["fn11.run"], "order N not found",
     "f8f5550f3002f63bad68973e1a03180f3b2a3d9788a35f01be0e135bdfda17e9"),
    ('Bad  "input" 1005', list("zbadce"), "bad input N",
     "32f1c02086e2227bd7bd3d7f5bb4d3385aced1165f8a4120657599e8d073a689"),
    ("  Can't read 'x' at 12.5\tms ", [], "cant read x at N.N ms",
     "b5834599db5e3c473e760e3c00f57c58e6cf6a9ab4166eb59e8d82abb889c899"),
    ("", [], "", "cbe5cfdf7c2118a9c3d78ef1d684f3afa089201352886449a06a6511cfef74a7"),
]


def test_golden_fingerprints(spark):
    rows = [(i, message, names) for i, (message, names, _, _) in enumerate(GOLDEN)]
    frame = spark.createDataFrame(rows, "i int, message string, names array<string>")
    message, names = F.col("message"), F.col("names")
    found = frame.select(
        "i",
        fingerprint.normalized_error(message).alias("normalized"),
        fingerprint.root_cause_hash(message, names).alias("hash"),
    )
    expected = [(i, normalized, sha) for i, (_, _, normalized, sha) in enumerate(GOLDEN)]
    assert [tuple(row) for row in found.orderBy("i").collect()] == expected


def test_unicode_white_space(spark):
    text = "a\u00a0\u2003b\u2028c\ufeff\u3000\n\x0bd\u180ee"
    assert one_column(spark, [text], fingerprint.normalized_error) == ["a b c d\u180ee"]


def test_fingerprint_ignores_digits_quotes_case_and_space(spark):
    same = ["User 12 'x' missing", 'user 9  "X"  MISSING ', "USER 7 x\tmissing"]
    hashes = one_column(
        spark, same, lambda m: fingerprint.root_cause_hash(m, F.array(F.lit("f")))
    )
    assert len(set(hashes)) == 1


@settings(max_examples=3, deadline=None)
@given(messages=st.lists(st.text(alphabet=" ab7'\"\tZ", max_size=12), min_size=20, max_size=40))
def test_normalisation_against_python(spark, messages):
    def plain(text):
        out, last_digit = [], False
        for char in text.lower():
            digit = char.isdigit()
            if digit and not last_digit:
                out.append("N")
            elif not digit and char not in "'\"":
                out.append(char)
            last_digit = digit
        return " ".join("".join(out).split())

    assert one_column(spark, messages, fingerprint.normalized_error) == [plain(m) for m in messages]


def test_stack_functions_take_the_first_frame_of_each_line(spark):
    stack = "\n".join(
        ["Error: x", "    at foo.bar (a.js:1)", " at async baz", "What happened at q", "",
         "at a.b.c at d.e\r", "at ..x", "cat one\rat two", "at x..y"]
    )
    assert one_column(spark, [stack, "", "no frames"], fingerprint.stack_functions) == [
        ["foo.bar", "async", "happened", "a.b.c", "one", "x"], [], []
    ]


def test_a_very_long_frame_name_does_not_exhaust_the_stack(spark):
    chain = F.concat(F.lit("at a"), F.repeat(F.lit(".b"), 200_000))
    names = spark.range(1).select(fingerprint.stack_functions(chain).alias("names"))
    assert names.select(F.length(F.col("names")[0])).first()[0] == 400_001


def test_throwing_functions_keep_order_and_ten(spark):
    stack = "\n".join(f"at s{i}.run" for i in [1, 2, 1, 3, 4, 5, 6, 7, 8])
    frame = spark.createDataFrame([(["b", "s2.run", "a"], stack)], "n array<string>, s string")
    found = frame.select(fingerprint.throwing_functions(F.col("n"), F.col("s"))).first()[0]
    assert found == ["b", "s2.run", "a"] + [f"s{i}.run" for i in [1, 3, 4, 5, 6, 7, 8]]


def test_blank_function_names_are_dropped_untrimmed_ones_kept(spark):
    frame = spark.createDataFrame(
        [({" x ": 1, "": 2, " ": 3, "\u00a0\t": 4},)], "m map<string,bigint>"
    )
    assert frame.select(fingerprint.named_functions(F.col("m"))).first()[0] == [" x "]


def test_pointers(spark):
    pointers = {
        "s3://b/x/y.json": "s3a://b/x/y.json",
        "https://bkt.s3.amazonaws.com/a/b%20c.json?x=1": "s3a://bkt/a/b%20c.json",
        "https://BKT.s3.amazonaws.com/A": "s3a://bkt/A",
        "https://bkt.s3.amazonaws.com/a#part": "s3a://bkt/a",
        "not a url": None,
        "": None,
        None: None,
    }
    assert one_column(spark, list(pointers), storage_uri) == list(pointers.values())


def test_listed_uris_are_decoded(spark):
    listed = ["s3a://b/a%20b+c.json", "s3a://b/a%2520b.json"]
    assert one_column(spark, listed, listed_uri) == ["s3a://b/a b+c.json", "s3a://b/a%20b.json"]


@pytest.mark.parametrize("size", [50, 60])
def test_shorten_and_lead(spark, size):
    texts = ["x" * (size - 1), "x" * size, "x" * (size + 1), "é" * (size + 1)]
    shortened = one_column(spark, texts, lambda t: issue.shorten(t, size))
    assert shortened == texts[:2] + ["x" * size + "...", "é" * size + "..."]
    led = one_column(spark, ["short"], lambda t: issue.lead(t, size))
    assert led == ["short..."]


INCIDENT = """
    id string, service_name string, endpoint_uuid string, account_id string,
    environment_name string, error_message string, timestamp timestamp, s3_pointer string,
    root_cause_hash string, endpoint_path string, endpoint_methods array<string>
"""


def incident(path, methods, message="boom"):
    from datetime import datetime, timezone

    ts = datetime(2024, 1, 2, 3, 4, 5, 678999, tzinfo=timezone.utc)
    return ("s-1", "svc", "ep-1", "acct", "prod", message, ts, "s3://b/k", "abc", path, methods)


ENDPOINTS = [
    (None, None), ("/a", []), ("/a", ["GET", "POST"]), ("/a", None), ("Unknown path", ["GET"]),
]


def rendered(spark, column, rows):
    frame = spark.createDataFrame(rows, INCIDENT).coalesce(1)
    return [row[0] for row in frame.select(column).collect()]


def test_titles(spark):
    rows = [incident(path, methods) for path, methods in ENDPOINTS]
    rows.append(incident(None, None, "m" * 51))
    assert rendered(spark, issue.issue_title(), rows) == [
        "🚨 svc: boom", "🚨 svc ANY /a: boom", "🚨 svc GET,POST /a: boom", "🚨 svc: boom",
        "🚨 svc GET Unknown path: boom", "🚨 svc: " + "m" * 50 + "...",
    ]


def test_labels(spark):
    rows = [incident(path, methods) for path, methods in ENDPOINTS]
    heads = [text.split("\n")[0] for text in rendered(spark, issue.choice_label(), rows)]
    assert heads == [
        "[svc] [prod] ep-1", "[svc] [prod] ANY /a", "[svc] [prod] GET,POST /a",
        "[svc] [prod] ANY /a", "[svc] [prod] GET Unknown path",
    ]
    full = rendered(spark, issue.choice_label(), [incident(None, None, "e" * 61)])
    assert full == [
        "[svc] [prod] ep-1\n    🚨 " + "e" * 60 + "...\n    ⏰ 2024-01-02 03:04:05"
    ]
    assert rendered(spark, issue.choice_short(), rows[:1]) == ["svc: boom..."]
    assert rendered(spark, issue.progress_text(), rows[:1]) == [
        "Drafting svc - boom..."
    ]


def test_body(spark):
    rows = [incident("/a", ["GET", "POST"]), incident(None, None)]
    bodies = rendered(spark, issue.issue_body("Bot", preamble="Note."), rows)
    assert bodies[0].split("\n") == [
        "## Bug Report", "**Detected by:** Bot", "**Timestamp:** 2024-01-02T03:04:05.678Z",
        "**Severity:** High", "", "Note.", "", "## Description", "", "**Service:** svc",
        "**Endpoint:** GET, POST /a", "**Environment:** prod", "**Error:** boom", "",
        "## Additional Context", "- **Account ID:** acct", "- **Incident ID:** s-1",
        "- **Root Cause Hash:** abc", "- **S3 Pointer:** s3://b/k",
    ]
    assert "**Endpoint:** Unknown endpoint" in bodies[1]
    assert "Note." not in rendered(spark, issue.issue_body(), rows)[0]


def test_upper_text(spark):
    assert one_column(spark, ["aé", "straße", None], upper_text) == ["AÉ", "STRASSE", None]


def test_fingerprint_is_plain_sha256(spark):
    text = "boom N|a|b"
    found = one_column(
        spark, ["BOOM 42"], lambda m: fingerprint.root_cause_hash(m, F.array(F.lit("b"), F.lit("a")))
    )
    assert found == [hashlib.sha256(text.encode()).hexdigest()]
