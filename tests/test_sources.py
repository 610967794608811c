"""JSON rows, payload objects, landed payloads and run tables on disk."""

import json

import pytest
from pyspark.sql import functions as F

from faultsift.operators.payloads import join_payloads, left_join_payloads
from faultsift.plans import triage
from faultsift.schemas import POSTED
from faultsift.session import work_folder
from faultsift.sources.ledger import (
    append_ledger,
    compact_ledger,
    init_ledger,
    read_ledger,
    read_ledger_log,
    record_posted,
)
from faultsift.sources.investigations import read_investigation_rows, read_investigations
from faultsift.sources.payloads import (
    land_payloads,
    read_payload_objects,
    read_payload_table,
    start_landing,
    table_buckets,
)
from faultsift.sources.runs import claim_run, read_runs, write_run
from tests.builders import investigation, investigations, payloads
from tests.test_operators import ids, ledger_rows
from tests.test_plans import plan


def test_json_rows_with_unnamed_tuples(spark, tmp_path):
    rows = [
        {
            "account_id": "a", "session_id": "s-1", "environment_id": "18446744", "service_id": 7,
            "endpoint_id": "9007199254740993", "timestamp": "2024-01-02 03:04:05.678901",
            "exceptions_data": [["msg", ["f1", "f2"]], ["m2", []]],
            "function_ids": {"f1": "12", "f2": 3},
            "exceptions_data_enriched": [["msg", ["1", 2]]], "unknown": {"x": 1},
        },
        {
            "session_id": "s-2", "timestamp": "soon", "exceptions_data": [],
            "endpoint_id": "1.x", "function_ids": {"f": "many", "g": 1},
        },
    ]
    (tmp_path / "rows.json").write_text("\n".join(json.dumps(row) for row in rows))
    first, second = read_investigation_rows(spark, str(tmp_path)).orderBy("session_id").collect()
    assert [(e.message, e.functions) for e in first.exceptions_data] == [
        ("msg", ["f1", "f2"]), ("m2", [])
    ]
    assert (first.endpoint_id, first.environment_id, first.service_id) == (9007199254740993, 18446744, 7)
    assert first.function_ids == {"f1": 12, "f2": 3}
    assert [(e.message, e.ids) for e in first.exceptions_data_enriched] == [("msg", [1, 2])]
    assert str(first.timestamp) == "2024-01-02 03:04:05.678901"
    assert (second.endpoint_id, second.function_ids) == (None, {"f": None, "g": 1})
    assert (second.timestamp, second.exceptions_data, second.service_name) == (None, [], None)


def test_payload_objects_are_whole_files(spark, tmp_path):
    folder = tmp_path / "flows" / "deep"
    folder.mkdir(parents=True)
    texts = {"a b+c.json": '{"message":\n"x"}', "p%20q.json": "{}\n", "é.json": "null"}
    for name, text in texts.items():
        (folder / name).write_text(text)
    found = read_payload_objects(spark, str(tmp_path)).collect()
    root = f"file://{folder}/"
    read = {row.obj_uri.replace("file:///", "file:/"): row.body for row in found}
    assert read == {(root + name).replace("file:///", "file:/"): text for name, text in texts.items()}


def test_object_paths_become_the_uris_of_pointers(spark, tmp_path):
    (tmp_path / "copy" / "deep").mkdir(parents=True)
    (tmp_path / "copy" / "deep" / "1.json").write_text("{}")
    for prefix in (f"{tmp_path}/copy", f"file://{tmp_path}/copy/"):
        found = read_payload_objects(spark, prefix, "s3a://b/flows/").collect()
        assert [row.obj_uri for row in found] == ["s3a://b/flows/deep/1.json"]


def test_landed_payloads_are_read_by_bucket(spark, tmp_path):
    objects = payloads(spark, {n: f'{{"message":"m {n}"}}' for n in range(200)})
    path = str(tmp_path / "landed")
    land_payloads(objects.where("obj_uri < 's3a://b/15'"), path, buckets=16)
    land_payloads(objects.where("obj_uri >= 's3a://b/15'"), path)
    landed = read_payload_table(spark, path)
    assert landed.count() == 200
    rows = [investigation(n, f"m{n}") for n in (3, 4, 500)]
    found = triage.slim(investigations(spark, rows))
    write_run(found, str(tmp_path / "candidates"), 1)
    kept = spark.read.schema(found.schema).parquet(str(tmp_path / "candidates" / "run=1"))
    joined = join_payloads(kept, landed)
    assert sorted(joined.collect()) == sorted(join_payloads(kept, objects).collect())
    assert joined.count() == 2
    for join in (join_payloads, left_join_payloads):
        assert "dynamicpruning" in plan(join(kept, landed))


def test_another_bucket_count_is_an_error(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_payloads(payloads(spark, {1: "{}"}), path, buckets=16)
    with pytest.raises(ValueError, match="16 buckets, not 8"):
        land_payloads(payloads(spark, {2: "{}"}), path, buckets=8)
    assert table_buckets(spark, path) == 16


def test_landing_again_does_not_multiply(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_payloads(payloads(spark, {1: '{"message":"old"}', 2: "{}"}), path, buckets=4)
    for _ in range(2):
        land_payloads(payloads(spark, {1: '{"message":"corrected"}'}), path)
    found = triage.slim(investigations(spark, [investigation(1), investigation(2)]))
    result = triage.outcomes(found, read_payload_table(spark, path)).collect()
    assert sorted((row.session_id, row.payload_message) for row in result) == [
        ("s-1", "corrected"), ("s-2", "")
    ]


def test_objects_are_landed_once_as_they_appear(spark, tmp_path):
    prefix, path = tmp_path / "objects", str(tmp_path / "landed")
    prefix.mkdir()
    for numbers in (range(0, 3), range(3, 5)):
        for n in numbers:
            (prefix / f"{n}.json").write_text(f'{{"message":"m {n}"}}')
        start_landing(
            spark, str(prefix), path, str(tmp_path / "checkpoint"), 4, "s3a://b", 2
        ).awaitTermination()
    landed = read_payload_table(spark, path)
    assert sorted(row.obj_uri for row in landed.collect()) == [f"s3a://b/{n}.json" for n in range(5)]


def test_investigations_by_date_partition(spark, tmp_path):
    rows = [investigation(n, minutes=n * 1440) for n in range(5)]
    path = str(tmp_path / "inv")
    frame = investigations(spark, rows).withColumn("day", F.to_date("timestamp"))
    frame.write.partitionBy("day").parquet(path)
    assert ids(read_investigations(spark, path, "day").where("day >= '2024-01-13'")) == ["s-3", "s-4"]


def test_ledger_runs(spark, tmp_path):
    path = str(tmp_path / "ledger")
    init_ledger(spark, path)
    assert read_ledger(spark, path).isEmpty()
    append_ledger(ledger_rows(spark, [(1, "a", 10, 1, "x"), (2, "b", 11, 1, "y")]), path, 1)
    init_ledger(spark, path)
    for _ in range(2):
        append_ledger(ledger_rows(spark, [(3, "b", 12, 2, "y2")]), path, 2)
        found = {row.root_cause_hash: row.id for row in read_ledger(spark, path).collect()}
        assert found == {"a": 1, "b": 3}
    before = {row.root_cause_hash: row.id for row in read_ledger(spark, path, before=2).collect()}
    assert before == {"a": 1, "b": 2}


def test_a_repeated_run_replaces_itself_even_with_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_run(spark.range(3), path, 1)
    write_run(spark.range(5), path, 2)
    write_run(spark.range(0), path, 2)
    assert read_runs(spark, "id BIGINT", path).count() == 3
    assert read_runs(spark, "id BIGINT", path, before=1).isEmpty()


def test_claims_go_on_from_the_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    first = claim_run(spark, path, "a", 0)
    assert (first.run, first.previous) == (1, None)
    assert claim_run(spark, path, "b", 0).run == 2
    assert claim_run(spark, path, "a", 1).run == 3
    again = claim_run(spark, path, "a", 0)
    assert (again.run, again.claimed_at) == (1, first.claimed_at)
    assert claim_run(spark, path, "a", 2).previous == 3
    assert claim_run(spark, path, "b", 0).run == 2


def test_ledger_rows_are_checked(spark, tmp_path):
    path = str(tmp_path / "ledger")
    init_ledger(spark, path)
    with pytest.raises(ValueError, match="repeat"):
        append_ledger(ledger_rows(spark, [(1, "a", 1, 1, "x"), (2, "a", 2, 1, "x")]), path, 1)
    assert read_ledger(spark, path).isEmpty()
    with pytest.raises(Exception, match="need root_cause_hash"):
        append_ledger(ledger_rows(spark, [(1, None, 1, 1, "x")]), path, 2)


def test_a_compacted_ledger_holds_the_same(spark, tmp_path):
    path, new = str(tmp_path / "ledger"), str(tmp_path / "new")
    init_ledger(spark, path)
    for run, rows in ((1, [(1, "a", 10, 1, "x")]), (2, [(2, "a", 11, 2, "y"), (3, "b", 12, 2, "z")])):
        assert claim_run(spark, path, "w", run).run == run
        append_ledger(ledger_rows(spark, rows), path, run)
    compact_ledger(spark, path, new)
    assert sorted(read_ledger(spark, new).collect()) == sorted(read_ledger(spark, path).collect())
    assert read_ledger_log(spark, new).count() == 2
    assert claim_run(spark, new, "w", 2).run == 2
    assert claim_run(spark, new, "other").run == 3


def test_posted_issues_get_their_numbers(spark, tmp_path):
    path = str(tmp_path / "ledger")
    init_ledger(spark, path)
    append_ledger(ledger_rows(spark, [(1, "a", None, 1, "x"), (2, "b", None, 1, "y")]), path, 0)
    posted = spark.createDataFrame([("a", 70), ("a", 71), ("new", 72), (None, 73)], POSTED)
    for _ in range(2):
        record_posted(spark, posted, path, "poster")
        found = {r.root_cause_hash: (r.github_issue_number, r.error_pattern) for r in read_ledger(spark, path).collect()}
        assert found == {"a": (71, "x"), "b": (None, "y"), "new": (72, "")}


def test_work_folder_is_below_the_configured_one(spark):
    folder = work_folder(spark, "x")
    assert folder != work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("column", ["exceptions_data", "function_ids"])
def test_nested_columns_survive_parquet(spark, tmp_path, column):
    frame = investigations(spark, [investigation(1)])
    frame.write.parquet(str(tmp_path / "t"))
    read = read_investigations(spark, str(tmp_path / "t"))
    assert read.select(column).collect() == frame.select(column).collect()
