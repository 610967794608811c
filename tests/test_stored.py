"""Tables kept from run to run: packed payloads, endpoint states, newest rows by day."""

import os
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from faultsift import __main__ as jobs
from faultsift.operators.endpoints import endpoint_info, endpoint_states, merge_states
from faultsift.operators.payloads import join_payloads, left_join_payloads, wanted_payloads
from faultsift.plans import triage
from faultsift.sources.endpoints import read_endpoint_states, start_endpoint_states
from faultsift.sources.files import names_in
from faultsift.sources.investigations import read_investigation_stream
from faultsift.sources.newest import read_candidates, start_newest
from faultsift.sources.payloads import (
    land_payloads,
    open_payload_table,
    pack_payloads,
    read_payload_table,
    remove_packed,
    unlanded_objects,
)
from faultsift.sources.runs import read_runs
from faultsift.streaming.intake import start_first_arrivals
from tests.builders import START, endpoint_versions, investigation, investigations, payloads

BUCKETS = 4


def uris(numbers):
    return sorted(f"s3a://b/{n}.json" for n in numbers)


def land(spark, path, bodies, minutes=0):
    at = F.lit(START + timedelta(minutes=minutes))
    land_payloads(payloads(spark, bodies).withColumn("landed_at", at), path, BUCKETS)


def executed_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def candidates_of(spark, numbers):
    return triage.slim(investigations(spark, [investigation(n, f"m{n}") for n in numbers]))


def test_packed_and_late_landings_are_one_table(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(spark, path, {n: f"old {n}" for n in range(50)})
    land(spark, path, {n: f"new {n}" for n in range(10)}, minutes=5)
    assert pack_payloads(spark, path) and not pack_payloads(spark, path)
    land(spark, path, {n: f"newest {n}" for n in range(5)}, minutes=9)
    table = open_payload_table(spark, path)
    assert len(table.packs) == 1 and table.tail.count() == 5
    assert read_payload_table(spark, path).count() == 65
    found = candidates_of(spark, [1, 7, 30, 99])
    want = [("s-1", "newest 1"), ("s-30", "old 30"), ("s-7", "new 7")]
    for payload_table in (table, table.rows):
        joined = join_payloads(found, payload_table)
        assert sorted((r.session_id, r.body) for r in joined.collect()) == want
    assert left_join_payloads(found, table).where("body IS NULL").count() == 1
    # Packed landings can go; what was landed since stays.
    remove_packed(spark, path)
    assert sorted((r.session_id, r.body) for r in join_payloads(found, open_payload_table(spark, path)).collect()) == want
    assert len([n for n in names_in(spark, f"{path}/rows") if n.startswith("landing=")]) == 1
    assert open_payload_table(spark, path, date(2100, 1, 1)).packs == ()


def test_no_body_of_a_pack_is_shuffled_before_it_is_wanted(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(spark, path, {n: f"body {n}" for n in range(200)})
    pack_payloads(spark, path)
    (pack,) = open_payload_table(spark, path).packs
    found = candidates_of(spark, range(0, 400, 3))
    plan = executed_plan(wanted_payloads(found, open_payload_table(spark, path)))
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    depth = lines[scan].index("FileScan")
    above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-|*()0123456789")) < depth]
    join = max(k for k, line in enumerate(above) if "ShuffledHashJoin" in line)
    assert "LeftSemi" in above[join]
    assert not any("Exchange" in line for line in above[join + 1 :])
    assert pack.count() == 200


def test_packing_disturbs_no_lookup_and_loses_no_landing(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(spark, path, {0: "{}"})

    def landings(part):
        for n in range(5):
            land(spark, path, {100 * part + n + 1: "{}"}, minutes=n)

    def packs():
        return [pack_payloads(spark, path) for _ in range(4)]

    def lookups():
        return [open_payload_table(spark, path).rows.select("obj_uri").distinct().count() for _ in range(6)]

    with ThreadPoolExecutor(5) as pool:
        beside = [pool.submit(packs), pool.submit(packs), pool.submit(lookups)]
        list(pool.map(landings, range(1, 3)))
        counts = beside[2].result()
        assert any(beside[0].result() + beside[1].result())
    assert counts == sorted(counts) and counts[0] >= 1
    every = [0] + [100 * part + n + 1 for part in (1, 2) for n in range(5)]
    pack_payloads(spark, path)
    remove_packed(spark, path)
    found = open_payload_table(spark, path).rows.select("obj_uri").distinct()
    assert sorted(r.obj_uri for r in found.collect()) == uris(every)


def test_objects_listed_and_not_landed(spark, tmp_path):
    folder, path = tmp_path / "objects", str(tmp_path / "landed")
    folder.mkdir()
    for n in range(4):
        (folder / f"{n}.json").write_text("{}")
    land(spark, path, {0: "{}", 2: "{}"})
    pack_payloads(spark, path)
    land(spark, path, {3: "{}"})
    missing = unlanded_objects(spark, str(folder), path, "s3a://b")
    assert [r.obj_uri for r in missing.collect()] == ["s3a://b/1.json"]


def state_bytes(folder):
    return sum(
        os.path.getsize(os.path.join(at, name))
        for at, _, names in os.walk(folder)
        for name in names
        if f"{os.sep}state{os.sep}" in at and not name.endswith(".crc")
    )


def test_state_of_arrivals_does_not_grow_with_bodies(spark, tmp_path):
    sizes = []
    for size in (10, 40_000):
        folder = f"{tmp_path}/{size}"
        text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=size))
        land(spark, f"{folder}/landed", {n: f'{{"message":"lost","x":"{text}"}}' for n in range(40)})
        rows = [investigation(n, "here") for n in range(3)]
        investigations(spark, rows).write.parquet(f"{folder}/in")
        start_first_arrivals(
            read_investigation_stream(spark, f"{folder}/in"), f"{folder}/landed", 2,
            f"{folder}/out", f"{folder}/checkpoint",
        ).awaitTermination()
        assert [r.error_message for r in spark.read.parquet(f"{folder}/out").collect()] == ["lost"]
        sizes.append(state_bytes(f"{folder}/checkpoint"))
    assert 0 < sizes[1] < 1.2 * sizes[0]


def some_versions(rng, n):
    return [
        ("acct", "prod", rng.randrange(6), rng.randrange(9), rng.choice([None, "", "/a", "/b"]), rng.choice([None, ["GET"], []]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("every", [1, 2, 100])
def test_stored_states_equal_one_aggregate(spark, tmp_path, every):
    rng, versions, table = random.Random(every), str(tmp_path / "versions"), str(tmp_path / "states")
    rows = []
    for part in range(5):
        new = some_versions(rng, 12)
        rows += new
        endpoint_versions(spark, new).coalesce(1).write.mode("append").parquet(versions)
        start_endpoint_states(spark, versions, table, every).awaitTermination()
        stored = merge_states(read_endpoint_states(spark, table))
        want = endpoint_states(endpoint_versions(spark, rows))
        assert sorted(stored.collect(), key=repr) == sorted(want.select(*stored.columns).collect(), key=repr)
    # Nothing new: nothing is read or written.
    before = names_in(spark, f"{table}/new")
    start_endpoint_states(spark, versions, table, every).awaitTermination()
    assert names_in(spark, f"{table}/new") == before
    if every == 2:
        # Batches 0 to 4; generations after 1 and 3; what the first replaced is gone.
        assert names_in(spark, f"{table}/complete") == [f"{n:012d}" for n in (1, 3)]
        assert names_in(spark, f"{table}/new") == ["run=2", "run=3", "run=4"]


def test_runs_take_stored_states(spark, tmp_path):
    versions, table = str(tmp_path / "versions"), str(tmp_path / "states")
    rows = [("acct", "prod", 1, 1, "/old", ["GET"]), ("acct", "prod", 1, 2, "/new", None)]
    for row in rows:
        endpoint_versions(spark, [row]).write.mode("append").parquet(versions)
        start_endpoint_states(spark, versions, table).awaitTermination()
    found = candidates_of(spark, [1])
    incidents = triage.incidents(found, payloads(spark, {1: "{}"}))
    both = [
        triage.with_endpoints(incidents, source).select("endpoint_path", "endpoint_methods").collect()
        for source in (endpoint_versions(spark, rows), read_endpoint_states(spark, table))
    ]
    assert both[0] == both[1] and both[0][0].endpoint_path == "/new"
    assert endpoint_info(merge_states(read_endpoint_states(spark, table))).count() == 1


def test_newest_by_day_equals_the_whole_look_back(spark, tmp_path):
    """At any cut of days, with late rows for old days and keys that come again."""
    source, table, day = str(tmp_path / "in"), str(tmp_path / "days"), 24 * 60
    rng, rows, number = random.Random(4), [], 0
    for part in range(4):
        new = []
        for _ in range(40):
            number += 1
            minutes = rng.randrange(max(0, part - 2) * day, (part + 1) * day)
            new.append(investigation(number, f"boom {'abcd'[rng.randrange(4)]}", minutes=minutes,
                                     service_name=f"svc-{rng.randrange(2)}"))
        rows += new
        investigations(spark, new).coalesce(1).write.mode("append").parquet(source)
        start_newest(read_investigation_stream(spark, source), table, every=3).awaitTermination()
        for days in (1, 2, 9):
            for minutes in (part * day + 700, (part + 1) * day):
                as_of = START + timedelta(minutes=minutes)
                want = triage.candidates(investigations(spark, rows), days, as_of)
                got = read_candidates(spark, table, days, as_of)
                assert sorted(got.collect(), key=repr) == sorted(want.select(*got.columns).collect(), key=repr)
    as_of = START + timedelta(minutes=4 * day)
    files = executed_plan(read_candidates(spark, table, 1, as_of))
    assert "PartitionFilters" in files and "seen_on" in files


def test_a_capped_run_counts_while_it_reads(spark, tmp_path, monkeypatch):
    """No second pass over the investigations for the summary's counter."""
    paths = {name: str(tmp_path / name) for name in ("inv", "pay", "end", "led", "out")}
    investigations(spark, [investigation(n, f"m{'abcdefg'[n]}") for n in range(7)]).write.parquet(paths["inv"])
    (tmp_path / "pay").mkdir()
    for n in range(7):
        (tmp_path / "pay" / f"{n}.json").write_text("{}")
    endpoint_versions(spark).write.parquet(paths["end"])

    def count(self):
        raise AssertionError("a second pass")

    monkeypatch.setattr(type(spark.range(1)), "count", count)
    jobs.main([
        "--investigations", paths["inv"], "--payloads", paths["pay"], "--raw", "--store", "s3a://b",
        "--endpoints", paths["end"], "--ledger", paths["led"], "--out", paths["out"],
        "--as-of", "2024-01-11", "--cap", "2",
    ])
    monkeypatch.undo()
    row = read_runs(spark, "cut BIGINT, total BIGINT", f"{paths['out']}/summary").first()
    assert (row.cut, row.total) == (5, 2)
