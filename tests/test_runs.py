"""Whole runs: the batch job, its replays, and the streams."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from faultsift.__main__ import main, parse_args
from faultsift.operators.ledger import unsolved
from faultsift.operators.ranking import newest_per_key
from faultsift.plans import triage
from faultsift.plans.run import run_triage
from faultsift.schemas import APPROVALS, CHOICES, LEDGER, WAITING
from faultsift.sources.drafts import DRAFTS
from faultsift.sources.investigations import read_investigation_stream
from faultsift.sources.ledger import read_ledger
from faultsift.sources.payloads import land_payloads, read_payload_table
from faultsift.sources.runs import read_runs
from faultsift.streaming.intake import (
    intake,
    start_first_arrivals,
    start_triage,
    still_waiting,
)
from tests.builders import START, endpoint_versions, investigation, investigations, payloads

LETTERS = "abcdefghij"


def rows(numbers, shift=0):
    return [
        investigation(n, f"boom {LETTERS[n % 10]}", minutes=n + shift, service_name=f"svc-{n % 2}")
        for n in numbers
    ]


def objects(spark, numbers):
    return payloads(spark, {n: "{}" for n in numbers})


def drafted(spark, out):
    found = read_runs(spark, DRAFTS, f"{out}/drafts").collect()
    return {row.root_cause_hash: (row.id, row.run) for row in found}


def test_runs_draft_each_cause_once(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    versions = endpoint_versions(spark, [("acct", "prod", 1, 1, "/a", ["GET"])])

    def run(writer, numbers):
        found = triage.slim(investigations(spark, rows(numbers)))
        return run_triage(found, objects(spark, numbers), versions, out, ledger, writer).first()

    first = run("a", range(4))
    assert (first.total, first.created, first.skipped) == (4, 4, 0)
    second = run("b", range(2, 8))
    assert (second.total, second.created, second.skipped) == (6, 4, 2)
    before = drafted(spark, out)
    assert sorted(run for _, run in before.values()) == [1] * 4 + [2] * 4
    times = {row.created_at for row in read_ledger(spark, ledger).collect()}

    assert run("b", range(2, 8)) == second
    assert drafted(spark, out) == before
    kept = read_ledger(spark, ledger).collect()
    assert sorted(row.id for row in kept) == list(range(1, 9))
    assert {row.root_cause_hash for row in kept} == set(before)
    assert {row.created_at for row in kept} == times
    assert {row.github_issue_number for row in kept} == {None}
    titles = {row.title for row in read_runs(spark, DRAFTS, f"{out}/drafts").collect()}
    assert "🚨 svc-0 GET /a: boom a" in titles


def test_an_empty_rerun_replaces_everything(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")

    def run(numbers):
        found = triage.slim(investigations(spark, rows(numbers)))
        return run_triage(
            found, objects(spark, numbers), endpoint_versions(spark), out, ledger, "same"
        ).first()

    assert run(range(4)).created == 4
    none = run([])
    assert (none.total, none.created, none.percent) == (0, 0, None)
    assert drafted(spark, out) == {} and read_ledger(spark, ledger).isEmpty()


def test_only_approved_incidents_are_drafted(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    found = triage.slim(investigations(spark, rows(range(3))))
    incidents = triage.incidents(found, objects(spark, range(3))).collect()
    approvals = spark.createDataFrame([(incidents[0].root_cause_hash,)], APPROVALS)
    summary = run_triage(
        found, objects(spark, range(3)), endpoint_versions(spark), out, ledger, "a",
        approvals=approvals,
    ).first()
    assert (summary.new, summary.created) == (3, 1)
    assert set(drafted(spark, out)) == {incidents[0].root_cause_hash}
    assert read_ledger(spark, ledger).count() == 1
    offered = read_runs(spark, CHOICES, f"{out}/choices").collect()
    assert {row.root_cause_hash for row in offered} == {row.root_cause_hash for row in incidents}


def test_command_line(spark, tmp_path, capsys):
    names = ("inv", "pay", "end", "led", "out", "landed", "check", "posted", "new")
    paths = {name: str(tmp_path / name) for name in names}
    investigations(spark, rows(range(3))).write.parquet(paths["inv"])
    (tmp_path / "pay").mkdir()
    for number in range(3):
        (tmp_path / "pay" / f"{number}.json").write_text('{"message":"lost %s"}' % LETTERS[number])
    endpoint_versions(spark).write.parquet(paths["end"])
    base = [
        "--investigations", paths["inv"], "--endpoints", paths["end"],
        "--ledger", paths["led"], "--out", paths["out"], "--as-of", "2024-01-11",
    ]
    raw = ["--payloads", paths["pay"], "--raw"]
    main([*base, *raw])
    # Without --store the files lie outside the object store the pointers name.
    assert "3 candidates, 0 drafts, 0 causes known before" in capsys.readouterr().out
    main([*base, *raw, "--store", "s3a://b", "--cap", "1", "--writer", "capped"])
    assert "1 candidates, 1 drafts" in capsys.readouterr().out
    summary = read_runs(spark, "cut BIGINT", f"{paths['out']}/summary").where("run = 2").first()
    assert summary.cut == 2
    main(["land", "--objects", paths["pay"], "--payloads", paths["landed"], "--store", "s3a://b",
          "--checkpoint", paths["check"], "--buckets", "4"])
    main([*base, "--payloads", paths["landed"]])
    assert "3 candidates, 2 drafts, 1 causes known before" in capsys.readouterr().out
    main([*base, "--payloads", paths["landed"], "--as-of", "2025-01-01"])
    assert "0 candidates, 0 drafts, 0 causes known before" in capsys.readouterr().out
    ledger = read_ledger(spark, paths["led"])
    ledger.select("root_cause_hash", (F.col("id") + 100).alias("github_issue_number")).write.parquet(paths["posted"])
    main(["posted", "--posted", paths["posted"], "--ledger", paths["led"]])
    assert read_ledger(spark, paths["led"]).where("github_issue_number > 100").count() == 3
    main(["compact", "--ledger", paths["led"], "--out", paths["new"]])
    assert read_ledger(spark, paths["new"]).count() == 3
    main(["stream", "--investigations", paths["inv"], "--payloads", paths["landed"],
          "--endpoints", paths["end"], "--ledger", paths["led"], "--out", paths["out"],
          "--checkpoint", f"{paths['check']}-stream"])
    main(["arrivals", "--investigations", paths["inv"], "--payloads", paths["landed"],
          "--out", f"{paths['out']}-first", "--checkpoint", f"{paths['check']}-first",
          "--days", "3650"])
    assert spark.read.parquet(f"{paths['out']}-first").count() == 3
    assert len(drafted(spark, paths["out"])) == 3
    with pytest.raises(SystemExit):
        parse_args([*base, *raw, "-d", "0"])
    with pytest.raises(SystemExit):
        parse_args(base)
    args = parse_args([*base, *raw])
    assert (args.days, args.cap) == (3, None)


def stream_of(spark, path):
    return read_investigation_stream(spark, path)


def test_stream_runs_equal_batch_runs(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path)
    everything = objects(spark, range(40))
    batches = [rows(range(0, 6)), rows(range(3, 9)), rows(range(9, 13))]
    ledger = spark.createDataFrame([], LEDGER)
    seen, expected = set(), []
    for batch in batches:
        found = newest_per_key(
            intake(investigations(spark, batch)), F.col("first_message")
        )
        unique = triage.distinct_incidents(found, everything)
        fresh = {row.root_cause_hash for row in unsolved(unique, ledger).collect()} - seen
        expected.append(len(fresh))
        seen |= fresh

    for batch in batches:
        investigations(spark, batch).coalesce(1).write.mode("append").parquet(source)
        start_triage(
            stream_of(spark, source), lambda: everything, lambda: endpoint_versions(spark),
            f"{folder}/out", f"{folder}/ledger", f"{folder}/checkpoint",
        ).awaitTermination()
    found = drafted(spark, f"{folder}/out")
    assert set(found) == seen
    runs = [run for _, run in found.values()]
    assert [runs.count(run) for run in (1, 2, 3)] == expected == [6, 3, 1]
    assert read_ledger(spark, f"{folder}/ledger").count() == len(seen)


def landed(spark, path, bodies, buckets=None, minutes=0):
    """Land objects at a time of the data."""
    at = F.lit(START + timedelta(minutes=minutes))
    land_payloads(payloads(spark, bodies).withColumn("landed_at", at), path, buckets)


def arrive(spark, tmp_path, batch, files=1):
    source, folder = str(tmp_path / "in"), str(tmp_path)
    investigations(spark, batch).coalesce(files).write.mode("append").parquet(source)
    start_first_arrivals(
        stream_of(spark, source), f"{folder}/landed", 2,
        f"{folder}/out", f"{folder}/checkpoint",
    ).awaitTermination()
    return sorted((row.error_message, row.id) for row in spark.read.parquet(f"{folder}/out").collect())


def test_first_arrivals_across_batches(spark, tmp_path):
    landed(spark, str(tmp_path / "landed"), {n: "{}" for n in range(200)}, 4)
    arrive(spark, tmp_path, [investigation(n, "hot", minutes=n) for n in range(100)], 2)
    found = arrive(
        spark, tmp_path,
        [investigation(n, "hot", minutes=n) for n in range(100, 150)]
        + [investigation(n, "cold", minutes=n) for n in range(150, 160)],
    )
    assert [message for message, _ in found] == ["cold", "hot"]


def test_arrivals_wait_for_their_payloads(spark, tmp_path):
    path = str(tmp_path / "landed")
    landed(spark, path, {1: "{}"}, 4)
    batch = [investigation(1, "here"), investigation(2, "waits"), investigation(3, "never")]
    assert arrive(spark, tmp_path, batch) == [("here", "s-1")]
    landed(spark, path, {2: "{}"}, minutes=60)
    assert arrive(spark, tmp_path, [investigation(4, "other")]) == [("here", "s-1"), ("waits", "s-2")]


def test_old_causes_are_forgotten(spark, tmp_path):
    path, day = str(tmp_path / "landed"), 24 * 60
    landed(spark, path, {n: "{}" for n in range(3)}, 4)
    arrive(spark, tmp_path, [investigation(0, "first", minutes=0)])
    landed(spark, path, {n: "{}" for n in (3, 4)}, minutes=9 * day)
    arrive(spark, tmp_path, [investigation(1, "first", minutes=day), investigation(3, "second", minutes=9 * day)])
    found = arrive(spark, tmp_path, [investigation(4, "first", minutes=10 * day)])
    assert found == [("first", "s-0"), ("first", "s-4"), ("second", "s-3")]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """A batch run again after its outputs were written, as after a lost driver."""
    source, folder = str(tmp_path / "in"), str(tmp_path)
    everything = objects(spark, range(20))

    def stream():
        start_triage(
            stream_of(spark, source), lambda: everything, lambda: endpoint_versions(spark),
            f"{folder}/out", f"{folder}/ledger", f"{folder}/checkpoint",
        ).awaitTermination()

    for batch in (rows(range(0, 4)), rows(range(2, 8))):
        investigations(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream()
    before = drafted(spark, f"{folder}/out")
    ledger = sorted(row.id for row in read_ledger(spark, f"{folder}/ledger").collect())
    commit = tmp_path / "checkpoint" / "commits" / "1"
    assert commit.exists()
    commit.unlink()
    (commit.parent / ".1.crc").unlink(missing_ok=True)
    stream()
    assert commit.exists()
    assert drafted(spark, f"{folder}/out") == before
    assert sorted(row.id for row in read_ledger(spark, f"{folder}/ledger").collect()) == ledger


def triage_batch(spark, tmp_path, batch, numbers, checkpoint="checkpoint"):
    source, folder = str(tmp_path / "in"), str(tmp_path)
    if batch:
        investigations(spark, batch).coalesce(1).write.mode("append").parquet(source)
    start_triage(
        stream_of(spark, source), lambda: objects(spark, numbers),
        lambda: endpoint_versions(spark), f"{folder}/out", f"{folder}/ledger",
        f"{folder}/{checkpoint}",
    ).awaitTermination()
    return sorted(drafted(spark, f"{folder}/out").values())


def test_late_payloads_are_tried_again(spark, tmp_path):
    """Also after a row whose clock is far ahead."""
    far = 900 * 24 * 60
    first = [investigation(0, "waits"), investigation(1, "here"), investigation(9, "long")]
    triage_batch(spark, tmp_path, first, [1])
    triage_batch(spark, tmp_path, [investigation(2, "Timeout", minutes=far)], [1])
    triage_batch(spark, tmp_path, [investigation(3, "other", minutes=far)], [0, 1, 3])
    found = triage_batch(spark, tmp_path, [investigation(4, "more")], [0, 1, 3, 4, 9])
    assert found == [("s-0", 3), ("s-1", 1), ("s-3", 3), ("s-4", 4), ("s-9", 4)]


def test_waiting_ends_by_the_clock_of_the_runs(spark):
    times = [START, START + timedelta(days=2)]
    frame = spark.createDataFrame([(None,) * 10 + (t,) for t in times], WAITING)
    assert still_waiting(frame, 3, START + timedelta(days=4)).count() == 1
    assert still_waiting(frame, 3, START + timedelta(days=3)).count() == 2


def test_batch_and_stream_share_a_ledger(spark, tmp_path):
    folder, numbers = str(tmp_path), range(6)
    found = triage.slim(investigations(spark, rows(range(4))))
    run_triage(
        found, objects(spark, numbers), endpoint_versions(spark), f"{folder}/out",
        f"{folder}/ledger", "batch",
    )
    before = drafted(spark, f"{folder}/out")
    assert triage_batch(spark, tmp_path, rows(range(4)), numbers) == sorted(before.values())
    after = triage_batch(spark, tmp_path, rows(range(4, 6)), numbers)
    assert len(after) == 6
    kept = sorted(read_ledger(spark, f"{folder}/ledger").collect())
    # A new checkpoint reads every file again and takes new numbers.
    assert triage_batch(spark, tmp_path, [], numbers, "another") == after
    assert sorted(read_ledger(spark, f"{folder}/ledger").collect()) == kept
