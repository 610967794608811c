"""Payloads written as one file each."""

from datetime import datetime
from pathlib import Path

from checks import catalog
from checks.derived import EVENTS


def test_objects_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Few bytes, many files: no one task creates them all, and each is found by its pointer."""
    props = ['{"k": 4}', '{"k": 5}']
    rows = [(n, datetime(2024, 1, 9), n, "error", 1.0, props[n % 2]) for n in range(1, 200)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "work_folder", lambda _, name: f"{tmp_path}/{name}")
    found = catalog.all_queries()["payload_objects_join"](spark, str(tmp_path)).collect()
    files = [*Path(tmp_path, "objects").glob("session_id=*/part-*.txt")]
    assert len(found) == len(files) > 100
    by_task = [file.name.split("-")[1] for file in files]
    assert len(set(by_task)) > 8 and max(map(by_task.count, by_task)) < len(files) // 4
    texts = {file.parent.name.removeprefix("session_id="): file.read_text() for file in files}
    assert {row.session_id: row.body for row in found} == texts
