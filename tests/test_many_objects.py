"""Small objects written, listed and read by tasks."""

import bz2
import gzip
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks import catalog
from checks.derived import EVENTS
from faultsift.sources import objects
from faultsift.sources.objects import list_objects, write_objects
from faultsift.sources.payloads import read_payload_objects
from tests.test_plans import plan


def read(frame):
    return sorted((row[0], row[1]) for row in frame.select("obj_uri", F.hex("body")).collect())


def as_spark_reads(spark, prefix):
    files = spark.read.option("recursiveFileLookup", "true").text(prefix, wholetext=True)
    path = F.try_url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return read(files.select(path.alias("obj_uri"), F.col("value").alias("body")))


def odd_objects(top):
    texts = {
        "a b+c.json": b'{"message":\n"x"}', "p%20q.json": b"{}\n", "\u00e9.json": b"null",
        "bad.json": b"\xff\xfe{", "empty.json": b"", "_x": b"u", "_x=1": b"v", "_metadata": b"w",
        ".dot": b"d", "y._COPYING_": b"c",
    }
    for name in ("", "deep/er", "deep/=_x", "_hidden", "_hidden=1", ".hidden", "_metadata1"):
        folder = Path(top, name)
        folder.mkdir(parents=True, exist_ok=True)
        for file, text in texts.items():
            if not (folder / file).exists():
                (folder / file).write_bytes(text)
    Path(top, "link.json").symlink_to(Path(top, "deep/er/a b+c.json"))
    Path(top, "linked").symlink_to(Path(top, "deep/er"))
    Path(top, "broken").symlink_to("/nowhere/at/all")


@pytest.mark.parametrize("folders", [1, 3, 256])
def test_objects_are_those_that_spark_finds(spark, tmp_path, monkeypatch, folders):
    """However few folders the first task looks through."""
    monkeypatch.setattr(objects, "FIRST_FOLDERS", folders)
    odd_objects(str(tmp_path))
    expected = as_spark_reads(spark, str(tmp_path))
    assert len(expected) > 25
    for prefix in (f"{tmp_path}", f"file:{tmp_path}/", f"file://{tmp_path}"):
        assert read(read_payload_objects(spark, prefix)) == expected
    one = f"{tmp_path}/deep/er/bad.json"
    assert read(read_payload_objects(spark, one)) == as_spark_reads(spark, one)
    assert read(read_payload_objects(spark, f"{tmp_path}/deep/*")) == as_spark_reads(spark, f"{tmp_path}/deep/*")


def test_the_driver_keeps_no_list_of_objects(spark, tmp_path):
    for n in range(20):
        Path(tmp_path, f"{n}.json").write_text("{}")
    found = read_payload_objects(spark, str(tmp_path), "s3a://b")
    assert "Scan text" not in plan(found) and found.inputFiles() == []
    assert found.count() == 20


def test_packed_objects_are_unpacked(spark, tmp_path):
    Path(tmp_path, "a.json").write_text("{}")
    Path(tmp_path, "b.json.gz").write_bytes(gzip.compress(b'{"message":"b"}'))
    Path(tmp_path, "c.BZ2").write_bytes(bz2.compress(b'{"message":"c"}'))
    found = {row.obj_uri: row.body for row in read_payload_objects(spark, str(tmp_path), "s3a://b").collect()}
    assert found == {
        "s3a://b/a.json": "{}", "s3a://b/b.json.gz": '{"message":"b"}', "s3a://b/c.BZ2": '{"message":"c"}'
    }


def test_folders_without_objects(spark, tmp_path):
    assert read_payload_objects(spark, str(tmp_path)).isEmpty()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_payload_objects(spark, f"{tmp_path}/none")


def test_objects_are_laid_out_as_spark_does(spark, tmp_path):
    """Also keys that are missing, repeated or no names of folders, and texts that are missing or no UTF-8."""
    keys = [None, "", "s-1", "s-1", "a b", "a/b:c", "x=%'\"", "{[^]}\t\x7f", "\u00e9", "s-2"]
    rows = spark.createDataFrame([(k, f"text {n}\n" if n != 9 else None) for n, k in enumerate(keys)], "k STRING, t STRING")
    rows = rows.unionByName(spark.sql("SELECT 's-3' AS k, cast(x'FF7B' AS STRING) AS t"))
    write_objects(rows, f"{tmp_path}/mine", "k")
    rows.repartition(4, "k").write.partitionBy("k").text(f"{tmp_path}/spark")
    laid = []
    for top in ("mine", "spark"):
        files = [*Path(tmp_path, top).glob("*/part-*.txt")]
        lines = {}
        for file in files:
            lines.setdefault(file.parent.name, []).extend(file.read_bytes().splitlines())
        laid.append({name: sorted(found) for name, found in lines.items()})
        # No key and an empty one have one folder, and files of their own where two tasks got them.
        assert len(lines) == 9 and len(files) in (9, 10)
        assert Path(tmp_path, top, "_SUCCESS").exists()
    assert laid[0] == laid[1]
    assert not [*Path(tmp_path, "mine").glob("*/.*")]


def test_no_rows_give_an_empty_folder(spark, tmp_path):
    write_objects(spark.createDataFrame([], "k STRING, t STRING"), f"{tmp_path}/none", "k")
    assert read_payload_objects(spark, f"{tmp_path}/none").isEmpty()
    assert list_objects(spark, f"{tmp_path}/none").isEmpty()


def test_each_object_is_one_file(spark, tmp_path, monkeypatch):
    """No check sum beside it: Spark's writer of local files makes one, with two process starts more."""
    rows = [(n, datetime(2024, 1, 9), n, "error", 1.0, '{"k": 5}') for n in range(1, 60)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(catalog, "work_folder", lambda _, name: f"{tmp_path}/{name}")
    found = catalog.all_queries()["payload_objects_join"](spark, str(tmp_path)).collect()
    folders = [*Path(tmp_path, "objects").glob("session_id=*")]
    assert len(found) == len(folders) > 40
    assert [len([*folder.iterdir()]) for folder in folders] == [1] * len(folders)
