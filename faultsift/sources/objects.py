"""Very many small objects in folders that all machines see as local ones.

Spark's own writer starts several processes for each file there, and its reader
keeps the list of all files in the driver. Here tasks make, list and read the
files themselves, so neither holds more than a batch of them. The functions that
tasks run name nothing else of this package: workers need not import it.
"""

from __future__ import annotations

import os
import uuid
from collections import deque

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.sources.files import make_folder, put_marker, seen_as_local

# Tasks that write, list or read objects, at least: an object costs far more than its bytes.
OBJECT_TASKS = 64

# Folders that one task looks through before the rest is dealt out.
FIRST_FOLDERS = 256

# Rows and bytes of a batch that a task gives back.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20

# What Spark writes as %XX in the name of a partition's folder, and the folder of no value.
ESCAPED = {n: f"%{n:02X}" for n in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Endings of files that Spark's reader unpacks, in any case.
PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|passthrough)$"


def object_tasks(spark: SparkSession) -> int:
    """Tasks for objects, whatever their size."""
    return max(OBJECT_TASKS, 4 * spark.sparkContext.defaultParallelism)


def write_objects(rows: DataFrame, folder: str, key: str) -> None:
    """The texts of ``rows`` (key, text) below a new folder, a file for each key.

    Folders and lines are those of ``write.partitionBy(key).text``. Left alone, AQE
    would give all rows to one task. A file has its name once it is whole, and a
    repeated task replaces it.
    """
    spark = rows.sparkSession
    dealt = rows.repartition(object_tasks(spark), key)
    top = seen_as_local(spark, folder)
    if top is None:
        dealt.write.partitionBy(key).text(folder)
        return
    make_folder(spark, folder)
    text = next(name for name in rows.columns if name != key)
    pairs = dealt.select(F.nullif(key, F.lit("")).alias("k"), F.col(text).cast("binary").alias("t"))
    pairs.sortWithinPartitions("k").mapInArrow(_writer(top, key), "objects BIGINT").agg(
        F.sum("objects")
    ).collect()
    put_marker(spark, f"{folder}/_SUCCESS")


def _writer(top: str, key: str):
    run, escaped, no_value = uuid.uuid4(), ESCAPED, NO_VALUE

    def write(batches):
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():05d}-{run}.txt", task.taskAttemptId()
        count, last, file, draft = 0, None, None, ""

        def finish():
            file.close()
            os.replace(draft, f"{os.path.dirname(draft)}/{name}")

        for batch in batches:
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file is None or value != last:
                    if file is not None:
                        finish()
                    part = no_value if value is None else value.translate(escaped)
                    folder = f"{top}/{key}={part}"
                    try:
                        os.mkdir(folder)
                    except FileExistsError:
                        pass
                    draft = f"{folder}/.{name}.{attempt}"
                    file, last, count = open(draft, "wb"), value, count + 1
                if text.is_valid:
                    file.write(text.as_buffer())
                file.write(b"\n")
        if file is not None:
            finish()
        yield pa.RecordBatch.from_pydict({"objects": pa.array([count], pa.int64())})

    return write


def list_objects(spark: SparkSession, top: str) -> DataFrame:
    """Files (path) at any depth below a folder, or the file itself, without those that Spark hides.

    One task lists the first folders and deals out what is below them. A folder
    that goes meanwhile is empty.
    """
    start = spark.range(0, 1, 1, 1).select(F.lit(top).alias("path"))
    first = start.mapInArrow(_lister(FIRST_FOLDERS), "path STRING, folder BOOLEAN")
    dealt = first.repartition(object_tasks(spark))
    below = dealt.mapInArrow(_lister(None), "path STRING, folder BOOLEAN")
    return below.select("path")


def _lister(most: int | None):
    """Lists folders until ``most`` are known and not listed; those are given back as folders."""
    rows = 10 * BATCH_ROWS

    def hidden(name, folder):
        if folder and name.startswith(("_metadata", "_common_metadata")):
            return False
        return name.startswith(".") or name.endswith("._COPYING_") or name[0] == "_" and "=" not in name

    def found(top):
        left = deque([top])
        while left and (most is None or len(left) < most):
            at = left.popleft()
            try:
                listed = os.scandir(at)
            except NotADirectoryError:
                yield at, False
                continue
            except FileNotFoundError:
                if most is not None and at == top:
                    raise
                continue
            with listed as entries:
                for entry in entries:
                    folder = entry.is_dir()
                    if hidden(entry.name, folder) or not (folder or entry.is_file()):
                        continue
                    if folder and (most is None or len(left) < most):
                        left.append(entry.path)
                    else:
                        yield entry.path, folder
        for path in left:
            yield path, True

    def batch_of(held):
        paths, folders = zip(*held)
        return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "folder": pa.array(folders, pa.bool_())})

    def run(batches):
        held = []
        for batch in batches:
            folders = batch.column(1).to_pylist() if batch.num_columns > 1 else [True] * batch.num_rows
            for path, folder in zip(batch.column(0).to_pylist(), folders):
                for item in found(path) if folder else [(path, False)]:
                    held.append(item)
                    if len(held) >= rows:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    return run


def read_local_objects(spark: SparkSession, prefix: str) -> DataFrame | None:
    """Every object below a prefix as (uri, value), whole and byte by byte; empty ones are left out, as Spark does.

    None where Spark itself has to read: another store, a pattern, a missing
    folder or packed files.
    """
    top = None if any(c in prefix for c in "{}[]*?\\") else seen_as_local(spark, prefix)
    if top is None or not os.path.exists(top):
        return None
    listed, packed = list_objects(spark, top), F.col("path").rlike(PACKED)
    if not listed.where(packed).isEmpty():
        return None
    skip = spark.conf.get("spark.sql.files.ignoreMissingFiles") == "true"
    # Packed ones that come later are left to the next call.
    read = listed.where(~packed).repartition(object_tasks(spark)).mapInArrow(_reader(skip), "path STRING, value BINARY")
    return read.select(F.concat(F.lit("file:"), "path").alias("uri"), F.col("value").cast("string").alias("value"))


def _reader(skip_missing: bool):
    most_rows, most_bytes = BATCH_ROWS, BATCH_BYTES

    def batch_of(paths, texts):
        return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "value": pa.array(texts, pa.binary())})

    def read(batches):
        paths, texts, size = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with open(path, "rb") as file:
                        text = file.read()
                except FileNotFoundError:
                    if not skip_missing:
                        raise
                    continue
                if text:
                    paths.append(path)
                    texts.append(text)
                    size += len(text)
                if len(paths) >= most_rows or size >= most_bytes:
                    yield batch_of(paths, texts)
                    paths, texts, size = [], [], 0
        if paths:
            yield batch_of(paths, texts)

    return read
