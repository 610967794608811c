"""What the operators share: tables, staged tables, words and running sums."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.session import work_folder

# White space that separates words, and nothing else does.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


# Rows and bytes that a Python worker gets at a time: texts are long, so less than Spark's own limits.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20
_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}
# Few heaps in a worker, and large blocks go back to the system at once.
_MALLOC = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, and bounds their batches.

    The same as setting ``spark.executorEnv.PYTHONPATH`` before the start;
    with ``--py-files`` it changes nothing. Smaller batches that a session asks
    for are kept.
    """
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in _LIMITS.items():
        if not 0 < size(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))
    here = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])
        environment.update({k: v for k, v in _MALLOC.items() if k not in environment})


Batches = Iterator[pa.RecordBatch]


def mapped(df: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks give their memory back to the system, as workers outlive them."""
    importable(df.sparkSession)

    def lean(batches: Batches) -> Batches:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return df.mapInArrow(lean, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _place(docs: DataFrame, name: str) -> int:
    """Which column is meant: the one of that very name, else one that differs in case."""
    names = docs.columns
    return names.index(name) if name in names else [c.lower() for c in names].index(name)


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """These columns only, whatever other columns of like names there are."""
    held = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return held.select(*[F.col(f"c{_place(docs, name)}").alias(name) for name in names])


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """These columns, all columns together as ``doc``, and all but the text as JSON in ``rest``.

    So no column of a caller meets one of an operator; ``unpacked`` gives the
    callers' columns back. ``rest`` decides between rows of one id and text.
    """
    own = [f"c{k}" for k in range(len(docs.columns))]
    held = docs.toDF(*own)
    others = [c for c in own if c != f"c{_place(docs, 'text')}"]
    return held.select(
        F.struct(*own).alias("doc"),
        F.to_json(F.struct(*others)).alias("rest"),
        *[F.col(f"c{_place(docs, name)}").alias(name) for name in names],
    )


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` that ``packed`` put together."""
    return rows.select(*[F.col("doc")[f"c{k}"].alias(name) for k, name in enumerate(docs.columns)])


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: what follows is not computed twice, and a lost executor
    costs a reread instead of a recomputation.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text") -> Column:
    """Tells rows with the same id but other texts apart."""
    return F.xxhash64(F.col(text))


def running_start(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str
) -> DataFrame:
    """Adds the sum of ``value`` over all rows before a row within its keys.

    Rows go by (bucket, order). Only the sums of the buckets of a key meet in
    one task, so a key with a third of all rows is spread over its buckets.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(bucket)
    before = Window.unboundedPreceding
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__sum"))
    bases = sums.withColumn(
        "__base", F.sum("__sum").over(whole.rowsBetween(before, 0)) - F.col("__sum")
    ).drop("__sum")
    within = df.withColumn(
        "__within", F.sum(value).over(inner.rowsBetween(before, 0)) - F.col(value)
    )
    return (
        within.join(bases, [*keys, bucket])
        .withColumn(out, F.col("__base") + F.col("__within"))
        .drop("__base", "__within")
    )
