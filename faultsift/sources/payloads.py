"""Error payloads: raw JSON objects, or a landed table of them."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultsift.functions.pointers import BUCKET_COUNT, listed_uri, uri_bucket
from faultsift.operators.payloads import LandedTable
from faultsift.sources.files import make_folder, names_in, put_marker, remove
from faultsift.sources.objects import read_local_objects

ROWS = "obj_uri STRING, body STRING, landed_at TIMESTAMP"
LAYOUT = "buckets INT"

# Landings that a pack holds.
HELD = "landing STRING"


def _as_payloads(
    files: DataFrame, prefix: str, store: str | None, uri: Column | None = None
) -> DataFrame:
    if uri is None:
        uri = listed_uri(F.col("_metadata.file_path"))
    if store is not None:
        # What follows the prefix in the path, whatever the scheme before it.
        folder = prefix.split("://")[-1].removeprefix("file:").strip("/")
        rest = F.substring_index(uri, f"{folder}/", -1)
        uri = F.concat(F.lit(store.rstrip("/") + "/"), rest)
    return files.select(uri.alias("obj_uri"), F.col("value").alias("body"))


def read_payload_objects(spark: SparkSession, prefix: str, store: str | None = None) -> DataFrame:
    """Every object below a prefix as (obj_uri, body).

    The prefix is listed and joined: a list of single paths would fail as a
    whole when one object is missing. ``store`` is the URI that pointers have
    where the prefix is a copy or a mount of it. For a store of any size land
    its objects and look them up in the landed table. Below a folder that is seen
    as local, tasks list and read: the objects are those found when rows are taken.
    """
    local = read_local_objects(spark, prefix)
    if local is not None:
        return _as_payloads(local, prefix, store, F.col("uri"))
    files = spark.read.option("recursiveFileLookup", "true").text(prefix, wholetext=True)
    return _as_payloads(files, prefix, store)


def table_buckets(spark: SparkSession, path: str) -> int:
    """The bucket count that a landed table was made with."""
    return spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()["buckets"]


def init_payload_table(spark: SparkSession, path: str, buckets: int) -> None:
    """An empty landed table, unless there is one; another bucket count is an error."""
    layout = spark.createDataFrame([(buckets,)], LAYOUT)
    layout.coalesce(1).write.mode("ignore").parquet(f"{path}/layout")
    kept = table_buckets(spark, path)
    if kept != buckets:
        raise ValueError(f"{path} has {kept} buckets, not {buckets}")
    for name in ("rows", "packed", "packs"):
        make_folder(spark, f"{path}/{name}")


def land_payloads(payloads: DataFrame, path: str, buckets: int | None = None) -> None:
    """Add payloads to a table, as a landing of its own by landing date and a hash of their URI.

    Nothing landed before is read or rewritten, and landings at the same time
    share no folder: of several rows of a URI the lookup takes the newest, so
    landing again after a failure does no harm. Within one landing the largest
    text of a URI is kept. ``buckets`` is needed for the first landing only.
    Rebalancing gives large buckets several files of the advisory size; each is
    sorted by URI.
    """
    spark = payloads.sparkSession
    if buckets is not None:
        init_payload_table(spark, path, buckets)
    count = table_buckets(spark, path)
    newest = Window.partitionBy("obj_uri").orderBy(F.desc("body"))
    if "landed_at" not in payloads.columns:
        payloads = payloads.withColumn("landed_at", F.current_timestamp())
    (
        payloads.select("obj_uri", "body", "landed_at")
        .withColumn("rn", F.row_number().over(newest))
        .where("rn = 1")
        .drop("rn")
        .withColumn("landed_on", F.to_date("landed_at"))
        .withColumn("uri_bucket", uri_bucket(F.col("obj_uri"), count))
        .hint("rebalance", F.col("uri_bucket"))
        .sortWithinPartitions("landed_on", "uri_bucket", "obj_uri")
        .write.partitionBy("landed_on", "uri_bucket")
        .parquet(f"{path}/rows/landing={uuid.uuid4().hex}")
    )


def start_landing(
    spark: SparkSession,
    prefix: str,
    path: str,
    checkpoint: str,
    buckets: int,
    store: str | None = None,
    files_a_batch: int = 100_000,
) -> StreamingQuery:
    """Land each object below a prefix once, as it appears."""
    init_payload_table(spark, path, buckets)
    files = (
        spark.readStream.schema("value STRING")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_a_batch)
        .text(prefix, wholetext=True)
    )
    return (
        _as_payloads(files, prefix, store)
        .writeStream.foreachBatch(lambda rows, _: land_payloads(rows, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _bucket(buckets: int) -> Column:
    column = uri_bucket(F.col("obj_uri"), buckets)
    return column.alias("uri_bucket", metadata={BUCKET_COUNT: buckets})


def _landings(spark: SparkSession, path: str) -> list[str]:
    """The landings that are written to their end."""
    names = [name for name in names_in(spark, f"{path}/rows") if name.startswith("landing=")]
    return [n[8:] for n in names if "_SUCCESS" in names_in(spark, f"{path}/rows/{n}")]


def _pack_names(spark: SparkSession, path: str) -> list[str]:
    return names_in(spark, f"{path}/packs")


def _held(spark: SparkSession, path: str, packs: list[str]) -> set[str]:
    """The landings that packs hold."""
    if not packs:
        return set()
    rows = spark.read.schema(HELD).parquet(*[f"{path}/packed/{name}/held" for name in packs])
    return {row.landing for row in rows.collect()}


def _pack(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    """The rows of a pack, which Spark knows to be bucketed by URI."""
    table = f"faultsift_pack_{name.rsplit('-', 1)[-1]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ROWS}) USING parquet "
        f"CLUSTERED BY (obj_uri) INTO {buckets} BUCKETS LOCATION '{path}/packed/{name}/rows'"
    )
    return spark.table(table)


def _tail(spark: SparkSession, path: str, landings: list[str]) -> DataFrame:
    rows = spark.read.schema(f"{ROWS}, landing STRING, landed_on DATE, uri_bucket INT")
    rows = rows.parquet(f"{path}/rows").where(F.col("landing").isin(landings))
    bucket = F.col("uri_bucket").alias(
        "uri_bucket", metadata={BUCKET_COUNT: table_buckets(spark, path)}
    )
    return rows.select("obj_uri", "body", "landed_at", "landed_on", bucket)


def open_payload_table(spark: SparkSession, path: str, since: date | None = None) -> LandedTable:
    """A landed table for lookups, of all days or from ``since`` on.

    Packs without a later day than ``since`` are not opened. Listed first, packs
    tell what they hold, so a landing that is packed meanwhile is read once.
    """
    packs = _pack_names(spark, path)
    held, buckets = _held(spark, path, packs), table_buckets(spark, path)
    tail = _tail(spark, path, [name for name in _landings(spark, path) if name not in held])
    if since is not None:
        tail = tail.where(F.col("landed_on") >= F.lit(since))
        packs = [name for name in packs if name[:10] >= since.isoformat()]

    def columns(rows: DataFrame) -> DataFrame:
        day = F.to_date("landed_at").alias("landed_on")
        rows = rows.select("obj_uri", "body", "landed_at", day, _bucket(buckets))
        return rows if since is None else rows.where(F.col("landed_on") >= F.lit(since))

    files = [columns(spark.read.schema(ROWS).parquet(f"{path}/packed/{n}/rows")) for n in packs]
    rows = reduce(DataFrame.unionByName, files, tail)
    return LandedTable(tail, tuple(columns(_pack(spark, path, n, buckets)) for n in packs), rows)


def pack_payloads(spark: SparkSession, path: str) -> bool:
    """Put all landings since the last pack into one: sorted by URI, one file a bucket.

    Landings and lookups may be under way: a pack counts from when its marker is
    written, and says which landings it holds. Packs made at the same time may
    hold a landing twice, which lookups take as one that landed again. Returns
    whether there was something to pack.
    """
    held = _held(spark, path, _pack_names(spark, path))
    new = [name for name in _landings(spark, path) if name not in held]
    if not new:
        return False
    buckets, token = table_buckets(spark, path), uuid.uuid4().hex
    rows = _tail(spark, path, new)
    last = rows.agg(F.max("landed_on")).first()[0]
    name = f"{last or date.min:%Y-%m-%d}-{token}"
    (
        rows.select("obj_uri", "body", "landed_at")
        .repartition(buckets, "obj_uri")
        .sortWithinPartitions("obj_uri")
        .write.bucketBy(buckets, "obj_uri")
        .sortBy("obj_uri")
        .option("path", f"{path}/packed/{name}/rows")
        .saveAsTable(f"faultsift_pack_{token}")
    )
    spark.createDataFrame([(x,) for x in new], HELD).coalesce(1).write.parquet(f"{path}/packed/{name}/held")
    put_marker(spark, f"{path}/packs/{name}")
    return True


def remove_packed(spark: SparkSession, path: str) -> None:
    """Remove landings that packs hold, once no lookup that began before the last pack is under way.

    Streams that follow the landings must have read them.
    """
    held = _held(spark, path, _pack_names(spark, path))
    for name in _landings(spark, path):
        if name in held:
            remove(spark, f"{path}/rows/landing={name}")


def unlanded_objects(spark: SparkSession, prefix: str, path: str, store: str | None = None) -> DataFrame:
    """URIs (obj_uri) of the objects below a prefix that are not in the table; contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(prefix)
    listed = _as_payloads(files.withColumn("value", F.lit("")), prefix, store).select("obj_uri")
    landed = open_payload_table(spark, path).rows.select("obj_uri")
    return listed.join(landed, "obj_uri", "left_anti")


def read_payload_table(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The rows of a landed table with its bucket count, of all days or from ``since`` on."""
    return open_payload_table(spark, path, since).rows.drop("landed_on")


def read_landing_stream(spark: SparkSession, path: str) -> DataFrame:
    """(obj_uri, landed_at) of the rows of a landed table as they are landed; bodies stay unread."""
    rows = spark.readStream.schema(f"{ROWS}, landing STRING, landed_on DATE, uri_bucket INT")
    return rows.parquet(f"{path}/rows").select("obj_uri", "landed_at")
