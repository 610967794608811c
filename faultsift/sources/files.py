"""Folders and empty marker files, by the file system that Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return at.getFileSystem(conf), at


def seen_as_local(spark: SparkSession, path: str) -> str | None:
    """The path without its scheme where it is in the local file system, which may be a mount that all machines share."""
    files, at = _at(spark, path)
    if files.getUri().getScheme() != "file":
        return None
    return files.makeQualified(at).toUri().getPath()


def make_folder(spark: SparkSession, path: str) -> None:
    """Does nothing where the folder exists, also if others make it at the same time."""
    files, at = _at(spark, path)
    files.mkdirs(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; they must not contain a comma and a space.

    The JVM writes all of them as one text, ``Array(path, path)``, as a call a
    name would be slow for a large folder.
    """
    files, at = _at(spark, path)
    if not files.exists(at):
        return []
    held = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(at))
    listed = spark._jvm.scala.runtime.ScalaRunTime.stringOf(held)[len("Array(") : -1]
    return sorted(name.rsplit("/", 1)[1] for name in listed.split(", ")) if listed else []


def put_marker(spark: SparkSession, path: str) -> None:
    """An empty file; its name is all it says."""
    files, at = _at(spark, path)
    files.create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)
