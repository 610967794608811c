"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# UTC: timestamps are rendered as ISO-8601 "Z" text.
# allowDuplicateKeys: a repeated JSON key is legal, the last one wins.
# unionOutputPartitioning: Spark 4.1 takes a union of bucketed tables for bucketed
# and then reads them unbucketed, so that equal keys stay apart.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.unionOutputPartitioning": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Stream checkpoints and staged tables go here, so every executor must see
    it. A session without that setting uses its warehouse if that is in a shared
    store, or if all of the session is on one machine; a warehouse on the local
    disk of a cluster's driver is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        if not one_machine and re.match(r"(file:|/)", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{warehouse.rstrip('/')}/work"
    return f"{root.rstrip('/')}/faultsift/{name}-{uuid.uuid4().hex}"
