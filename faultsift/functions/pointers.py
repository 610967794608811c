"""Object-storage pointers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Pointer scheme and the scheme of the file system reading it.
POINTER_SCHEME = "s3://"
URI_SCHEME = "s3a://"


# Key of the column metadata that holds the bucket count of a landed table.
BUCKET_COUNT = "buckets"


def storage_uri(pointer: Column) -> Column:
    """``s3://`` or virtual-host ``https://`` pointer to one ``s3a://`` form.

    NULL when the pointer is not a URL.
    """
    host = F.try_parse_url(pointer, F.lit("HOST"))
    path = F.try_parse_url(pointer, F.lit("PATH"))
    bucket = F.split_part(F.lower(host), F.lit("."), F.lit(1))
    return F.when(
        F.startswith(pointer, F.lit(POINTER_SCHEME)),
        F.concat(F.lit(URI_SCHEME), F.substr(pointer, F.lit(len(POINTER_SCHEME) + 1))),
    ).otherwise(F.concat(F.lit(URI_SCHEME), bucket, F.lit("/"), F.substr(path, F.lit(2))))


def listed_uri(file_path: Column) -> Column:
    """URI of an object as listed by Spark, with its percent-encoding undone.

    URL decoding would also turn ``+`` into a space, so ``+`` is encoded first.
    """
    return F.try_url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def uri_bucket(uri: Column, buckets: int) -> Column:
    """Partition number of a URI in a landed payload table."""
    return F.pmod(F.xxhash64(uri), F.lit(buckets)).cast("int")
