"""Candidates joined to their payload objects, and what becomes of each."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultsift.functions.fingerprint import root_cause_hash, throwing_functions
from faultsift.functions.payload import (
    MESSAGE_FIELDS,
    STACK_FIELDS,
    context_again,
    document,
    field,
    first_truthy,
    first_truthy_again,
    is_text_or_absent,
    payload_context,
    sealed_document,
    second_reading,
    text_or_empty,
    was_read,
)
from faultsift.functions.pointers import BUCKET_COUNT, URI_SCHEME, storage_uri, uri_bucket
from faultsift.operators.joins import hashed_join
from faultsift.schemas import INCIDENT_COLUMNS

OK, MISSING, INVALID, NON_STRING = "ok", "missing", "invalid", "non_string"
UNLOCATABLE, TOO_LARGE = "unlocatable", "too_large"


@dataclass(frozen=True)
class LandedTable:
    """A landed table as it is looked up: the landings of late, and packs of older ones.

    ``tail`` has day and bucket folders, of which a lookup of few objects reads
    only those it names. Each of ``packs`` is bucketed by URI, so its bodies are
    read where they are: only the keys of a lookup are shuffled to them.
    ``rows`` are those of all landings (obj_uri, body, landed_at, landed_on,
    uri_bucket), read from the files alone.
    """

    tail: DataFrame
    packs: tuple[DataFrame, ...]
    rows: DataFrame


def with_uri(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("obj_uri", storage_uri(F.col("s3_pointer")))


def is_located() -> Column:
    """Whether ``obj_uri`` names an object; a pointer that is no URL gives none."""
    return F.startswith("obj_uri", F.lit(URI_SCHEME))


def _in_packs(landed: LandedTable, keys: DataFrame) -> list[DataFrame]:
    """The rows of packs that have one of the distinct URIs ``keys``.

    A pack is bucketed by URI, so its rows stay where they are read and the keys
    are dealt to as many buckets; the hash table of a bucket is made of its keys.
    """
    found = []
    for pack in landed.packs:
        buckets = pack.schema["uri_bucket"].metadata[BUCKET_COUNT]
        dealt = keys.repartition(buckets, "obj_uri").hint("shuffle_hash")
        found.append(pack.join(dealt, "obj_uri", "left_semi"))
    return found


def wanted_payloads(candidates: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """The payloads (obj_uri, body) that the candidates name, one for each URI.

    Keys first: payloads are filtered by the distinct URIs of the candidates
    before anything else. A landed table carries its bucket count, and the
    bucket is part of the key, so few candidates make Spark read only the
    buckets they name; packs of it are filtered without moving a body. Of
    several objects of a URI the newest landed one counts, or the largest text
    where a table does not tell.
    """
    keys = with_uri(candidates).where(is_located()).select("obj_uri").distinct()
    packs = []
    if isinstance(payloads, LandedTable):
        packs = _in_packs(payloads, keys)
        payloads = payloads.tail
    names = ["obj_uri"]
    if "uri_bucket" in payloads.columns:
        buckets = payloads.schema["uri_bucket"].metadata[BUCKET_COUNT]
        keys = keys.withColumn("uri_bucket", uri_bucket(F.col("obj_uri"), buckets))
        names = ["uri_bucket", "obj_uri"]
    found = hashed_join(payloads, keys, names, "left_semi")
    order = F.col("landed_at") if "landed_at" in payloads.columns else F.lit(0)
    found = found.select("obj_uri", "body", order.alias("landed_at"))
    found = reduce(DataFrame.unionByName, [p.select(*found.columns) for p in packs], found)
    newest = F.max(F.struct(F.col("landed_at"), F.col("body")))
    return found.groupBy("obj_uri").agg(newest["body"].alias("body"))


def join_payloads(candidates: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """Inner join of candidates and payloads on the object URI.

    Both sides are shuffled by URI unless Spark finds one small; AQE splits a
    URI shared by very many candidates.
    """
    found = wanted_payloads(candidates, payloads)
    joined = hashed_join(with_uri(candidates).where(is_located()), found, ["obj_uri"], "inner")
    return joined.select(*candidates.columns, "obj_uri", "body")


def left_join_payloads(candidates: DataFrame, payloads: DataFrame | LandedTable) -> DataFrame:
    """Every candidate with its payload body, NULL when the object is missing."""
    # NULL URIs match nothing, but would all be shuffled to one task; a key of
    # their own spreads them.
    row_hash = F.xxhash64("session_id", "s3_pointer", "timestamp").cast("string")
    keyed = with_uri(candidates).withColumn(
        "_uri", F.coalesce("obj_uri", F.concat(F.lit("none:"), row_hash))
    )
    found = wanted_payloads(candidates, payloads).select(F.col("obj_uri").alias("_uri"), "body")
    return hashed_join(keyed, found, ["_uri"], "left").drop("_uri")


def with_landed_bodies(met: DataFrame, landed: LandedTable) -> DataFrame:
    """``met`` (obj_uri, landed_at, ...) with the bodies of those very landings.

    The keys name the days and buckets to read, and only rows with one of the
    keys take part in the join.
    """
    buckets = landed.tail.schema["uri_bucket"].metadata[BUCKET_COUNT]
    names = ["landed_on", "uri_bucket", "obj_uri", "landed_at"]
    keys = met.select("obj_uri", "landed_at").distinct().withColumns(
        {"landed_on": F.to_date("landed_at"), "uri_bucket": uri_bucket(F.col("obj_uri"), buckets)}
    )
    found = [hashed_join(landed.tail, keys, names, "left_semi")]
    found += _in_packs(landed, met.select("obj_uri").distinct())
    rows = reduce(DataFrame.unionByName, [f.select("obj_uri", "landed_at", "body") for f in found])
    # A landing may be in two packs.
    rows = rows.groupBy("obj_uri", "landed_at").agg(F.max("body").alias("body"))
    joined = hashed_join(met, rows, ["obj_uri", "landed_at"], "inner")
    return joined.select(*[c for c in met.columns if c != "landed_at"], "body")


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is evaluated once per row.

    Catalyst copies an expression into every filter it pushes below it; it does
    not push filters on a generated column below the ``explode``.
    """
    return rows.withColumn(name, F.explode(F.array(value)))


def with_document(joined: DataFrame) -> DataFrame:
    """Parse each body once: the document as a VARIANT, or ``again`` by the second reader.

    The second reader gets only what the VARIANT parser refuses; it reads valid
    JSON of any depth and length. ``unread`` tells why there is neither: the
    object is missing or cannot be located, is not one JSON value, or has a
    field too deep to tell its kind.
    """
    body = F.col("body")
    parsed = once(joined, "sealed", sealed_document(body))
    refused = F.col("sealed").isNull() & body.isNotNull()
    parsed = once(parsed, "again", F.when(refused, second_reading(body)))
    parsed = parsed.withColumn("doc", document(F.col("sealed"), body))
    again = F.col("again")
    unread = (
        F.when(F.col("doc").isNotNull(), F.lit(None))
        .when(~F.coalesce(is_located(), F.lit(False)), UNLOCATABLE)
        .when(body.isNull(), MISSING)
        .when(again.isNull(), INVALID)
        .when(~was_read(again), TOO_LARGE)
    )
    return parsed.withColumn("unread", unread).drop("sealed")


def with_outcome(joined: DataFrame) -> DataFrame:
    """Add ``outcome``, ``payload_message`` and ``payload_stack``; drop the body."""
    names = [*MESSAGE_FIELDS, *STACK_FIELDS]
    fields = {name: field(F.col("doc"), name).alias(name) for name in names}
    again = F.col("again")
    rows = with_document(joined).drop("body").select("*", F.struct(*fields.values()).alias("raw"))
    chosen = F.struct(
        first_truthy([F.col(f"raw.{name}") for name in MESSAGE_FIELDS]).alias("message"),
        first_truthy([F.col(f"raw.{name}") for name in STACK_FIELDS]).alias("stack"),
        first_truthy_again(again, MESSAGE_FIELDS).alias("message_again"),
        first_truthy_again(again, STACK_FIELDS).alias("stack_again"),
    )
    rows = once(rows, "chosen", chosen)
    message, stack = F.col("chosen.message"), F.col("chosen.stack")
    others = [F.coalesce(f"chosen.{name}.other", F.lit(False)) for name in ("message_again", "stack_again")]
    outcome = (
        F.when(F.col("unread").isNotNull(), F.col("unread"))
        .when(~is_text_or_absent(message) | ~is_text_or_absent(stack), NON_STRING)
        .when(others[0] | others[1], NON_STRING)
        .otherwise(OK)
    )
    return rows.withColumns(
        {
            "outcome": outcome,
            "payload_message": F.coalesce("chosen.message_again.text", text_or_empty(message)),
            "payload_stack": F.coalesce("chosen.stack_again.text", text_or_empty(stack)),
        }
    ).drop("doc", "again", "unread", "raw", "chosen")


def with_context(joined: DataFrame) -> DataFrame:
    """Add the payload context as a VARIANT; rows without a document are dropped.

    So are rows that only the second reader reads and that have no context of
    their own: the whole document is no VARIANT then.
    """
    refused = F.col("doc").isNull() & F.col("again").isNotNull()
    context = F.coalesce(payload_context(F.col("doc")), F.when(refused, context_again(F.col("body"))))
    rows = once(with_document(joined), "context", context)
    return rows.where(F.col("context").isNotNull()).drop("doc", "again", "unread", "body")


def with_fingerprint(outcomes: DataFrame) -> DataFrame:
    """Add message, functions and fingerprint; the fingerprint of rejects is NULL."""
    message = F.coalesce(
        F.nullif("payload_message", F.lit("")), F.nullif("first_message", F.lit("")), F.lit("")
    )
    functions = throwing_functions(F.col("function_names"), F.col("payload_stack"))
    fingerprint = root_cause_hash(F.col("error_message"), F.col("throwing_functions"))
    return (
        outcomes.withColumns({"error_message": message, "throwing_functions": functions})
        .withColumn("root_cause_hash", F.when(F.col("outcome") == OK, fingerprint))
        .withColumnsRenamed({"session_id": "id", "payload_stack": "stack_trace"})
    )


def to_incidents(fingerprinted: DataFrame) -> DataFrame:
    """Incident rows: the outcomes that have a fingerprint."""
    return fingerprinted.where(F.col("outcome") == OK).select(*INCIDENT_COLUMNS)


def rejects(outcomes: DataFrame) -> DataFrame:
    """Quarantine: candidates that gave no incident, and why."""
    return outcomes.where(F.col("outcome") != OK).select(
        "session_id", "s3_pointer", "obj_uri", F.col("outcome").alias("reason")
    )
