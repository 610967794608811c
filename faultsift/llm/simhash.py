"""SimHash near-dedup by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.llm.common import mapped, packed, pick, staged, table, text_key, unpacked
from faultsift.llm.graph import connected_components

SEED = 42
BITS = 64
SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 2

_BYTE_BASE = np.arange(8) * 256
_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(gram), SEED) for gram in grams], dtype="<u8")
    # How often each of the 8 bytes has each value, then how often each bit is set.
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE_BASE).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).reshape(64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) of every row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle) for x in batch.column(2).to_pylist()], "<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view("<i8"))],
                ["doc_id", "text_key", "fp"],
            )

    rows = pick(docs, "doc_id", "text")
    rows = rows.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    return mapped(rows, run, "doc_id long, text_key long, fp long")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment of a fingerprint."""
    cuts = [BITS * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _part(fp: Column, first: int, width: int) -> Column:
    if width == BITS:
        return fp
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _ball(width: int, radius: int) -> list[int]:
    """All bit masks of a segment with at most ``radius`` bits."""
    return [
        sum(1 << b for b in bits)
        for weight in range(radius + 1)
        for bits in combinations(range(width), weight)
    ]


def links(classes: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(u, v), u < v: all pairs of distinct fingerprints ``fp`` that differ in at most max_bits bits.

    By pigeonhole some segment differs in at most max_bits // segments bits, so
    probing a ball of that radius in each segment's table finds every pair. The
    whole distance is part of the join condition, and a pair counts only in
    the first segment that finds it: the join puts out each link once and no
    other candidate.
    """
    parts = _segments(segments)
    radius = max_bits // segments
    if max(width for _, width in parts) >= BITS:
        raise ValueError("take at least two segments")

    def slots(name: str, masks) -> DataFrame:
        entries = [
            F.struct(
                F.lit(k).alias("segment"),
                _part(F.col("fp"), first, width).bitwiseXOR(F.lit(m).cast("long")).alias("value"),
            )
            for k, (first, width) in enumerate(parts)
            for m in masks(width)
        ]
        return classes.select(F.col("fp").alias(name), F.inline(F.array(*entries)))

    probes = slots("u", lambda width: _ball(width, radius))
    entries = slots("v", lambda width: [0])
    diff = F.col("u").bitwiseXOR(F.col("v"))
    first_find = F.lit(True)
    for k, (first, width) in enumerate(parts[:-1]):
        far = F.bit_count(_part(diff, first, width)) > radius
        first_find = first_find & ((F.col("probe.segment") <= k) | far)
    probes, entries = probes.alias("probe"), entries.alias("entry")
    near = (
        (F.col("probe.segment") == F.col("entry.segment"))
        & (F.col("probe.value") == F.col("entry.value"))
        & (F.col("u") < F.col("v"))
        & (F.bit_count(diff) <= max_bits)
        & first_find
    )
    return probes.join(entries, near).select("u", "v")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) of every row of ``docs`` (doc_id, text).

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest doc_id reachable, component the smallest fingerprint (as rows
    of one id may have several texts, two components may share their id). Null text counts as empty, and texts without
    words share fingerprint zero, which links like any other. Repeated rows
    keep one result row each. Null ids take part but never name a component
    unless all ids of it are null. Other columns of ``docs`` are ignored.
    """
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    joined = connected_components(links(classes, max_bits, segments)).join(
        classes, F.col("node") == F.col("fp")
    )
    joined = staged(joined.select("node", "component", "rep"), "components")
    least = joined.groupBy("component").agg(F.min("rep").alias("least"))
    of_node = joined.select("node", "component").join(least, "component")
    owners = classes.join(of_node, F.col("fp") == F.col("node"), "left")
    owners = owners.select(
        F.col("fp").alias("class"),
        F.coalesce("component", "fp").alias("component"),
        F.when(F.col("node").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id"),
    )
    owners = staged(owners, "owners")
    # Both sides get an exchange of their own, so Spark may split a hot fingerprint.
    return rows.join(owners, F.col("fp") == F.col("class")).drop("class")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id.

    Rows with a null id or of a group without any id always stay. All columns
    of ``docs`` are returned as they are.
    """
    found = near_duplicates(docs, shingle, max_bits).where("doc_id IS NOT NULL")
    first = F.min(F.struct("doc_id", "text_key")).alias("keeper")
    keepers = found.groupBy("component").agg(first)
    keepers = keepers.select(
        F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.text_key").alias("keep_key")
    )
    rows = packed(docs, "doc_id", "text")
    rows = rows.select("doc", "rest", F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    same = (F.col("id") == F.col("keep_id")) & (F.col("key") == F.col("keep_key"))
    kept = rows.where("id IS NOT NULL").join(keepers, same, "left_semi")
    copies = Window.partitionBy("id", "key").orderBy("rest")
    kept = kept.withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    return unpacked(kept.select("doc").union(rows.where("id IS NULL").select("doc")), docs)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
