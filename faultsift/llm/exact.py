"""Exact dedup by an index of live digests: cuckoo filters over bucketed content.

Of equal texts (A-Z lower-cased, nothing else changed) the row with the largest
doc_id stays. Each task first indexes the rows it reads, so that a text of very
many copies leaves it once; the rest meets by digest bucket. In both places a
cuckoo filter answers for texts that are new, and a hit counts only if the
whole text is found in the content of its bucket.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.llm.common import importable, mapped, packed, pick, staged, table, unpacked

# Cells of a filter bucket, and fingerprints moved before the filter counts as full.
CELLS = 4
MOVES = 200
LEAST_BUCKETS = 64

# Bytes of text that a task's own index holds; the oldest texts are deleted beyond.
LIVE_BYTES = 32 << 20
# Bytes of text in a bucket of the index, on average.
BUCKET_BYTES = 8 << 20
# Buckets that a task reads one after the other, at most about.
BUCKETS_A_TASK = 16
# What an entry costs besides its text.
ENTRY_BYTES = 400

KEY_BITS = 64


class CuckooFilter:
    """Set of 64-bit keys in 16 bits each, which may also hold a key that was never added.

    A key's fingerprint lies in one of two buckets; either is found from the
    other and the fingerprint, so that fingerprints can be moved and deleted.
    """

    def __init__(self, buckets: int = LEAST_BUCKETS, cells: bytes | None = None):
        self.mask = buckets - 1
        self.cells = array("H", cells if cells is not None else bytes(2 * CELLS * buckets))

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = key >> 48 or 1
        first = key & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x9E3779B1 >> 8) & self.mask)

    def _cell(self, bucket: int, mark: int) -> int:
        """Where a bucket has a fingerprint (0: a free cell), or -1."""
        cells = self.cells
        for cell in range(bucket * CELLS, bucket * CELLS + CELLS):
            if cells[cell] == mark:
                return cell
        return -1

    def __contains__(self, key: int) -> bool:
        mark, first, second = self._places(key)
        return self._cell(first, mark) >= 0 or self._cell(second, mark) >= 0

    def add(self, key: int) -> bool:
        """False if there is no room; a fingerprint is lost then, and the filter has to be rebuilt."""
        mark, bucket, second = self._places(key)
        for place in (bucket, second):
            cell = self._cell(place, 0)
            if cell >= 0:
                self.cells[cell] = mark
                return True
        for move in range(MOVES):
            cell = bucket * CELLS + move % CELLS
            mark, self.cells[cell] = self.cells[cell], mark
            bucket = self._other(bucket, mark)
            cell = self._cell(bucket, 0)
            if cell >= 0:
                self.cells[cell] = mark
                return True
        return False

    def discard(self, key: int) -> None:
        """Only for a key that was added."""
        mark, first, second = self._places(key)
        cell = self._cell(first, mark)
        self.cells[cell if cell >= 0 else self._cell(second, mark)] = 0


class LiveIndex:
    """Texts by key, each with a value: a cuckoo filter, and the content in buckets by key.

    The content is looked at only where the filter has the key. Texts of one key
    are told apart by their content and share a fingerprint.
    """

    def __init__(self, live: CuckooFilter | None = None):
        self.live = live or CuckooFilter()
        self.content: dict[int, list[list]] = {}

    def _bucket(self, key: int) -> list[list]:
        return self.content.get(key & self.live.mask, [])

    def find(self, key: int, text: bytes) -> list | None:
        """The entry [key, text, value] of a text."""
        if key in self.live:
            for entry in self._bucket(key):
                if entry[0] == key and entry[1] == text:
                    return entry
        return None

    def load(self, key: int, text: bytes, value) -> None:
        """Content whose key the filter has already."""
        self.content.setdefault(key & self.live.mask, []).append([key, text, value])

    def insert(self, key: int, text: bytes, value) -> None:
        """For a text that has no entry."""
        known = key in self.live and any(entry[0] == key for entry in self._bucket(key))
        self.load(key, text, value)
        if not known and not self.live.add(key):
            self._grow()

    def delete(self, key: int, text: bytes) -> None:
        """For a text that has an entry."""
        left = [entry for entry in self._bucket(key) if entry[0] != key or entry[1] != text]
        if not any(entry[0] == key for entry in left):
            self.live.discard(key)
        if left:
            self.content[key & self.live.mask] = left
        else:
            del self.content[key & self.live.mask]

    def entries(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket

    def _grow(self) -> None:
        """Twice the buckets, or more, filled from the stored keys."""
        held = list(self.entries())
        keys = {entry[0] for entry in held}
        buckets = self.live.mask + 1
        full = True
        while full:
            buckets *= 2
            self.live = CuckooFilter(buckets)
            full = not all(self.live.add(key) for key in keys)
        self.content = {}
        for key, text, value in held:
            self.load(key, text, value)


def normalised(text: bytes | None) -> bytes:
    """UTF-8 with A-Z in lower case; null counts as empty."""
    return (text or b"").lower()


def _key(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "little") >> (64 - bits)


_ENTRY = "row long, doc_id long, entry long, sha256 binary, key long, text binary"


def entries(docs: DataFrame, live_bytes: int = LIVE_BYTES, key_bits: int = KEY_BITS) -> DataFrame:
    """One row a document (doc_id, text): its number, and that of the row which has its text.

    The first row of a text in a task brings the text as ``text``; the others
    name it as their ``entry``. A task's index holds ``live_bytes`` of text;
    a text deleted from it for room is brought again when it comes again.
    """
    importable(docs.sparkSession)
    schema = pa.schema(
        [(n, pa.binary() if t == "binary" else pa.int64()) for n, t in map(str.split, _ENTRY.split(", "))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        index, order, held = LiveIndex(), deque(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            rows, owners, digests, keys, heads = [], [], [], [], []
            for text in texts:
                text = normalised(text)
                digest = hashlib.sha256(text).digest()
                key = _key(digest, key_bits)
                entry = index.find(key, text)
                if entry is None:
                    index.insert(key, text, row)
                    order.append((key, text))
                    held += len(text) + ENTRY_BYTES
                    while held > live_bytes and len(order) > 1:
                        old = order.popleft()
                        index.delete(*old)
                        held -= len(old[1]) + ENTRY_BYTES
                rows.append(row)
                owners.append(row if entry is None else entry[2])
                digests.append(digest)
                keys.append(key - (1 << 64) if key >> 63 else key)
                heads.append(text if entry is None else None)
                row += 1
            columns = [rows, ids, owners, digests, keys, heads]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return mapped(pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text"), run, _ENTRY)


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod("key", F.lit(buckets)))


def _buckets(heads: DataFrame, bucket_bytes: int) -> int:
    held = heads.agg(F.sum(F.length("text") + ENTRY_BYTES)).first()[0] or 0
    return int(held // bucket_bytes) + 1


def classes(heads: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(entry, class) of ``heads`` (entry, key, text): entries of equal texts are one class.

    A bucket of the index is read by one task, which holds the index of one
    bucket at a time. A text comes at most once for each task that read it.
    """
    importable(heads.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        for batch in batches:
            found = []
            for bucket, key, entry, text in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    at, index = bucket, LiveIndex()
                key &= (1 << 64) - 1
                own = index.find(key, text)
                if own is None:
                    index.insert(key, text, entry)
                found.append(entry if own is None else own[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(found, pa.int64())], ["entry", "class"]
            )

    buckets = _buckets(heads, bucket_bytes)
    rows = _bucketed(heads, buckets)
    # As many tasks as the session asks for, or more where that would be too much for one.
    tasks = buckets // BUCKETS_A_TASK + 1
    many = tasks > int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "bucket") if many else rows.repartition("bucket")
    rows = rows.sortWithinPartitions("bucket")
    return mapped(rows.select("bucket", "key", "entry", "text"), run, "entry long, class long")


def exact_duplicates(
    docs: DataFrame,
    live_bytes: int = LIVE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha256) of every row of ``docs`` (doc_id, text).

    Texts are equal when identical after lower-casing A-Z only; a null text
    counts as empty. The row with the largest doc_id stays; of rows that repeat
    that id one stays. A null id is less than any other, so keep_id is null only
    where all ids of a text are. Repeated rows keep one result row each; an
    empty table gives none. Other columns of ``docs`` are ignored.
    """
    rows = staged(entries(docs, live_bytes, key_bits), "entries")
    heads = rows.where("text IS NOT NULL")
    of_entry = staged(classes(heads, bucket_bytes), "classes").withColumnRenamed("entry", "own")
    held = rows.groupBy("entry").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("best")
    )
    held = staged(held.join(of_entry, F.col("entry") == F.col("own")).drop("own"), "held")
    total = held.groupBy("class").agg(F.sum("n").alias("size"), F.max("best").alias("keep"))
    total = held.select("entry", "class").join(total, "class")
    total = total.select(F.col("entry").alias("own"), "size", "keep")
    # An entry's rows come from one task, so no key of this join is hot.
    joined = rows.select("row", "doc_id", "entry", "sha256").join(
        total, F.col("entry") == F.col("own")
    )
    return joined.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "sha256",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text, that of the largest doc_id; all columns as they are."""
    body = F.sha2(F.coalesce(F.translate("text", _UPPER, _UPPER.lower()), F.lit("")), 256)
    rows = packed(docs, "doc_id", "text").select(
        "doc", "rest", F.col("doc_id").cast("long").alias("id"), body.alias("body")
    )
    stay = exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("keep_id"), F.lower(F.hex("sha256")).alias("keep_body")
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("body") == F.col("keep_body"))
    nth = F.row_number().over(Window.partitionBy("id", "body").orderBy("rest"))
    kept = rows.join(stay, same, "left_semi").withColumn("nth", nth).where("nth = 1")
    return unpacked(kept, docs)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# The index as a table: a row with the filter's cells for each bucket, and one for each live text.
# No number is null, as pandas would hold such a column as floats.
INDEX = "bucket long, cells binary, key long, text binary, copies long"


def _changes(docs: DataFrame, sign: int, buckets: int) -> DataFrame:
    """(bucket, key, text, change): how many rows a task read of each text."""
    rows = staged(entries(docs), "entries")
    counts = rows.groupBy("entry").agg((F.count("*") * sign).alias("change"))
    heads = rows.where("text IS NOT NULL").select(F.col("entry").alias("own"), "key", "text")
    return _bucketed(heads.join(counts, F.col("own") == F.col("entry")), buckets).select(
        "bucket", "key", "text", "change"
    )


def updated_index(index: DataFrame, buckets: int, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The live index (``INDEX``) after rows (text) were added to a corpus and others removed.

    ``buckets`` stays that of the index, about one for each 8 MB of text. Copies
    are counted; a text whose last copy is removed leaves the filter and the
    content. Removing a text that is not live changes nothing, and additions
    come before removals. Only buckets are held, one at a time.
    """
    importable(index.sparkSession)
    changes = _changes(added, 1, buckets).union(_changes(removed, -1, buckets))

    def run(key: tuple, state: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        full = (1 << 64) - 1
        cells = state["cells"].dropna()
        found = LiveIndex(CuckooFilter(len(cells.iloc[0]) // (2 * CELLS), cells.iloc[0]) if len(cells) else None)
        for own, text, copies in state.loc[state["text"].notna(), ["key", "text", "copies"]].itertuples(index=False):
            found.load(int(own) & full, bytes(text), int(copies))
        # Stable: additions of a text come before its removals.
        batch = batch.sort_values("change", ascending=False, kind="stable")
        for own, text, change in batch[["key", "text", "change"]].itertuples(index=False):
            own, text, change = int(own) & full, bytes(text), int(change)
            entry = found.find(own, text)
            if entry is None:
                if change > 0:
                    found.insert(own, text, change)
            elif entry[2] + change > 0:
                entry[2] += change
            else:
                found.delete(own, text)
        rows = [(key[0], found.live.cells.tobytes(), 0, None, 0)]
        for own, text, copies in found.entries():
            rows.append((key[0], None, own - (1 << 64) if own >> 63 else own, text, copies))
        return pd.DataFrame(rows, columns=["bucket", "cells", "key", "text", "copies"])

    pair = index.groupBy("bucket").cogroup(changes.groupBy("bucket"))
    return pair.applyInPandas(run, INDEX)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256")
    )


OP11_SQL = f"""
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS body
    FROM documents
), grouped AS (
    SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM texts JOIN grouped USING (body)
"""
