"""Exact dedup against grouping by text, and the live index against a plain dict."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultsift.llm.common import staged
from faultsift.llm.exact import (
    CELLS,
    INDEX,
    CuckooFilter,
    LiveIndex,
    entries,
    exact_duplicates,
    normalised,
    updated_index,
    without_copies,
)
from tests.llm.builders import ODD, documents, no_documents, odd_documents, words

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(pairs):
    """Result rows of (doc_id, text) pairs, grouped by text."""
    groups = defaultdict(list)
    for doc, text in pairs:
        groups[normalised((text or "").encode())].append(doc)
    out = []
    for body, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for doc in ids:
            kept = doc == keep and left == 1
            left -= kept
            out.append((doc, keep, len(ids), kept, hashlib.sha256(body).hexdigest()))
    return out


def results(docs, **parameters):
    rows = exact_duplicates(docs, **parameters).collect()
    return [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.sha256).hex()) for r in rows]


def same(got, want):
    assert Counter(got) == Counter(want)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_copies_in_other_case_and_of_many_sizes(spark):
    rng = random.Random(3)
    texts = [" ".join(words(rng, rng.randrange(1, 5), 3)) for _ in range(400)]
    texts += [t.upper() for t in texts[:100]] + ["É", "é", "ÉA", "Éa", "K", "K"] + ["hot"] * 200
    docs = documents(spark, texts).repartition(7)
    want = brute(list(enumerate(texts)))
    same(results(docs), want)
    assert sum(row[3] for row in want) == len({row[4] for row in want})


@pytest.mark.parametrize("key_bits", [1, 4, 8])
def test_texts_of_one_key_are_told_apart_by_content(spark, key_bits):
    texts = [f"text {n % 150}" for n in range(400)]
    same(results(documents(spark, texts).repartition(4), key_bits=key_bits), brute(list(enumerate(texts))))


def test_a_task_without_room_deletes_and_meets_its_texts_again(spark):
    texts = [f"text {n % 40}" for n in range(400)]
    docs = documents(spark, texts).coalesce(1)
    assert entries(docs, live_bytes=2000).where("text IS NOT NULL").count() > 40
    same(results(docs, live_bytes=2000, bucket_bytes=1000), brute(list(enumerate(texts))))


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    docs = odd_documents(spark)
    same(results(docs), brute(pairs_of(docs)))
    doubled = docs.union(docs)
    same(results(doubled), brute(pairs_of(doubled)))
    assert results(no_documents(spark)) == []


def test_null_ids_only(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "A")], "doc_id LONG, text STRING")
    rows = results(docs)
    assert [row[1:3] for row in rows] == [(None, 2)] * 2 and sum(row[3] for row in rows) == 1


def test_what_stays_has_all_columns_as_they_are(spark):
    docs = odd_documents(spark)
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    rows = {tuple(row) for row in kept.collect()}
    assert rows <= {tuple(row) for row in docs.collect()}
    assert len(rows) == len({normalised((row[1] or "").encode()) for row in ODD}) == kept.count()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.booleans()), max_size=600), st.integers(0, 3))
def test_live_index_is_a_dict(changes, zeros):
    """Keys that share low bits overflow their buckets, which makes the filter grow."""
    index, want = LiveIndex(CuckooFilter(2)), {}
    for n, add in changes:
        text = str(n).encode()
        key = int.from_bytes(hashlib.sha256(text).digest()[:8], "little") >> zeros << zeros
        entry = index.find(key, text)
        assert (entry[2] if entry else None) == want.get(text)
        if add and entry is None:
            index.insert(key, text, n)
            want[text] = n
        elif not add and entry is not None:
            index.delete(key, text)
            del want[text]
    assert {entry[1]: entry[2] for entry in index.entries()} == want
    assert sum(cell != 0 for cell in index.live.cells) == len({entry[0] for entry in index.entries()})


def test_filter_without_room_says_so_and_the_index_grows():
    small = CuckooFilter(1)
    assert [small.add((n + 1) << 48) for n in range(CELLS)] == [True] * CELLS
    assert not small.add(99 << 48)
    index = LiveIndex(CuckooFilter(1))
    keys = [int.from_bytes(hashlib.sha256(b"%d" % n).digest()[:8], "little") for n in range(5000)]
    for key in keys:
        index.insert(key, b"", key)
    assert index.live.mask + 1 >= 5000 / CELLS and all(index.find(key, b"")[2] == key for key in keys)
    absent = [int.from_bytes(hashlib.sha256(b"-%d" % n).digest()[:8], "little") for n in range(20_000)]
    assert sum(key in index.live for key in absent) < 20


def test_index_follows_additions_and_removals(spark):
    rng = random.Random(5)
    live, buckets = Counter(), 5
    index = spark.createDataFrame([], INDEX)
    for _ in range(3):
        added = [f"Text {rng.randrange(60)}" for _ in range(80)]
        removed = [f"text {rng.randrange(90)}" for _ in range(60)]
        index = staged(
            updated_index(index, buckets, documents(spark, added), documents(spark, removed)), "index"
        )
        live.update(t.lower().encode() for t in added)
        for t in removed:
            live[t.encode()] = max(0, live[t.encode()] - 1)
        rows = index.collect()
        got = {bytes(r.text): r.copies for r in rows if r.text is not None}
        assert got == {t: n for t, n in live.items() if n}
        cells = [r for r in rows if r.cells is not None]
        marks = sum(len(bytes(r.cells)) // 2 - memoryview(bytes(r.cells)).cast("H").tolist().count(0) for r in cells)
        assert len(cells) == len({r.bucket for r in rows}) and marks == len(got)
