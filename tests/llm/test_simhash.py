import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from faultsift.llm.graph import connected_components
from faultsift.llm.simhash import fingerprint, keep_one, links, near_duplicates
from tests.llm.builders import documents, no_documents, odd_documents, words

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    low = "".join(c.lower() if c in LETTERS.upper() else c for c in text)
    tokens = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not tokens:
        return 0
    grams = [" ".join(tokens[k : k + 3]) for k in range(len(tokens) - 2)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [
    "", "  \n", "One", "One two", "one TWO three", "a b c d e f g", "É à b c\x0bd e", "x " * 400,
])
def test_fingerprints_follow_their_definition(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_the_same(spark):
    text = "some three words"
    row = spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64(text.encode(), seed=42).intdigest() == fingerprint(text)


def near_numbers(rng, centres, around, flips):
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(around):
            x = centre
            for _ in range(rng.randrange(flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("max_bits,segments", [(3, 2), (3, 4), (4, 2), (2, 3)])
def test_links_are_all_pairs_within_the_distance(spark, max_bits, segments):
    fps = np.array(near_numbers(random.Random(max_bits), 40, 12, 5), "<u8").view("<i8").tolist()
    classes = spark.createDataFrame([(x,) for x in fps], "fp LONG")
    got = [(r.u, r.v) for r in links(classes, max_bits, segments).collect()]
    assert len(got) == len(set(got))
    want = {
        (u, v) for u in fps for v in fps if u < v and ((u ^ v) % 2**64).bit_count() <= max_bits
    }
    assert set(got) == want and len(want) > 100


def brute_components(nodes, edges):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        label[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000 + k) for k in range(1, 400)]
    frame = spark.createDataFrame(edges, "u LONG, v LONG")
    used = {n for u, v in edges if u != v for n in (u, v)}
    got = connected_components(frame).collect()
    assert {r.node: r.component for r in got} == brute_components(used, edges)
    assert len(got) == len(used)
    assert connected_components(frame.limit(0)).collect() == []


def test_whole_operator_equals_brute_force(spark):
    rng = random.Random(3)
    texts = {}
    for base in range(12):
        own = words(rng, 300)
        for copy in range(8):
            text = list(own)
            for _ in range(rng.choice([0, 0, 1, 2, 40])):
                text[rng.randrange(300)] = f"z{rng.randrange(99)}"
            texts[base * 8 + copy] = " ".join(text)
    texts |= {500: "", 501: " ", 502: None}
    fps = {doc: plain_fingerprint(text or "") for doc, text in texts.items()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = brute_components(fps, pairs)
    got = near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fp % 2**64 for r in got} == fps
    assert 20 < len(set(want.values())) < len(want) - 20


def test_one_of_each_group_stays(spark):
    rng = random.Random(4)
    base = " ".join(words(rng, 200))
    frame = documents(spark, {3: base, 1: base, 2: " ".join(words(rng, 200)), 9: "", 8: ""})
    kept = keep_one(frame.union(frame))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8]


def test_odd_rows(spark):
    frame = odd_documents(spark)
    found = near_duplicates(frame).collect()
    assert len(found) == 10
    blank = {r.doc_id: r.component_id for r in found if r.fp == 0}
    assert blank == {1: 1, 2: 1, 3: 1}
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, 1), (False, 4), (False, 4), (False, 6), (False, 7), (True, 0)]
    assert near_duplicates(no_documents(spark)).collect() == []
    assert keep_one(no_documents(spark)).collect() == []
