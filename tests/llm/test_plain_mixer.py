"""The whole mix, written again as plain loops that share no code with it."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from faultsift.llm.mixture import mixed

BLOCK, SHARD, SEED = 64, 4096, 20_240_517
FULL = (1 << 64) - 1


def stirred(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & FULL
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & FULL
    return x ^ (x >> 31)


def placed(index, count, key):
    """Where a four-round Feistel network over the next even number of bits puts an index."""
    if count <= 1:
        return index
    half = max(1, ((count - 1).bit_length() + 1) // 2)
    while True:
        left, right = index >> half, index % (1 << half)
        for step in range(4):
            turn = stirred((right + stirred((key * 4 + step + 0x9E3779B97F4A7C15) & FULL)) & FULL)
            left, right = right, left ^ turn % (1 << half)
        index = (left << half) + right
        if index < count:
            return index


def split(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def goals(sizes):
    """Weights 1, 2, 3; what a source cannot take three times over goes to the others."""
    out, stopped, left = {}, set(), sum(sizes)
    while len(stopped) < len(sizes):
        free = [k for k in range(len(sizes)) if k not in stopped]
        weight = sum(k % 3 + 1 for k in free)
        over = [k for k in free if (k % 3 + 1) * left / weight > 3 * sizes[k]]
        if not over:
            return {**out, **{k: left * (k % 3 + 1) / weight for k in free}}
        for k in over:
            out[k] = 3.0 * sizes[k]
        stopped |= set(over)
        left -= sum(out[k] for k in over)
    return out


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hashed(doc, key):
    """Spark's hash of two numbers; a null one is passed over."""
    out = 42
    for value in (doc, key):
        if value is not None:
            out = xxhash.xxh64(value.to_bytes(8, "little", signed=True), seed=out).intdigest()
    return signed(out)


def text_key(text):
    return signed(xxhash.xxh64(text.encode(), seed=42).intdigest())


def plain_mix(rows):
    """taken by (doc_id, text, source)."""
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    buckets = 64 + len(rows) // 20_000
    own = {s: sorted((r for r in rows if r[2] == s), key=lambda r: (
        hashed(r[0], text_key(r[1])) % buckets, r[0] is not None, r[0] or 0, text_key(r[1])
    )) for s in sources}
    sizes = [sum(len(split(t)) for _, t, _ in own[s]) for s in sources]
    goal = goals(sizes)
    blocks = [-(-n // BLOCK) for n in sizes]
    quota = [min(round(goal[k] * blocks[k] / n), 3 * blocks[k]) if n else 0 for k, n in enumerate(sizes)]
    total, sequence = sum(quota), [0] * len(sources)
    for shard in range(-(-total // SHARD)):
        slots = min(SHARD, total - shard * SHARD)
        odds = np.array(quota, float) / max(1, total)
        for k, n in enumerate(np.random.default_rng([SEED, shard]).multinomial(slots, odds)):
            sequence[k] += int(n)
    # What was drawn above a quota goes to those below, in order.
    spare = sum(max(0, n - q) for n, q in zip(sequence, quota))
    for k, q in enumerate(quota):
        sequence[k], more = min(sequence[k], q), max(0, q - sequence[k])
        sequence[k] += min(more, spare)
        spare -= min(more, spare)
    taken = {}
    for k, s in enumerate(sources):
        times = [0] * max(1, blocks[k])
        for nth in range(sequence[k]):
            turn, index = divmod(nth, max(1, blocks[k]))
            key = stirred((SEED + k * 1_000_003 + turn) & FULL) >> 8
            times[placed(index, max(1, blocks[k]), key)] += 1
        at = 0
        for row in own[s]:
            n = len(split(row[1]))
            taken[row] = sum(times[w // BLOCK] for w in range(at, at + n))
            at += n
    return taken, {s: goal.get(k, 0.0) for k, s in enumerate(sources)}


def test_mix_equals_plain_loops(spark):
    rng, rows = random.Random(9), []
    for source, words in (("a", 30_000), ("b", 4_000), ("Z", 900), ("é", 9_000), (None, 150)):
        while words > 0:
            n = min(words, rng.randrange(0, 400))
            rows.append((rng.choice([None, len(rows)]), " ".join(f"w{len(rows)}_{k}" for k in range(n)) + "\n", source))
            words -= max(n, 1)
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")
    got = mixed(frame.repartition(5)).collect()
    want, goal = plain_mix(rows)
    keys = {(d, text_key(t), s): (d, t, s) for d, t, s in rows}
    assert {keys[r.doc_id, r.row_key, r.source]: r.taken for r in got} == want
    assert all(abs(r.target - goal[r.source]) < 1e-6 for r in got)
    assert sum(want.values()) > 40_000
    assert spark.range(1).select(F.xxhash64(F.lit("x")).alias("h")).first().h == text_key("x")
