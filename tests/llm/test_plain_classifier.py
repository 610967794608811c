"""The classifier against a plain loop over the same loss, one row and one weight at a time."""

import math
import random
import re
import zlib

import pytest

from faultsift.llm.toxicity import FAIRNESS, IDENTITIES, RIDGE, toxicity
from tests.llm.builders import documents

PAIRS = [
    (word, row.split()[(k + 1) % len(row.split())]) for row in IDENTITIES for k, word in enumerate(row.split())
]


def features(words):
    out = set()
    for word in words:
        out.add(zlib.crc32(f"={word}".encode()))
        out |= {zlib.crc32(f"^{word[:n]}".encode()) for n in (4, 5, 6) if len(word) >= n}
    return out


def words_of(text):
    return set(re.findall(r"[^\W\d_]+", text.lower()))


def plain_scores(texts, toxic):
    """Scores after many small steps down the loss; texts that are held out are scored and not learnt."""
    learnt = [d for d in texts if zlib.crc32(str(d).encode()) % 4 != 2]
    found = {d: features(words_of(texts[d])) for d in texts}
    n, p = len(learnt), sum(toxic[d] for d in learnt)
    chosen = []
    for f in sorted(set().union(*(found[d] for d in learnt))):
        total = sum(f in found[d] for d in learnt)
        expected = total * p / n
        positive = sum(f in found[d] and toxic[d] for d in learnt)
        chi = (positive - expected) ** 2 / (expected * (1 - p / n) * (1 - total / (n + 1)) + 1e-9)
        if total >= 2 and chi >= 15:
            chosen.append(f)
    at = {f: k for k, f in enumerate(chosen)}
    swap = dict(PAIRS)
    changes = []
    for d in learnt:
        words = words_of(texts[d])
        if words & set(swap):
            other = features({swap.get(w, w) for w in words})
            changes.append({at[f]: (f in found[d]) - (f in other) for f in found[d] ^ other if f in at})
    for a, b in PAIRS:
        one, two = features({a}), features({b})
        changes.append({at[f]: (f in one) - (f in two) for f in one ^ two if f in at})
    share = p / n
    weights = {d: (share / p / 2 + 0.25 / p) if toxic[d] else ((1 - share) / (n - p) / 2 + 0.25 / (n - p)) for d in learnt}
    rows = [(sorted(at[f] for f in found[d] if f in at), toxic[d], weights[d]) for d in learnt]
    w, bias = [0.0] * len(chosen), math.log(share / (1 - share))
    for _ in range(6000):
        slope, lean = [RIDGE * x for x in w], 0.0
        for has, y, weight in rows:
            error = weight * (1 / (1 + math.exp(-(bias + sum(w[k] for k in has)))) - y)
            lean += error
            for k in has:
                slope[k] += error
        for change in changes:
            if change:
                moved = sum(w[k] * v for k, v in change.items())
                for k, v in change.items():
                    slope[k] += 2 * FAIRNESS * moved * v / len(changes)
        w = [x - 0.5 * s for x, s in zip(w, slope)]
        bias -= 0.5 * lean
    return {d: 1 / (1 + math.exp(-(bias + sum(w[at[f]] for f in found[d] if f in at)))) for d in texts}, len(chosen)


def test_scores_equal_those_of_a_plain_loop(spark):
    rng = random.Random(3)
    texts, toxic = {}, {}
    for d in range(90):
        toxic[d] = int(d % 3 == 0)
        text = [rng.choice(["river", "stone", "table", "window", "garden"]) for _ in range(6)]
        text += rng.sample(["zblorf", "grumpa", "skirr"], 2) if toxic[d] else []
        text += ["muslims"] if d % 3 == 0 and d % 2 or d % 11 == 0 else []
        texts[d] = " ".join(text)
    frame = documents(spark, texts)
    labels = spark.createDataFrame([(d, 1, t) for d, t in toxic.items()], "doc_id LONG, quality INT, toxic INT")
    got = {r.doc_id: r.score for r in toxicity(frame, labels).collect()}
    want, chosen = plain_scores(texts, toxic)
    assert chosen > 5
    for d, score in want.items():
        assert got[d] == pytest.approx(score, abs=0.02)
    # Without the penalty, naming the group would move the score far.
    assert max(abs(got[d] - want[d]) for d in texts) < 0.02
