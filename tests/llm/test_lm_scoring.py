import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from faultsift.llm import lm
from faultsift.llm.lm import Network, lexicon, numbered, pseudo_likelihood, scored, tokens, trained
from tests.llm.builders import ODD, documents, no_documents, odd_documents


def corpus(spark, n=400):
    """Words that follow from their neighbours: a cycle with jumps."""
    rng = random.Random(1)
    texts = []
    for _ in range(n):
        at, text = rng.randrange(100), []
        for _ in range(rng.randrange(20, 120)):
            text.append(f"w{at}")
            at = (at + 1) % 100 if rng.random() < 0.95 else rng.randrange(100)
        texts.append(" ".join(text))
    return documents(spark, texts).repartition(4)


def test_scores_are_the_conditional_log_probabilities(spark):
    frame = documents(spark, {1: "a b a c a b", 2: "c", 3: ""})
    words = lexicon(frame)
    network = Network.fresh(words)
    got = {r.doc_id: r for r in scored(numbered(frame, words), words, network).collect()}
    ids = [words.numbers[w] for w in "a b a c a b".split()]
    total = 0.0
    for k, own in enumerate(ids):
        around = [ids[k + o] if 0 <= k + o < len(ids) else words.beyond for o in lm.OFFSETS]
        h = np.tanh(sum(network.embed[j][w] for j, w in enumerate(around)) + network.shift)
        logits = (h @ network.out + network.bias).astype(float)
        p = np.exp(logits) / np.exp(logits).sum()
        assert abs(p.sum() - 1) < 1e-9
        total += math.log(p[words.classes[own]]) + words.within[own]
    assert abs(got[1].log_likelihood - total) < 1e-3
    assert (got[2].n_tokens, got[3].n_tokens, got[3].log_likelihood) == (1, 0, 0.0)


def test_training_helps_and_order_matters(spark):
    frame = corpus(spark)
    words = lexicon(frame)
    texts = numbered(frame, words).persist()
    mean = lambda rows: rows.agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]
    network = trained(texts, words, 6)
    before, after = (mean(scored(texts, words, x)) for x in (Network.fresh(words), network))
    assert after > before + 0.1
    mixed = frame.withColumn("text", F.array_join(F.shuffle(F.split("text", " ")), " "))
    assert mean(scored(numbered(mixed, words), words, network)) < after - 0.1


def test_the_lexicon_counts_all_texts(spark):
    frame = documents(spark, ["x x y", "x Z", None])
    words = lexicon(frame)
    assert set(words.numbers) == {"x", "y", "z"} and words.numbers["x"] == 0
    assert abs(words.shares.sum() - 1) < 1e-9
    assert tokens("It's A-b 3.5") == ["it", "'", "s", "a", "-", "b", "3", ".", "5"]


def test_odd_rows(spark):
    got = pseudo_likelihood(odd_documents(spark)).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(tokens(r[1])) for r in ODD)
    assert all(math.isfinite(r.log_likelihood) and r.log_likelihood <= 0 for r in got)
    assert pseudo_likelihood(no_documents(spark)).collect() == []
    assert [r.log_likelihood for r in pseudo_likelihood(documents(spark, ["", None])).collect()] == [0, 0]


def test_rare_words_have_their_own_counts(spark, monkeypatch):
    """Held by every task, joined, or with a number of their own: the words of a class sum to one."""
    monkeypatch.setattr(lm, "VOCABULARY", 3)
    monkeypatch.setattr(lm, "HELD", 2)
    monkeypatch.setattr(lm, "HASHED", 2)
    counts = {"a": 40, "b": 30, "c": 20, "d": 9, "e": 7, "f": 5, "g": 2, "h": 1}
    texts = [" ".join([w] * n) for w, n in counts.items()]
    words = lexicon(documents(spark, texts))
    assert set(words.numbers) == set("abc") and set(words.held) == set("de") and words.more
    single = numbered(documents(spark, list(counts)), words).persist()
    network = Network.fresh(words)
    got = [r.log_likelihood for r in scored(single, words, network).orderBy("doc_id").collect()]
    place = {w: words.numbers.get(w, 3 + lm.hashed(w, 2)) for w in counts}
    around = [np.full(1, words.beyond)] * len(lm.OFFSETS)
    total = np.bincount(words.classes[list(place.values())], list(counts.values()), lm.CLASSES)
    for (word, n), value in zip(counts.items(), got):
        target = words.classes[place[word]]
        of_class = network.log_odds(around, np.array([target]))[0]
        assert abs(value - of_class - math.log(n / total[target])) < 1e-5


def test_classes_come_from_neighbours(spark, monkeypatch):
    monkeypatch.setattr(lm, "OWN_CLASS", 3)
    monkeypatch.setattr(lm, "CLASSES", 5)
    rng = random.Random(3)
    texts = []
    for _ in range(200):
        k = rng.randrange(10)
        texts.append(f"the n{k} is here" if rng.random() < 0.5 else f"is v{k} the here")
    words = lexicon(documents(spark, texts))
    of = {w: words.classes[k] for w, k in words.numbers.items()}
    assert {of[f"n{k}"] for k in range(10)}.isdisjoint(of[f"v{k}"] for k in range(10))


def test_every_position_trains(spark):
    """Each word that stands beside another moves its embedding of that offset."""
    order = [f"w{k}" for k in range(60)]
    frame = documents(spark, [" ".join(order), "", None])
    words = lexicon(frame)
    fresh, network = Network.fresh(words), trained(numbered(frame, words), words, 1)
    for k, offset in enumerate(lm.OFFSETS):
        beside = order[:offset] if offset < 0 else order[offset:]
        at = [words.numbers[w] for w in beside]
        assert (network.embed[k][at] != fresh.embed[k][at]).any(1).all()


def test_logits_use_the_same_room_and_no_odds_are_lost():
    """Many positions are scored in parts; the large array is made once."""
    words = lm.Lexicon({}, {}, None, False, np.ones(50), None, None, np.full(lm.CLASSES, 1 / lm.CLASSES))
    network, rng = Network.fresh(words), np.random.default_rng(1)
    count = 2 * lm.BATCH + 5
    around = [rng.integers(0, 51, count) for _ in lm.OFFSETS]
    target = rng.integers(0, lm.CLASSES, count)
    network.learn([a[:100] for a in around], target[:100], 0.3)
    room = network.room
    logits = network.hidden(around) @ network.out + network.bias
    want = logits[np.arange(count), target] - np.log(np.exp(logits).sum(1))
    assert np.allclose(network.log_odds(around, target), want, atol=1e-5)
    assert network.room is room and room.shape == (lm.BATCH, lm.CLASSES)


SPACES = ["a\x1cb\x85c d e", " \t\nlead trail\r\n\v\f", "ΑΣ ΣΑΣ. İstanbul I.", "q́ ​ z", "\x00a b"]


def test_words_split_by_piece_are_those_of_the_texts():
    """Blanks of all kinds, endings that depend on the whole word, empty and null texts."""
    texts = [*(r[1] for r in ODD), *SPACES, "", None, "a-b_c 3.5 a-b_c a-b_c", "x" * 5000]
    for some in (texts, texts[::-1], ["", None], []):
        split = lm.Split.of(some)
        order, ends = split.in_order()
        got = [split.words[k] for k in order.tolist()]
        assert [got[a:b] for a, b in zip(ends[:-1], ends[1:])] == [tokens(t) for t in some]
        counts = Counter()
        for word, n in zip(split.words, split.counts().tolist()):
            counts[word] += n
        assert counts == Counter(w for t in some for w in tokens(t))


def test_each_distinct_piece_is_taken_apart_once(monkeypatch):
    """Counting and numbering look at the pieces of a batch, not at each word of each text."""
    seen = []

    class Pattern:
        def findall(self, text):
            seen.append(text)
            return lm.re.findall(r"\w+|[^\w\s]", text)

    monkeypatch.setattr(lm, "_WORD", Pattern())
    split = lm.Split.of(["b, a b, c"] * 300)
    assert sorted(seen) == ["a", "b,", "c"] and sorted(split.counts().tolist()) == [300, 300, 600, 600]


def test_a_step_moves_by_the_plain_gradient():
    """Bias as a factor, pairs of values added at a time: the same step as written out in doubles."""
    words = lm.Lexicon({}, {}, None, False, np.ones(50), None, None, np.full(lm.CLASSES, 1 / lm.CLASSES))
    network, rng = Network.fresh(words), np.random.default_rng(2)
    network.bias += rng.normal(0, 2, lm.CLASSES).astype("f4")
    network.out *= 5
    around = [rng.integers(0, 51, 700) for _ in lm.OFFSETS]
    target = rng.integers(0, lm.CLASSES, 700)
    embed, shift, out, bias = (p.astype(float) for p in network.parts)
    h = np.tanh(sum(embed[k][a] for k, a in enumerate(around)) + shift)
    p = np.exp(h @ out + bias)
    p /= p.sum(1, keepdims=True)
    p[np.arange(700), target] -= 1
    back = (p @ out.T) * (1 - h * h)
    for k, a in enumerate(around):
        np.subtract.at(embed[k], a, back * 0.3 / math.sqrt(700))
    want = [embed, shift - 0.3 * back.mean(0), out - 0.3 * h.T @ p / 700, bias - 0.3 * p.mean(0)]
    network.learn(around, target, 0.3)
    assert all(np.allclose(got, w, atol=2e-6) for got, w in zip(network.parts, want))
