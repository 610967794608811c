"""Masked pseudo-likelihood of documents by a bidirectional window network."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import mapped, pick, staged, table

# Words with an embedding of their own, classes of the output, and width of the network.
VOCABULARY = 4096
# Embeddings, and numbers, that all other words share by hash.
HASHED = 4096
# Words whose counts every task holds; those of all others are joined.
HELD = 100_000
CLASSES = 128
# The most frequent words are classes of their own.
OWN_CLASS = 64
WIDTH = 16
OFFSETS = (-2, -1, 1, 2)
# Rounds over all positions of the corpus.
ROUNDS = 2
BATCH = 1024
# Passes over the statistics that classes are formed from, and the frequent
# words beside a word that these count.
PASSES = 20
BESIDE = 31
RATE = 0.3
SEED = 7
# Means of parameters that are taken side by side.
GROUPS = 64
# Distinct words counted before their counts are handed on.
COUNTED = 300_000
# Positions scored at a time.
CHUNK = 16_384

_WORD = re.compile(r"\w+|[^\w\s]")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass(frozen=True)
class Split:
    """The words of some texts, each of the distinct pieces between blanks taken apart once.

    Piece ``k`` is ``sizes[k]`` of ``words`` from ``starts[k]``; ``pieces``
    numbers the pieces of all texts in order, ``ends`` where each text begins
    and ends in them.
    """

    words: list[str]
    starts: np.ndarray
    sizes: np.ndarray
    pieces: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Split:
        # No word has an ASCII blank; a piece with another blank has several words.
        lower = pa.array([(text or "").lower() for text in texts], pa.large_string())
        parts = pc.ascii_split_whitespace(lower)
        coded = parts.flatten().dictionary_encode()
        found = [_WORD.findall(piece) for piece in coded.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, found), "<i8", len(found))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())])
        words = list(chain.from_iterable(found))
        return cls(words, np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy(), ends)

    def counts(self) -> np.ndarray:
        """How often the texts have each of ``words`` by way of its piece."""
        return np.repeat(np.bincount(self.pieces, minlength=len(self.sizes)), self.sizes)

    def in_order(self) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``words`` of all words of the texts, and where each text begins and ends in these."""
        sizes = self.sizes[self.pieces]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return np.repeat(self.starts[self.pieces] - ends[:-1], sizes) + np.arange(ends[-1]), ends[self.ends]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts: counted in each task, then summed by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}

        def hand_on() -> pa.RecordBatch:
            words, counts = list(seen), list(seen.values())
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"]
            )

        for batch in batches:
            split = Split.of(batch.column(0).to_pylist())
            for word, n in zip(split.words, split.counts().tolist()):
                seen[word] = seen.get(word, 0) + n
            if len(seen) > COUNTED:
                yield hand_on()
        yield hand_on()

    rows = mapped(docs.select("text"), run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def hashed(word: str, count: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % count


@dataclass(frozen=True)
class Lexicon:
    """Numbers of all words: the most frequent have their own, the others one by hash.

    ``within`` is the log-probability of each word in its class; for a hashed
    number the log of one occurrence, to which the log of the word's own count
    is added. ``held`` has these logs for the words that every task knows,
    ``counts`` (word, n) for all.
    """

    numbers: dict[str, int]
    held: dict[str, float]
    counts: DataFrame
    # Whether there are words that are neither numbered nor held.
    more: bool
    totals: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    shares: np.ndarray

    @property
    def beyond(self) -> int:
        """The number of what lies beyond an end."""
        return len(self.totals)


def vocabulary(docs: DataFrame) -> Lexicon:
    """Numbers and counts of all words; classes are still missing."""
    counts = staged(word_counts(docs), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY + HELD).toPandas()
    words, n = top["word"].tolist(), top["n"].to_numpy("f8")
    numbers = {w: k for k, w in enumerate(words[:VOCABULARY])}
    by_hash = F.crc32(F.encode("word", "utf-8")) % HASHED
    sums = counts.groupBy(by_hash.alias("h")).agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    others, types = np.zeros(HASHED), 0
    for row in sums.collect():
        others[row["h"]] = row["n"]
        types += row["types"]
    for word, k in numbers.items():
        others[hashed(word, HASHED)] -= n[k]
    none = np.zeros(0)
    return Lexicon(
        numbers,
        dict(zip(words[VOCABULARY:], np.log(n[VOCABULARY:]).tolist())),
        counts,
        types > len(words),
        np.concatenate([n[:VOCABULARY], others]),
        none,
        none,
        none,
    )


def _grouped(features: np.ndarray, weights: np.ndarray, groups: int) -> np.ndarray:
    """The group of each row: weighted k-means that starts from equal shares along the main axis."""
    mean = np.average(features, axis=0, weights=weights)
    axis = np.linalg.eigh((features - mean).T @ ((features - mean) * weights[:, None]))[1][:, -1]
    # An axis has no sign of its own.
    along = (features - mean) @ (axis * np.sign(axis[np.abs(axis).argmax()]))
    order = np.lexsort((np.arange(len(along)), along))
    group = np.empty(len(along), "<i8")
    group[order] = np.minimum(groups * (np.cumsum(weights[order]) - weights[order]) / weights.sum(), groups - 1)
    for _ in range(PASSES):
        mass = np.bincount(group, weights, minlength=groups)
        sums = np.zeros((groups, features.shape[1]))
        np.add.at(sums, group, features * weights[:, None])
        centres = sums / np.maximum(mass, 1e-9)[:, None]
        far = (centres**2).sum(1) - 2 * features @ centres.T
        far[:, mass == 0] = np.inf
        group = far.argmin(1)
    return group


def classified(words: Lexicon, texts: DataFrame) -> Lexicon:
    """``words`` with classes from the neighbours that each number has in all ``texts`` (ids).

    The top words are classes of their own. The others are grouped by how often
    each of the most frequent words stands before and after them.
    """
    count, beyond, beside = len(words.totals), words.beyond, BESIDE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(count * 2 * beside, "<i8")
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), 500):
                sequence, places = _sequence(ids[at : at + 500], beyond)
                near = np.minimum(sequence, BESIDE)
                own = sequence[places] * (2 * beside)
                seen += np.bincount(own + near[places - 1], minlength=len(seen))
                seen += np.bincount(own + beside + near[places + 1], minlength=len(seen))
        table = seen.reshape(count, 2 * beside)
        met = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.array(list(table[met].astype("f8")), pa.list_(pa.float64()))],
            ["id", "beside"],
        )

    made = mapped(texts.select("ids"), run, "id long, beside array<double>")
    made = made.groupBy("id").agg(Summarizer.sum(array_to_vector("beside")).alias("beside"))
    near = np.zeros((count, 2 * beside))
    for row in made.select("id", vector_to_array("beside").alias("beside")).collect():
        near[row["id"]] = row["beside"]
    own = min(OWN_CLASS, len(words.numbers))
    classes = np.arange(count, dtype="<i8")
    met = own + np.flatnonzero(near[own:].any(1))
    classes[own:] = OWN_CLASS + np.arange(count - own) % (CLASSES - OWN_CLASS)
    if len(met):
        # Square roots of shares, as common neighbours would else outweigh all others.
        features = np.sqrt(near[met] / near[met].sum(1, keepdims=True))
        classes[met] = OWN_CLASS + _grouped(features, words.totals[met], CLASSES - OWN_CLASS)
    of_class = np.bincount(classes, words.totals, minlength=CLASSES)
    n = words.totals.copy()
    n[len(words.numbers) :] = 1
    return replace(
        words,
        classes=classes,
        within=np.log(n / np.maximum(of_class, 1)[classes]),
        shares=(of_class + 1) / (of_class.sum() + CLASSES),
    )


def lexicon(docs: DataFrame) -> Lexicon:
    """Numbers, counts and classes of all words of the corpus."""
    words = vocabulary(docs)
    return classified(words, numbered(docs, words))


def numbered(docs: DataFrame, words: Lexicon) -> DataFrame:
    """(row, doc_id, ids, logs, rest) of each text.

    ``row`` is unique, ids are the word numbers as little-endian 16-bit
    integers, logs the sum of the logs of the counts of its held words, and
    rest its words that are neither numbered nor held, as often as they occur.
    """
    sent = docs.sparkSession.sparkContext.broadcast((words.numbers, words.held, words.beyond))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, beyond = sent.value
        first, count = len(numbers), beyond - len(numbers)
        # One look for each word; the last entry is for words that are not known.
        known = {w: k for k, w in enumerate(chain(numbers, held))}
        place = np.array([*numbers.values(), *(first + hashed(w, count) for w in held), 0], "<i8")
        log = np.array([0.0] * first + [*held.values(), 0.0])
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            split = Split.of(batch.column(1).to_pylist())
            at = np.array([known.get(w, len(known)) for w in split.words], "<i8")
            own, logs, unknown = place[at], log[at], at == len(known)
            for k in np.flatnonzero(unknown).tolist():
                own[k] = first + hashed(split.words[k], count)
            order, ends = split.in_order()
            ids, size = own[order].astype("<u2"), batch.num_rows
            of_text = np.repeat(np.arange(size), np.diff(ends))
            rest = np.flatnonzero(unknown[order])
            rare = [split.words[k] for k in order[rest].tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + size)),
                    batch.column(0),
                    pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    pa.array(np.bincount(of_text, logs[order], size).astype(float)),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(rest, ends), pa.int32()), pa.array(rare, pa.string())
                    ),
                ],
                ["row", "doc_id", "ids", "logs", "rest"],
            )
            row += size

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return mapped(rows, run, "row long, doc_id long, ids binary, logs double, rest array<string>")


@dataclass
class Network:
    """Sums an embedding for each offset, bends the sum and predicts the class between."""

    embed: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    room: np.ndarray | None = None

    @classmethod
    def fresh(cls, words: Lexicon) -> Network:
        rng = np.random.default_rng(SEED)
        return cls(
            rng.normal(0, 0.1, (len(OFFSETS), words.beyond + 1, WIDTH)).astype("f4"),
            np.zeros(WIDTH, "f4"),
            rng.normal(0, 0.1, (WIDTH, CLASSES)).astype("f4"),
            np.log(words.shares).astype("f4"),
        )

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.shift, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def filled(self, values: np.ndarray) -> Network:
        cuts = np.cumsum([p.size for p in self.parts])[:-1]
        made = [v.reshape(p.shape).astype("f4") for v, p in zip(np.split(values, cuts), self.parts)]
        return Network(*made)

    def hidden(self, around: list[np.ndarray]) -> np.ndarray:
        total = self.embed[0].take(around[0], 0)
        total += self.shift
        for k in range(1, len(OFFSETS)):
            total += self.embed[k].take(around[k], 0)
        return np.tanh(total, out=total)

    def logits(self, h: np.ndarray) -> np.ndarray:
        """Logits of all classes but for the bias, for ``BATCH`` rows at most, in room that the next call uses again.

        New arrays of this size come from the system and go back to it each
        time. The bias is a factor of what the logits are summed with: one pass
        less over all of them.
        """
        if self.room is None:
            self.room = np.empty((BATCH, CLASSES), "f4")
        return np.matmul(h, self.out, out=self.room[: len(h)])

    def learn(self, around: list[np.ndarray], target: np.ndarray, rate: float) -> None:
        h, lift = self.hidden(around), np.exp(self.bias)
        p = self.logits(h)
        np.exp(p, out=p)
        # Each row stays ``total`` times its probabilities over ``lift``.
        total = p @ lift
        p[np.arange(len(target)), target] -= total / lift[target]
        share = 1 / total
        back = p @ (self.out * lift).T
        back *= (1 - h * h) * share[:, None]
        h *= share[:, None]
        step = rate / len(target)
        self.out -= (h.T @ p) * (step * lift)
        self.bias -= (share @ p) * (step * lift)
        self.shift -= step * back.sum(0)
        # An embedding moves by the sum, not the mean, as each is met seldom.
        back *= rate / math.sqrt(len(target))
        # Two numbers for each complex value, as numpy adds those faster than rows.
        pairs, half = back.view("c8").ravel(), np.arange(WIDTH // 2)
        for k in range(len(OFFSETS)):
            places = (around[k] * (WIDTH // 2))[:, None] + half
            np.subtract.at(self.embed[k].view("c8").reshape(-1), places.ravel(), pairs)

    def log_odds(self, around: list[np.ndarray], target: np.ndarray) -> np.ndarray:
        """Log-probability of each target class."""
        odds, lift = np.empty(len(target), "f4"), np.exp(self.bias)
        for k in range(0, len(target), BATCH):
            some = target[k : k + BATCH]
            logits = self.logits(self.hidden([a[k : k + BATCH] for a in around]))
            own = logits[np.arange(len(some)), some] + self.bias[some]
            odds[k : k + BATCH] = own - np.log(np.exp(logits, out=logits) @ lift)
        return odds


def _sequence(ids: list[bytes], beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other with two ends between, and the places of their words."""
    lengths = np.array([len(x) // 2 for x in ids], "<i8")
    gap = -min(OFFSETS)
    begins = np.cumsum(lengths + gap) - lengths
    total = int(lengths.sum())
    places = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
    sequence = np.full(total + gap * (len(ids) + 1), beyond, "<i8")
    sequence[places] = np.frombuffer(b"".join(ids), "<u2")
    return sequence, places


def trained(texts: DataFrame, words: Lexicon, rounds: int = ROUNDS) -> Network:
    """A network trained on all ``texts`` (ids).

    In each round every task starts from the same network, learns to predict
    every position of all its texts from its neighbours (a word is not in its
    own window), and hands on its parameters; their mean, by positions, starts the next round. Means are
    taken in two steps, so that no task gets all of them.
    """
    spark = texts.sparkSession
    network = Network.fresh(words)
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((network, words.classes, words.beyond))

        def run(batches: Iterator[pa.RecordBatch], turn=turn, sent=sent) -> Iterator[pa.RecordBatch]:
            start, classes, beyond = sent.value
            own = start.filled(start.flat())
            task = TaskContext.get().partitionId()
            rng = np.random.default_rng([SEED, turn, task])
            learnt = 0
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for at in range(0, len(ids), 500):
                    sequence, places = _sequence(ids[at : at + 500], beyond)
                    rng.shuffle(places)
                    for k in range(0, len(places), BATCH):
                        some = places[k : k + BATCH]
                        around = [sequence[some + o] for o in OFFSETS]
                        own.learn(around, classes[sequence[some]], RATE / (1 + turn))
                    learnt += len(places)
            if learnt:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task], pa.int64()),
                        pa.array([float(learnt)]),
                        pa.array([own.flat().astype("f8")], pa.list_(pa.float64())),
                    ],
                    ["task", "weight", "params"],
                )

        made = mapped(texts.select("ids"), run, "task long, weight double, params array<double>")
        made = made.withColumn("params", array_to_vector("params"))
        part = made.groupBy(F.pmod("task", F.lit(GROUPS)).alias("g")).agg(
            Summarizer.mean(F.col("params"), F.col("weight")).alias("params"),
            F.sum("weight").alias("weight"),
        )
        # Grouped, so that a corpus without words gives no row.
        mean = part.groupBy(F.lit(0).alias("all")).agg(Summarizer.mean(F.col("params"), F.col("weight")).alias("params"))
        row = mean.select(vector_to_array("params").alias("params")).first()
        if row is not None:
            network = network.filled(np.array(row["params"]))
    return network


def scored(texts: DataFrame, words: Lexicon, network: Network) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of ``texts``, as ``numbered`` makes them."""
    sent = texts.sparkSession.sparkContext.broadcast((network, words.classes, words.within, words.beyond))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, classes, within, beyond = sent.value
        for batch in batches:
            rows, docs, own_logs = batch.column(0), batch.column(1), batch.column(3).to_numpy()
            ids = batch.column(2).to_pylist()
            for at in range(0, len(ids), 500):
                some = ids[at : at + 500]
                sequence, places = _sequence(some, beyond)
                word = sequence[places]
                target = classes[word]
                logs = within[word]
                for k in range(0, len(places), CHUNK):
                    part = places[k : k + CHUNK]
                    around = [sequence[part + o] for o in OFFSETS]
                    logs[k : k + CHUNK] += own.log_odds(around, target[k : k + CHUNK])
                n = np.array([len(x) // 2 for x in some], "<i8")
                total = np.bincount(np.repeat(np.arange(len(n)), n), logs, minlength=len(n))
                total = total + own_logs[at : at + len(some)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.slice(at, len(some)),
                        docs.slice(at, len(some)),
                        pa.array(n),
                        pa.array(total.astype(float)),
                    ],
                    ["row", "doc_id", "n_tokens", "log_likelihood"],
                )

    made = mapped(texts.select("row", "doc_id", "ids", "logs"),
        run, "row long, doc_id long, n_tokens long, log_likelihood double"
    )
    if words.more:
        rest = texts.select("row", F.explode("rest").alias("word")).join(words.counts, "word")
        rest = rest.groupBy("row").agg(F.sum(F.ln("n")).alias("rest"))
        total = F.col("log_likelihood") + F.coalesce("rest", F.lit(0.0))
        made = made.join(rest, "row", "left").withColumn("log_likelihood", total)
    mean = F.col("log_likelihood") / F.greatest("n_tokens", F.lit(1))
    return made.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of every row of ``docs``.

    Vocabulary, classes and network are learnt from all texts of ``docs``
    (doc_id, text). Each word's probability given two words on either side is
    that of its class by the network times that of the word in its class, which
    comes from the word's own count, however rare the word;
    log_likelihood sums the logs over the whole text. Null and empty texts have
    0 words and 0.0. Repeated rows train and score each; ids may repeat or be
    null; a table without rows gives none. Other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text")
    words = vocabulary(docs)
    texts = staged(numbered(docs, words), "word-numbers")
    words = classified(words, texts)
    return scored(texts, words, trained(texts, words))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))
