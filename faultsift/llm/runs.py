"""Periodic runs of words, by recompression.

The words of a batch of documents become one sequence. Compressing blocks of a
symbol and pairs of symbols by turns gives a run-length grammar of it, level by
level. Two positions extend equally as far as they can be climbed together, so
the exact extent of each candidate costs a few steps a level. Candidates come
from a harmonic grid: for each period, pairs of positions that far apart.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import importable, mapped, pick, table

# A run has this many words, and this many periods, at least.
LEAST_WORDS = 6
LEAST_PERIODS = 4

# Words of the documents that are compressed together; a longer document is a batch by itself.
BATCH_WORDS = 200_000

# Symbols of the last level.
TOP = 8


@dataclass
class Level:
    """Symbols, and where the symbols of the next level begin among them.

    ``starts`` has one more element, the number of symbols; ``parent`` is the
    symbol of the next level that a symbol is part of. ``pairs`` tells whether
    pairs or blocks are compressed.
    """

    symbols: np.ndarray
    starts: np.ndarray
    parent: np.ndarray
    pairs: bool

    def mirrored(self) -> Level:
        n, m = len(self.symbols), len(self.starts) - 1
        return Level(self.symbols[::-1], n - self.starts[::-1], m - 1 - self.parent[::-1], self.pairs)


def _blocks(symbols: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each block of one symbol becomes a symbol of (symbol, length); single ones stay."""
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    starts = np.append(starts, len(symbols))
    heads, sizes = symbols[starts[:-1]], np.diff(starts)
    many = np.flatnonzero(sizes > 1)
    codes, names = pd.factorize(heads[many] * (len(symbols) + 1) + sizes[many])
    heads[many] = fresh + codes
    return heads, starts, fresh + len(names)


def _pairs(symbols: np.ndarray, fresh: int, turn: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols are dealt into left and right ones; each left one with a right one behind it is a pair."""
    salt = np.uint64((2 * turn + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    left = ((symbols.astype(np.uint64) + np.uint64(1)) * salt >> np.uint64(41)) & np.uint64(1) == 0
    first = np.flatnonzero(left[:-1] & ~left[1:])
    kept = np.ones(len(symbols), bool)
    kept[first + 1] = False
    starts = np.append(np.flatnonzero(kept), len(symbols))
    heads = symbols[starts[:-1]]
    codes, names = pd.factorize(symbols[first] * fresh + symbols[first + 1])
    heads[first - np.arange(len(first))] = fresh + codes
    return heads, starts, fresh + len(names)


class Grammar:
    """Run-length grammar of a sequence of symbols from 0 on; the first and the last must be unique."""

    def __init__(self, symbols: np.ndarray):
        self.length = len(symbols)
        self.levels: list[Level] = []
        fresh = int(symbols.max()) + 1
        turn = 0
        while len(symbols) > TOP:
            for pairs in (False, True):
                if pairs:
                    above, starts, fresh = _pairs(symbols, fresh, turn)
                else:
                    above, starts, fresh = _blocks(symbols, fresh)
                if len(above) < len(symbols):
                    parent = np.repeat(np.arange(len(above)), np.diff(starts))
                    self.levels.append(Level(symbols, starts, parent, pairs))
                    symbols = above
            turn += 1
        self.top = symbols

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal from positions x and from y on; x and y differ."""
        return _extend(self.levels, self.top, x, y)

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal before positions x and y."""
        mirrored = [level.mirrored() for level in self.levels]
        return _extend(mirrored, self.top[::-1], self.length - x, self.length - y)


def _extend(levels: list[Level], top: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Climb while both positions have equal symbols, then go down where they part.

    On each level a position inside a symbol of the next level is moved to its
    end first, by what both have left of it; equal symbols are parsed alike, so
    both are at a beginning then, or one block is longer and they part there.
    """
    begin, x, y = x, x.copy(), y.copy()
    parted = np.full(len(x), len(levels))
    live = np.arange(len(x))
    for h, level in enumerate(levels):
        a, b = x[live], y[live]
        same = level.symbols[a] == level.symbols[b]
        parted[live[~same]] = h
        live, a, b = live[same], a[same], b[same]
        up, other = level.parent[a], level.parent[b]
        inside = (level.starts[up] != a) | (level.starts[other] != b)
        rest, others = level.starts[up + 1] - a, level.starts[other + 1] - b
        step = inside * (1 if level.pairs else np.minimum(rest, others))
        x[live], y[live] = a + step, b + step
        if not level.pairs:
            uneven = inside & (rest != others)
            parted[live[uneven]] = h
            live = live[~uneven]
        x[live], y[live] = level.parent[x[live]], level.parent[y[live]]
    while len(live):
        live = live[top[x[live]] == top[y[live]]]
        x[live] += 1
        y[live] += 1
    for h in range(len(levels) - 1, -1, -1):
        level = levels[h]
        down = np.flatnonzero(parted > h)
        up, other = x[down], y[down]
        a, b = level.starts[up], level.starts[other]
        same = level.symbols[a] == level.symbols[b]
        if level.pairs:
            step = same
        else:
            step = same * np.minimum(level.starts[up + 1] - a, level.starts[other + 1] - b)
        x[down], y[down] = a + step, b + step
    return x - begin


def _sequence(docs: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents in that order, a unique symbol before, between and after them, and their starts."""
    sizes = np.array([len(docs[k]) for k in order])
    starts = 1 + np.concatenate(([0], np.cumsum(sizes + 1)))
    out = np.empty(starts[-1] + LEAST_PERIODS, np.int64)
    words = max((int(docs[k].max()) for k in order if len(docs[k])), default=-1) + 1
    ends = np.concatenate((starts - 1, starts[-1] + np.arange(LEAST_PERIODS)))
    out[ends] = words + np.arange(len(ends))
    for begin, k in zip(starts, order):
        out[begin : begin + len(docs[k])] = docs[k]
    return out, starts[:-1]


def candidates(docs: list[np.ndarray], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the sequence of ``docs``, periods) that may lie in a run; longest documents first.

    A run of period q has 4 q words, so 3 q positions in a row equal those q
    later, and one of the first 2 q of them is a multiple of 2 q: from there q
    positions are equal. Up to four of them are looked at here.
    """
    text, starts = _sequence(docs, order)
    sizes = np.array([len(docs[k]) for k in order])
    at, periods = [], []
    for q in range(1, int(sizes.max(initial=0)) // LEAST_PERIODS + 1):
        fit = int(np.searchsorted(-sizes, -max(LEAST_WORDS, LEAST_PERIODS * q), "right"))
        if not fit:
            break
        end = int(starts[fit - 1] + sizes[fit - 1])
        hit = np.flatnonzero(text[: end - q : 2 * q] == text[q : end : 2 * q]) * (2 * q)
        for k in range(1, min(q, LEAST_PERIODS)):
            hit = hit[text[hit + k] == text[hit + k + q]]
        if len(hit):
            at.append(hit)
            periods.append(np.full(len(hit), q))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(at), np.concatenate(periods)


def find_runs(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of the runs of ``docs`` (arrays of word numbers), in order.

    A run is a stretch with smallest period q and at least max(6, 4 q) words that
    cannot be made longer. Only documents with a candidate get a grammar.
    """
    order = np.argsort([-len(doc) for doc in docs], kind="stable")
    at, periods = candidates(docs, order)
    _, starts = _sequence(docs, order)
    owner = np.searchsorted(starts, at, "right") - 1
    held, place = np.unique(owner, return_inverse=True)
    if not len(held):
        return (np.zeros(0, np.int64),) * 4
    text, own_starts = _sequence(docs, order[held])
    at = at - starts[owner] + own_starts[place]
    grammar = Grammar(text)
    begin = at - grammar.before(at, at + periods)
    length = at + periods + grammar.after(at, at + periods) - begin
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)
    begin, length, periods, place = begin[long], length[long], periods[long], place[long]
    # A stretch that also has multiples of its period is found with each: the least counts.
    rank = np.lexsort((periods, length, begin))
    begin, length, periods, place = begin[rank], length[rank], periods[rank], place[rank]
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])
    begin, length, periods, place = begin[new], length[new], periods[new], place[new]
    doc = order[held][place]
    rank = np.lexsort((periods, begin, doc))
    return doc[rank], (begin - own_starts[place])[rank], length[rank], periods[rank]


RUNS = "array<struct<start: long, length: long, period: long>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Rewrite = Callable[[int | None, int], np.ndarray | None]


def periodic_runs(
    docs: DataFrame, batch_words: int = BATCH_WORDS, rewrite: Rewrite | None = None
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text).

    Words are separated by ASCII white space. ``runs`` are in order of start,
    then period. ``collapsed`` is the text's words joined by one space, without
    those that any run contains after its first period. A null or blank text
    has no words, no runs and an empty text; repeated rows and ids keep one
    result row each; an empty table gives none. Other columns are ignored.
    ``rewrite(doc_id, n_words)`` may give the numbers of the words to take
    instead of 0, 1, and so on. Texts are never cut; a batch holds
    ``batch_words`` words, or one longer text.
    """
    importable(docs.sparkSession)

    def report(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        flat = pa.array([word for words in texts for word in words], pa.binary())
        codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
        cuts = np.cumsum([0, *map(len, texts)])
        numbers = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        bodies = texts
        if rewrite:
            for k, words in enumerate(texts):
                taken = rewrite(ids[k], len(words))
                if taken is not None:
                    numbers[k] = numbers[k][taken]
                    bodies[k] = [words[n] for n in taken]
        found: list[list[dict]] = [[] for _ in ids]
        masks: dict[int, np.ndarray] = {}
        for doc, start, length, period in zip(*(x.tolist() for x in find_runs(numbers))):
            found[doc].append({"start": start, "length": length, "period": period})
            gone = masks.setdefault(doc, np.zeros(len(numbers[doc]), bool))
            gone[start + period : start + length] = True
        for doc, gone in masks.items():
            bodies[doc] = [bodies[doc][n] for n in np.flatnonzero(~gone)]
        joined = pa.array([b" ".join(words) for words in bodies], pa.binary())
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(x) for x in numbers], pa.int64()),
            pa.array(found, _RUNS),
            joined.cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            owners = batch.column(0).to_pylist()
            for own, text in zip(owners, batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()  # bytes: ASCII white space only
                if ids and held + len(words) > batch_words:
                    yield report(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(own)
                texts.append(words)
                held += len(words)
        if ids:
            yield report(ids, texts)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return mapped(rows, run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repeats: words from a on repeat those of a period, for a tenth of the ids."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    words = np.arange(n)
    words[a:] = a + (words[a:] - a) % p
    return words


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id plants nothing; see ``periodic_runs`` for the rest."""
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    # The longest, then that of the smallest start, then period.
    key = F.transform(
        "runs", lambda r: F.struct(r["length"].alias("n"), -r["start"], -r["period"], r.alias("run"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.transform(lines, lambda line: F.concat(line, F.lit("\n")))
    best = found.withColumn("best", F.array_max(key)["run"])
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
