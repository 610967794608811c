"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

import re
from collections.abc import Iterator
from copy import copy
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import mapped, packed, pick, staged, table, text_key, unpacked

WINDOW = 5
COVERAGE = 0.8
# Diagonals that count as one place of a document: as many words may be missing or added.
BAND = 16
# Up to so many window hashes (8 bytes each) go to every task to thin out the
# windows before the join. Beyond, all windows are shuffled to the join.
SENT_HASHES = 2_000_000
# Characters of texts that are worked on together; a longer text alone.
TOGETHER = 250_000

# Units that follow a number, and numbers in words.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce "
    "ounces gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres "
    "gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years cent cents dollar dollars euro euros percent degree "
    "degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh w kw v "
    "volt volts watt watts j joule joules hz".split()
)
NUMBERS = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million".split()
)

# Words that start sentences and are no names.
STARTERS = frozenset(
    "a an the this that these those there here i you he she it we they my your his her its our "
    "their what which who whom whose when where why how if then than so and or but nor yet for as "
    "at by in on of off to from with without within into onto over under after before since until "
    "during while because although though unless each every all both some any no not none many "
    "much more most few several is are was were be been has have had do does did can could will "
    "would shall should may might must let please given suppose assume find consider determine "
    "calculate compute show prove one also now finally first next however therefore thus".split()
)

# Kinds of a token; all but PLAIN are slots of a template.
PLAIN, NUMBER, UNIT, NAME = range(4)
_SLOT = ["", "#", "u", "n"]

_SEPARATOR, _LETTER, _DIGIT = range(3)
_OTHER_MARKS = re.compile(r"[^\w\x00-\x7f]")


def _classes() -> np.ndarray:
    out = np.full(256, _SEPARATOR, np.int8)
    for byte in range(256):
        if byte >= 0x80 or chr(byte).isalpha():
            out[byte] = _LETTER
        elif chr(byte).isdigit():
            out[byte] = _DIGIT
    return out


@cache
def _odd_capitals() -> re.Pattern:
    """The few capitals that have another length in lower case: they are not seen as capitals."""
    every = (chr(k) for k in range(0x80, 0x110000) if not 0xD800 <= k < 0xE000)
    return re.compile("[%s]" % "".join(c for c in every if len(c.lower().encode()) != len(c.encode())))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_CLASS = _classes()
_ENDS = np.isin(np.arange(256), list(b".!?:\n"))
_JOINS_DIGITS = np.isin(np.arange(256), list(b".,:/"))
_ODD = np.uint64(0x9E3779B97F4A7C15)
# A number for each byte, and a factor for each place in a word.
_BYTE = _mixed(np.arange(1, 257, dtype="<u8") * _ODD)
_PLACE = _mixed(np.arange(1001, 1257, dtype="<u8") * _ODD) | np.uint64(1)


def _word_hashes(data: np.ndarray, starts: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, whose order counts."""
    if not len(starts):
        return np.zeros(0, "<u8")
    place = np.arange(len(data), dtype=np.int32)
    place -= np.repeat(
        np.concatenate([[0], starts]).astype(np.int32),
        np.diff(np.concatenate([[0], starts, [len(data)]])),
    )
    terms = _BYTE[data] * _PLACE[place & 255]
    terms[~word] = 0
    return _mixed(np.add.reduceat(terms, starts))


@cache
def known_hashes(name: str) -> np.ndarray:
    # A unit without a number is known by three letters and more.
    free = {unit for unit in UNITS if len(unit) > 2 and unit != "min"}
    words = sorted({"numbers": NUMBERS, "units": UNITS, "free": free, "starters": STARTERS}[name])
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    word = data != 32
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    return np.sort(_word_hashes(data, starts, word))


def _is_in(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(values), bool)
    at = np.searchsorted(found, values)
    at[at == len(found)] = 0
    return found[at] == values


class Templates:
    """The canonical tokens of some texts one after the other, and the hashes of their windows.

    Tokens are runs of letters or of digits, in lower case: digits with one of
    ``.,:/`` between are one number, letters with an apostrophe between one
    word, and "5km" is two tokens. ``owner`` is the number of a token's text,
    ``first`` the first token of each text. ``begins`` are the capitalised words
    that start a sentence and may be names. All texts are worked on at once as
    one array of bytes.
    """

    def __init__(self, texts: list[str | None]):
        shown, low = [], []
        for text in texts:
            text = text or ""
            if not text.isascii():
                text = _OTHER_MARKS.sub(" ", text)
            lower = text.lower().encode("utf-8", "replace")
            if not text.isascii():
                text = _odd_capitals().sub(lambda m: m[0].lower(), text)
            shown.append(text.encode("utf-8", "replace"))
            low.append(lower)
        # Lines of spaces, so that every byte has neighbours.
        data = np.frombuffer(b"\n" + b"\n".join(low) + b"\n", np.uint8)
        upper = np.frombuffer(b"\n" + b"\n".join(shown) + b"\n", np.uint8) != data
        kinds = _CLASS[data]
        for at in (np.flatnonzero(_JOINS_DIGITS[data]), np.flatnonzero(data == 39)):
            at = at[(at > 0) & (at < len(data) - 1)]
            own = _DIGIT if len(at) and data[at[0]] != 39 else _LETTER
            kinds[at[(kinds[at - 1] == own) & (kinds[at + 1] == own)]] = own
        word = kinds != _SEPARATOR
        turn = (kinds[:-1] == _DIGIT) & (kinds[1:] == _LETTER)
        starts = np.flatnonzero(word[1:] & (~word[:-1] | turn)) + 1
        ends = np.flatnonzero(word[:-1] & (~word[1:] | turn)) + 1
        self.data, self.starts, self.ends = data, starts, ends
        self.plain = _word_hashes(data, starts, word)
        begin_of = np.cumsum([1] + [len(x) + 1 for x in low])
        self.owner = np.searchsorted(begin_of, starts, side="right") - 1
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))

        kind = np.where(kinds[starts] == _DIGIT, NUMBER, PLAIN)
        kind[_is_in(self.plain, known_hashes("numbers"))] = NUMBER
        after = np.zeros(len(kind), bool)
        after[1:] = (kind[:-1] == NUMBER) & (self.owner[1:] == self.owner[:-1])
        kind[after & _is_in(self.plain, known_hashes("units"))] = UNIT
        begins = np.zeros(len(kind), bool)
        if upper.any():
            count = np.concatenate([[0], np.cumsum(upper)])
            width = np.select([data[starts] >= 0xE0, data[starts] >= 0xC0], [3, 2], 1)
            reach = np.minimum(starts + width, ends)
            capital = (count[reach] > count[starts]) & (count[ends] == count[reach]) & (ends > reach)
            # A capital at the start of a sentence says nothing by itself.
            stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
            inside = np.zeros(len(kind), bool)
            inside[1:] = stops[starts[1:]] == stops[ends[:-1]]
            begins = capital & ~inside & (kind == PLAIN)
            begins &= ~_is_in(self.plain, known_hashes("starters"))
            kind[capital & inside & (kind == PLAIN)] = NAME
        self.kind = kind
        self.begins = begins

    def whole(self, size: int) -> np.ndarray:
        """Whether the window that starts at a token lies in one text."""
        count = max(0, len(self.kind) - size + 1)
        return self.owner[:count] == self.owner[len(self.kind) - count :]

    def wide(self) -> Templates:
        """The same texts with more slots, and names of several words as one token.

        A capitalised word at the start of a sentence is a name too, and a unit
        is one without a number before it.
        """
        other = copy(self)
        kind = np.where(self.begins, NAME, self.kind)
        kind[(kind == PLAIN) & _is_in(self.plain, known_hashes("free"))] = UNIT
        goes_on = np.zeros(len(kind), bool)
        goes_on[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (self.owner[1:] == self.owner[:-1])
        goes_on[1:] &= (self.starts[1:] - self.ends[:-1] == 1) & (self.data[self.ends[:-1]] == 32)
        kept = np.flatnonzero(~goes_on)
        other.kind, other.plain, other.owner = kind[kept], self.plain[kept], self.owner[kept]
        other.starts = self.starts[kept]
        other.ends = self.ends[np.append(kept[1:], len(kind))[: len(kept)] - 1]
        other.first = np.searchsorted(other.owner, np.arange(len(self.first)))
        return other

    def windows(self, size: int, names: bool) -> np.ndarray:
        """Hash of each window; ``names`` replaces names as well as numbers and units."""
        slot = (self.kind != PLAIN) & (names | (self.kind != NAME))
        tokens = np.where(slot, _MARK[self.kind], self.plain)
        count = max(0, len(tokens) - size + 1)
        out = np.full(count, size, "<u8")
        for k in range(size):
            out = (out ^ tokens[k : k + count]) * _ODD
            out ^= out >> np.uint64(29)
        return out

    def literal(self, size: int) -> np.ndarray:
        """How many tokens of each window are words, not slots."""
        sums = np.concatenate([[0], np.cumsum(self.kind == PLAIN)])
        return sums[size:] - sums[: max(0, len(sums) - size)]

    def slots(self, start: int, size: int) -> list[str]:
        """The values of a window by token: kind and text, or empty for a word."""
        return [
            _SLOT[k] + self.data[a:b].tobytes().decode() if k else ""
            for k, a, b in zip(
                self.kind[start : start + size],
                self.starts[start : start + size],
                self.ends[start : start + size],
            )
        ]


_MARK = _mixed(np.arange(2001, 2005, dtype="<u8") * _ODD)


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, size, hash, item_pos, item_slots, total, wide): windows of every benchmark item.

    An item of fewer words is one window. Windows of which less than half is
    words are left out unless an item has no others, so that runs of bare
    numbers match nothing by themselves. ``wide`` marks the windows of the wide
    template, of which more than a third is words; an item has them only if
    that holds for half of them. Null and empty items have no windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = Templates([text])
                size = min(window, len(made.kind))
                if not size:
                    continue
                usable = np.flatnonzero(made.literal(size) * 2 >= size)
                if not len(usable):
                    usable = np.arange(len(made.kind) - size + 1)
                forms = [made.windows(size, names).view("<i8") for names in (True, False)]
                for pos in usable.tolist():
                    for h in {int(form[pos]) for form in forms}:
                        out.append((item, size, h, pos, made.slots(pos, size), len(usable), False))
                other = made.wide()
                literal = other.literal(window)
                usable = np.flatnonzero(literal * 3 > window)
                if 2 * len(usable) >= len(literal):
                    wide = other.windows(window, True).view("<i8")
                    for pos in usable.tolist():
                        slots = other.slots(pos, window)
                        out.append((item, window, int(wide[pos]), pos, slots, len(usable), True))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in out], schema=schema
            )

    schema = pa.schema(
        [
            ("item_id", pa.int64()),
            ("size", pa.int32()),
            ("hash", pa.int64()),
            ("item_pos", pa.int64()),
            ("item_slots", pa.list_(pa.string())),
            ("total", pa.int64()),
            ("wide", pa.bool_()),
        ]
    )
    rows = pick(items, "item_id", "text").select(F.col("item_id").cast("long"), "text").distinct()
    return mapped(rows,
        run,
        "item_id long, size int, hash long, item_pos long, item_slots array<string>, total long, "
        "wide boolean",
    )


def document_windows(
    docs: DataFrame, sizes: list[int], wanted: np.ndarray | None, window: int = WINDOW
) -> DataFrame:
    """(doc_id, text_key, hash, doc_pos, doc_slots, doc_wide): windows of whole texts.

    ``wanted``, sorted, thins them out to windows that some item has. Windows of
    the wide template have ``window`` tokens.
    """
    sent = None
    if wanted is not None:
        sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = None if sent is None else sent.value
        for batch in batches:
            ids, keys, texts = (batch.column(k).to_pylist() for k in range(3))
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size < TOGETHER):
                    size += len(texts[end] or "")
                    end += 1
                made = Templates(texts[at:end])
                yield batch_of(list(hits(made, hashes, ids[at:end], keys[at:end])))
                at = end

    def hits(made: Templates, hashes: np.ndarray | None, ids: list, keys: list) -> Iterator[tuple]:
        for size in sizes:
            whole = made.whole(size)
            plain = made.windows(size, False).view("<i8")
            forms = [(plain, whole, made)]
            if (made.kind == NAME).any():
                named = made.windows(size, True).view("<i8")
                forms.append((named, whole & (named != plain), made))
            if size == window:
                other = made.wide()
                forms.append((other.windows(size, True).view("<i8"), other.whole(size), other))
            for form, hit, shown in forms:
                if hashes is not None:
                    hit = hit & _is_in(form, hashes)
                for place in np.flatnonzero(hit).tolist():
                    own = shown.owner[place]
                    pos = place - int(shown.first[own])
                    slots = shown.slots(place, size)
                    yield ids[own], keys[own], int(form[place]), pos, slots, shown is not made

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.int64()),
            ("hash", pa.int64()),
            ("doc_pos", pa.int64()),
            ("doc_slots", pa.list_(pa.string())),
            ("doc_wide", pa.bool_()),
        ]
    )
    rows = pick(docs, "doc_id", "text")
    rows = rows.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
    return mapped(rows,
        run,
        "doc_id long, text_key long, hash long, doc_pos long, doc_slots array<string>, "
        "doc_wide boolean",
    )


def leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE
) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, changed): items that a document's text contains.

    Texts become templates: numbers, units after numbers and capitalised words
    inside sentences turn into typed placeholders, everything else into lower
    case. In a wide template beside it, capitalised words that start sentences
    are names too, but for ``STARTERS``, names of several words are one slot,
    and units need no number. Windows of like templates are joined by hash. Along a diagonal (document minus item
    position) a slot of the item must always have the same value in the
    document, and different names must stay different; other diagonals are
    dropped. An item leaks where the diagonals of one place hold at least
    ``coverage`` of its windows. ``changed`` tells that slots have other values.

    Null and empty texts and items match nothing. Repeated rows of ``docs``
    give one row; null ids are kept as ids. Other columns are ignored.
    """
    known = staged(benchmark_windows(items, window), "benchmark-windows")
    sizes = [r[0] for r in known.select("size").distinct().orderBy("size").collect()]
    wanted = None
    if known.select("hash").distinct().count() <= SENT_HASHES:
        rows = known.select("hash").distinct().toPandas()
        wanted = np.sort(rows["hash"].to_numpy("<i8"))
    found = document_windows(docs, sizes, wanted, window).withColumnRenamed("doc_wide", "wide")
    found = found.join(known, ["hash", "wide"])
    # What is no slot in the document matched by its text.
    pairs = F.zip_with(
        "item_slots",
        "doc_slots",
        lambda a, b: F.struct(a.alias("a"), F.when(b == "", a).otherwise(b).alias("b")),
    )
    found = found.select(
        "doc_id",
        "text_key",
        "item_id",
        "total",
        "item_pos",
        (F.col("doc_pos") - F.col("item_pos")).alias("diagonal"),
        F.filter(pairs, lambda p: p["a"] != "").alias("pairs"),
        "wide",
    )
    # Each template by itself: more slots may contradict each other where as
    # words they do no harm.
    where = ["doc_id", "text_key", "item_id", "total", "wide"]
    lines = found.groupBy(*where, "diagonal").agg(
        F.collect_set("item_pos").alias("positions"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    old = F.array_distinct(F.transform("pairs", lambda p: p["a"]))
    names = F.filter("pairs", lambda p: p["a"].startswith("n"))
    new_names = F.array_distinct(F.transform(names, lambda p: p["b"]))
    lines = lines.where((F.size(old) == F.size("pairs")) & (F.size(new_names) == F.size(names)))
    # Bands overlap by half, so that any place of half a band's width is in one of them.
    places = F.array(
        *[F.floor((F.col("diagonal") + shift) / BAND) * 2 + k for k, shift in enumerate((0, BAND // 2))]
    )
    placed = lines.withColumn("place", F.explode(places))
    share = F.size(F.array_distinct(F.flatten(F.collect_set("positions")))) / F.col("total")
    changed = F.max(F.exists("pairs", lambda p: p["a"] != p["b"]))
    best = placed.groupBy(*where, "place").agg(share.alias("coverage"), changed.alias("changed"))
    best = best.where(F.col("coverage") >= coverage)
    return best.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("coverage").alias("coverage"), F.min("changed").alias("changed")
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item; all columns as they are."""
    found = leaks(docs, items).select(
        F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")
    )
    found = staged(found.distinct(), "leaks")
    rows = packed(docs, "doc_id", "text")
    rows = rows.select("doc", F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    same = F.col("id").eqNullSafe(F.col("leak_id")) & (F.col("key") == F.col("leak_key"))
    return unpacked(rows.join(found, same, "left_anti"), docs)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "changed")
