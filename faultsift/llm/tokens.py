"""Token ids in fixed-width bit-packed blocks, written in document order and read back."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultsift.llm.common import importable, mapped, pick, table
from faultsift.session import work_folder

END_ID = 2
# Ids after which a block of whole documents is full.
BLOCK_IDS = 1 << 16
# Ids from one entry of a block's offset table to the next.
STRIDE = 4096
# Documents of a shard, about. A shard is sorted by one task.
SHARD_ROWS = 8192
# Beyond so many shards they grow instead.
MAX_SHARDS = 50_000
# Where null ids are sorted.
NO_ID = -(1 << 63)
# Texts that are encoded together.
TOGETHER = 200
# Distinct words a worker remembers the ids of; then they become the older ones,
# and those that were older are forgotten.
REMEMBERED = 600_000


def bit_width(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids as consecutive fields of ``width`` bits, the least significant bit first."""
    if width in (16, 32):
        return np.asarray(ids).astype(f"<u{width // 8}").tobytes()
    bits = (np.asarray(ids, "<u8")[:, None] >> np.arange(width, dtype="<u8")) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` one on; reads only their bytes."""
    if not count:
        return np.zeros(0, "<u4")
    begin, end = first * width, (first + count) * width
    data = np.frombuffer(packed, np.uint8, (end + 7) // 8 - begin // 8, begin // 8)
    if width == 16:
        return data.view("<u2").astype("<u4")
    if width == 32:
        return data.view("<u4").copy()
    at = begin % 8 + np.arange(count, dtype="<i8") * width
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    field = np.zeros(count, "<u8")
    for k in range((width + 7) // 8 + 1):
        field |= data[(at >> 3) + k].astype("<u8") << np.uint64(8 * k)
    return ((field >> (at & 7).astype("<u8")) & np.uint64((1 << width) - 1)).astype("<u4")


def _words(text: str) -> list[str]:
    """The text split at white space, of any kind that the tokenizer knows.

    Full stops and commas are words of their own where none has a mark beside it.
    """
    if not _GLUED.search(text):
        text = text.replace(".", " . ").replace(",", " , ")
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        # White space to Python only: without it there is nothing to split at.
        return _WHITE.split(text)
    # The tokenizer writes lower case; of ASCII letters nothing else depends on it.
    return (text.lower() if text.isascii() else text).split()


# What a tokenizer file says if its pre-tokens never span white
# space and hold all letters of a run, in lower case and as bytes.
_WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}

WORD_END = "</w>"


def is_wordwise(tokenizer) -> bool:
    """Whether the ids of a text are those of its words one after the other."""
    settings = json.loads(tokenizer.to_str())
    model = settings["model"]
    plain = model["type"] == "BPE" and not model.get("dropout")
    plain = plain and model.get("end_of_word_suffix") == WORD_END
    apart = not any(token["lstrip"] or token["rstrip"] for token in settings["added_tokens"])
    return plain and apart and all(settings[key] == value for key, value in _WORDWISE.items())


class Encoder:
    """Ids of texts by a tokenizer file, remembered by white-space separated word where that may be.

    Of a word-wise tokenizer, words of letters that only carry ASCII marks
    behind them are encoded as letters and marks, letters together, all other
    words one by one. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.wordwise = is_wordwise(self.tokenizer)
        # Whether an id ends a word: it says so in the vocabulary.
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[k for word, k in vocabulary.items() if word.endswith(WORD_END)]] = True
        # Ids are kept in 16 bits where the vocabulary allows.
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind, x.ids).tobytes() for x in found]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one pre-token each, as one text."""
        (made,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(made.ids, self.kind)
        ends = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
        if len(ends) != len(words):
            return self._ids(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: set[str]) -> None:
        known, fresh, tailed, other = self.known, {}, [], []
        for word in words:
            core = word.rstrip(punctuation)
            if not _is_plain(core):
                other.append(word)
                continue
            if core not in known:
                fresh[core] = None
            if len(core) < len(word):
                tailed.append((word, core))
        # The bytes of ASCII letters are themselves to the tokenizer's model.
        tokenize, kind = self.tokenizer.model.tokenize, self.kind
        together = []
        for core in fresh:
            if core.isascii():
                known[core] = array(kind, [token.id for token in tokenize(core.lower())]).tobytes()
            else:
                together.append(core)
        if together:
            known.update(zip(together, self._together(together)))
        for word, core in tailed:
            tail = word[len(core) :]
            if tail not in known:
                known[tail] = self._ids([tail])[0]
            known[word] = known[core] + known[tail]
        if other:
            known.update(zip(other, self._ids(other)))

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        if not self.wordwise:
            for ids in self._ids([text or "" for text in texts]):
                yield np.frombuffer(ids, self.kind)
            return
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        words = [_words(text or "") for text in texts]
        # Each word is looked up once; what is not known yet leaves a gap.
        found = [list(map(known.get, own)) for own in words]
        gaps = [(k, at) for k, own in enumerate(found) for at in _gaps(own)]
        missing = {words[k][at] for k, at in gaps}
        if older:
            again = {word: older[word] for word in missing if word in older}
            known.update(again)
            missing.difference_update(again)
        self._learn(missing)
        for k, at in gaps:
            found[k][at] = known[words[k][at]]
        for own in found:
            yield np.frombuffer(b"".join(own), self.kind)


def _gaps(found: list[bytes | None]) -> list[int]:
    """The places of what is None."""
    places, at = [], -1
    for _ in range(found.count(None)):
        at = found.index(None, at + 1)
        places.append(at)
    return places


def _is_plain(word: str) -> bool:
    """Whether a word is letters that stay letters in lower case, so that it is one pre-token.

    Beyond Cyrillic, what is a letter depends on the version of Unicode.
    """
    if not word.isalpha():
        return False
    if word.isascii():
        return True
    return max(word) <= "\u052f" and "\u0130" not in word and unicodedata.is_normalized("NFC", word)


# A full stop or comma beside another mark, or behind a letter that may become
# one and a mark: there the tokenizer may take more than it as one pre-token.
_MARK = r"[^\w\s]|[\x1c-\x1f_"
_GLUED = re.compile(rf"[.,](?:(?<=(?:{_MARK}İ԰-\U0010ffff]).)|(?={_MARK}]))")
_WHITE = re.compile(r"[^\S\x1c-\x1f]+")

_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder a worker process, whose memory outlives a task."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, remembered] = Encoder(path, remembered)
    return _ENCODERS[path, remembered]


def encoded(
    docs: DataFrame, path: str, end_id: int = END_ID, cuts: tuple = (), remembered: int = REMEMBERED
) -> DataFrame:
    """(doc_id, n, ids, shard): ids of whole texts with the end id, as little-endian integers.

    ``shard`` is the number of ``cuts`` below the id; null ids come first. An id
    of very many rows is a cut several times, and its rows are dealt by their
    ids to the shards between those.
    """
    end = np.array([end_id], "<u2" if end_id < 1 << 16 else "<u4")
    edges = np.array(cuts, "<i8")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                docs, texts = part.column(0), part.column(1).to_pylist()
                own = docs.fill_null(NO_ID).to_numpy()
                shard = np.searchsorted(edges, own)
                made = [np.append(ids, end) for ids in encoder(path, remembered).encode(texts)]
                for k in np.flatnonzero(np.searchsorted(edges, own, "right") > shard + 1).tolist():
                    between = np.searchsorted(edges, own[k], "right") - shard[k] + 1
                    shard[k] += zlib.crc32(made[k].tobytes()) % between
                # 16 bits hold most vocabularies: half the bytes to shuffle.
                yield pa.RecordBatch.from_arrays(
                    [
                        docs,
                        pa.array([len(x) for x in made], pa.int64()),
                        pa.array([_narrow(x) for x in made], pa.binary()),
                        pa.array(shard.astype("<i4")),
                    ],
                    ["doc_id", "n", "ids", "shard"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return mapped(rows, run, "doc_id long, n long, ids binary, shard int")


def _narrow(ids: np.ndarray) -> bytes:
    return ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")


BLOCKS = (
    "shard int, block int, first long, n_ids long, width int, "
    "doc_ids array<long>, doc_starts array<long>, offsets array<long>, packed binary"
)


def blocks(
    docs: DataFrame,
    path: str,
    vocabulary: int,
    end_id: int = END_ID,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The rows of the file format, shard by shard in ascending doc_id order.

    A block holds whole documents up to about 65,536 ids, a longer document
    alone. ``first`` counts the ids of the shard before it, ``doc_starts`` the
    ids of the block before each document, and ``offsets`` the bytes before
    every 4,096th id, so that ids can be read from the middle.
    """
    width = bit_width(vocabulary)
    # Only ids are read for the cuts, not the texts.
    docs = pick(docs, "doc_id", "text")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shards = min(MAX_SHARDS, ids.count() // SHARD_ROWS + 1)
    points = [k / shards for k in range(1, shards)]
    cuts = ()
    if points:
        own = F.coalesce("doc_id", F.lit(NO_ID))
        cut = F.percentile_approx(own, points, max(10_000, 20 * shards))
        cuts = tuple(sorted(ids.agg(cut).first()[0] or ()))
    # The shard is known from the id alone: no second pass over the texts. Each
    # shard goes whole to the task, and file, of its number, and is sorted
    # there, spilling if need be.
    made = encoded(docs, path, end_id, cuts, remembered).repartitionById(len(cuts) + 1, F.col("shard"))
    made = made.sortWithinPartitions("shard", "doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first, held, n_held = None, 0, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, first, held, n_held
            if not held:
                return
            lengths = np.array([count for _, count, _ in held], "<i8")
            if width == 16 and all(len(data) == 2 * count for _, count, data in held):
                packed = b"".join([data for _, _, data in held])
            else:
                packed = pack(np.concatenate([_wide(data, count) for _, count, data in held]), width)
            row = {
                "shard": shard,
                "block": number,
                "first": first,
                "n_ids": n_held,
                "width": width,
                "doc_ids": [doc for doc, _, _ in held],
                "doc_starts": (np.cumsum(lengths) - lengths).tolist(),
                "offsets": (np.arange(0, n_held, STRIDE) * width // 8).tolist(),
                "packed": packed,
            }
            number, first, held, n_held = number + 1, first + n_held, [], 0
            yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            docs, n, ids, own = (batch[c].to_pylist() for c in ("doc_id", "n", "ids", "shard"))
            for doc, count, data, s in zip(docs, n, ids, own):
                if s != shard:
                    yield from flush()
                    shard, number, first = s, 0, 0
                if n_held and n_held + count > BLOCK_IDS:
                    yield from flush()
                held.append((doc, count, data))
                n_held += count
        yield from flush()

    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("first", pa.int64()),
            ("n_ids", pa.int64()),
            ("width", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_starts", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())),
            ("packed", pa.binary()),
        ]
    )
    return mapped(made.select("doc_id", "n", "ids", "shard"), run, BLOCKS)


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str,
    vocabulary: int,
    end_id: int = END_ID,
    remembered: int = REMEMBERED,
) -> None:
    """Writes ``docs`` (doc_id, text) as packed blocks below ``folder``.

    Files are Parquet tables of blocks, so any store that Spark reaches will
    do and a lost task writes its file anew. Ids are packed, so the files are
    not compressed again. Null texts count as empty and have only the end id;
    null ids come first, repeated ids one after the other. ``remembered`` bounds
    the words that a worker keeps the ids of, twice as many at most.
    """
    made = blocks(docs, path, vocabulary, end_id, remembered)
    made.write.option("compression", "none").parquet(folder)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``start``: the ids of all blocks before."""
    rows = spark.read.schema(BLOCKS).parquet(folder)
    sums = rows.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row a shard: at most MAX_SHARDS.
    whole = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select("shard", (F.sum("n").over(whole) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(sums), "shard").select(
        *rows.columns, (F.col("base") + F.col("first")).alias("start")
    )


def read_ids(row, first: int, count: int) -> np.ndarray:
    """``count`` ids of a block from its ``first`` one on, by its offset table."""
    entry = first // STRIDE
    data = memoryview(row["packed"])[row["offsets"][entry] :] if row["offsets"] else b""
    return unpack(data, row["width"], first - entry * STRIDE, count)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document from the files, ids as an array."""
    return _documents(spark, folder, "ids array<long>", pa.list_(pa.int64()), lambda ids: ids.tolist())


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, computed from the files."""
    return _documents(spark, folder, "ids_crc32 long", pa.int64(), zlib.crc32)


def _documents(spark: SparkSession, folder: str, column: str, kind: pa.DataType, of) -> DataFrame:
    importable(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, begins, n_ids, widths, packed, bases = batch.columns
            for k in range(batch.num_rows):
                count = n_ids[k].as_py()
                ids = unpack(packed[k].as_buffer(), widths[k].as_py(), 0, count)
                starts = begins[k].values.to_numpy()
                cuts = [*starts.tolist(), count]
                yield pa.RecordBatch.from_arrays(
                    [
                        docs[k].values,
                        pa.array(starts + bases[k].as_py()),
                        pa.array(np.diff(starts, append=count)),
                        pa.array([of(ids[a:b]) for a, b in zip(cuts, cuts[1:])], kind),
                    ],
                    ["doc_id", "start", "n_tokens", column.split()[0]],
                )

    rows = read_blocks(spark, folder).select(
        "doc_ids", "doc_starts", "n_ids", "width", "packed", "start"
    )
    return mapped(rows, run, f"doc_id long, start long, n_tokens long, {column}")


def tokenizer_file(name: str = "word_bpe_49k.json") -> tuple[str, int]:
    """(path, vocabulary size) of a public tokenizer file."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(name))
    return path, Tokenizer.from_file(path).get_vocab_size()


def token_output(docs: DataFrame, remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``docs``, written to the shared folder and read back."""
    spark = docs.sparkSession
    folder = work_folder(spark, "tokens")
    write_tokens(docs, folder, *tokenizer_file(), remembered=remembered)
    return read_digests(spark, folder)


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))
