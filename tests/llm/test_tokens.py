import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faultsift.llm import tokens
from faultsift.llm.tokens import (
    END_ID,
    Encoder,
    bit_width,
    pack,
    read_blocks,
    read_digests,
    read_ids,
    read_tokens,
    tokenizer_file,
    unpack,
    write_tokens,
)
from tests.llm.builders import ODD, documents, no_documents, odd_documents

PATH, VOCABULARY = tokenizer_file()


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_bit_widths():
    assert [bit_width(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@given(st.integers(1, 32), st.data())
@settings(max_examples=200, deadline=None)
def test_packing_round_trip_and_reading_from_the_middle(width, data):
    ids = data.draw(st.lists(st.integers(0, 2**width - 1), max_size=80))
    packed = pack(np.array(ids, "<u4"), width)
    assert len(packed) == (len(ids) * width + 7) // 8
    first = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - first))
    assert unpack(packed, width, first, count).tolist() == ids[first : first + count]


MARKED = st.lists(
    st.one_of(st.sampled_from([". ", ", ", ".\n", ",\n", "'s", "_", "\u0301", "\u2019", '"', "A", "é"]), st.text(max_size=3)),
    max_size=10,
).map("".join)


@given(st.lists(st.one_of(st.text(max_size=60), MARKED), max_size=8))
@settings(max_examples=300, deadline=None)
def test_ids_by_word_are_those_of_the_tokenizer(texts):
    encoder = Encoder(PATH)
    got = [ids.tolist() for ids in encoder.encode(texts)]
    found = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert got == [x.ids for x in found]


@pytest.mark.parametrize("text", [
    "It's don't I'LL., a.b,c ...,, x.,", "Σίσυφος ΣΑΣ İstanbul ẞ ﬁ Å éa", "<|endoftext|> a<|startoftext|>b",
    "ab cd ef​gh \x1f x\x85y", "日本語 テキスト, ひらがな. 한국어", "12 3.5 １２ Ⅷ ½ a1b2", "́ ́a ,́",
])
def test_ids_of_unusual_texts(whole, text):
    encoder = Encoder(PATH)
    assert next(iter(encoder.encode([text]))).tolist() == whole(text)
    encoder = Encoder(PATH, remembered=1)
    for _ in range(3):
        assert next(iter(encoder.encode([text]))).tolist() == whole(text)


def brute(rows, whole):
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc, text in order:
        ids = [*whole(text), 2]
        out.append((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out, start


def test_files_hold_every_document_in_order(spark, tmp_path, whole, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_ROWS", 20)
    monkeypatch.setattr(tokens, "BLOCK_IDS", 300)
    texts = {k * 7 % 211: f"text number {k}, " * (k % 40) for k in range(200)}
    frame = documents(spark, texts)
    write_tokens(frame, f"{tmp_path}/t", PATH, VOCABULARY)
    got = sorted(read_digests(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    want, total = brute(texts.items(), whole)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    starts = np.cumsum([0, *[r.n_tokens for r in got]])
    assert [r.start for r in got] == starts[:-1].tolist() and starts[-1] == total
    blocks = read_blocks(spark, f"{tmp_path}/t").orderBy("start").collect()
    assert len({b.shard for b in blocks}) > 5 and len(blocks) > 10
    ids = {r.doc_id: r.ids for r in read_tokens(spark, f"{tmp_path}/t").collect()}
    assert ids[7] == [*whole(texts[7]), 2]


def test_ids_from_the_middle_of_a_block(spark, tmp_path, whole):
    text = "one two three four. " * 4_000
    write_tokens(documents(spark, {1: text}), f"{tmp_path}/t", PATH, VOCABULARY)
    block = read_blocks(spark, f"{tmp_path}/t").first()
    ids = whole(text)
    for first, count in ((0, 5), (4095, 3), (9_000, 100), (len(ids), 1)):
        assert read_ids(block, first, count).tolist() == [*ids, 2][first : first + count]


def test_odd_rows(spark, tmp_path, whole):
    write_tokens(odd_documents(spark), f"{tmp_path}/t", PATH, VOCABULARY)
    got = read_digests(spark, f"{tmp_path}/t").collect()
    want, _ = brute([(r[0], r[1]) for r in ODD], whole)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    assert sum(r.start == 0 and r.doc_id is None for r in got) == 1
    write_tokens(no_documents(spark), f"{tmp_path}/none", PATH, VOCABULARY)
    assert read_digests(spark, f"{tmp_path}/none").collect() == []


def other_tokenizer(tmp_path, **changes):
    """The word-wise file with other settings, and one without its normaliser."""
    settings = json.load(open(tokenizer_file()[0]))
    settings.update(changes)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(settings))
    return str(path)


@pytest.mark.parametrize("changes", [{"normalizer": None}, {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}])
def test_any_tokenizer_file_gives_its_own_ids(tmp_path, changes):
    path = other_tokenizer(tmp_path, **changes)
    texts = ["Hello World", "Two  lines\nand tabs\t, don't", "", None, "é É 12 a<|endoftext|>b"]
    plain = Tokenizer.from_file(path)
    got = [ids.tolist() for ids in Encoder(path).encode(texts)]
    assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not Encoder(path).wordwise and Encoder(tokenizer_file()[0]).wordwise


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_all_tokenizer_files(name):
    path, _ = tokenizer_file(name)
    text = "Some Words, in 2 lines.\n And  İstanbul's ﬁne\u3000text… \x1c"
    (got,) = Encoder(path).encode([text])
    assert got.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("hot", [None, 7])
def test_an_id_of_very_many_rows_is_spread(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(tokens, "SHARD_ROWS", 50)
    rows = [(hot, f"text number {n}") for n in range(500)] + [(n, f"other {n}") for n in range(100, 300)] + [(3, "x")]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    write_tokens(frame, str(tmp_path / "t"), *tokenizer_file())
    found = read_blocks(spark, str(tmp_path / "t"))
    sizes = {}
    for row in found.collect():
        sizes[row.shard] = sizes.get(row.shard, 0) + len(row.doc_ids)
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) < 200
    read = read_tokens(spark, str(tmp_path / "t")).collect()
    ids = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda n: (n is not None, n or 0))
    encode = Tokenizer.from_file(tokenizer_file()[0]).encode
    want = sorted((d, [*encode(t, add_special_tokens=False).ids, END_ID]) for d, t in rows if d != hot)
    assert sorted((r.doc_id, r.ids) for r in read if r.doc_id != hot) == want


def test_marks_behind_known_letters_need_no_encoding_of_their_own(whole, monkeypatch):
    """Letters and marks are remembered apart, and what is known is not encoded again."""
    made = Encoder(PATH)
    texts = ["Boom *** été !!", "boom*** Boom!! été*** boom!!"]
    first = next(made.encode(texts[:1]))
    monkeypatch.setattr(made, "_ids", lambda words: pytest.fail(f"encoded again: {words}"))
    assert [first.tolist(), next(made.encode(texts[1:])).tolist()] == [whole(text) for text in texts]
