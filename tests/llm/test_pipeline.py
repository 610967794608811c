import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from faultsift.llm.mixture import mixed
from faultsift.llm.simhash import fingerprint
from faultsift.llm.tokens import END_ID, tokenizer_file
from faultsift.llm.toxicity import toxicity
from tests.llm.builders import documents, no_documents, odd_documents, words

NAMES = ["toxicity", "simhash", "decontamination", "mixing", "tokens"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Toxic texts, copies and leaks among clean ones; and the same with odd or no rows."""
    rng = random.Random(12)
    texts, labels = {}, []
    bench = {k: " ".join(words(rng, 30, 9_000)) for k in range(5)}
    for doc in range(300):
        own = words(rng, rng.randrange(40, 160), 9_000)
        labels.append((doc, 1, int(doc % 10 == 0)))
        if doc % 10 == 0:
            own += ["zblorf", "grumpa"]
        if doc % 17 == 1:
            own.insert(20, bench[doc % 5])
        texts[doc] = " ".join(own)
    for copy in range(300, 330):
        texts[copy] = texts[1 + copy % 3]
    folder = tmp_path_factory.mktemp("sf")
    for name, frame in (
        ("whole", documents(spark, texts)), ("odd", odd_documents(spark)), ("none", no_documents(spark)),
    ):
        frame.write.parquet(f"{folder}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(
            f"{folder}/{name}/labels.parquet"
        )
        spark.createDataFrame(list(bench.items()), "item_id LONG, text STRING").write.parquet(
            f"{folder}/{name}/benchmark.parquet"
        )
    return str(folder), texts, bench


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_stage_equals_brute_force(spark, tables, tmp_path):
    folder, texts, bench = tables
    folder += "/whole"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "tokens":
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        results[name] = docs

    ids = {name: [r.doc_id for r in results[name].select("doc_id").collect()] for name in NAMES}
    whole = spark.read.parquet(f"{folder}/documents.parquet")
    scores = toxicity(whole, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert sorted(ids["toxicity"]) == sorted(r.doc_id for r in scores if not r.predicted)
    assert all(doc % 10 for doc in ids["toxicity"] if doc < 300)

    left = sorted(ids["toxicity"])
    fps = {doc: fingerprint(texts[doc]) for doc in left}
    kept = [d for d in left if not any(e < d and (fps[d] ^ fps[e]).bit_count() <= 3 for e in left)]
    assert sorted(ids["simhash"]) == kept
    clean = [d for d in kept if not any(item in texts[d] for item in bench.values())]
    assert sorted(ids["decontamination"]) == clean and len(clean) < len(kept)

    taken = {r.doc_id: r.taken / r.size for r in mixed(results["decontamination"]).collect()}
    for doc, ratio in taken.items():
        assert int(ratio) <= ids["mixing"].count(doc) <= int(ratio) + 1
    assert set(ids["mixing"]) <= set(clean)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file()[0])
    start = 0
    for r in sorted(results["tokens"].collect(), key=lambda r: r.start):
        own = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, END_ID]
        assert (r.start, r.n_tokens) == (start, len(own))
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    assert sorted(ids["tokens"]) == sorted(ids["mixing"])
    got = corpus_pipeline.run(spark, folder)
    assert sorted(got.collect()) == sorted(results["tokens"].collect())


@pytest.mark.parametrize("name", ["odd", "none"])
def test_odd_and_empty_tables(spark, tables, name):
    folder = f"{tables[0]}/{name}"
    got = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in got}
    assert ids >= {1, 4, 6, 7, None} - {None} if name == "odd" else not got
