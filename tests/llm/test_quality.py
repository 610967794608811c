import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from faultsift.llm.quality import learn, measured, supervised
from tests.llm.builders import ODD, documents, no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(5)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n,
    )


def shown(row):
    return (
        row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
        row.base_failed,
    )


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = {}
    for doc in range(150):
        n = rng.randrange(0, 60)
        pool = ["a", "b", "c|", "d#", "é", "İ", "\U0001f600", "x y"]
        texts[doc] = "".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\t ", "\x0b"]) for _ in range(n))
    texts[900] = "one two three four five " * 3
    texts[901] = "w " * 9
    texts[902] = "w " * 10
    got = {r.doc_id: shown(r) for r in supervised(documents(spark, texts)).collect()}
    assert got == {doc: base(text) for doc, text in texts.items()}


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeilmnorst") for _ in range(rng.randrange(2, 9))) for _ in range(n)).capitalize() + "."


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(2)
    good = {k: "\n".join(prose(rng, rng.randrange(8, 60)) for _ in range(rng.randrange(2, 6))) for k in range(200)}
    symbols = {300 + k: " ".join(w + "%%%" for w in prose(rng, 80).split()) for k in range(25)}
    tables = {400 + k: " | ".join(prose(rng, 60).split()) for k in range(25)}
    rows = {r.doc_id: r for r in supervised(documents(spark, good | symbols | tables)).collect()}
    assert all(rows[k].kept for k in good)
    assert not any(rows[k].kept for k in symbols | tables)
    assert all(0 <= r.posterior <= 1 for r in rows.values())
    assert not any(r.kept for r in rows.values() if r.base_failed)


def test_rules_that_agree_weigh_more():
    patterns = [((1, 1, 1), 900), ((-1, -1, 1), 90), ((-1, -1, -1), 10), ((0, 0, 1), 5)]
    got = learn(patterns)
    assert got.start > 0
    assert got.odds[0][-1] < -2 and got.odds[1][-1] < -2
    assert all(o[0] == 0 and o[-1] <= 0 <= o[1] for o in got.odds)
    assert learn([]).odds == []


def test_only_native_nodes(spark):
    plan = supervised(documents(spark, ["a b c"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(spark):
    got = supervised(odd_documents(spark)).collect()
    assert sorted(map(shown, got)) == sorted(base(r[1]) for r in ODD)
    assert supervised(no_documents(spark)).collect() == []
    assert measured(no_documents(spark)).count() == 0


@pytest.mark.parametrize("threshold,kept", [(0.0, 3), (1.1, 0)])
def test_threshold(spark, threshold, kept):
    texts = [prose(random.Random(k), 30) for k in range(3)]
    got = supervised(documents(spark, texts), keep=threshold)
    assert got.where(F.col("kept")).count() == kept
