import random

import pytest

from faultsift.llm import leaks as module
from faultsift.llm.leaks import Templates, leaks, without_leaks
from tests.llm.builders import documents, no_documents, odd_documents, words

ITEMS = "item_id LONG, text STRING"

QUESTION = (
    "A farmer sells 12 kg of apples to Anna and 30 kg of pears to Bob at the market. "
    "If Anna pays 24 dollars, how much does every kilogram of apples cost in the end?"
)
OTHER = (
    "A farmer sells 7 kg of apples to Paula and 18 kg of pears to Igor at the market. "
    "If Paula pays 21 dollars, how much does every kilogram of apples cost in the end?"
)


def items(spark, texts):
    return spark.createDataFrame(list(texts.items()), ITEMS)


def found(spark, texts, bench):
    rows = leaks(documents(spark, texts), items(spark, bench)).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id): r.changed for r in rows}


def tokens(text):
    t = Templates([text])
    kinds = ["", "#", "u", "n"]
    return [kinds[k] + t.data[a:b].tobytes().decode() for a, b, k in zip(t.starts, t.ends, t.kind)]


def test_tokens_and_their_kinds():
    assert tokens("Anna has 3.5 km, five kg; see Bob's 12:30. The End of U. don't") == [
        "anna", "has", "#3.5", "ukm", "#five", "ukg", "see", "nbob's", "#12:30", "the", "nend", "of",
        "u", "don't",
    ]
    assert tokens("run 5km LOUD km été Été “Quoted”\nNext") == [
        "run", "#5", "ukm", "loud", "km", "été", "nété", "nquoted", "next"
    ]


def test_questions_with_other_values_are_caught(spark):
    filler = " ".join(words(random.Random(1), 300))
    mixed = OTHER.replace("If Paula pays", "If Igor pays")
    texts = {
        1: f"{filler} {QUESTION} {filler}", 2: f"{filler}. {OTHER} {filler}",
        3: f"{filler}. {mixed} {filler}", 4: filler, 5: QUESTION.lower().replace(",", " -"),
        6: QUESTION[: len(QUESTION) // 2], 7: QUESTION.upper(),
    }
    got = found(spark, texts, {10: QUESTION, 11: "nothing of the kind is anywhere in these texts"})
    assert got == {(1, 10): False, (2, 10): True, (5, 10): False, (7, 10): False}


def test_slots_must_be_consistent(spark):
    bench = {1: "take 5 red balls and 5 blue balls and put 9 of them into the bag then count"}
    texts = {
        1: "take 8 red balls and 8 blue balls and put 3 of them into the bag then count",
        2: "take 8 red balls and 6 blue balls and put 3 of them into the bag then count",
    }
    assert found(spark, texts, bench) == {(1, 1): True}


def test_bare_numbers_and_short_items(spark):
    bench = {1: "1 2 3 4 5 6 7", 2: "two words", 3: "single", 4: "", 5: None}
    texts = {1: "9 8 7 6 5 4 3 and 2", 2: "these two words match", 3: "a single one", 4: "none"}
    got = found(spark, texts, bench)
    assert set(got) == {(1, 1), (2, 2), (3, 3)}


@pytest.mark.parametrize("sent", [module.SENT_HASHES, 0])
def test_equals_brute_force(spark, monkeypatch, sent):
    """Whole benchmark items within documents, with and without thinning windows out first."""
    monkeypatch.setattr(module, "SENT_HASHES", sent)
    rng = random.Random(6)
    bench = {k: " ".join(words(rng, rng.randrange(8, 60), 5000)) for k in range(30)}
    texts, want = {}, set()
    for doc in range(150):
        parts = [" ".join(words(rng, 50, 5000))]
        for item in rng.sample(sorted(bench), rng.choice([0, 0, 1, 2])):
            parts += [bench[item].upper() if doc % 5 == 0 else bench[item], " ".join(words(rng, 20, 5000))]
            want.add((doc, item))
        texts[doc] = "\n".join(parts)
    assert set(found(spark, texts, bench)) == want
    kept = without_leaks(documents(spark, texts), items(spark, bench))
    assert {r.doc_id for r in kept.collect()} == set(texts) - {doc for doc, _ in want}


def test_odd_rows(spark):
    bench = items(spark, {1: "same words here again", 2: "text without an id"})
    frame = odd_documents(spark)
    got = {(r.doc_id, r.item_id) for r in leaks(frame, bench).collect()}
    assert got == {(4, 1), (5, 1), (None, 2)}
    kept = without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7]
    assert leaks(no_documents(spark), bench).collect() == []
    assert leaks(frame, bench.limit(0)).collect() == []
    assert without_leaks(frame, bench.limit(0)).count() == 10


def test_names_at_the_start_of_sentences(spark):
    bench = {1: "Tom has 5 apples. Tom buys 3 more apples. How many apples does Tom have now?"}
    tom = bench[1]
    texts = {
        1: tom.replace("Tom", "Ana"), 2: tom, 3: tom.upper(),
        4: tom.replace("Tom has", "Ana has").replace("Tom buys", "Eva buys"),
        5: "Then came a line. " + tom.replace("Tom", "Ana"),
    }
    assert found(spark, texts, bench) == {(1, 1): True, (2, 1): False, (3, 1): False, (5, 1): True}


def test_other_words_at_the_start_of_sentences_do_no_harm(spark):
    rest = " ".join(words(random.Random(4), 60, 5000))
    bench = {1: f"Boats {rest}. Boats {rest[::-1]}. Later it ends"}
    texts = {1: bench[1].replace(". Boats", ". Ships"), 2: "What is the way out of the " + rest[:20]}
    assert set(found(spark, texts, bench)) == {(1, 1)}


def test_one_odd_capital_hides_no_other(spark):
    """Capitals of another length in lower case: dotted I, sharp s, Kelvin."""
    for odd in "İẞ\u212a":
        assert tokens(f"see {odd} and then Anna go")[-2:] == ["nanna", "go"]
    texts = {1: f"It is 300 \u212a in İzmir. {OTHER}", 2: f"STRAẞE. {QUESTION}"}
    assert found(spark, texts, {10: QUESTION}) == {(1, 10): True, (2, 10): False}
    assert tokens("STRAẞE") == tokens("straße")


def test_names_of_several_words_and_free_units(spark):
    one = "Last year Tom drove his old car to the lake and Tom came back after 3 hours. How fast did Tom drive in miles per hour on the way?"
    bench = {1: one}
    ann = one.replace("Tom", "Mary Ann")
    texts = {
        1: ann, 2: ann.replace("miles", "kilometers"), 3: one.replace("miles", "kilometers"),
        4: one.replace("Tom", "Jean Paul Roy", 1), 5: f"Mary Ann saw it. {ann}", 6: one,
        7: ann.replace("car", "boat").replace("lake", "town").replace("back", "home").replace("way", "run"),
    }
    got = found(spark, texts, bench)
    # One other word in 28 changes no slot of the narrow template.
    assert got == {(1, 1): True, (2, 1): True, (3, 1): False, (5, 1): True, (6, 1): False}


def reparameterised(rng, n):
    """Questions of words and slots, each as it stands and with other values."""
    names = ["Tom", "Mary Ann", "Igor", "Paula", "Jean Paul", "Li Wei", "Olga", "Ben"]
    units = ["miles", "kilometers", "meters", "pounds", "kilograms", "hours", "minutes", "euros"]
    out = []
    for _ in range(n):
        shape, values = [], []
        for _ in range(rng.randrange(25, 70)):
            kind = rng.random()
            if kind < 0.09:
                shape.append(("#", rng.randrange(2)))
            elif kind < 0.18:
                shape.append(("n", rng.randrange(2)))
            elif kind < 0.22:
                shape.append(("u", rng.randrange(2)))
            else:
                shape.append(("", f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"))
        for _ in range(2):
            number = rng.sample(range(2, 500), 2)
            name, unit = rng.sample(names, 2), rng.sample(units, 2)
            made = {"#": [str(x) for x in number], "n": name, "u": unit}
            values.append(" ".join(x if kind == "" else made[kind][x] for kind, x in shape))
        out.append(tuple(values))
    return out


def test_recall_and_precision_on_questions_with_other_values(spark):
    """500 questions: at least nine in ten are found with other values, and hardly another document."""
    rng = random.Random(21)
    pairs = reparameterised(rng, 500)
    bench = {k: a for k, (a, _) in enumerate(pairs)}
    clean = [a for a, _ in reparameterised(rng, 500)]
    filler = lambda: " ".join(words(rng, 30, 5000))
    texts = {k: f"{filler()}. {b} {filler()}" for k, (_, b) in enumerate(pairs)}
    texts |= {1000 + k: f"{filler()}. {a} {filler()}" for k, a in enumerate(clean)}
    got = set(found(spark, texts, bench))
    assert len(got & {(k, k) for k in range(500)}) >= 450
    assert len(got - {(k, k) for k in range(500)}) <= 2
