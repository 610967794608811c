"""Small tables for the tests of the llm subpackage."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def documents(spark, texts, sources=None):
    """``texts`` is a list, or a dict by id; every row gets a source in turn."""
    pairs = list(texts.items() if isinstance(texts, dict) else enumerate(texts))
    names = sources or ["a", "b", "c"]
    rows = [
        (doc, text, "en", names[k % len(names)], len(text or ""))
        for k, (doc, text) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


# Nulls, empty and blank texts, ties, repeated rows and one very long text.
ODD = [
    (None, "a text without an id", "en", None, None),
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "same words here again", "en", "b", 21),
    (4, "same words here again", "en", "b", 21),
    (4, "another text of that id", "de", "b", 23),
    (5, "same words here again", "fr", None, 21),
    (6, "long " + "word " * 60_000, "en", "c", 300_005),
    (7, "é ß İ     \U0001f600 </s> <|endoftext|> \\ \u0000 x", "en", "c", 30),
]


def odd_documents(spark):
    """With columns whose names the operators use themselves."""
    rows = [(*row, "kept", row[0], 0.5) for row in ODD]
    return spark.createDataFrame(rows, f"{DOCUMENTS}, score STRING, component_id LONG, size DOUBLE")


# Names that operators use, or used, for columns of their own.
OWN_NAMES = [
    "DOC_ID", "Text", "__doc", "__text", "__copy", "__id", "__key", "__copies", "__source", "__doc_id", "__a",
    "__nth", "__again", "__score", "doc", "rest", "c0", "id", "key", "keep_id", "copies", "row", "entry", "nth",
    "again", "component", "fp", "hash", "taken", "bucket", "start",
]


def clashing_documents(spark):
    """The odd rows with columns named like any operator's own, and with names that differ in case."""
    frame = odd_documents(spark)
    rows = [(*row, *[f"{name} {k}" for name in OWN_NAMES]) for k, row in enumerate(frame.collect())]
    own = ", ".join(f"`{name}` STRING" for name in OWN_NAMES)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    return spark.createDataFrame(rows, f"{types}, {own}")


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
