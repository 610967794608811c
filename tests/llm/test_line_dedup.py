import random

from faultsift.llm.linedup import without_repeated_lines
from tests.llm.builders import documents, no_documents, odd_documents

TRIM = " \t\x0b\x0c\r"


def brute(texts, size=3):
    """Every later occurrence of a window of lines, over all texts in order."""
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        lines = text.split("\n")
        held = [(k, x.strip(TRIM)) for k, x in enumerate(lines) if x.strip(TRIM)]
        gone = set()
        for k in range(len(held) - size + 1):
            key = tuple(x for _, x in held[k : k + size])
            if key in seen:
                gone.update(range(held[k][0], held[k + size - 1][0] + 1))
            seen.add(key)
        out[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)
    return out


def found(frame):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in without_repeated_lines(frame).collect()}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    pool = [f"line {k}" for k in range(25)] + ["", "  ", " line 3 "]
    texts = {
        doc: "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14))) for doc in range(120)
    }
    texts |= {doc: texts[0] for doc in range(200, 260)}
    assert found(documents(spark, texts)) == brute(texts)


def test_passages_across_documents_go_and_others_stay(spark):
    shared = "one two three\nfour five six\nseven eight nine\nten"
    texts = {
        1: f"a start\n{shared}\nan end", 2: f"{shared}", 3: "only here\nand here\nand there",
        4: "one two three\nfour five six", 5: f"x\n\n{shared}\ny",
    }
    result = found(documents(spark, texts))
    assert result[1][0] == texts[1] and result[3][0] == texts[3] and result[4][0] == texts[4]
    assert result[2] == ("", 4, 4)
    assert result[5] == ("x\n\ny", 7, 4)


def test_a_line_over_and_over(spark):
    result = found(documents(spark, {1: "\n".join(["again"] * 5)}))
    assert result[1] == ("again", 5, 4)


def test_odd_rows(spark):
    rows = without_repeated_lines(odd_documents(spark))
    assert rows.columns == ["doc_id", "text", "n_lines", "n_removed"]
    got = rows.collect()
    assert len(got) == 10
    assert {(r.doc_id, r.n_lines, r.text is None) for r in got if r.doc_id in (1, 2)} == {
        (1, 0, True), (2, 1, False)
    }
    assert sum(r.n_removed for r in got) == 0
    assert without_repeated_lines(no_documents(spark)).collect() == []


def test_repeated_rows_keep_their_first_occurrence(spark):
    frame = documents(spark, {1: "a\nb\nc"})
    got = without_repeated_lines(frame.union(frame)).collect()
    assert [r.text for r in got] == ["a\nb\nc"] * 2
