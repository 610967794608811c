"""Quality rules as weak supervision. DataFrame functions only.

Rules vote for or against a text, or abstain. Expectation-maximisation over the
vote patterns of all texts estimates how each rule votes on good and on bad
texts, and the posterior probability of good quality decides.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import SPACE, pick, staged, table

LEAST_WORDS = 10
# Percent of the words that may be in repeated windows of five.
MOST_REPEATED = 20
WINDOW = 5
# Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
KEEP = 0.5
ROUNDS = 100
_BLANK = " \t\x0b\x0c\r"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, and only where it is needed."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+", -1), lambda w: w != "")


def _n_repeat_words(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, each once."""

    def covered(pairs: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1)["h"], F.get(pairs, k + 1)["h"]
            no = F.lit(False)
            return F.coalesce(before == x["h"], no) | F.coalesce(after == x["h"], no)

        places = F.transform(
            F.filter(pairs, again), lambda x: F.sequence(x["pos"], x["pos"] + (WINDOW - 1))
        )
        return F.size(F.array_distinct(F.flatten(places)))

    pairs = F.transform(hashes, lambda h, pos: F.struct(h.alias("h"), pos.alias("pos")))
    unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(unique, 0).otherwise(_let(F.array_sort(pairs), covered))


def measured(docs: DataFrame) -> DataFrame:
    """Counts of every row of ``docs`` (doc_id, text), over the whole text.

    n_words, word_chars (their code points), n_symbols, n_dup_lines (lines with
    a word that equal an earlier line), n_repeat_words (words in windows of five
    that occur twice or more), n_lines (with a word), n_ended (of these, with
    a sentence's end), n_upper (capital letters), n_marks (characters that are
    neither letter, digit nor space) and n_spoiled (words with a symbol). Null
    counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = pick(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns(
        {
            "words": words_of(F.col("text")),
            "lines": F.filter(
                F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(_BLANK)) != ""
            ),
        }
    )
    words = F.col("words")
    window = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda k: F.xxhash64(*[words[k + n] for n in range(WINDOW)]),
    )
    hashes = F.when(F.size(words) >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("text", pattern, ""))

    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": left(f"[^{SYMBOLS}]+"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _let(hashes, _n_repeat_words),
        "n_lines": F.size("lines"),
        "n_ended": F.size(F.filter("lines", lambda x: x.rlike(r"[.!?:;…][\"'”’»)\]]*\s*$"))),
        "n_upper": left(r"[^\p{Lu}]+"),
        "n_marks": left(r"[\p{L}\p{N}\p{M}\p{Z}\s]+"),
        "n_spoiled": F.size(F.filter(words, lambda w: w.rlike(f"[{SYMBOLS}]"))),
    }
    return rows.select("doc_id", *[c.cast("long").alias(name) for name, c in counts.items()])


@dataclass(frozen=True)
class Rule:
    """Votes for a text, else against it, else abstains."""

    name: str
    good: Column
    bad: Column

    @property
    def vote(self) -> Column:
        # Null (a share of nothing) abstains.
        return F.when(self.good, 1).when(self.bad, -1).otherwise(0)


def rules() -> list[Rule]:
    """The default rules, over the columns of ``measured``."""
    n = F.col("n_words")

    def share(count: str, of: str) -> Column:
        return F.col(count) / F.nullif(F.col(of), F.lit(0))

    def rule(name: str, value: Column, good: float, bad: float) -> Rule:
        """Small values are good."""
        return Rule(name, value <= good, value >= bad)

    mean = share("word_chars", "n_words")
    return [
        Rule("length", n >= 30, n < LEAST_WORDS),
        Rule("word_length", mean.between(3, 10), (mean < 2.5) | (mean > 14)),
        rule("symbols", share("n_symbols", "n_words"), 0.05, 0.2),
        rule("spoiled_words", share("n_spoiled", "n_words"), 0.05, 0.25),
        rule("marks", share("n_marks", "word_chars"), 0.1, 0.15),
        rule("duplicate_lines", share("n_dup_lines", "n_lines"), 0.1, 0.4),
        rule("repeated_words", share("n_repeat_words", "n_words"), 0.05, 0.2),
        rule("capitals", share("n_upper", "word_chars"), 0.15, 0.4),
        Rule("sentences", share("n_ended", "n_lines") >= 0.5, share("n_ended", "n_lines") < 0.1),
    ]


@dataclass(frozen=True)
class Verdicts:
    """What the rules' votes mean: log odds of good against bad, of each vote and at the start."""

    start: float
    odds: list[dict[int, float]]

    def posterior(self, votes: list[Column]) -> Column:
        total = F.lit(self.start)
        for vote, own in zip(votes, self.odds):
            total = total + F.when(vote == 1, own[1]).when(vote == -1, own[-1]).otherwise(own[0])
        return 1 / (1 + F.exp(-total))


def learn(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> Verdicts:
    """Expectation-maximisation over (votes, number of texts).

    There is an entry for each pattern that occurs, at most 3 to the power of
    the number of rules, however many texts there are. A text starts as good
    unless some rule votes against it. The vote rates of each class are
    smoothed by one text a vote, a rule's vote for a text never counts against
    it, nor the reverse, and abstaining counts for nothing.
    """
    if not patterns:
        return Verdicts(0.0, [])
    n_rules = len(patterns[0][0])
    good = []
    for votes, _ in patterns:
        against = -1 in votes
        good.append(0.02 if against else 0.98)
    prior, rates = 0.5, []
    for _ in range(rounds):
        mass = [
            sum(n * g for (_, n), g in zip(patterns, good)),
            sum(n * (1 - g) for (_, n), g in zip(patterns, good)),
        ]
        prior = (mass[0] + 1) / (sum(mass) + 2)
        rates = []
        for r in range(n_rules):
            own = []
            for side in (0, 1):
                count = {-1: 1.0, 0: 1.0, 1: 1.0}
                for (votes, n), g in zip(patterns, good):
                    count[votes[r]] += n * (1 - g if side else g)
                whole = sum(count.values())
                own.append({v: c / whole for v, c in count.items()})
            odds = {v: math.log(own[0][v] / own[1][v]) for v in (-1, 0, 1)}
            rates.append({-1: min(odds[-1], 0.0), 0: 0.0, 1: max(odds[1], 0.0)})
        start = math.log(prior / (1 - prior))
        good = [
            1 / (1 + math.exp(-max(-60.0, min(60.0, start + sum(o[v] for o, v in zip(rates, votes))))))
            for votes, _ in patterns
        ]
    return Verdicts(math.log(prior / (1 - prior)), rates)


def supervised(docs: DataFrame, own_rules: list[Rule] | None = None, keep: float = KEEP) -> DataFrame:
    """Counts, base_failed, posterior and kept of every row of ``docs`` (doc_id, text).

    base_failed: fewer than ten words, or more than 20 percent of the words in
    windows of five that repeat. Such texts are not kept, and votes are weighed
    over the others, which are kept where the posterior is at least ``keep``. Null texts count as empty. Repeated
    rows count as often as they occur, ids may repeat or be null, and a table
    without rows gives none. Other columns of ``docs`` are ignored.
    """
    used = own_rules or rules()
    counted = staged(measured(docs), "counts")
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
    votes = [F.col(f"vote_{rule.name}") for rule in used]
    voted = counted.withColumns({f"vote_{rule.name}": rule.vote for rule in used})
    patterns = voted.where(~failed).groupBy(*votes).agg(F.count("*").alias("n")).collect()
    patterns = sorted((tuple(row[:-1]), row[-1]) for row in patterns)
    posterior = learn(patterns).posterior(votes)
    return voted.withColumns(
        {"base_failed": failed, "posterior": posterior}
    ).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = supervised(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


OP10_SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT row_id, unnest(range(1, len(words) - 3)) AS pos,
        unnest(list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))) AS content
    FROM split WHERE len(words) >= 5
), again AS (
    SELECT row_id, pos FROM windows
    QUALIFY count(*) OVER (PARTITION BY row_id, content) > 1
), covered AS (
    SELECT row_id, count(DISTINCT place) AS n
    FROM (SELECT row_id, unnest(range(pos, pos + 5)) AS place FROM again) GROUP BY row_id
), counted AS (
    SELECT s.doc_id, s.row_id, len(words) AS n_words,
        length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:;…]["''”’»)\]]*\s*$'))) AS n_ended,
        length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS n_upper,
        length(regexp_replace(text, '[\p{L}\p{N}\p{M}\p{Z}\s]+', '', 'g')) AS n_marks,
        len(list_filter(words, lambda w: regexp_matches(w, '[#*$%&|<>]'))) AS n_spoiled
    FROM split s LEFT JOIN covered c ON s.row_id = c.row_id
), voted AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        [CASE WHEN n_words >= 30 THEN 1 WHEN n_words < 10 THEN -1 ELSE 0 END,
         CASE WHEN word_chars / n_words BETWEEN 3 AND 10 THEN 1
            WHEN word_chars / n_words < 2.5 OR word_chars / n_words > 14 THEN -1 ELSE 0 END,
         CASE WHEN n_symbols / n_words <= 0.05 THEN 1 WHEN n_symbols / n_words >= 0.2 THEN -1 ELSE 0 END,
         CASE WHEN n_spoiled / n_words <= 0.05 THEN 1 WHEN n_spoiled / n_words >= 0.25 THEN -1 ELSE 0 END,
         CASE WHEN n_marks / word_chars <= 0.1 THEN 1 WHEN n_marks / word_chars >= 0.15 THEN -1 ELSE 0 END,
         CASE WHEN n_dup_lines / n_lines <= 0.1 THEN 1 WHEN n_dup_lines / n_lines >= 0.4 THEN -1 ELSE 0 END,
         CASE WHEN n_repeat_words / n_words <= 0.05 THEN 1 WHEN n_repeat_words / n_words >= 0.2 THEN -1 ELSE 0 END,
         CASE WHEN n_upper / word_chars <= 0.15 THEN 1 WHEN n_upper / word_chars >= 0.4 THEN -1 ELSE 0 END,
         CASE WHEN n_ended / n_lines >= 0.5 THEN 1 WHEN n_ended / n_lines < 0.1 THEN -1 ELSE 0 END
        ] AS votes
    FROM counted
), patterns AS (
    SELECT list(votes ORDER BY votes) AS v, list(n ORDER BY votes) AS n, range(1, count(*) + 1) AS each
    FROM (SELECT votes, count(*)::DOUBLE AS n FROM voted WHERE NOT base_failed GROUP BY votes)
), em AS (
    SELECT 0 AS round, 0.0::DOUBLE AS start, NULL::DOUBLE[] AS against, NULL::DOUBLE[] AS in_favour,
        list_transform(v, lambda x: CASE WHEN list_contains(x, -1) THEN 0.02 ELSE 0.98 END::DOUBLE) AS good
    FROM patterns WHERE v IS NOT NULL
    UNION ALL
    SELECT round + 1, start, against, in_favour,
        list_transform(each, lambda i: 1 / (1 + exp(-greatest(-60, least(60, start + list_sum(
            list_transform(range(1, 10), lambda r: CASE v[i][r]
                WHEN -1 THEN against[r] WHEN 1 THEN in_favour[r] ELSE 0 END)))))))
    FROM (
        SELECT round, each, v,
            ln((list_sum(good_n) + 1) / (list_sum(bad_n) + 1)) AS start,
            list_transform(range(1, 10), lambda r: least(0, ln(
                (1 + list_sum(list_transform(each, lambda i: CASE WHEN v[i][r] = -1 THEN good_n[i] ELSE 0 END)))
                / (3 + list_sum(good_n)) / (
                (1 + list_sum(list_transform(each, lambda i: CASE WHEN v[i][r] = -1 THEN bad_n[i] ELSE 0 END)))
                / (3 + list_sum(bad_n)))))) AS against,
            list_transform(range(1, 10), lambda r: greatest(0, ln(
                (1 + list_sum(list_transform(each, lambda i: CASE WHEN v[i][r] = 1 THEN good_n[i] ELSE 0 END)))
                / (3 + list_sum(good_n)) / (
                (1 + list_sum(list_transform(each, lambda i: CASE WHEN v[i][r] = 1 THEN bad_n[i] ELSE 0 END)))
                / (3 + list_sum(bad_n)))))) AS in_favour
        FROM (
            SELECT round, each, v, list_transform(each, lambda i: n[i] * good[i]) AS good_n,
                list_transform(each, lambda i: n[i] * (1 - good[i])) AS bad_n
            FROM em, patterns WHERE round < 100
        )
    )
), weights AS (
    SELECT * FROM em WHERE round = 100
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 1 / (1 + exp(-(coalesce(start, 0) + list_sum(list_transform(range(1, 10), lambda r:
        CASE votes[r] WHEN -1 THEN against[r] WHEN 1 THEN in_favour[r] ELSE 0 END))))) >= 0.5 AS kept
FROM voted LEFT JOIN weights ON true
"""
