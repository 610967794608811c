"""Line dedup: three-line windows that occur before are cut out. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import pick, staged, table, text_key

LINES = 3
# White space that a line is trimmed of before it is compared.
TRIM = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    """The lines with a character other than white space: struct(pos, line), trimmed."""
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda line, pos: F.struct(pos.alias("pos"), F.btrim(line, F.lit(TRIM)).alias("line")),
    )
    return F.filter(lines, lambda x: x["line"] != "")


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, text_key, a, b, first, last): every window of consecutive lines that are not blank.

    ``a`` and ``b`` are two 64-bit hashes of its lines, ``first`` and ``last``
    the positions of its first and last line among all lines of the text.
    """
    held = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
        _lines(F.col("text")).alias("lines"),
    ).where(F.size("lines") >= lines)

    def window(k: Column) -> Column:
        own = [F.col("lines")[k + n] for n in range(lines)]
        texts = [x["line"] for x in own]
        return F.struct(
            F.xxhash64(*texts).alias("a"),
            F.xxhash64(F.lit(lines), *reversed(texts)).alias("b"),
            own[0]["pos"].alias("first"),
            own[-1]["pos"].alias("last"),
        )

    starts = F.sequence(F.lit(0), F.size("lines") - lines)
    return held.select("doc_id", "text_key", F.inline(F.transform(starts, window)))


def repeated_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, text_key, positions): lines covered by a window that occurs before.

    The first occurrence is that of the smallest (doc_id, text_key, position),
    null ids first. It is found as a partial minimum, so a window of very many
    occurrences sends one row a task; only windows that occur again are joined.
    """
    found = windows(docs, lines)
    place = F.struct("doc_id", "text_key", "first")
    first = found.groupBy("a", "b").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
    first = first.where("n > 1").select(F.col("a").alias("x"), F.col("b").alias("y"), "origin")
    # Both sides get an exchange of their own, so Spark may split a hot window.
    first = staged(first, "windows")
    later = found.join(first, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")))
    later = later.where(~place.eqNullSafe(F.col("origin")))
    covered = F.explode(F.sequence("first", "last")).alias("pos")
    # At most as many positions as the text has lines.
    return (
        later.select("doc_id", "text_key", covered)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("positions"))
    )


def without_repeated_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every row of ``docs`` (doc_id, text).

    Lines are compared trimmed, and blank ones do not count, so a window may
    span blank lines, which go with it. Every occurrence of a window but the
    first is cut: the covered positions of all its windows together. Windows
    that overlap their own first occurrence (a line repeated over and over)
    are later occurrences too. Texts of fewer than three such lines stay as
    they are, as do texts of nothing but white space. A null text stays null
    and has 0 lines. Rows that repeat both id and text are one occurrence, so
    both keep it. Other columns of ``docs`` are ignored.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = rows.withColumn("text_key", text_key())
    gone = repeated_lines(rows, lines).select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "positions"
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    joined = keyed.join(gone, same, "left")
    split = F.split("text", "\n", -1)
    # array_except works by a hash set, also for texts of very many lines.
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("positions"))
    text = F.array_join(F.transform(kept, lambda pos: F.col("__lines")[pos]), "\n")
    joined = joined.withColumn("__lines", split)
    return joined.select(
        "doc_id",
        F.when(F.col("positions").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_removed"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_lines(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
    SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) - 1 AS pos FROM split
), trimmed AS (
    SELECT doc_id, pos, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
    FROM numbered
), windows AS (
    SELECT doc_id, pos AS head, lead(pos, 2) OVER w AS tail,
        line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS content
    FROM trimmed WHERE line <> ''
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, head) AS nth
    FROM windows WHERE tail IS NOT NULL
), covered AS (
    SELECT DISTINCT doc_id, unnest(generate_series(head, tail)) AS pos FROM later WHERE nth > 1
), kept AS (
    SELECT n.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
        coalesce(string_agg(n.raw, chr(10) ORDER BY n.pos) FILTER (WHERE c.pos IS NULL), '') AS text
    FROM numbered n LEFT JOIN covered c ON n.doc_id = c.doc_id AND n.pos = c.pos
    GROUP BY n.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN k.text END AS text,
    coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
