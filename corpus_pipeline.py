"""A corpus from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
it kept; ``run`` writes every result to the shared folder and rereads it. All
stages but the last return the columns of ``documents``. Null, empty, repeated
and very long texts are treated as each operator's docstring says; without
rows every stage returns none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultsift.llm.common import importable, staged, table
from faultsift.llm.leaks import without_leaks
from faultsift.llm.mixture import resampled
from faultsift.llm.simhash import keep_one
from faultsift.llm.tokens import token_output
from faultsift.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    importable(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    importable(spark)
    return keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    importable(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes their words."""
    importable(spark)
    return resampled(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixed documents, and per document what they hold."""
    importable(spark)
    # Workers of a pipeline hold what earlier stages left: fewer words are remembered.
    return token_output(docs, remembered=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_ids),
]

# The classifier, the fingerprints and the tokenizer have no SQL: tests/llm
# compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
