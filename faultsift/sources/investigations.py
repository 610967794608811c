"""Investigation tables and JSON-lines extracts of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.schemas import INVESTIGATION_COLUMNS, INVESTIGATION_JSON, INVESTIGATIONS


def read_investigations(
    spark: SparkSession, path: str, date_column: str | None = None
) -> DataFrame:
    """A parquet table, best partitioned by the date of ``timestamp``."""
    schema = INVESTIGATIONS + (f", {date_column} DATE" if date_column else "")
    return spark.read.schema(schema).parquet(path)


def read_investigation_stream(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """The same table as a file stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(INVESTIGATIONS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_investigation_rows(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines extract, one object per row."""
    return decode_rows(spark.read.schema(INVESTIGATION_JSON).json(path))


def decode_lines(lines: DataFrame, column: str) -> DataFrame:
    """Rows of a table that holds the JSON text of one investigation per row."""
    parsed = lines.select(F.from_json(column, INVESTIGATION_JSON).alias("row"))
    return decode_rows(parsed.select("row.*"))


def decode_rows(raw: DataFrame) -> DataFrame:
    """Typed investigations from the raw JSON shape; what does not convert is NULL."""
    numbers = ("environment_id", "service_id", "endpoint_id")
    typed = {
        **{name: F.col(name).try_cast("bigint") for name in numbers},
        "timestamp": F.try_to_timestamp(F.col("timestamp")),
        "function_ids": F.col("function_ids").try_cast("map<string,bigint>"),
        "exceptions_data": _tuples("exceptions_data", "functions", "array<string>"),
        "exceptions_data_enriched": _tuples("exceptions_data_enriched", "ids", "array<bigint>"),
    }
    return raw.withColumns(typed).select(*INVESTIGATION_COLUMNS)


def _tuples(column: str, second: str, second_type: str) -> Column:
    """Unnamed ``[message, [..]]`` pairs as structs.

    The inner list arrives as JSON text; its items may be quoted numbers.
    """
    return F.transform(
        column,
        lambda pair: F.struct(
            F.get(pair, F.lit(0)).alias("message"),
            F.from_json(F.get(pair, F.lit(1)), "array<string>").try_cast(second_type).alias(second),
        ),
    )
