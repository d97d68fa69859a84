"""Parquet tables of the pipeline."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.layout import POSITION, ROW_BITS
from rosterlake.operators.contracts import require_columns


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """A Bronze table with the position of each row in its source.

    The Bronze sink stores positions. A table of another tool has none: there, row order is the
    order of numbered files and of rows within a file.
    """
    bronze = spark.read.parquet(path)
    if set(POSITION) <= set(bronze.columns):
        return bronze
    # numbered files: `part-99999-x` comes before `part-100000-x`
    names = sorted((unquote(f.rsplit("/", 1)[-1]) for f in bronze.inputFiles()), key=lambda n: (len(n), n))
    numbers = spark.createDataFrame(list(enumerate(names)), "_number long, _name string")
    placed = bronze.withColumns(
        {"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
    ).join(numbers, F.col("_file") == F.col("_name"))
    position = F.shiftleft("_number", ROW_BITS).bitwiseOR(F.col("_row"))
    return placed.withColumn(POSITION[0], position).drop("_file", "_row", "_number", "_name")


def read_snapshot(
    spark: SparkSession, path: str, required: Iterable[str], label: str
) -> DataFrame:
    """A snapshot table that has the columns a comparison needs."""
    frame = spark.read.parquet(path)
    require_columns(frame.columns, required, f"{label} ({path})")
    return frame


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet path, from its footers."""
    source = spark.read.parquet(path)
    return spark.sql("SELECT count(*) AS n FROM {source}", source=source).first().n
