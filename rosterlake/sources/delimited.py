"""Landed CSV parts as one all-string DataFrame in source order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.errors import MALFORMED, ContractError
from rosterlake.layout import ROW_BITS

_RAW = "_raw_record"


def header_columns(spark: SparkSession, part: str) -> list[str]:
    """S3: column names of one part; no type is inferred."""
    return spark.read.csv(part, header=True, escape='"', multiLine=True).columns


def read_parts(spark: SparkSession, folder: str, landed: DataFrame) -> DataFrame:
    """The records of all landed parts, with their position.

    Parts end at record ends, so records may hold line breaks and parts still parse in
    parallel. A record shorter than the header reads its missing fields as NULL; a longer one
    fails the job. That needs the parser to see all fields, hence no column pruning in it. Records
    of parts end with a line feed; that is named, since detecting it would rewrite line ends within
    fields.
    """
    seen = landed.agg(
        F.min("header").alias("one"), F.max("header").alias("other"), F.min("part").alias("part")
    ).first()
    if seen.one != seen.other:
        raise ContractError("The archives' main files do not share one header")
    names = header_columns(spark, f"{folder}/parts/{seen.part}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("lineSep", "\n")
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        .csv(f"{folder}/parts/*")
    )
    # a part is read by one task in order, which numbers its rows in the low bits
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    part, low = F.shiftleft(part, ROW_BITS), (1 << ROW_BITS) - 1
    # quotes open a field at its start only
    outside_quotes = F.regexp_replace(_RAW, '(^|(?<=,))"[^"]*+(?:""[^"]*+)*+"', "")
    fields = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(","))) + 1
    too_long = F.col(_RAW).isNotNull() & (fields > len(names))
    return (
        rows.withColumn(
            "_source_row", part.bitwiseOR(F.monotonically_increasing_id().bitwiseAND(low))
        )
        .where(F.when(too_long, F.raise_error(F.lit(f"{MALFORMED}: a record has more fields than the header")).cast("boolean")).otherwise(True))
        .drop(_RAW)
    )
