"""Archive -> Bronze table and ingestion report."""

from __future__ import annotations

import re

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from rosterlake.errors import JOB_ERRORS, MALFORMED, MalformedSourceError
from rosterlake.layout import BRONZE_NAME, BRONZE_REPORT_NAME, DirectoryProfile
from rosterlake.operators.bronze import bronze_records, retained_columns
from rosterlake.session import scratch_space
from rosterlake.sinks.files import run_time_utc, write_report, write_table
from rosterlake.sources.archives import land_archives
from rosterlake.sources.delimited import read_parts
from rosterlake.sources.tables import row_count


#: Digests of the archives, taken in the pass that unpacked them; one JSON object an archive.
DIGESTS_NAME = "{stem}_archive_digests.json"


def archive_stem(archive: str) -> str:
    """The name that outputs carry: the archive's without extension, with wildcards as `all`."""
    name = archive.rstrip("/").rsplit("/", 1)[-1]
    return re.sub(r"[*?{}\[\],]+", "all", name.rsplit(".", 1)[0])


def build_bronze(
    spark: SparkSession,
    archive: str,
    folder: str,
    profile: DirectoryProfile = DirectoryProfile(),
    part_bytes: int | None = None,
) -> dict[str, object]:
    """S1-S4, V1, V2, V12, P1, F1, A8, K1, K2. `archive` is one path or a glob.

    The parse counts its input while it writes the kept rows, once and unsorted: their position in
    the source is stored with them. No shuffle stands between the two, so each task's count enters
    the total once, however often tasks are retried. It must be what the cutting of parts counted.
    """
    stem = archive_stem(archive)
    output = BRONZE_NAME.format(stem=stem)
    with scratch_space(spark, "bronze") as scratch:
        try:
            landed = land_archives(spark, archive, scratch, part_bytes)
            source = read_parts(spark, scratch, landed)
            columns = retained_columns(source.columns)
            seen = Observation("source_records")
            counted = source.observe(seen, F.count(F.lit(1)).alias("input_row_count"))
            write_table(bronze_records(counted, profile), f"{folder}/{output}")
        except JOB_ERRORS as error:
            found = re.search(rf"{MALFORMED}: ([\w \-]*)", str(error))
            if found:
                problem = found.group(1).removesuffix(" SQLSTATE")  # which Spark adds
                raise MalformedSourceError(f"{archive}: {problem}") from error
            raise
        digests = landed.where("sha256 IS NOT NULL").select(F.col("archive").alias("path"), "sha256")
        write_report(digests, f"{folder}/{DIGESTS_NAME.format(stem=stem)}")
        cut = landed.agg(F.sum("records")).first()[0]
        if cut != seen.get["input_row_count"]:
            raise MalformedSourceError(
                f"{archive}: {cut} records were found, but {seen.get['input_row_count']} were read"
            )

    metadata = {
        "source_filename": archive.rstrip("/").rsplit("/", 1)[-1],
        "input_row_count": seen.get["input_row_count"],
        "massachusetts_row_count": row_count(spark, f"{folder}/{output}"),
        "output_filename": output,
        "retained_columns": columns,
    }
    report = spark.range(1).select(
        F.lit(metadata["source_filename"]).alias("source_filename"),
        run_time_utc().alias("run_time_utc"),
        F.lit(metadata["input_row_count"]).alias("input_row_count"),
        F.lit(metadata["massachusetts_row_count"]).alias("massachusetts_row_count"),
        F.lit(output).alias("output_filename"),
        F.array(*[F.lit(name) for name in columns]).alias("retained_columns"),
    )
    write_report(report, f"{folder}/{BRONZE_REPORT_NAME.format(stem=stem)}")
    return metadata
