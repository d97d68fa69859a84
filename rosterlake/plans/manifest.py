"""Stage reports + archive -> lineage manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.layout import (
    BRONZE_COUNTS,
    BRONZE_REPORT_NAME,
    PROVIDERS_NAME,
    QUALITY_COUNTS,
    QUALITY_REPORT_NAME,
    TAXONOMIES_NAME,
)
from rosterlake.operators.contracts import check_snapshot_label
from rosterlake.operators.lineage import manifest
from rosterlake.plans.bronze import DIGESTS_NAME, archive_stem
from rosterlake.sinks.files import run_time_utc, write_report
from rosterlake.sources.archives import file_digests
from rosterlake.sources.reports import read_report


def _digests(spark: SparkSession, archive: str, bronze_folder: str) -> DataFrame:
    """Digests that Bronze has taken of the archives while it read them; without such, of the files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{bronze_folder}/{DIGESTS_NAME.format(stem=archive_stem(archive))}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema("path string, sha256 string").json(path.toString())
    return file_digests(spark, archive)


def write_manifest(
    spark: SparkSession,
    label: str,
    archive: str,
    bronze_folder: str,
    silver_folder: str,
    gold_database: str,
    manifest_folder: str,
    revision: str | None = None,
) -> str:
    """S8, S9, V9-V11, K9. `revision` is the code version that the caller ran.

    A run over several archives has one line per archive, each with the run's totals.
    """
    check_snapshot_label(label)
    bronze_report = f"{bronze_folder}/{BRONZE_REPORT_NAME.format(stem=archive_stem(archive))}"
    quality_report = f"{silver_folder}/{QUALITY_REPORT_NAME}"
    labelled = {"snapshot_label": F.lit(label)}
    paths = {
        "bronze_directory": F.lit(bronze_folder),
        "bronze_metadata": F.lit(bronze_report),
        "bronze_parquet": F.concat(F.lit(f"{bronze_folder}/"), F.col("output_filename")),
        "gold_database": F.lit(gold_database),
        "silver_directory": F.lit(silver_folder),
        "silver_provider_taxonomies": F.lit(f"{silver_folder}/{TAXONOMIES_NAME}"),
        "silver_providers": F.lit(f"{silver_folder}/{PROVIDERS_NAME}"),
        "silver_quality_report": F.lit(quality_report),
    }
    bronze = read_report(
        spark, bronze_report, "ingestion report", BRONZE_COUNTS, ["output_filename"]
    ).withColumns(
        labelled
        | {
            "output_paths": F.struct(*[path.alias(name) for name, path in paths.items()]),
        }
    )
    quality = read_report(spark, quality_report, "quality report", QUALITY_COUNTS)
    digests = _digests(spark, archive, bronze_folder)
    zip_name = F.substring_index("path", "/", -1)
    target = f"{manifest_folder}/{label}.json"
    write_report(
        manifest(
            bronze,
            quality.withColumns(labelled),
            digests.withColumns(labelled | {"source_zip_filename": zip_name}),
            run_time_utc(),
            revision,
        ),
        target,
    )
    return target
