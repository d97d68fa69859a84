"""Bronze table -> Silver tables and quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.layout import (
    PROVIDERS_NAME,
    QUALITY_COUNTS,
    QUALITY_REPORT_NAME,
    TAXONOMIES_NAME,
    DirectoryProfile,
)
from rosterlake.operators.silver import (
    check_bronze,
    counted_keys,
    counted_quality,
    ordered_taxonomies,
    silver_providers,
    silver_taxonomies,
)
from rosterlake.session import scratch_space
from rosterlake.sinks.files import run_time_utc, write_report, write_table
from rosterlake.sources.tables import read_bronze


def write_silver(
    spark: SparkSession,
    bronze: DataFrame,
    folder: str,
    profile: DirectoryProfile = DirectoryProfile(),
) -> dict[str, int]:
    """K3: both Silver tables of a Bronze table with positions; returns the quality counts.

    A narrow pass first writes one row per provider, with the counts over all records, with which
    the wide passes meet the records; adaptive execution picks the joins by the size that was
    written. Bronze is scanned three times.
    """
    with scratch_space(spark, "silver") as scratch:
        write_table(counted_keys(bronze, profile), f"{scratch}/keys")
        counted = spark.read.parquet(f"{scratch}/keys")
        keys = counted.where(F.col("npi").isNotNull())
        counts = counted_quality(counted).first().asDict()
        write_table(silver_providers(bronze, profile, keys), f"{folder}/{PROVIDERS_NAME}")
        taxonomies = silver_taxonomies(bronze, profile, keys)
        write_table(ordered_taxonomies(taxonomies), f"{folder}/{TAXONOMIES_NAME}")
    return counts


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    folder: str,
    profile: DirectoryProfile = DirectoryProfile(),
) -> dict[str, int]:
    """S5, V3, V4, K3, K4."""
    bronze = read_bronze(spark, bronze_path)
    check_bronze(bronze)
    counts = write_silver(spark, bronze, folder, profile)
    report = spark.range(1).select(
        run_time_utc().alias("run_time_utc"),
        *[F.lit(counts[name]).cast("long").alias(name) for name in QUALITY_COUNTS],
        F.lit(PROVIDERS_NAME).alias("providers_output_filename"),
        F.lit(TAXONOMIES_NAME).alias("provider_taxonomies_output_filename"),
    )
    write_report(report, f"{folder}/{QUALITY_REPORT_NAME}")
    return counts
