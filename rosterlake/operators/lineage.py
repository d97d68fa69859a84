"""The lineage manifest of a finished snapshot: aggregates only, no provider rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.layout import BRONZE_COUNTS, QUALITY_COUNTS


def manifest(
    bronze_reports: DataFrame,
    quality_reports: DataFrame,
    digests: DataFrame,
    run_time: Column,
    revision: str | None = None,
) -> DataFrame:
    """K9: one row per archive of each snapshot label, keys in sorted order.

    Each input has a `snapshot_label`; any number of snapshots joins in one job. Columns of the
    inputs beside the counts: `output_paths` (struct) in the Bronze reports, `sha256` and
    `source_zip_filename` in the digests.
    """
    bronze = bronze_reports.select(
        "snapshot_label",
        "output_paths",
        F.struct(*sorted(BRONZE_COUNTS)).alias("bronze_counts"),
    )
    quality = quality_reports.select(
        "snapshot_label", F.struct(*sorted(QUALITY_COUNTS)).alias("silver_data_quality_counts")
    )
    return (
        bronze.join(quality, "snapshot_label")
        .join(
            digests.select(
                "snapshot_label",
                "source_zip_filename",
                F.col("sha256").alias("source_zip_sha256"),
            ),
            "snapshot_label",
        )
        .select(
            "bronze_counts",
            F.lit(revision).cast("string").alias("git_commit_sha"),
            "output_paths",
            run_time.alias("run_time_utc"),
            "silver_data_quality_counts",
            "snapshot_label",
            "source_zip_filename",
            "source_zip_sha256",
        )
    )
