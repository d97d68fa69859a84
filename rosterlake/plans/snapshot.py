"""One snapshot from archive to manifest."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rosterlake.layout import BRONZE_NAME, DirectoryProfile
from rosterlake.operators.contracts import check_snapshot_label
from rosterlake.plans.bronze import archive_stem, build_bronze
from rosterlake.plans.gold import publish_gold
from rosterlake.plans.manifest import write_manifest
from rosterlake.plans.silver import build_silver


def run_snapshot(
    spark: SparkSession,
    archive: str,
    label: str,
    data_folder: str,
    database: str,
    database_location: str | None = None,
    revision: str | None = None,
    profile: DirectoryProfile = DirectoryProfile(),
) -> str:
    """All four stages in order; the first that fails ends the run. Returns the manifest path."""
    check_snapshot_label(label)
    bronze, silver = f"{data_folder}/bronze/{label}", f"{data_folder}/silver/{label}"
    build_bronze(spark, archive, bronze, profile)
    build_silver(
        spark, f"{bronze}/{BRONZE_NAME.format(stem=archive_stem(archive))}", silver, profile
    )
    publish_gold(spark, silver, database, database_location, profile=profile)
    return write_manifest(
        spark,
        label,
        archive,
        bronze,
        silver,
        database,
        f"{data_folder}/gold/manifests",
        revision,
    )
