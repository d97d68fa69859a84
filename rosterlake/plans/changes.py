"""Two Silver snapshots -> aggregate change reports."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rosterlake.errors import SnapshotKeyError
from rosterlake.layout import (
    CHANGE_MEASURES,
    CHANGE_MEASURES_NAME,
    CHANGE_REPORT_NAME,
    COMPARED_PROVIDER_COLUMNS,
    COMPARED_TAXONOMY_COLUMNS,
)
from rosterlake.operators.changes import change_measures, compare_snapshots
from rosterlake.sinks.files import run_time_utc, write_report
from rosterlake.sources.tables import read_snapshot


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def report_changes(
    spark: SparkSession,
    old_providers: str,
    new_providers: str,
    old_taxonomies: str,
    new_taxonomies: str,
    folder: str,
    missing_equal: bool = False,
) -> dict[str, int]:
    """The measures as one JSON object and as labelled rows."""
    providers, taxonomies = COMPARED_PROVIDER_COLUMNS, COMPARED_TAXONOMY_COLUMNS
    row = compare_snapshots(
        read_snapshot(spark, old_providers, providers, "Older providers"),
        read_snapshot(spark, new_providers, providers, "Newer providers"),
        read_snapshot(spark, old_taxonomies, taxonomies, "Older taxonomies"),
        read_snapshot(spark, new_taxonomies, taxonomies, "Newer taxonomies"),
        missing_equal,
    ).first()
    for name, path, keyless, repeated in (
        ("Older providers", old_providers, row.old_keyless, row.old_repeated),
        ("Newer providers", new_providers, row.new_keyless, row.new_repeated),
    ):
        if keyless:
            raise SnapshotKeyError(f"{name} ({path}) has rows without an NPI")
        if repeated:
            raise SnapshotKeyError(f"{name} ({path}) has {repeated} NPIs more than once")
    metrics = {name: row[name] for name in CHANGE_MEASURES}
    frame = spark.range(1).select(*[F.lit(n).alias(name) for name, n in metrics.items()])
    report = frame.select(
        run_time_utc().alias("run_time_utc"),
        F.lit(_name(old_providers)).alias("old_providers_filename"),
        F.lit(_name(new_providers)).alias("new_providers_filename"),
        F.lit(_name(old_taxonomies)).alias("old_taxonomies_filename"),
        F.lit(_name(new_taxonomies)).alias("new_taxonomies_filename"),
        *metrics,
        F.lit(CHANGE_MEASURES_NAME).alias("measures_filename"),
    )
    write_report(report, f"{folder}/{CHANGE_REPORT_NAME}")
    measures = change_measures(frame).orderBy("position")
    write_report(measures, f"{folder}/{CHANGE_MEASURES_NAME}")
    return metrics
