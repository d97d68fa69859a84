"""Silver tables -> catalog tables and views."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rosterlake.layout import PROVIDERS_NAME, TAXONOMIES_NAME, DirectoryProfile
from rosterlake.sinks.catalog import replace_tables, replace_views


def publish_gold(
    spark: SparkSession,
    silver_folder: str,
    database: str,
    location: str | None = None,
    buckets: int | None = None,
    profile: DirectoryProfile = DirectoryProfile(),
) -> dict[str, tuple[int, int]]:
    """K5, K6, V8: replace both tables, then the views over them."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    sources = {
        "providers": f"{silver_folder}/{PROVIDERS_NAME}",
        "provider_taxonomies": f"{silver_folder}/{TAXONOMIES_NAME}",
    }
    counts = replace_tables(spark, sources, database, buckets)
    replace_views(spark, database, profile)
    return counts
