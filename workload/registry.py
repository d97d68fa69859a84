
from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake import layout as L
from rosterlake.functions import clean_date, clean_npi, clean_zip
from rosterlake.operators import bronze, changes, contracts, gold, silver
from rosterlake.plans import (
    build_bronze,
    build_silver,
    publish_gold,
    report_changes,
    run_snapshot,
)
from rosterlake.plans.silver import write_silver
from rosterlake.session import scratch_folder
from rosterlake.sinks.catalog import gold_query, reconciliation
from rosterlake.sinks.files import write_table
from rosterlake.sources.archives import archive_members, file_digests, is_main_member
from workload.archives import write_archives, write_documents
from workload.records import directory_records, once, release

Query = Callable[[SparkSession, str], DataFrame]


def plain_name(name: str) -> str:
    """A source column's name without blanks and punctuation."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def plainly_named(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[plain_name(name) for name in frame.columns])


# --- Bronze and Silver --------------------------------------------------------------------


def bronze_state_filter(spark, sf_dir):
    kept = bronze.bronze_records(directory_records(spark, sf_dir))
    return plainly_named(kept)


def conform_fields(spark, sf_dir):
    conformed = silver.conform(directory_records(spark, sf_dir))
    return plainly_named(conformed)


def _normalized(column: str, source: str, function) -> Query:
    """Raw and normalised values of one field with their number of rows."""

    def query(spark, sf_dir):
        raw = bronze.quoted(source)
        return (
            directory_records(spark, sf_dir)
            .groupBy(raw.alias("raw"), function(raw).alias(column))
            .agg(F.count(F.lit(1)).alias("records"))
        )

    return query


def derive_status(spark, sf_dir):
    return silver.conform(directory_records(spark, sf_dir)).select(
        F.col("_source_row").alias("source_row"), "deactivation_date", "reactivation_date", "status"
    )


def slots_to_rows(spark, sf_dir):
    rows = silver.slot_rows(silver.valid_individuals(directory_records(spark, sf_dir)))
    return plainly_named(rows)


def first_taxonomy_per_key(spark, sf_dir):
    valid = silver.valid_individuals(directory_records(spark, sf_dir))
    return silver.first_per_code(silver.slot_rows(valid))


def cohort_members(spark, sf_dir):
    return silver.cohort_records(directory_records(spark, sf_dir)).select(
        "npi", F.col("_source_row").alias("source_row")
    )


def silver_providers(spark, sf_dir):
    return silver.silver_providers(directory_records(spark, sf_dir))


def silver_taxonomies(spark, sf_dir):
    return silver.ordered_taxonomies(silver.silver_taxonomies(directory_records(spark, sf_dir)))


def dq_metrics(spark, sf_dir):
    return silver.quality_metrics(directory_records(spark, sf_dir))


def records_without_taxonomy(spark, sf_dir):
    return silver.records_without_taxonomy(directory_records(spark, sf_dir))


def key_violations(spark, sf_dir):
    return contracts.key_violations(silver.conform(directory_records(spark, sf_dir)))


# --- Gold ---------------------------------------------------------------------------------


def write_silver_tables(spark, sf_dir, name) -> str:
    """Silver tables of all records or of one release, as the pipeline stores them."""
    folder = scratch_folder(spark, "silver")
    records = directory_records(spark, sf_dir)
    write_silver(spark, records if name == "all" else release(records, name), folder)
    return folder


def _silver(spark, sf_dir, name="all"):
    folder = once(write_silver_tables, spark, sf_dir, name)
    return (
        spark.read.parquet(f"{folder}/{L.PROVIDERS_NAME}"),
        spark.read.parquet(f"{folder}/{L.TAXONOMIES_NAME}"),
    )


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: gold.relation(name, *_silver(spark, sf_dir))


# --- Snapshot comparison ------------------------------------------------------------------


def _snapshots(spark, sf_dir):
    """(old providers, new providers, old taxonomies, new taxonomies)."""
    older, newer = (_silver(spark, sf_dir, name) for name in ("older", "newer"))
    return older[0], newer[0], older[1], newer[1]


def newly_observed(spark, sf_dir):
    return changes.newly_observed(*_snapshots(spark, sf_dir)[:2])


def not_observed(spark, sf_dir):
    return changes.not_observed(*_snapshots(spark, sf_dir)[:2])


def shared_attributes(spark, sf_dir):
    return changes.shared_providers(*_snapshots(spark, sf_dir)[:2])


def _attribute_changes(missing_equal: bool) -> Query:
    return lambda spark, sf_dir: changes.shared_attribute_changes(
        *_snapshots(spark, sf_dir)[:2], missing_equal
    )


def known_codes(spark, sf_dir):
    old_providers, _, old_taxonomies, new_taxonomies = _snapshots(spark, sf_dir)
    return changes.known_codes(old_taxonomies.unionByName(new_taxonomies), old_providers)


def taxonomy_set_changes(spark, sf_dir):
    old_providers, new_providers, *taxonomies = _snapshots(spark, sf_dir)
    shared = changes.shared_providers(old_providers, new_providers).select("npi")
    return changes.changed_code_sets(*taxonomies).join(shared, "npi", "left_semi")


def change_metrics(spark, sf_dir):
    return changes.change_metrics(*_snapshots(spark, sf_dir))


def change_metrics_missing_equal(spark, sf_dir):
    return changes.change_metrics(*_snapshots(spark, sf_dir), missing_equal=True)


def change_measures_long(spark, sf_dir):
    return changes.change_measures(change_metrics(spark, sf_dir))


def change_report(spark, sf_dir):
    """The written JSON report, with its time's format checked."""
    folder = scratch_folder(spark, "changes")
    paths = [
        f"{once(write_silver_tables, spark, sf_dir, name)}/{table}"
        for table in (L.PROVIDERS_NAME, L.TAXONOMIES_NAME)
        for name in ("older", "newer")
    ]
    report_changes(spark, *paths, folder)
    is_utc = F.col("run_time_utc").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?\+00:00$")
    return spark.read.json(f"{folder}/{L.CHANGE_REPORT_NAME}").withColumn("run_time_utc", is_utc)


# --- Archives, catalog and lineage --------------------------------------------------------

def archive_main_members(spark, sf_dir):
    members = archive_members(spark, once(write_archives, spark, sf_dir))
    return members.select(
        F.substring_index("archive", "/", -1).alias("archive"),
        "member",
        is_main_member().alias("is_main"),
    )


def bronze_from_archive(spark, sf_dir):
    """All archives in one run; each record's text must survive the trip."""
    folder = scratch_folder(spark, "ingest")
    report = build_bronze(spark, f"{once(write_archives, spark, sf_dir)}/*.zip", folder)
    return plainly_named(spark.read.parquet(f"{folder}/{report['output_filename']}").drop(*L.POSITION))


def file_hashes(spark, sf_dir):
    digests = file_digests(spark, once(write_documents, spark, sf_dir))
    number = F.regexp_extract("path", r"doc_id=(\d+)\.", 1)
    return digests.select(number.cast("long").alias("doc_id"), "sha256")


def _published(spark, sf_dir) -> str:
    """Bronze table -> Silver tables -> catalog; returns the database and the Silver folder."""
    folder = scratch_folder(spark, "gold")
    kept = bronze.bronze_records(directory_records(spark, sf_dir))
    write_table(kept, f"{folder}/bronze")
    build_silver(spark, f"{folder}/bronze", f"{folder}/silver")
    database = "gold_" + folder[-12:]
    publish_gold(spark, f"{folder}/silver", database, f"{folder}/warehouse", buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return database, f"{folder}/silver"


def table_reconciliation(spark, sf_dir):
    database, silver = once(_published, spark, sf_dir)
    sources = {"providers": L.PROVIDERS_NAME, "provider_taxonomies": L.TAXONOMIES_NAME}
    return reconciliation(spark, {t: f"{silver}/{name}" for t, name in sources.items()}, database)


def _catalog(name: str) -> Query:
    return lambda spark, sf_dir: gold_query(spark, name, once(_published, spark, sf_dir)[0])


def run_manifest(spark, sf_dir):
    """Monthly archives to manifest for both snapshots; times, paths and digests are left out."""
    zips, folder = once(write_archives, spark, sf_dir), scratch_folder(spark, "run")

    def run(label: str) -> str:
        database = f"run_{label}_{folder[-12:]}"
        return run_snapshot(
            spark, f"{zips}/extract_{label}_*.zip", label, folder, database, f"{folder}/db/{label}"
        )

    with ThreadPoolExecutor() as pool:  # snapshots do not depend on each other
        list(pool.map(run, ("older", "newer")))
    manifests = spark.read.json(f"{folder}/gold/manifests/*.json")
    return manifests.select(
        "snapshot_label",
        "source_zip_filename",
        F.col("source_zip_sha256").rlike("^[0-9a-f]{64}$").alias("has_digest"),
        *[F.col(f"bronze_counts.{n}").alias(f"bronze_{n}") for n in L.BRONZE_COUNTS],
        *[F.col(f"silver_data_quality_counts.{n}").alias(f"silver_{n}") for n in L.QUALITY_COUNTS],
    )


QUERIES: dict[str, Query] = {
    # F1, F2, P1, X2
    "bronze_state_filter": bronze_state_filter,
    # X1-X6, P2
    "conform_fields": conform_fields,
    "normalize_npi": _normalized("npi", L.NPI, clean_npi),
    "normalize_zip": _normalized("zip", L.ZIP, clean_zip),
    "normalize_date": _normalized("day", L.ENUMERATION_DATE, clean_date),
    # P3, X8
    "derive_status": derive_status,
    # R1, U1, F5, P4
    "slots_to_rows": slots_to_rows,
    # W2
    "first_taxonomy_per_key": first_taxonomy_per_key,
    # F6, J2
    "cohort_members": cohort_members,
    # F2-F4, W1, P2, P3
    "silver_providers": silver_providers,
    # J3, O1
    "silver_taxonomies": silver_taxonomies,
    # A9, F11, J4
    "dq_metrics": dq_metrics,
    "records_without_taxonomy": records_without_taxonomy,
    # V6, V7, A11
    "key_violations": key_violations,
    # G1-G4
    "g1_active_providers": _gold("active_primary_care_providers"),
    "g2_counts_by_zip": _gold("provider_counts_by_zip"),
    "g3_counts_by_taxonomy": _gold("provider_counts_by_taxonomy"),
    "g4_completeness_summary": _gold("data_completeness_summary"),
    # Q1-Q7
    "q1_active_count": _gold("active_provider_count"),
    "q2_specialty_mix": _gold("specialty_mix"),
    "q3_zip_footprint": _gold("zip_footprint"),
    "q4_top_zips": _gold("top_zips"),
    "q5_status_mix": _gold("status_mix"),
    "q6_completeness": _gold("field_completeness"),
    "q7_multi_taxonomy": _gold("multi_taxonomy_providers"),
    # J9, U3
    "newly_observed": newly_observed,
    "not_observed": not_observed,
    # J7, U2, P6
    "shared_attributes": shared_attributes,
    "shared_attribute_changes": _attribute_changes(False),
    "shared_attribute_changes_missing_equal": _attribute_changes(True),
    # J6, F9, J8, U4, A7
    "known_codes": known_codes,
    "taxonomy_set_changes": taxonomy_set_changes,
    # A10, R2, K8
    "change_metrics": change_metrics,
    "change_metrics_missing_equal": change_metrics_missing_equal,
    "change_measures_long": change_measures_long,
    # S6, K7, X10
    "change_report": change_report,
    # S1, X11
    "archive_members": archive_main_members,
    # S2-S4, V12, A8, K1, K2
    "bronze_from_archive": bronze_from_archive,
    # S9, X9
    "file_digests": file_hashes,
    # S5, S7, K3-K6, V8, A12
    "table_reconciliation": table_reconciliation,
    "catalog_specialty_mix": _catalog("specialty_mix"),
    "catalog_top_zips": _catalog("top_zips"),
    "catalog_completeness": _catalog("field_completeness"),
    # S8, K9, V9-V11
    "run_manifest": run_manifest,
}
