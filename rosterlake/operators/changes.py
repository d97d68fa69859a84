"""Comparison of two Silver snapshots as aggregate counts.

Absence from a file proves nothing about a provider, so the measures speak of providers that
are newly observed or not observed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import (
    clean_key,
    differs,
    differs_or_missing,
    has_text,
    strip_tidy,
)
from rosterlake.layout import (
    CHANGE_MEASURES,
    COMPARED_PROVIDER_COLUMNS,
    COMPARED_TAXONOMY_COLUMNS,
    DEACTIVATED,
)
from rosterlake.operators.contracts import require_columns

KEY_PROBLEM = "SNAPSHOT_KEYS_UNUSABLE"


def compared_providers(frame: DataFrame, label: str = "The provider snapshot") -> DataFrame:
    """P6, V5."""
    require_columns(frame.columns, COMPARED_PROVIDER_COLUMNS, label)
    return frame.select(
        clean_key(F.col("npi")).alias("npi"),
        F.lower(clean_key(F.col("status"))).alias("status"),
        clean_key(F.col("deactivation_date")).alias("deactivation_date"),
        clean_key(F.col("practice_zip")).alias("practice_zip"),
    )


def compared_codes(frame: DataFrame, label: str = "The taxonomy snapshot") -> DataFrame:
    """Usable (provider, code) pairs."""
    require_columns(frame.columns, COMPARED_TAXONOMY_COLUMNS, label)
    return frame.where(has_text(F.col("npi")) & has_text(F.col("taxonomy_code"))).select(
        strip_tidy(F.col("npi")).alias("npi"),
        F.upper(strip_tidy(F.col("taxonomy_code"))).alias("taxonomy_code"),
    )


def known_codes(taxonomies: DataFrame, providers: DataFrame) -> DataFrame:
    """Each provider's distinct codes, for providers of the same snapshot.

    Pairs become distinct before they are shuffled by provider.
    """
    return (
        compared_codes(taxonomies)
        .distinct()
        .join(compared_providers(providers).select("npi").distinct(), "npi", "left_semi")
    )


def newly_observed(old_providers: DataFrame, new_providers: DataFrame) -> DataFrame:
    """Keys of the newer snapshot that the older one does not show."""
    return only_in(new_providers, old_providers)


def not_observed(old_providers: DataFrame, new_providers: DataFrame) -> DataFrame:
    """Keys of the older snapshot that the newer one does not show."""
    return only_in(old_providers, new_providers)


def only_in(here: DataFrame, there: DataFrame) -> DataFrame:
    keys = [compared_providers(side).select("npi").distinct() for side in (here, there)]
    return keys[0].join(keys[1], "npi", "left_anti")


def keyed_side(frame: DataFrame, prefix: str, label: str = "The snapshot") -> DataFrame:
    """One row per key with the number of rows it stands for, attributes prefixed.

    Keys of a usable snapshot are unique, and then this changes no value. It keeps a repeated
    key from multiplying in a join before the key check refuses the snapshot.
    """
    return (
        compared_providers(frame, label)
        .groupBy("npi")
        .agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            *[F.max(n).alias(f"{prefix}_{n}") for n in COMPARED_PROVIDER_COLUMNS[1:]],
        )
    )


def fixed_width(value: Column) -> tuple[Column, Column]:
    """Two longs that are equal for equal texts only: at most 18 digits as number and length, other texts as two hashes.

    Hash aggregation keeps numbers in place, but sorts where it has to keep texts.
    """
    digits = value.rlike(r"\A[0-9]{1,18}\z")
    return (
        F.when(digits, value.try_cast("long")).otherwise(F.xxhash64(value)),
        F.when(digits, F.length(value).cast("long")).when(value.isNotNull(), F.xxhash64(F.lit(1), value)),
    )


def compact_side(frame: DataFrame, prefix: str, label: str = "The snapshot") -> DataFrame:
    """What `keyed_side` returns, as numbers: all that the measures ask of a value.

    Missing values have a NULL `_b`; what else a measure needs to know is a flag.
    """
    rows = compared_providers(frame, label)
    status, place = fixed_width(F.col("status")), fixed_width(F.col("practice_zip"))
    values = {
        "status_a": status[0],
        "status_b": status[1],
        "practice_zip_a": place[0],
        "practice_zip_b": place[1],
        "is_deactivated": F.col("status") == DEACTIVATED,
        "has_deactivation_date": F.col("deactivation_date").isNotNull(),
    }
    narrow = rows.select("npi", *[value.alias(name) for name, value in values.items()])
    return narrow.groupBy("npi").agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"), *[F.max(n).alias(f"{prefix}_{n}") for n in values]
    )


def shared_providers(old_providers: DataFrame, new_providers: DataFrame) -> DataFrame:
    """Providers in both snapshots with old and new attributes side by side."""
    old, new = keyed_side(old_providers, "old"), keyed_side(new_providers, "new")
    return old.join(new, "npi").drop("old_rows", "new_rows")


def _changed(name: str, missing_equal: bool) -> Column:
    compare, sides = differs if missing_equal else differs_or_missing, []
    for prefix in ("old", "new"):
        a, b = F.col(f"{prefix}_{name}_a").alias("a"), F.col(f"{prefix}_{name}_b").alias("b")
        sides.append(F.when(b.isNotNull(), F.struct(a, b)))
    return compare(*sides)


def status_changed(missing_equal: bool = False) -> Column:
    return _changed("status", missing_equal)


def newly_deactivated() -> Column:
    """Deactivated now with a date, and not deactivated before (a missing status is not)."""
    return (
        ~F.col("old_is_deactivated").eqNullSafe(F.lit(True))
        & F.col("new_is_deactivated")
        & F.col("new_has_deactivation_date")
    )


def zip_changed(missing_equal: bool = False) -> Column:
    return _changed("practice_zip", missing_equal)


def shared_attribute_changes(
    old_providers: DataFrame, new_providers: DataFrame, missing_equal: bool = False
) -> DataFrame:
    """The three attribute counts over shared providers."""
    shared = compact_side(old_providers, "old").join(compact_side(new_providers, "new"), "npi")
    return shared.agg(
        F.count_if(status_changed(missing_equal)).alias("deactivation_status_change_count"),
        F.count_if(newly_deactivated()).alias("confirmed_newly_deactivated_count"),
        F.count_if(zip_changed(missing_equal)).alias("primary_zip_change_count"),
    )


def changed_code_sets(old_taxonomies: DataFrame, new_taxonomies: DataFrame) -> DataFrame:
    """Providers whose set of codes is not the same on both sides.

    Sets are never built: a pair seen on one side only makes its provider's sets differ, and a
    provider without pairs has the empty set. Grouping on the pair keeps a provider with very
    many rows spread out.
    """
    pairs = (
        compared_codes(old_taxonomies)
        .withColumn("is_old", F.lit(True))
        .unionByName(compared_codes(new_taxonomies).withColumn("is_old", F.lit(False)))
    )
    return (
        pairs.groupBy("npi", "taxonomy_code")
        .agg(F.bool_and("is_old").alias("old_only"), F.bool_or("is_old").alias("in_old"))
        .where(F.col("old_only") | ~F.col("in_old"))
        .select("npi")
        .distinct()
    )


def compare_snapshots(
    old_providers: DataFrame,
    new_providers: DataFrame,
    old_taxonomies: DataFrame,
    new_taxonomies: DataFrame,
    missing_equal: bool = False,
) -> DataFrame:
    """A10, V6, V7: the eight measures and the key problems of both sides, as one row.

    Each side is reduced to one row per key, which counts the rows it stands for, so repeated
    and missing keys show in the same pass. The joins then use the partitioning and order that
    the grouping left: one shuffle per input. Changed code sets join the older side, since only
    shared providers count; behind the outer join they would need another shuffle.
    """
    old = compact_side(old_providers, "old", "The older snapshot")
    new = compact_side(new_providers, "new", "The newer snapshot")
    codes = changed_code_sets(old_taxonomies, new_taxonomies)
    marked = old.join(codes.withColumn("codes_changed", F.lit(True)), "npi", "left")
    per_key = marked.join(new, "npi", "full_outer")
    keyed = F.col("npi").isNotNull()
    in_old, in_new = F.col("old_rows").isNotNull(), F.col("new_rows").isNotNull()
    shared = keyed & in_old & in_new
    measures = {
        "old_provider_count": keyed & in_old,
        "new_provider_count": keyed & in_new,
        "newly_observed_npi_count": keyed & in_new & ~in_old,
        "not_observed_in_newer_snapshot_count": keyed & in_old & ~in_new,
        "deactivation_status_change_count": shared & status_changed(missing_equal),
        "confirmed_newly_deactivated_count": shared & newly_deactivated(),
        "primary_zip_change_count": shared & zip_changed(missing_equal),
        "taxonomy_set_change_count": shared & F.col("codes_changed"),
        "old_keyless": ~keyed & in_old,
        "new_keyless": ~keyed & in_new,
        "old_repeated": keyed & (F.col("old_rows") > 1),
        "new_repeated": keyed & (F.col("new_rows") > 1),
    }
    return per_key.agg(*[F.count_if(test).alias(name) for name, test in measures.items()])


def change_metrics(
    old_providers: DataFrame,
    new_providers: DataFrame,
    old_taxonomies: DataFrame,
    new_taxonomies: DataFrame,
    missing_equal: bool = False,
) -> DataFrame:
    """A10: the eight measures; evaluating them fails when a snapshot's keys are unusable."""
    row = compare_snapshots(
        old_providers, new_providers, old_taxonomies, new_taxonomies, missing_equal
    )
    problems = ("old_keyless", "new_keyless", "old_repeated", "new_repeated")
    unusable = F.greatest(*problems) > 0
    checked = F.when(unusable, F.raise_error(F.lit(KEY_PROBLEM)).cast("long"))
    return row.select(
        *[checked.otherwise(F.col(name)).alias(name) for name in CHANGE_MEASURES]
    )


def change_measures(metrics: DataFrame) -> DataFrame:
    """R2, K8: one (position, measure, count) row per measure, with display labels."""
    parts = [
        part
        for at, (name, label) in enumerate(CHANGE_MEASURES.items(), start=1)
        for part in (F.lit(at), F.lit(label), F.col(name))
    ]
    return metrics.select(F.stack(F.lit(len(CHANGE_MEASURES)), *parts)).toDF(
        "position", "measure", "count"
    )
