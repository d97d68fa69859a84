"""Bronze -> Silver: conformed providers, one row per (provider, code), quality counts.

Everything is keyed by the provider number, and any number may hold a large share of the
rows. So each step reduces per key before its shuffle: aggregates instead of windows over
raw rows, and no collected groups.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import (
    clean_key,
    clean_npi,
    clean_text,
    clean_upper,
    day_of,
    has_text,
    is_not,
    npi_of,
    strip_tidy,
    zip_of,
)
from rosterlake.layout import (
    ACTIVE,
    DATE_FIELDS,
    DEACTIVATED,
    ENTITY_TYPE,
    NPI,
    POSITION,
    PROVIDER_FIELDS,
    QUALITY_COUNTS,
    SILVER_INPUT_COLUMNS,
    STATE,
    ZIP,
    DirectoryProfile,
)
from rosterlake.operators.bronze import in_state, quoted
from rosterlake.operators.contracts import require_columns, taxonomy_slots


def check_bronze(bronze: DataFrame) -> None:
    """V3, V4."""
    require_columns(bronze.columns, SILVER_INPUT_COLUMNS, "The Bronze table")
    taxonomy_slots(bronze.columns)


def conformed_field(
    name: str, text: Column, profile: DirectoryProfile = DirectoryProfile()
) -> Column:
    """One Silver provider field from its cleaned text."""
    if name in DATE_FIELDS:
        return day_of(text, profile).cast("string")
    if name == "practice_zip":
        return zip_of(text)
    if name == "practice_state":
        return F.upper(text)
    return text


def conformed(texts: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """Silver fields and status over columns of cleaned text.

    Cleaning stays a projection of its own below this one: fields whose text is looked at
    several times are then cleaned once.
    """
    return texts.withColumns(
        {n: conformed_field(n, F.col(n), profile) for n in PROVIDER_FIELDS}
    ).withColumn("status", status_of(F.col("deactivation_date")))


def status_of(deactivation_date: Column) -> Column:
    """A readable deactivation date makes a provider deactivated, whatever follows it."""
    return F.when(deactivation_date.isNotNull(), DEACTIVATED).otherwise(ACTIVE)


def conform(bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """Every row's Silver fields, before any filter or deduplication."""
    texts = bronze.select(
        *POSITION,
        clean_npi(quoted(NPI)).alias("npi"),
        *[clean_text(quoted(source)).alias(name) for name, source in PROVIDER_FIELDS.items()],
    )
    return conformed(texts, profile)


def valid_individuals(
    bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()
) -> DataFrame:
    """In-state individuals with a usable key, raw columns plus `npi`."""
    return (
        bronze.where(in_state(profile))
        .where(clean_key(quoted(ENTITY_TYPE)) == profile.individual_code)
        .where(npi_of(strip_tidy(quoted(NPI))).isNotNull())
        .withColumn("npi", strip_tidy(quoted(NPI)))
    )


def slot_rows(records: DataFrame) -> DataFrame:
    """One row per populated slot, from a single pass over the records."""
    slots = taxonomy_slots(records.columns)
    pairs = [
        part
        for slot in slots
        for part in (F.lit(slot.number).cast("long"), quoted(slot.code), quoted(slot.switch))
    ]
    return (
        records.select("npi", *POSITION, F.stack(F.lit(len(slots)), *pairs))
        .where(has_text(F.col("col1")))
        .select(
            "npi",
            F.upper(strip_tidy(F.col("col1"))).alias("taxonomy_code"),
            clean_upper(F.col("col2")).alias("primary_taxonomy_flag"),
            F.col("col0").alias("taxonomy_slot"),
            *POSITION,
        )
    )


def first_per_code(rows: DataFrame) -> DataFrame:
    """Per (provider, code) the lowest slot, then the earliest row.

    Grouping on the pair spreads a provider with very many rows, and partial aggregation
    leaves one candidate per pair and task.
    """
    first = F.min(F.struct("taxonomy_slot", *POSITION, "primary_taxonomy_flag"))
    return (
        rows.groupBy("npi", "taxonomy_code")
        .agg(first.alias("first"))
        .select("npi", "taxonomy_code", "first.primary_taxonomy_flag", "first.taxonomy_slot")
    )


def slot_codes(records: DataFrame) -> list[Column]:
    """Each slot's cleaned code as a column `code_n`."""
    return [
        clean_upper(quoted(slot.code)).alias(f"code_{slot.number}")
        for slot in taxonomy_slots(records.columns)
    ]


def any_code(codes: list[Column], test: Callable[[Column], Column]) -> Column:
    """True when at least one code passes the test."""
    return F.coalesce(reduce(or_, [test(code) for code in codes]), F.lit(False))


def in_cohort(profile: DirectoryProfile = DirectoryProfile()) -> Callable[[Column], Column]:
    """an approved code, in whatever slot and primary or not."""
    return lambda code: code.isin(*profile.cohort_codes)


def cohort_records(
    bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()
) -> DataFrame:
    """Every valid record of a cohort provider, with or without a code of its own.

    One semi join; adaptive execution splits a provider that has a large share of the records.
    """
    keys = provider_keys(bronze, profile).where("in_cohort").select("npi")
    return valid_individuals(bronze, profile).join(keys, "npi", "left_semi")


def provider_keys(bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """One narrow row per valid individual: its records, its first row's position, has it a code,
    is it in the cohort. All are fixed-width, so tasks reduce them by hashing."""
    valid = valid_individuals(bronze, profile)
    coded = valid.select("npi", *POSITION, *slot_codes(valid))
    return coded.groupBy("npi").agg(*key_columns(coded, profile))


def key_columns(coded: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> list[Column]:
    """What `provider_keys` aggregates over rows with cleaned codes."""
    codes = [F.col(name) for name in coded.columns if name.startswith("code_")]
    return [
        F.count(F.lit(1)).alias("records"),
        F.min(POSITION[0]).alias("first"),
        F.bool_or(any_code(codes, Column.isNotNull)).alias("has_code"),
        F.bool_or(any_code(codes, in_cohort(profile))).alias("in_cohort"),
    ]


def counted_keys(bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """Provider keys and row counts from one scan: a row per valid individual, and one without a
    key for all other records.

    The counts are further fixed-width sums of the same groups, so the tasks reduce them as they
    reduce the keys, the keyless group too. They are plain rows: a task that runs twice counts once.
    """
    texts = bronze.select(*POSITION, *row_texts(), *slot_codes(bronze))
    valid = (
        (F.upper("state") == profile.state)
        & (F.col("entity") == profile.individual_code)
        & npi_of(F.col("npi")).isNotNull()
    )
    return texts.groupBy(F.when(valid, F.col("npi")).alias("npi")).agg(
        *key_columns(texts, profile), *row_counts(profile)
    )


def silver_providers(
    bronze: DataFrame,
    profile: DirectoryProfile = DirectoryProfile(),
    keys: DataFrame | None = None,
) -> DataFrame:
    """The first source row of each cohort provider, conformed.

    The narrow keys (given by a caller that has them) say which row that is; whole records meet
    them in one join on position, which no provider's records crowd, and are never sorted by
    provider. Entity and state are constants behind the filters. Fields are cleaned on retained
    rows only.
    """
    keys = provider_keys(bronze, profile) if keys is None else keys
    firsts = keys.where("in_cohort").select(F.col("first").alias(POSITION[0]))
    rows = valid_individuals(bronze, profile).join(firsts, POSITION[0], "left_semi")
    known = {
        "entity_type_code": F.lit(profile.individual_code),
        "practice_state": F.lit(profile.state),
    }
    texts = rows.select(
        "npi",
        *[
            known.get(name, clean_text(quoted(source))).alias(name)
            for name, source in PROVIDER_FIELDS.items()
        ],
    )
    return conformed(texts, profile)


def silver_taxonomies(
    bronze: DataFrame,
    profile: DirectoryProfile = DirectoryProfile(),
    keys: DataFrame | None = None,
) -> DataFrame:
    """All codes of the retained providers, approved or not.

    Rows are unique per (provider, code) before the semi join shuffles them by provider. `keys` are
    the provider keys where a caller has them already.
    """
    keys = provider_keys(bronze, profile) if keys is None else keys
    codes = first_per_code(slot_rows(valid_individuals(bronze, profile)))
    return codes.join(keys.where("in_cohort").select("npi"), "npi", "left_semi")


def ordered_taxonomies(taxonomies: DataFrame) -> DataFrame:
    """O1: a range sort on all three columns, so one provider may span files."""
    return taxonomies.orderBy("npi", "taxonomy_slot", "taxonomy_code")


def key_quality(keys: DataFrame) -> DataFrame:
    """J4 and the cohort size, from provider keys."""
    return keys.agg(*key_counts())


def key_counts() -> list[Column]:
    keyed = F.col("npi").isNotNull()
    uncoded = F.sum(F.when(keyed & ~F.col("has_code"), F.col("records")))
    return [
        F.coalesce(uncoded, F.lit(0)).alias("missing_taxonomy_count"),
        F.count_if(keyed & F.col("in_cohort")).alias("primary_care_providers_retained"),
    ]


def records_without_taxonomy(
    bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()
) -> DataFrame:
    """From fixed-width partial aggregates per provider."""
    return key_quality(provider_keys(bronze, profile))


def row_texts() -> list[Column]:
    """The fields that row counts look at, cleaned; a projection of its own cleans each once."""
    sources = {"npi": NPI, "entity": ENTITY_TYPE, "state": STATE, "zip": ZIP}
    sources |= {name: PROVIDER_FIELDS[name] for name in DATE_FIELDS}
    return [clean_key(quoted(source)).alias(name) for name, source in sources.items()]


def row_counts(profile: DirectoryProfile = DirectoryProfile()) -> list[Column]:
    """A9, row part, over the columns of `row_texts`."""
    npi = F.col("npi")
    return [
        F.count(F.lit(1)).alias("input_row_count"),
        F.count_if(F.col("entity") == profile.organization_code).alias(
            "organization_records_excluded"
        ),
        F.count_if(is_not(F.upper("state"), profile.state)).alias(
            "non_massachusetts_records_excluded"
        ),
        F.count_if(npi.isNull()).alias("missing_npi_count"),
        F.count_if(npi.isNotNull() & npi_of(npi).isNull()).alias("invalid_npi_count"),
        *[
            F.count_if(
                F.col(name).isNotNull() & day_of(F.col(name), profile).isNull()
            ).alias(f"invalid_{name}_count")
            for name in DATE_FIELDS
        ],
        F.count_if(zip_of(F.col("zip")).isNull()).alias("missing_zip_count"),
    ]


def row_quality(bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """A9, row part: counts over all Bronze rows, without a shuffle of rows."""
    return bronze.select(*row_texts()).agg(*row_counts(profile))


def quality_metrics(bronze: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """The eleven quality counts as one row, from one narrow scan."""
    return counted_quality(counted_keys(bronze, profile))


def counted_quality(counted: DataFrame) -> DataFrame:
    """The quality counts from `counted_keys`."""
    own = [name for name in QUALITY_COUNTS if name in counted.columns]
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in own]
    return counted.agg(*sums, *key_counts()).select(*QUALITY_COUNTS)
