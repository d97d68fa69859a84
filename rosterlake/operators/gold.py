"""Gold views and aggregate queries, in SQL over two relations.

Each text names its inputs in braces, so the same text serves DataFrames (`relation`) and
catalog tables (`rosterlake.sinks.catalog`). Results are aggregates; none returns provider rows
except the active subset itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rosterlake.layout import ACTIVE, DirectoryProfile

# G1-G4. A view may use the views before it.
VIEWS = {
    "active_primary_care_providers": f"SELECT * FROM {{providers}} WHERE status = '{ACTIVE}'",
    # A missing ZIP is a group of its own.
    "provider_counts_by_zip": """
        SELECT practice_zip, count(*) AS provider_count
        FROM {active_primary_care_providers}
        GROUP BY practice_zip
    """,
    # The semi join keeps (code, provider) pairs from multiplying; the distinct count then
    # aggregates per (code, provider) first, which spreads a code that most providers share.
    "provider_counts_by_taxonomy": """
        SELECT t.taxonomy_code, count(DISTINCT t.npi) AS provider_count
        FROM {provider_taxonomies} t
        LEFT SEMI JOIN {active_primary_care_providers} p ON p.npi = t.npi
        GROUP BY t.taxonomy_code
    """,
    "data_completeness_summary": """
        WITH coded AS (SELECT DISTINCT npi FROM {provider_taxonomies})
        SELECT
            count(*) AS provider_count,
            count_if(p.practice_zip IS NULL OR trim(p.practice_zip) = '')
                AS missing_zip_count,
            count_if(p.practice_address_line_1 IS NULL OR trim(p.practice_address_line_1) = '')
                AS missing_address_line_1_count,
            count_if(p.practice_phone IS NULL OR trim(p.practice_phone) = '')
                AS missing_phone_count,
            count_if(p.enumeration_date IS NULL OR trim(p.enumeration_date) = '')
                AS missing_enumeration_date_count,
            count_if(coded.npi IS NULL) AS missing_taxonomy_count
        FROM {providers} p LEFT JOIN coded ON coded.npi = p.npi
    """,
}

# Q1-Q7.
QUERIES = {
    "active_provider_count": """
        SELECT count(*) AS active_primary_care_provider_count
        FROM {active_primary_care_providers}
    """,
    "specialty_mix": """
        SELECT taxonomy_code, provider_count
        FROM {provider_counts_by_taxonomy}
        WHERE taxonomy_code IN ({cohort_codes})
        ORDER BY taxonomy_code NULLS LAST
    """,
    "zip_footprint": """
        SELECT practice_zip, provider_count
        FROM {provider_counts_by_zip}
        ORDER BY practice_zip NULLS LAST
    """,
    "top_zips": """
        SELECT practice_zip, provider_count
        FROM {provider_counts_by_zip}
        ORDER BY provider_count DESC, practice_zip NULLS LAST
        LIMIT 10
    """,
    "status_mix": """
        SELECT status, count(*) AS provider_count
        FROM {providers}
        GROUP BY status
        ORDER BY status NULLS LAST
    """,
    "field_completeness": """
        SELECT missing_zip_count, missing_phone_count, missing_taxonomy_count
        FROM {data_completeness_summary}
    """,
    "multi_taxonomy_providers": """
        WITH several AS (
            SELECT npi FROM {provider_taxonomies} GROUP BY npi HAVING count(*) > 1
        )
        SELECT count(*) AS providers_with_multiple_taxonomy_assignments FROM several
    """,
}


def code_list(profile: DirectoryProfile) -> str:
    return ", ".join("'" + code.replace("'", "''") + "'" for code in profile.cohort_codes)


def relation(
    name: str,
    providers: DataFrame,
    provider_taxonomies: DataFrame,
    profile: DirectoryProfile = DirectoryProfile(),
) -> DataFrame:
    """The named view or query over two Silver DataFrames."""
    text = (VIEWS | QUERIES)[name].replace("{cohort_codes}", code_list(profile))
    inputs = {"providers": providers, "provider_taxonomies": provider_taxonomies}
    for view in VIEWS:
        if view != name and f"{{{view}}}" in text:
            inputs[view] = relation(view, providers, provider_taxonomies, profile)
    used = {key: frame for key, frame in inputs.items() if f"{{{key}}}" in text}
    return providers.sparkSession.sql(text, **used)
