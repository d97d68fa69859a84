"""Column names, codes and formats of the provider directory, and the run's parameters."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values of the published layout -------------------------------------------------

NPI = "NPI"
ENTITY_TYPE = "Entity Type Code"
REPLACEMENT_NPI = "Replacement NPI"
ORGANIZATION_NAME = "Provider Organization Name (Legal Business Name)"
LAST_NAME = "Provider Last Name (Legal Name)"
FIRST_NAME = "Provider First Name"
MIDDLE_NAME = "Provider Middle Name"
NAME_PREFIX = "Provider Name Prefix Text"
NAME_SUFFIX = "Provider Name Suffix Text"
CREDENTIAL = "Provider Credential Text"
ADDRESS_LINE_1 = "Provider First Line Business Practice Location Address"
ADDRESS_LINE_2 = "Provider Second Line Business Practice Location Address"
CITY = "Provider Business Practice Location Address City Name"
STATE = "Provider Business Practice Location Address State Name"
ZIP = "Provider Business Practice Location Address Postal Code"
COUNTRY = "Provider Business Practice Location Address Country Code (If outside U.S.)"
PHONE = "Provider Business Practice Location Address Telephone Number"
FAX = "Provider Business Practice Location Address Fax Number"
ENUMERATION_DATE = "Provider Enumeration Date"
LAST_UPDATE_DATE = "Last Update Date"
DEACTIVATION_REASON = "NPI Deactivation Reason Code"
DEACTIVATION_DATE = "NPI Deactivation Date"
REACTIVATION_DATE = "NPI Reactivation Date"

SLOT_CODE_PREFIX = "Healthcare Provider Taxonomy Code_"
SLOT_SWITCH_PREFIX = "Healthcare Provider Primary Taxonomy Switch_"

# Silver column -> source column. Silver adds `npi` before and `status` after these.
PROVIDER_FIELDS = {
    "entity_type_code": ENTITY_TYPE,
    "provider_last_name": LAST_NAME,
    "provider_first_name": FIRST_NAME,
    "provider_middle_name": MIDDLE_NAME,
    "provider_name_prefix": NAME_PREFIX,
    "provider_name_suffix": NAME_SUFFIX,
    "provider_credential": CREDENTIAL,
    "practice_address_line_1": ADDRESS_LINE_1,
    "practice_address_line_2": ADDRESS_LINE_2,
    "practice_city": CITY,
    "practice_state": STATE,
    "practice_zip": ZIP,
    "practice_country_code": COUNTRY,
    "practice_phone": PHONE,
    "practice_fax": FAX,
    "enumeration_date": ENUMERATION_DATE,
    "deactivation_reason_code": DEACTIVATION_REASON,
    "deactivation_date": DEACTIVATION_DATE,
    "reactivation_date": REACTIVATION_DATE,
}
DATE_FIELDS = ("enumeration_date", "deactivation_date", "reactivation_date")

# Base columns that a source must have, that Bronze keeps, and that Silver must find.
REQUIRED_SOURCE_COLUMNS = (NPI, ENTITY_TYPE, LAST_NAME, FIRST_NAME, STATE, ZIP)
SILVER_INPUT_COLUMNS = (NPI, *PROVIDER_FIELDS.values())
RETAINED_COLUMNS = (*SILVER_INPUT_COLUMNS, REPLACEMENT_NPI, ORGANIZATION_NAME, LAST_UPDATE_DATE)

COMPARED_PROVIDER_COLUMNS = ("npi", "status", "deactivation_date", "practice_zip")
COMPARED_TAXONOMY_COLUMNS = ("npi", "taxonomy_code")

ACTIVE, DEACTIVATED = "active", "deactivated"

# Main file of an archive: basename prefix, suffix, and the suffix of its header companion.
MAIN_FILE_PREFIX = "npidata_pfile_"
MAIN_FILE_SUFFIX = ".csv"
HEADER_FILE_SUFFIX = "_fileheader.csv"

SNAPSHOT_LABEL_PATTERN = r"^[A-Za-z0-9_-]+$"

BRONZE_COUNTS = ("input_row_count", "massachusetts_row_count")
QUALITY_COUNTS = (
    "input_row_count",
    "organization_records_excluded",
    "non_massachusetts_records_excluded",
    "primary_care_providers_retained",
    "missing_npi_count",
    "invalid_npi_count",
    "invalid_enumeration_date_count",
    "invalid_deactivation_date_count",
    "invalid_reactivation_date_count",
    "missing_zip_count",
    "missing_taxonomy_count",
)

# Change measure -> display label, in report order.
CHANGE_MEASURES = {
    "old_provider_count": "Providers in older snapshot",
    "new_provider_count": "Providers in newer snapshot",
    "newly_observed_npi_count": "Newly observed NPIs",
    "not_observed_in_newer_snapshot_count": "NPIs not observed in newer snapshot",
    "deactivation_status_change_count": "Deactivation-status changes",
    "confirmed_newly_deactivated_count": "Confirmed newly deactivated NPIs",
    "primary_zip_change_count": "Primary ZIP-code changes",
    "taxonomy_set_change_count": "Taxonomy-set changes",
}

# File names inside the stage folders.
BRONZE_NAME = "{stem}_massachusetts.parquet"
BRONZE_REPORT_NAME = "{stem}_massachusetts_metadata.json"
PROVIDERS_NAME = "providers_ma_primary_care.parquet"
TAXONOMIES_NAME = "provider_taxonomies.parquet"
QUALITY_REPORT_NAME = "transform_data_quality_report.json"
CHANGE_REPORT_NAME = "snapshot_change_report.json"
CHANGE_MEASURES_NAME = "snapshot_change_measures.json"

# --- Parameters ---------------------------------------------------------------------------

# The column that gives a row's place in its source; "first" always means first by it. One long
# holds the number of the file, and in its low bits that of the row.
POSITION = ("_source_row",)
ROW_BITS = 33


@dataclass(frozen=True)
class DirectoryProfile:
    """Which records a run keeps and how it reads their values."""

    state: str = "MA"
    individual_code: str = "1"
    organization_code: str = "2"
    cohort_codes: tuple[str, ...] = ("207Q00000X", "207R00000X", "208D00000X", "208000000X")
    # (shape, format): a date is parsed with the first format whose shape fits the text.
    date_formats: tuple[tuple[str, str], ...] = (
        (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    )
    # Nanosecond timestamps cover these days only; others count as unparseable.
    date_bounds: tuple[str, str] = ("1677-09-22", "2262-04-11")
