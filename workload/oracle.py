"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from workload.records import MONTH_EXPRESSION, RECORD_EXPRESSIONS, RELEASE_EXPRESSION
from workload.registry import plain_name

# --- Fixed values of the layout, stated here again so that a slip in the engine's shows ----

FIELDS = {
    "entity_type_code": "Entity Type Code",
    "provider_last_name": "Provider Last Name (Legal Name)",
    "provider_first_name": "Provider First Name",
    "provider_middle_name": "Provider Middle Name",
    "provider_name_prefix": "Provider Name Prefix Text",
    "provider_name_suffix": "Provider Name Suffix Text",
    "provider_credential": "Provider Credential Text",
    "practice_address_line_1": "Provider First Line Business Practice Location Address",
    "practice_address_line_2": "Provider Second Line Business Practice Location Address",
    "practice_city": "Provider Business Practice Location Address City Name",
    "practice_state": "Provider Business Practice Location Address State Name",
    "practice_zip": "Provider Business Practice Location Address Postal Code",
    "practice_country_code": "Provider Business Practice Location Address Country Code (If outside U.S.)",
    "practice_phone": "Provider Business Practice Location Address Telephone Number",
    "practice_fax": "Provider Business Practice Location Address Fax Number",
    "enumeration_date": "Provider Enumeration Date",
    "deactivation_reason_code": "NPI Deactivation Reason Code",
    "deactivation_date": "NPI Deactivation Date",
    "reactivation_date": "NPI Reactivation Date",
}
DATES = ("enumeration_date", "deactivation_date", "reactivation_date")
RETAINED = (
    "NPI",
    "Entity Type Code",
    "Provider Last Name (Legal Name)",
    "Provider First Name",
    "Provider Middle Name",
    "Provider Name Prefix Text",
    "Provider Name Suffix Text",
    "Provider Credential Text",
    "Provider First Line Business Practice Location Address",
    "Provider Second Line Business Practice Location Address",
    "Provider Business Practice Location Address City Name",
    "Provider Business Practice Location Address State Name",
    "Provider Business Practice Location Address Postal Code",
    "Provider Business Practice Location Address Country Code (If outside U.S.)",
    "Provider Business Practice Location Address Telephone Number",
    "Provider Business Practice Location Address Fax Number",
    "Provider Enumeration Date",
    "NPI Deactivation Reason Code",
    "NPI Deactivation Date",
    "NPI Reactivation Date",
    "Replacement NPI",
    "Provider Organization Name (Legal Business Name)",
    "Last Update Date",
)
QUALITY = (
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
MEASURES = {
    "old_provider_count": "Providers in older snapshot",
    "new_provider_count": "Providers in newer snapshot",
    "newly_observed_npi_count": "Newly observed NPIs",
    "not_observed_in_newer_snapshot_count": "NPIs not observed in newer snapshot",
    "deactivation_status_change_count": "Deactivation-status changes",
    "confirmed_newly_deactivated_count": "Confirmed newly deactivated NPIs",
    "primary_zip_change_count": "Primary ZIP-code changes",
    "taxonomy_set_change_count": "Taxonomy-set changes",
}
NPI, ENUMERATION, DEACTIVATION = "NPI", "Provider Enumeration Date", "NPI Deactivation Date"
ZIP = "Provider Business Practice Location Address Postal Code"
STATE = "Provider Business Practice Location Address State Name"
CODE, SWITCH = "Healthcare Provider Taxonomy Code_", "Healthcare Provider Primary Taxonomy Switch_"

COHORT = "('207Q00000X', '207R00000X', '208D00000X', '208000000X')"


def clean(text: str) -> str:
    return f"nullif(trim({text}, ' ' || chr(9) || chr(10) || chr(13) || chr(160)), '')"


def npi(text: str) -> str:
    return f"CASE WHEN regexp_full_match({clean(text)}, '[0-9]{{10}}') THEN {clean(text)} END"


def zip5(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({clean(text)}, '[0-9]{{5}}(-?[0-9]{{4}})?')"
        f" THEN left({clean(text)}, 5) END"
    )


def day(text: str) -> str:
    value = clean(text)
    parsed = f"""coalesce(
        CASE WHEN regexp_full_match({value}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
             THEN try_strptime({value}, '%Y-%m-%d') END,
        CASE WHEN regexp_full_match({value}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}')
             THEN try_strptime({value}, '%m/%d/%Y') END)"""
    return f"""CASE WHEN {parsed} BETWEEN timestamp '1677-09-22' AND timestamp '2262-04-11'
        THEN strftime({parsed}, '%Y-%m-%d') END"""


def _field(name: str) -> str:
    raw = plain_name(FIELDS[name])
    if name in DATES:
        return day(raw)
    if name == "practice_zip":
        return zip5(raw)
    if name == "practice_state":
        return f"upper({clean(raw)})"
    return clean(raw)


_RAW = {plain_name(name): text for name, text in RECORD_EXPRESSIONS.items()}
_NPI, _ZIP = plain_name(NPI), plain_name(ZIP)
_SLOTS = [
    (n, plain_name(f"{CODE}{n}"), plain_name(f"{SWITCH}{n}"))
    for n in (1, 2, 10)
]

RECORDS = f"""records AS (
    SELECT {', '.join(f'{text} AS {name}' for name, text in _RAW.items())},
        o_orderkey AS source_row, {RELEASE_EXPRESSION} AS release, {MONTH_EXPRESSION} AS month
    FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def silver(prefix: str = "", release: str | None = None) -> str:
    """CTEs conf, valid, slots, tax, cohort, prov and ptax, of all records or one release."""
    chosen = f"WHERE release = '{release}'" if release else ""
    fields = ",\n        ".join(f"{_field(name)} AS {name}" for name in FIELDS)
    slots = " UNION ALL ".join(
        f"""SELECT {npi(_NPI)} AS npi, upper({clean(code)}) AS taxonomy_code,
            upper({clean(switch)}) AS primary_taxonomy_flag,
            CAST({n} AS BIGINT) AS taxonomy_slot, source_row
        FROM records {chosen}"""
        for n, code, switch in _SLOTS
    )
    p = prefix
    return f"""{p}conf AS (
        SELECT source_row, {npi(_NPI)} AS npi, {clean(_NPI)} AS raw_npi,
        {fields},
        CASE WHEN {day(plain_name(DEACTIVATION))} IS NULL
             THEN 'active' ELSE 'deactivated' END AS status
        FROM records {chosen}
    ), {p}valid AS (
        SELECT * FROM {p}conf
        WHERE practice_state = 'MA' AND entity_type_code = '1' AND npi IS NOT NULL
    ), {p}slots AS (
        SELECT s.* FROM ({slots}) s
        WHERE s.taxonomy_code IS NOT NULL
          AND s.source_row IN (SELECT source_row FROM {p}valid)
    ), {p}tax AS (
        SELECT npi, taxonomy_code, primary_taxonomy_flag, taxonomy_slot FROM (
            SELECT *, row_number() OVER (
                PARTITION BY npi, taxonomy_code ORDER BY taxonomy_slot, source_row) AS n
            FROM {p}slots) WHERE n = 1
    ), {p}cohort AS (
        SELECT DISTINCT npi FROM {p}tax WHERE taxonomy_code IN {COHORT}
    ), {p}prov AS (
        SELECT npi, {', '.join(FIELDS)}, status FROM (
            SELECT *, row_number() OVER (PARTITION BY npi ORDER BY source_row) AS n
            FROM {p}valid WHERE npi IN (SELECT npi FROM {p}cohort)) WHERE n = 1
    ), {p}ptax AS (
        SELECT * FROM {p}tax WHERE npi IN (SELECT npi FROM {p}cohort)
    )"""


def over_silver(body: str) -> str:
    return f"WITH {RECORDS}, {silver()} {body}"


def over_records(body: str) -> str:
    return f"WITH {RECORDS} {body}"


SNAPSHOTS = f"WITH {RECORDS}, {silver('o_', 'older')}, {silver('n_', 'newer')}"
SHARED = """, shared AS (
    SELECT o.npi, o.status AS old_status, n.status AS new_status,
        o.deactivation_date AS old_deactivation_date,
        n.deactivation_date AS new_deactivation_date,
        o.practice_zip AS old_practice_zip, n.practice_zip AS new_practice_zip
    FROM o_prov o JOIN n_prov n ON o.npi = n.npi
), changed AS (
    SELECT npi FROM shared WHERE npi IN (
        SELECT npi FROM (
            (SELECT npi, taxonomy_code FROM o_ptax EXCEPT SELECT npi, taxonomy_code FROM n_ptax)
            UNION ALL
            (SELECT npi, taxonomy_code FROM n_ptax EXCEPT SELECT npi, taxonomy_code FROM o_ptax)))
)"""


def _attribute_counts(missing_equal: bool) -> str:
    def changed(name: str) -> str:
        if missing_equal:
            return f"old_{name} IS DISTINCT FROM new_{name}"
        return f"coalesce(old_{name} <> new_{name}, true)"

    return f"""
        count(*) FILTER (WHERE {changed('status')}) AS deactivation_status_change_count,
        count(*) FILTER (WHERE old_status IS DISTINCT FROM 'deactivated'
            AND new_status = 'deactivated' AND new_deactivation_date IS NOT NULL)
            AS confirmed_newly_deactivated_count,
        count(*) FILTER (WHERE {changed('practice_zip')}) AS primary_zip_change_count"""


def _change_metrics(missing_equal: bool) -> str:
    return f"""SELECT
        (SELECT count(*) FROM o_prov) AS old_provider_count,
        (SELECT count(*) FROM n_prov) AS new_provider_count,
        (SELECT count(*) FROM n_prov WHERE npi NOT IN (SELECT npi FROM o_prov))
            AS newly_observed_npi_count,
        (SELECT count(*) FROM o_prov WHERE npi NOT IN (SELECT npi FROM n_prov))
            AS not_observed_in_newer_snapshot_count,
        {_attribute_counts(missing_equal)},
        (SELECT count(*) FROM changed) AS taxonomy_set_change_count
        FROM shared"""


def _quality(p: str = "", rows: str = "conf") -> str:
    raw = "records"
    return f"""SELECT
        count(*) AS input_row_count,
        count(*) FILTER (WHERE c.entity_type_code = '2') AS organization_records_excluded,
        count(*) FILTER (WHERE c.practice_state IS DISTINCT FROM 'MA')
            AS non_massachusetts_records_excluded,
        (SELECT count(*) FROM {p}prov) AS primary_care_providers_retained,
        count(*) FILTER (WHERE c.raw_npi IS NULL) AS missing_npi_count,
        count(*) FILTER (WHERE c.raw_npi IS NOT NULL AND c.npi IS NULL) AS invalid_npi_count,
        {', '.join(f'''count(*) FILTER (
            WHERE {clean('r.' + plain_name(FIELDS[n]))} IS NOT NULL AND c.{n} IS NULL)
            AS invalid_{n}_count''' for n in DATES)},
        count(*) FILTER (WHERE c.practice_zip IS NULL) AS missing_zip_count,
        (SELECT count(*) FROM {p}valid WHERE npi NOT IN (SELECT npi FROM {p}tax))
            AS missing_taxonomy_count
        FROM {p}{rows} c JOIN {raw} r ON r.source_row = c.source_row"""


ACTIVE = "(SELECT * FROM prov WHERE status = 'active')"
BY_ZIP = f"(SELECT practice_zip, count(*) AS provider_count FROM {ACTIVE} GROUP BY practice_zip)"
BY_CODE = f"""(SELECT t.taxonomy_code, count(DISTINCT a.npi) AS provider_count
    FROM {ACTIVE} a JOIN ptax t ON a.npi = t.npi GROUP BY t.taxonomy_code)"""


def _missing(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NULL OR trim({column}) = '')"


MISSING_CODE = """count(*) FILTER (
    WHERE NOT EXISTS (SELECT 1 FROM ptax WHERE ptax.npi = prov.npi))"""
TOP_ZIPS = f"""SELECT practice_zip, provider_count FROM {BY_ZIP}
    ORDER BY provider_count DESC, practice_zip ASC NULLS LAST LIMIT 10"""
SPECIALTY_MIX = f"""SELECT taxonomy_code, provider_count FROM {BY_CODE}
    WHERE taxonomy_code IN {COHORT} ORDER BY taxonomy_code"""
COMPLETENESS = f"""SELECT {_missing('practice_zip')} AS missing_zip_count,
    {_missing('practice_phone')} AS missing_phone_count,
    {MISSING_CODE} AS missing_taxonomy_count FROM prov"""


def _normalized(column: str, raw: str, expression: str) -> str:
    return over_records(
        f"SELECT {raw} AS raw, {expression} AS {column}, count(*) AS records"
        f" FROM records GROUP BY ALL"
    )


def _retained() -> list[str]:
    return [
        plain_name(name)
        for name in RECORD_EXPRESSIONS
        if name in RETAINED or name.startswith((CODE, SWITCH))
    ]


def _bronze(extra: str = "") -> str:
    return over_records(
        f"SELECT {', '.join(_retained())}{extra} FROM records"
        f" WHERE upper({clean(plain_name(STATE))}) = 'MA'"
    )


def _manifest() -> str:
    parts = []
    for label, p in (("older", "o_"), ("newer", "n_")):
        # Silver reads Bronze, which holds in-state rows only.
        quality = _quality(p, "bronze")
        parts.append(f"""SELECT '{label}' AS snapshot_label, source_zip_filename, true AS has_digest,
            (SELECT count(*) FROM records WHERE release = '{label}') AS bronze_input_row_count,
            q.input_row_count AS bronze_massachusetts_row_count,
            {', '.join(f'q.{name} AS silver_{name}' for name in QUALITY)}
            FROM ({quality}) q, (SELECT DISTINCT concat('extract_', release, '_', month, '.zip')
                AS source_zip_filename FROM records WHERE release = '{label}')""")
    bronze = ", ".join(
        f"{p}bronze AS (SELECT * FROM {p}conf WHERE practice_state = 'MA')" for p in ("o_", "n_")
    )
    return f"{SNAPSHOTS}, {bronze} {' UNION ALL '.join(parts)}"


CHANGE_ROWS = " UNION ALL ".join(
    f"SELECT {at} AS position, '{label}' AS measure, {name} AS count FROM m"
    for at, (name, label) in enumerate(MEASURES.items(), start=1)
)

ORACLE: dict[str, str] = {
    "bronze_state_filter": _bronze(", source_row"),
    "conform_fields": over_silver(
        f"SELECT source_row, npi, {', '.join(FIELDS)}, status FROM conf"
    ),
    "normalize_npi": _normalized("npi", _NPI, npi(_NPI)),
    "normalize_zip": _normalized("zip", _ZIP, zip5(_ZIP)),
    "normalize_date": _normalized(
        "day", plain_name(ENUMERATION), day(plain_name(ENUMERATION))
    ),
    "derive_status": over_silver(
        "SELECT source_row, deactivation_date, reactivation_date, status FROM conf"
    ),
    "slots_to_rows": over_silver("SELECT * FROM slots"),
    "first_taxonomy_per_key": over_silver("SELECT * FROM tax"),
    "cohort_members": over_silver(
        "SELECT npi, source_row FROM valid WHERE npi IN (SELECT npi FROM cohort)"
    ),
    "silver_providers": over_silver("SELECT * FROM prov"),
    "silver_taxonomies": over_silver(
        "SELECT * FROM ptax ORDER BY npi, taxonomy_slot, taxonomy_code"
    ),
    "dq_metrics": over_silver(_quality()),
    "records_without_taxonomy": over_silver(
        """SELECT (SELECT count(*) FROM valid WHERE npi NOT IN (SELECT npi FROM tax))
            AS missing_taxonomy_count,
        (SELECT count(*) FROM prov) AS primary_care_providers_retained"""
    ),
    "key_violations": over_silver(
        """SELECT (SELECT count(*) FROM conf WHERE npi IS NULL) AS missing_key_rows,
        (SELECT count(*) FROM (SELECT npi FROM conf WHERE npi IS NOT NULL
            GROUP BY npi HAVING count(*) > 1)) AS repeated_keys"""
    ),
    "g1_active_providers": over_silver(f"SELECT * FROM {ACTIVE}"),
    "g2_counts_by_zip": over_silver(f"SELECT * FROM {BY_ZIP}"),
    "g3_counts_by_taxonomy": over_silver(f"SELECT * FROM {BY_CODE}"),
    "g4_completeness_summary": over_silver(
        f"""SELECT count(*) AS provider_count, {_missing('practice_zip')} AS missing_zip_count,
        {_missing('practice_address_line_1')} AS missing_address_line_1_count,
        {_missing('practice_phone')} AS missing_phone_count,
        {_missing('enumeration_date')} AS missing_enumeration_date_count,
        {MISSING_CODE} AS missing_taxonomy_count FROM prov"""
    ),
    "q1_active_count": over_silver(
        f"SELECT count(*) AS active_primary_care_provider_count FROM {ACTIVE}"
    ),
    "q2_specialty_mix": over_silver(SPECIALTY_MIX),
    "q3_zip_footprint": over_silver(f"SELECT * FROM {BY_ZIP} ORDER BY practice_zip"),
    "q4_top_zips": over_silver(TOP_ZIPS),
    "q5_status_mix": over_silver(
        "SELECT status, count(*) AS provider_count FROM prov GROUP BY status ORDER BY status"
    ),
    "q6_completeness": over_silver(COMPLETENESS),
    "q7_multi_taxonomy": over_silver(
        """SELECT count(*) AS providers_with_multiple_taxonomy_assignments
        FROM (SELECT npi FROM ptax GROUP BY npi HAVING count(*) > 1)"""
    ),
    "newly_observed": f"""{SNAPSHOTS}
        SELECT npi FROM n_prov WHERE npi NOT IN (SELECT npi FROM o_prov)""",
    "not_observed": f"""{SNAPSHOTS}
        SELECT npi FROM o_prov WHERE npi NOT IN (SELECT npi FROM n_prov)""",
    "shared_attributes": f"{SNAPSHOTS}{SHARED} SELECT * FROM shared",
    "shared_attribute_changes": f"""{SNAPSHOTS}{SHARED}
        SELECT {_attribute_counts(False)} FROM shared""",
    "shared_attribute_changes_missing_equal": f"""{SNAPSHOTS}{SHARED}
        SELECT {_attribute_counts(True)} FROM shared""",
    "known_codes": f"""{SNAPSHOTS}
        SELECT npi, taxonomy_code FROM (SELECT * FROM o_ptax UNION ALL SELECT * FROM n_ptax)
        WHERE npi IN (SELECT npi FROM o_prov) GROUP BY ALL""",
    "taxonomy_set_changes": f"{SNAPSHOTS}{SHARED} SELECT npi FROM changed",
    "change_metrics": f"{SNAPSHOTS}{SHARED} {_change_metrics(False)}",
    "change_metrics_missing_equal": f"{SNAPSHOTS}{SHARED} {_change_metrics(True)}",
    "change_measures_long": f"""{SNAPSHOTS}{SHARED}, m AS ({_change_metrics(False)})
        {CHANGE_ROWS}""",
    "change_report": f"""{SNAPSHOTS}{SHARED}, m AS ({_change_metrics(False)})
        SELECT *, true AS run_time_utc, 'snapshot_change_measures.json' AS measures_filename,
            'providers_ma_primary_care.parquet' AS old_providers_filename,
            'providers_ma_primary_care.parquet' AS new_providers_filename,
            'provider_taxonomies.parquet' AS old_taxonomies_filename,
            'provider_taxonomies.parquet' AS new_taxonomies_filename
        FROM m""",
    "archive_members": over_records(
        """, period AS (SELECT DISTINCT release, month,
            concat('npidata_pfile_', month, '01-', month, '28') AS base FROM records)
        SELECT concat('extract_', release, '_', month, '.zip') AS archive, member, is_main FROM (
            SELECT release, month, concat(base, '.csv') AS member, true AS is_main FROM period
            UNION ALL SELECT release, month, concat(base, '_fileheader.csv'), false FROM period
            UNION ALL SELECT release, month, concat('docs/readme_', release, '.txt'), false FROM period)
        """
    ),
    "bronze_from_archive": _bronze(),
    "file_digests": """SELECT doc_id, sha256(text || chr(10)) AS sha256 FROM documents
        UNION ALL SELECT 3, sha256('')""",
    "table_reconciliation": over_silver(
        """SELECT 'providers' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows, true AS content_matches
        FROM prov UNION ALL SELECT 'provider_taxonomies', count(*), count(*), true FROM ptax"""
    ),
    "catalog_specialty_mix": over_silver(SPECIALTY_MIX),
    "catalog_top_zips": over_silver(TOP_ZIPS),
    "catalog_completeness": over_silver(COMPLETENESS),
    "run_manifest": _manifest(),
}
