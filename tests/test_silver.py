"""Bronze -> Silver rules on hand-made records."""

import pytest
from pyspark.sql import functions as F

from rosterlake import layout as L
from rosterlake.errors import ContractError
from rosterlake.operators import silver as S
from rosterlake.plans.silver import write_silver
from tests.fixtures import CODE_1, CODE_2, SWITCH_1, SWITCH_2, bronze_frame, bronze_record


def outputs(spark, *records):
    bronze = bronze_frame(spark, list(records))
    S.check_bronze(bronze)
    return (
        [r.asDict() for r in S.silver_providers(bronze).orderBy("npi").collect()],
        [r.asDict() for r in S.ordered_taxonomies(S.silver_taxonomies(bronze)).collect()],
        S.quality_metrics(bronze).first().asDict(),
    )


def test_valid_individual(spark):
    providers, taxonomies, counts = outputs(spark, bronze_record())
    assert len(providers) == 1 and len(taxonomies) == 1
    assert list(providers[0]) == ["npi", *L.PROVIDER_FIELDS, "status"]
    assert providers[0]["practice_zip"] == "01760"
    assert providers[0]["provider_middle_name"] is None
    assert providers[0]["status"] == "active"
    assert taxonomies[0] == {
        "npi": "1730000011",
        "taxonomy_code": "207Q00000X",
        "primary_taxonomy_flag": "Y",
        "taxonomy_slot": 1,
    }
    assert counts == dict.fromkeys(L.QUALITY_COUNTS, 0) | {
        "input_row_count": 1,
        "primary_care_providers_retained": 1,
    }


def test_approved_code_need_not_be_primary(spark):
    providers, taxonomies, _ = outputs(
        spark,
        bronze_record(**{CODE_1: "122300000X", CODE_2: " 207r00000x ", SWITCH_2: "n"}),
    )
    assert len(providers) == 1
    assert [(t["taxonomy_code"], t["primary_taxonomy_flag"]) for t in taxonomies] == [
        ("122300000X", "Y"),
        ("207R00000X", "N"),
    ]


def test_organization_is_left_out(spark):
    providers, taxonomies, counts = outputs(spark, bronze_record(entity_type_code="2"))
    assert providers == [] and taxonomies == []
    assert counts["organization_records_excluded"] == 1


def test_missing_and_invalid_keys(spark):
    providers, _, counts = outputs(spark, bronze_record(npi=" "), bronze_record(npi="12345abcde"))
    assert providers == []
    assert (counts["missing_npi_count"], counts["invalid_npi_count"]) == (1, 1)


def test_out_of_state_and_missing_state(spark):
    providers, _, counts = outputs(
        spark,
        bronze_record(practice_state="NY"),
        bronze_record(practice_state="", npi="1000000002"),
        bronze_record(practice_state=" ma ", npi="1000000003"),
    )
    assert [p["npi"] for p in providers] == ["1000000003"]
    assert providers[0]["practice_state"] == "MA"
    assert counts["non_massachusetts_records_excluded"] == 2


def test_organization_and_state_counts_overlap(spark):
    _, _, counts = outputs(spark, bronze_record(entity_type_code="2", practice_state="NY"))
    assert counts["organization_records_excluded"] == 1
    assert counts["non_massachusetts_records_excluded"] == 1


@pytest.mark.parametrize("text", ["2023-11-09", "11/09/2023"])
def test_deactivation_date_sets_status(spark, text):
    providers, _, _ = outputs(
        spark, bronze_record(deactivation_date=text, reactivation_date="2024-01-31")
    )
    assert providers[0]["deactivation_date"] == "2023-11-09"
    assert providers[0]["status"] == "deactivated"


def test_unreadable_deactivation_date_leaves_active(spark):
    providers, _, counts = outputs(spark, bronze_record(deactivation_date="02/30/2024"))
    assert providers[0]["status"] == "active"
    assert counts["invalid_deactivation_date_count"] == 1


def test_same_code_in_two_slots(spark):
    _, taxonomies, _ = outputs(spark, bronze_record(**{CODE_2: "207Q00000X", SWITCH_2: "N"}))
    assert [(t["taxonomy_slot"], t["primary_taxonomy_flag"]) for t in taxonomies] == [(1, "Y")]


def test_lowest_slot_wins_over_earlier_row(spark):
    _, taxonomies, _ = outputs(
        spark,
        bronze_record(**{CODE_1: "", CODE_2: "207Q00000X", SWITCH_2: "N"}),
        bronze_record(**{SWITCH_1: ""}),
        bronze_record(**{SWITCH_1: "Y"}),
    )
    assert [(t["taxonomy_slot"], t["primary_taxonomy_flag"]) for t in taxonomies] == [(1, None)]


def test_first_row_of_a_repeated_provider(spark):
    """The first row counts even when only a later row has the approved code."""
    providers, taxonomies, counts = outputs(
        spark,
        bronze_record(provider_last_name="First", **{CODE_1: "122300000X"}),
        bronze_record(provider_last_name="Second"),
    )
    assert [p["provider_last_name"] for p in providers] == ["First"]
    assert {t["taxonomy_code"] for t in taxonomies} == {"122300000X", "207Q00000X"}
    assert counts["primary_care_providers_retained"] == 1


def test_records_without_taxonomy_are_rows(spark):
    _, _, counts = outputs(
        spark,
        bronze_record(**{CODE_1: " "}),
        bronze_record(**{CODE_1: ""}),
        bronze_record(npi="1000000002", **{CODE_1: ""}),
        bronze_record(npi="1000000002"),
    )
    assert counts["missing_taxonomy_count"] == 2


def test_unusable_zip_counts_over_all_rows(spark):
    _, _, counts = outputs(
        spark,
        bronze_record(practice_zip=""),
        bronze_record(practice_zip="2108", practice_state="NY", entity_type_code="2"),
    )
    assert counts["missing_zip_count"] == 2


def test_empty_input_keeps_schema(spark):
    bronze = bronze_frame(spark, [bronze_record()]).limit(0)
    providers = S.silver_providers(bronze)
    assert providers.columns == ["npi", *L.PROVIDER_FIELDS, "status"]
    assert set(dict(providers.dtypes).values()) == {"string"}
    assert providers.count() == 0
    assert dict(S.silver_taxonomies(bronze).dtypes)["taxonomy_slot"] == "bigint"
    assert S.quality_metrics(bronze).first().asDict() == dict.fromkeys(L.QUALITY_COUNTS, 0)


def test_missing_silver_columns(spark):
    bronze = bronze_frame(spark, [bronze_record()]).drop(L.FAX, L.CREDENTIAL)
    with pytest.raises(ContractError) as error:
        S.check_bronze(bronze)
    assert L.FAX in str(error.value) and L.CREDENTIAL in str(error.value)


def test_another_profile(spark):
    profile = L.DirectoryProfile(state="NY", cohort_codes=("122300000X",))
    bronze = bronze_frame(
        spark, [bronze_record(), bronze_record(practice_state="NY", **{CODE_1: "122300000X"})]
    )
    providers = S.silver_providers(bronze, profile).collect()
    assert [p.practice_state for p in providers] == ["NY"]


def test_against_brute_force_with_a_hot_key(spark, tmp_path):
    """A third of the rows hold one key; results equal a plain loop over the rows."""
    codes = ["207Q00000X", "122300000X", "", " 208d00000x", "363L00000X"]
    records = []
    for i in range(600):
        key = 7 if i % 3 == 0 else i % 41
        records.append(
            bronze_record(
                npi=f"10000000{key:02d}",
                provider_last_name=f"Name {i}",
                practice_state="NY" if i % 13 == 0 else "MA",
                entity_type_code="2" if key % 5 == 4 else "1",
                **{
                    CODE_1: codes[(i * 7 + key) % 5] if key % 4 else "",
                    SWITCH_1: "Y" if i % 2 else "",
                    CODE_2: codes[(i + key) % 5] if key % 3 == 0 else "",
                    SWITCH_2: "N",
                },
            )
        )
    valid = [r for r in records if r[L.STATE] == "MA" and r[L.ENTITY_TYPE] == "1"]
    first_row, best, rows = {}, {}, {}
    for at, r in enumerate(valid):
        first_row.setdefault(r[L.NPI], r)
        rows[r[L.NPI]] = rows.get(r[L.NPI], 0) + 1
        for slot, code, switch in ((1, CODE_1, SWITCH_1), (2, CODE_2, SWITCH_2)):
            value = r[code].strip().upper()
            if value:
                pair = (r[L.NPI], value)
                best[pair] = min(best.get(pair, (99,)), (slot, at, r[switch] or None))
    cohort = {npi for npi, code in best if code in L.DirectoryProfile().cohort_codes}
    coded = {npi for npi, _ in best}

    bronze = bronze_frame(spark, records).repartition(5, F.rand(1))
    providers = {r.npi: r.provider_last_name for r in S.silver_providers(bronze).collect()}
    taxonomies = {
        (r.npi, r.taxonomy_code): (r.taxonomy_slot, r.primary_taxonomy_flag)
        for r in S.silver_taxonomies(bronze).collect()
    }
    counts = S.quality_metrics(bronze).first()
    assert providers == {npi: first_row[npi][L.LAST_NAME] for npi in cohort}
    assert taxonomies == {
        pair: (b[0], b[2]) for pair, b in best.items() if pair[0] in cohort
    }
    for limit in ("-1", "10m"):  # joins by shuffles, joins by broadcasts
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        written = write_silver(spark, bronze, f"{tmp_path}/{limit}")
        assert written == counts.asDict()
        for name, frame in (
            (L.PROVIDERS_NAME, S.silver_providers(bronze)),
            (L.TAXONOMIES_NAME, S.silver_taxonomies(bronze)),
        ):
            stored = spark.read.parquet(f"{tmp_path}/{limit}/{name}")
            assert stored.columns == frame.columns
            assert sorted(map(tuple, stored.collect()), key=repr) == sorted(
                map(tuple, frame.collect()), key=repr
            )
        records_of = S.cohort_records(bronze)
        assert records_of.columns == ["npi", *[c for c in bronze.columns if c != L.NPI]]
        members = records_of.select("npi", f"`{L.LAST_NAME}`").collect()
        assert sorted(map(tuple, members)) == sorted(
            (r[L.NPI], r[L.LAST_NAME]) for r in valid if r[L.NPI] in cohort
        )
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts.missing_taxonomy_count == sum(n for npi, n in rows.items() if npi not in coded)
    assert counts.primary_care_providers_retained == len(cohort)
