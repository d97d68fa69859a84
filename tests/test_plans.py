"""Physical plans: what is read, what is shuffled, what is never used."""

import re

import pytest

from rosterlake import layout as L
from rosterlake.operators import changes as C
from rosterlake.operators import gold as G
from rosterlake.operators import silver as S
from rosterlake.plans import silver as silver_plan
from tests.fixtures import bronze_frame, bronze_record, text_frame


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffles(frame):
    return len(re.findall(r"\bExchange hashpartitioning", plan(frame)))


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    bronze_frame(spark, [bronze_record()]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def silver(spark, bronze, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans") / "silver")
    S.silver_providers(bronze).write.parquet(f"{folder}/p")
    S.silver_taxonomies(bronze).write.parquet(f"{folder}/t")
    return spark.read.parquet(f"{folder}/p"), spark.read.parquet(f"{folder}/t")


@pytest.fixture(autouse=True, scope="module")
def no_broadcast(spark):
    """Large inputs: no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def read_columns(frame):
    """Columns of each scan, by the number of fields in its output."""
    return [len(re.findall(r"#\d+", m)) for m in re.findall(r"FileScan parquet \[(.*?)\] Batched", plan(frame))]


def test_providers_meet_fixed_width_keys_by_position(bronze):
    frame = S.silver_providers(bronze)
    assert "Window" not in plan(frame)
    # narrow keys are reduced by hashing; whole records are sorted for the join by position alone
    assert "SortAggregate" not in plan(frame) and "partial_min(_source_row" in plan(frame)
    assert shuffles(frame) == 3 and "SortMergeJoin [_source_row" in plan(frame)


def test_providers_do_not_shuffle_records_for_a_small_cohort(spark, bronze, tmp_path):
    S.provider_keys(bronze).write.parquet(f"{tmp_path}/keys")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    frame = S.silver_providers(bronze, keys=spark.read.parquet(f"{tmp_path}/keys"))
    assert shuffles(frame) == 0 and "BroadcastHashJoin" in plan(frame)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_taxonomies_reduce_before_the_shuffle(bronze):
    frame = S.silver_taxonomies(bronze)
    assert "partial_min(struct(" in plan(frame)
    assert shuffles(frame) == 3  # (provider, code), then both sides of the semi join


def test_cohort_records_take_one_join_that_can_be_split(bronze):
    text = plan(S.cohort_records(bronze))
    assert re.search(r"SortMergeJoin \[npi#\d+\], \[npi#\d+\], LeftSemi", text)
    assert "Broadcast" not in text and text.count("FileScan") == 2


def test_row_quality_moves_no_rows(bronze):
    frame = S.row_quality(bronze)
    assert shuffles(frame) == 0
    assert read_columns(frame) == [7]


def test_quality_reads_narrow_columns(bronze):
    frame = S.quality_metrics(bronze)
    assert shuffles(frame) == 1
    assert read_columns(frame) == [9]
    assert "SortAggregate" not in plan(frame)


def test_silver_scans_bronze_three_times(spark, bronze, tmp_path, monkeypatch):
    written, write = [], silver_plan.write_table
    monkeypatch.setattr(silver_plan, "write_table", lambda frame, path: (written.append(plan(frame)), write(frame, path)))
    silver_plan.write_silver(spark, bronze, f"{tmp_path}/silver")
    place = bronze.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert [len(re.findall(rf"FileScan parquet .*{re.escape(place)[:60]}", text)) for text in written] == [1, 1, 1]


def test_active_filter_reaches_the_scan(silver):
    text = plan(G.relation("active_provider_count", *silver))
    assert "EqualTo(status,active)" in text


def test_specialty_filter_reaches_the_scan(silver):
    text = plan(G.relation("specialty_mix", *silver))
    assert "In(taxonomy_code" in text or "taxonomy_code IN" in text
    assert "PushedFilters: [IsNotNull(npi), In(taxonomy_code" in text or "In(taxonomy_code, [" in text


def test_top_zips_keep_only_ten_per_task(silver):
    assert "TakeOrderedAndProject(limit=10" in plan(G.relation("top_zips", *silver))


def test_comparison_shuffles_each_input_once(silver):
    providers, taxonomies = silver
    frame = C.change_metrics(providers, providers, taxonomies, taxonomies)
    # two provider sides, the (provider, code) pairs, and the providers with changed sets
    assert shuffles(frame) == 4


@pytest.mark.parametrize("name", [*G.VIEWS, *G.QUERIES])
def test_gold_uses_no_product(silver, name):
    text = plan(G.relation(name, *silver))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_silver_stays_in_the_jvm(bronze):
    for frame in (S.silver_providers(bronze), S.silver_taxonomies(bronze), S.quality_metrics(bronze)):
        assert not re.search(r"Python|MapInPandas|ArrowEval", plan(frame))


def test_comparison_uses_no_product(spark):
    providers = text_frame(spark, L.COMPARED_PROVIDER_COLUMNS, [("1", "active", "", "")])
    codes = text_frame(spark, L.COMPARED_TAXONOMY_COLUMNS, [("1", "A")])
    text = plan(C.change_metrics(providers, providers, codes, codes))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_measures_are_hash_aggregated(silver):
    for missing_equal in (False, True):
        metrics = C.compare_snapshots(silver[0], silver[0], silver[1], silver[1], missing_equal)
        changes = C.shared_attribute_changes(silver[0], silver[0], missing_equal)
        for frame in (metrics, changes):
            assert "SortAggregate" not in plan(frame) and "HashAggregate" in plan(frame)
