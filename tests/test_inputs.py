"""Inputs that the queries derive from the tables: the same rows, moved as narrow as they can be."""

import hashlib
import os
import re
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from workload import archives, records, registry
from workload.records import once

from rosterlake.session import remove_folder


def local(path):
    return Path("/" + path.removeprefix("file:").lstrip("/"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    orders = [
        (i, i % 7 + 1, "F", 1.0, datetime(1992 + i % 7, i % 12 + 1, 3) if i % 50 else None, "1-URGENT")
        for i in range(300, 0, -1)
    ]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, names).write.parquet(f"{folder}/orders.parquet")
    customers = [(i, f"Customer#{i}", i, 1.0, "BUILDING") for i in range(1, 8)]
    names = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(customers, names).write.parquet(f"{folder}/customer.parquet")
    texts = [(i, f"text {i}\nof é") for i in range(40)] + [(7, "text 7\nof é"), (50, None), (51, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    yield str(folder)
    for key in [key for key in records._written if key[2] == str(folder)]:
        path = records._written.pop(key)
        if key[0] == "write_silver_tables":
            remove_folder(spark, path)


def test_documents_are_files_without_a_folder_each(spark, tables):
    found = sorted((r.doc_id, r.sha256) for r in registry.file_hashes(spark, tables).collect())
    texts = {i: f"text {i}\nof é\n" * (1 + (i == 7)) for i in range(40)} | {50: "\n", 51: "\n"}
    expected = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items()]
    assert found == sorted([*expected, (3, hashlib.sha256(b"").hexdigest())])
    files = local(once(archives.write_documents, spark, tables)).parents[1]
    assert not [p for p in files.rglob("doc_id=*") if p.is_dir()]
    assert not [p for p in files.rglob("*") if p.name.endswith(".draft")]


def test_archives_hold_their_records_in_order_and_nothing_else_is_written(spark, tables):
    zips = local(once(archives.write_archives, spark, tables))
    counts = 0
    for path in zips.iterdir():
        with zipfile.ZipFile(path) as archive:
            (member,) = [n for n in archive.namelist() if n.endswith("28.csv")]
            text = archive.read(member).decode()
        counts += text.count('"US"')
        numbers = [int(n) for n in re.findall(r'"(\d+) Main Street"', text)]
        assert numbers == sorted(numbers)
    assert counts == 300
    written = [p for p in zips.parent.rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert not [p for p in written if p.suffix == ".csv"] and os.listdir(zips.parent / "drafts") == []


def test_records_without_a_date_reach_bronze(spark, tables):
    assert registry.bronze_from_archive(spark, tables).count() == registry.bronze_state_filter(spark, tables).count() > 0


def test_records_are_dealt_before_they_are_spelled_out(spark, tables):
    frame = records.dealt_records(spark, tables)
    plan = frame._jdf.queryExecution().optimizedPlan().toString().strip().splitlines()
    (dealt,) = [i for i, line in enumerate(plan) if "RepartitionByExpression" in line]
    (spelled,) = [i for i, line in enumerate(plan) if "Main Street" in line]
    assert spelled < dealt
    assert frame.count() == 300 and frame.exceptAll(records.derived_records(spark, tables)).isEmpty()


def test_a_comparison_writes_the_two_snapshots_it_reads(spark, tables):
    before = {key[3:] for key in records._written if key[0] == "write_silver_tables" and key[2] == tables}
    registry.not_observed(spark, tables).collect()
    after = {key[3:] for key in records._written if key[0] == "write_silver_tables" and key[2] == tables}
    assert after - before == {("older",), ("newer",)}
