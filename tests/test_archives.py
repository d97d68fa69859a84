"""Archives -> Bronze."""

import hashlib
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from rosterlake import layout as L
from rosterlake.errors import ArchiveError, ContractError, MalformedSourceError
from rosterlake.plans import build_bronze
from rosterlake.sources import archives as A
from rosterlake.sources.tables import read_bronze
from tests.fixtures import (
    HEADER_MEMBER,
    MAIN_MEMBER,
    SOURCE_COLUMNS,
    csv_text,
    make_archive,
    source_record,
)


def stored(spark, folder, stem="weekly"):
    """Bronze in source order, without the positions."""
    bronze = spark.read.parquet(f"{folder}/{L.BRONZE_NAME.format(stem=stem)}")
    return bronze.orderBy(*L.POSITION).drop(*L.POSITION)


def bronze_of(spark, tmp_path, text, **kwargs):
    path = make_archive(tmp_path / "weekly.zip", text)
    metadata = build_bronze(spark, path, f"{tmp_path}/bronze", **kwargs)
    return metadata, stored(spark, f"{tmp_path}/bronze")


def test_main_member_is_found(spark, tmp_path):
    path = make_archive(tmp_path / "a.zip", "x\n", [HEADER_MEMBER, "docs/npidata_pfile.txt"])
    assert [r.member for r in A.main_members(spark, path).collect()] == [MAIN_MEMBER]


@pytest.mark.parametrize(
    "member, is_main",
    [
        ("npidata_pfile_1.csv", True),
        ("folder/npidata_pfile_1.CSV", True),
        ("NPIDATA_PFILE_1.csv", False),
        ("npidata_pfile_1_FileHeader.csv", False),
        ("npidata_pfile_1.csv.txt", False),
        ("npidata_pfile_1/other.csv", False),
    ],
)
def test_main_member_names(spark, member, is_main):
    frame = spark.createDataFrame([(member,)], "member string")
    assert frame.select(A.is_main_member()).first()[0] is is_main


def test_no_main_member(spark, tmp_path):
    path = make_archive(tmp_path / "a.zip", None)
    with pytest.raises(ArchiveError, match="holds no main file"):
        A.main_members(spark, path)


def test_several_main_members(spark, tmp_path):
    path = make_archive(tmp_path / "a.zip", "x\n", ["npidata_pfile_2.csv"])
    with pytest.raises(ArchiveError, match="holds 2 possible main files"):
        A.main_members(spark, path)


def test_not_a_zip(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(b"no zip")
    with pytest.raises(ArchiveError, match="not a readable ZIP"):
        A.main_members(spark, str(tmp_path / "a.zip"))


def test_empty_file(spark, tmp_path):
    (tmp_path / "empty.zip").write_bytes(b"")
    make_archive(tmp_path / "good.zip", "x\n")
    for name in ("empty.zip", "*.zip"):
        with pytest.raises(ArchiveError, match="empty.zip is not a readable ZIP"):
            A.main_members(spark, str(tmp_path / name))
    with pytest.raises(ArchiveError, match="names no archive"):
        A.main_members(spark, f"{tmp_path}/nothing*.zip")


def test_hidden_names_are_archives_too(spark, tmp_path):
    for name in ("_a.zip", ".b.zip", "c.zip"):
        make_archive(tmp_path / name, "x\n")
    assert A.main_members(spark, f"{tmp_path}/*.zip").count() == 3


def test_missing_required_column(spark, tmp_path):
    columns = [c for c in SOURCE_COLUMNS if c != L.FIRST_NAME]
    with pytest.raises(ContractError, match=L.FIRST_NAME):
        bronze_of(spark, tmp_path, csv_text([source_record()], columns))


def test_only_in_state_rows_and_counts(spark, tmp_path):
    states = ["MA", "NY", " ma ", "", "CT"]
    records = [source_record(**{L.NPI: f"100000000{i}", L.STATE: s}) for i, s in enumerate(states)]
    metadata, bronze = bronze_of(spark, tmp_path, csv_text(records))
    assert [r[L.NPI] for r in bronze.collect()] == ["1000000000", "1000000002"]
    assert bronze.columns == SOURCE_COLUMNS
    assert set(dict(bronze.dtypes).values()) == {"string"}
    report = spark.read.text(f"{tmp_path}/bronze/{L.BRONZE_REPORT_NAME.format(stem='weekly')}")
    saved = json.loads(report.first().value)
    assert saved.pop("run_time_utc").endswith("+00:00")
    assert saved == metadata == {
        "source_filename": "weekly.zip",
        "input_row_count": 5,
        "massachusetts_row_count": 2,
        "output_filename": "weekly_massachusetts.parquet",
        "retained_columns": SOURCE_COLUMNS,
    }


def test_blank_stays_blank_and_text_is_untouched(spark, tmp_path):
    odd = 'He said "hi", then\nleft\t'
    record = source_record(**{L.LAST_NAME: odd, L.MIDDLE_NAME: "  padded "})
    _, bronze = bronze_of(spark, tmp_path, csv_text([record], quote_all=True))
    assert bronze.first().asDict() == record


def test_no_row_in_state_keeps_schema(spark, tmp_path):
    metadata, bronze = bronze_of(spark, tmp_path, csv_text([source_record(**{L.STATE: "NY"})]))
    assert (metadata["input_row_count"], metadata["massachusetts_row_count"]) == (1, 0)
    assert bronze.columns == SOURCE_COLUMNS and bronze.count() == 0


def test_header_only(spark, tmp_path):
    metadata, bronze = bronze_of(spark, tmp_path, csv_text([]))
    assert metadata["input_row_count"] == 0 and bronze.columns == SOURCE_COLUMNS


def test_short_record_is_padded(spark, tmp_path):
    columns = [L.STATE, *[c for c in SOURCE_COLUMNS if c != L.STATE]]
    text = csv_text([source_record()], columns) + 'MA,1000000009\n"MA","a ""q"", b"\n\n'
    metadata, bronze = bronze_of(spark, tmp_path, text)
    assert metadata["input_row_count"] == 3
    assert [r[L.NPI] for r in bronze.collect()] == [source_record()[L.NPI], "1000000009", 'a "q", b']
    assert bronze.collect()[1][L.ZIP] == ""


@pytest.mark.parametrize("extra", [",", ',"x, y"', ",a,b"])
def test_long_record_is_refused(spark, tmp_path, extra):
    text = csv_text([source_record(**{L.STATE: "NY", L.LAST_NAME: "a,b"})]).rstrip("\n") + extra
    with pytest.raises(MalformedSourceError, match="weekly.zip: a record has more fields than the header$"):
        bronze_of(spark, tmp_path, text + "\n")


def test_byte_order_mark_and_line_ends(spark, tmp_path):
    text = "﻿" + csv_text([source_record()] * 2).replace("\n", "\r\n")
    metadata, bronze = bronze_of(spark, tmp_path, text)
    assert metadata["input_row_count"] == 2 and bronze.columns == SOURCE_COLUMNS
    assert {r[SOURCE_COLUMNS[-1]] for r in bronze.collect()} == {"Y"}


def test_part_size_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        bronze_of(spark, tmp_path, csv_text([source_record()]), part_bytes=0)


@pytest.mark.parametrize("part_bytes", [1, 700, 5000])
def test_parts_keep_records_whole_and_in_order(spark, tmp_path, part_bytes):
    records = [
        source_record(**{L.NPI: str(1000000000 + i), L.LAST_NAME: f'line\n"{i}"\nx' if i % 3 else ""})
        for i in range(60)
    ]
    metadata, bronze = bronze_of(spark, tmp_path, csv_text(records), part_bytes=part_bytes)
    assert metadata["input_row_count"] == 60
    assert [r.asDict() for r in bronze.collect()] == records
    placed = read_bronze(spark, f"{tmp_path}/bronze/weekly_massachusetts.parquet")
    ordered = placed.orderBy(*L.POSITION).select(f"`{L.NPI}`").collect()
    assert [r[0] for r in ordered] == [r[L.NPI] for r in records]


@pytest.mark.parametrize("part_bytes", [20_000, 1 << 20, None])
def test_stray_quotes_do_not_move_record_ends(spark, tmp_path, part_bytes):
    odd = ['5" pipe', 'a"b"c', 'x ""y', "", 'ends"', "plain"]
    lines = [",".join(SOURCE_COLUMNS)]
    for i in range(2000):
        record = source_record(**{L.NPI: str(i), L.LAST_NAME: odd[i % 6], L.FIRST_NAME: '"a ""b"",\nc"'})
        lines.append(",".join(record.values()))
    metadata, bronze = bronze_of(spark, tmp_path, "\r\n".join(lines) + "\r\n", part_bytes=part_bytes)
    assert metadata["input_row_count"] == metadata["massachusetts_row_count"] == 2000
    rows = bronze.collect()
    assert [r[L.NPI] for r in rows] == [str(i) for i in range(2000)]
    assert [r[L.LAST_NAME] for r in rows[:6]] == odd
    assert {r[L.FIRST_NAME] for r in rows} == {'a "b",\nc'}


@pytest.mark.parametrize("part_bytes", [None, 300])
@pytest.mark.parametrize("last", ['"open', '"open\n', '"a ""', '"a\nb,c'])
def test_unclosed_quote_is_refused(spark, tmp_path, last, part_bytes):
    text = csv_text([source_record()] * 3) + "1," + last
    with pytest.raises(MalformedSourceError, match="ends within a quoted field"):
        bronze_of(spark, tmp_path, text, part_bytes=part_bytes)


@pytest.mark.parametrize("place", ["header", "record", "end"])
def test_undecodable_bytes_are_refused(spark, tmp_path, place):
    text = csv_text([source_record(**{L.LAST_NAME: "Exa\xfemple"})] * 2 + [source_record()])
    data = text.encode("utf-8").replace("\xfe".encode(), b"\xfe" if place == "record" else b"")
    data = data.replace(b"\n", b"\xff\n", 1) if place == "header" else data
    data = data[:-1] + b"\xc3" if place == "end" else data
    path = make_archive(tmp_path / "weekly.zip", data)
    with pytest.raises(MalformedSourceError, match="not UTF-8"):
        build_bronze(spark, path, f"{tmp_path}/bronze")


def test_counts_that_differ_are_refused(spark, tmp_path, monkeypatch):
    from rosterlake.plans import bronze as plan

    landed = lambda *a: A.land_archives(*a).withColumn("records", F.col("records") + 1)
    monkeypatch.setattr(plan, "land_archives", landed)
    with pytest.raises(MalformedSourceError, match="4 records were found, but 3 were read"):
        bronze_of(spark, tmp_path, csv_text([source_record()] * 3))


def slow_records(text):
    """Record ends and the number of records, byte by byte."""
    ends, records, state, begun = [], 0, "start", False
    for at, byte in enumerate(text):
        char = chr(byte)
        if state == "quoted":
            state = "closing" if char == '"' else "quoted"
            continue
        if state == "closing" and char == '"':
            state = "quoted"
            continue
        if char == "\n":
            ends.append(at + 1)
            records, begun, state = records + begun, False, "start"
            continue
        if char != "\r":
            begun = True
        if state == "start" and char == '"':
            state = "quoted"
        else:
            state = "start" if char == "," else "text"
    return ends, records + begun, state == "quoted"


@pytest.mark.parametrize("block", [1, 2, 7, 37, 10**6])
def test_record_blocks_cut_at_record_ends_only(monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    random.seed(block)
    letters = ['"', '""', '"a"', ",", "\n", "\r\n", "x", "\u00e9", "\n\n", ',"']
    for _ in range(150):
        text = "".join(random.choices(letters, k=random.randrange(60))).encode()
        ends, records, is_open = slow_records(text)
        for size in (1, 10, 64):
            parts, current, counts, found = [], b"", [], 0
            try:
                for piece, n, cut in A._record_blocks(io.BytesIO(text), size):
                    current, found = current + piece, found + n
                    if cut:
                        parts.append(current)
                        counts.append(found)
                        current, found = b"", 0
            except ValueError as error:
                assert is_open and "within a quoted field" in str(error)
                continue
            assert not is_open
            at = 0
            for part, n in zip(parts, counts, strict=True):
                assert len(part) >= size and at + len(part) in ends
                assert n == slow_records(part)[1]
                at += len(part)
            assert b"".join(parts) + current == text
            assert sum(counts) + found == records


def test_several_archives_in_one_run(spark, tmp_path):
    for name in ("b", "a"):
        records = [source_record(**{L.NPI: f"{name}{i}"}) for i in range(3)]
        make_archive(tmp_path / f"{name}.zip", csv_text(records))
    metadata = build_bronze(spark, f"{tmp_path}/*.zip", f"{tmp_path}/out")
    assert metadata["input_row_count"] == 6
    found = [r[L.NPI] for r in stored(spark, f"{tmp_path}/out", "all").collect()]
    assert found == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_archive_name_with_blanks(spark, tmp_path):
    path = make_archive(tmp_path / "weekly file (1).zip", csv_text([source_record()]))
    assert build_bronze(spark, path, f"{tmp_path}/out")["output_filename"] == (
        "weekly file (1)_massachusetts.parquet"
    )
    assert stored(spark, f"{tmp_path}/out", "weekly file (1)").count() == 1
    assert A.file_digests(spark, path).count() == 1


def test_archives_with_other_headers_are_refused(spark, tmp_path):
    make_archive(tmp_path / "a.zip", csv_text([source_record()]))
    make_archive(tmp_path / "b.zip", csv_text([source_record()], list(reversed(SOURCE_COLUMNS))))
    with pytest.raises(ContractError, match="share one header"):
        build_bronze(spark, f"{tmp_path}/*.zip", f"{tmp_path}/out")


def test_landing_again_gives_the_same_parts(spark, tmp_path):
    """What a retried task does: the same files with the same content."""
    path = make_archive(tmp_path / "a.zip", csv_text([source_record()] * 50))
    uri = f"file://{path}"
    for _ in range(2):
        landed = list(A._land_member(uri, MAIN_MEMBER, f"file://{tmp_path}/parts", 2000))
    files = sorted((tmp_path / "parts").glob("*/*"))
    assert len(files) == len(landed) and not [f for f in files if f.name.startswith("_")]


def test_digests(spark, tmp_path):
    contents = {f"f{i}.zip": bytes([i]) * (i * 700_000) for i in range(1, 4)}
    contents |= {"_hidden.zip": b"x", ".b.zip": b"y", "empty.zip": b"", "a [1]{2}.zip": b"z"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    for paths in (f"{tmp_path}/*.zip", str(tmp_path)):
        found = A.file_digests(spark, paths).withColumn("name", F.substring_index("path", "/", -1))
        assert {r.name: r.sha256 for r in found.collect()} == {
            name: hashlib.sha256(content).hexdigest() for name, content in contents.items()
        }
    only = A.file_digests(spark, f"{tmp_path}/empty.zip").collect()
    assert [r.sha256 for r in only] == [hashlib.sha256(b"").hexdigest()]


@pytest.mark.parametrize("part_bytes", [None, 300])
def test_line_ends_may_differ_from_record_to_record(spark, tmp_path, part_bytes):
    records = [source_record(**{L.NPI: str(i), L.LAST_NAME: "a\r\nb" if i % 3 else "c\nd"}) for i in range(12)]
    head, *lines = [csv_text([], quote_all=True), *[csv_text([r], quote_all=True).split("\n", 1)[1] for r in records]]
    for first in ("\n", "\r\n"):
        text = head.rstrip("\n") + first + "".join(x.rstrip("\n") + ("\r\n", "\n")[i % 2] for i, x in enumerate(lines))
        metadata, bronze = bronze_of(spark, tmp_path, text + "\r\n\n", part_bytes=part_bytes)
        assert metadata["input_row_count"] == 12
        assert sorted((r.asDict() for r in bronze.collect()), key=str) == sorted(records, key=str)


@pytest.mark.parametrize("block", [1, 3, 10**6])
def test_record_ends_leave_as_line_feeds(monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    random.seed(block)
    for _ in range(150):
        text = "".join(random.choices(['"a\r\nb"', ",", "\n", "\r\n", "x", "\n\n"], k=random.randrange(40))).encode()
        ends, records, is_open = slow_records(text)
        wanted, at = b"", 0
        for end in [*ends, len(text)]:
            line = text[at:end]
            wanted, at = wanted + (line[:-2] + b"\n" if line.endswith(b"\r\n") else line), end
        for size in (1, 10, 64):
            try:
                pieces = [*A._record_blocks(io.BytesIO(text), size, line_feeds=True)]
            except ValueError:
                assert is_open
                continue
            assert b"".join(p for p, *_ in pieces) == wanted and sum(n for _, n, _ in pieces) == records


@pytest.mark.parametrize("part_bytes", [500, 10**9])
def test_archives_are_digested_while_they_are_read(spark, tmp_path, part_bytes, monkeypatch):
    paths = [make_archive(tmp_path / f"{name}.zip", csv_text([source_record()] * n)) for name, n in (("a", 30), ("b", 0))]
    landed = A.land_archives(spark, f"{tmp_path}/*.zip", f"{tmp_path}/scratch", part_bytes)
    found = {r.archive.rsplit("/", 1)[-1]: r.sha256 for r in landed.where("sha256 IS NOT NULL").collect()}
    assert found == {p.rsplit("/", 1)[-1]: hashlib.sha256(open(p, "rb").read()).hexdigest() for p in paths}
    assert landed.where("sha256 IS NOT NULL").count() == 2 and landed.count() == (2 if part_bytes == 10**9 else landed.count())
    # each byte is read once, but for the directory at the end
    read = []
    monkeypatch.setattr(A, "_open", lambda uri: Counting(open(uri.removeprefix("file://"), "rb"), read))
    list(A._land_member(f"file://{paths[0]}", MAIN_MEMBER, f"file://{tmp_path}/again", part_bytes))
    assert sum(read) <= os.path.getsize(paths[0]) + 2000


class Counting:
    def __init__(self, stream, read):
        self.stream, self.counts = stream, read

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.stream.close()

    def __getattr__(self, name):
        return getattr(self.stream, name)

    def read(self, size=-1):
        data = self.stream.read(size)
        self.counts.append(len(data))
        return data


def test_listing(spark, tmp_path):
    names = ["a.txt", "b.crc", "_c", ".d.txt", ".a.txt.crc", ".gone.crc", "e{1}.txt", "sub/x.txt", "sub/.x.txt.crc", "sub/deep/y.txt", "sub2/x.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_text(name)
    top = {n for n in names if "/" not in n} - {".a.txt.crc"}

    def listed(pattern):
        return {r.archive.removeprefix(f"file:{tmp_path}/"): r.length for r in A.archive_files(spark, f"{tmp_path}{pattern}").collect()}

    assert listed("") == listed("/") == {n: len(n) for n in top}
    assert listed("/sub*/x.txt").keys() == listed("/{sub,sub2}/*.txt").keys() == {"sub/x.txt", "sub2/x.txt"}
    assert listed("/s*").keys() == {"sub/x.txt", "sub2/x.txt"}
    assert listed("/*.txt").keys() == {"a.txt", ".d.txt", "e{1}.txt"} and listed("/[a_]*").keys() == {"a.txt", "_c"}
    assert listed("/e\\{1\\}.txt").keys() == {"e{1}.txt"} and listed("/?.txt").keys() == listed("/[!b].txt").keys() == {"a.txt"}
    assert listed("/b.crc").keys() == {"b.crc"} and listed("/none*/x") == listed("/none") == {}
    assert listed("/*/*/y.txt").keys() == {"sub/deep/y.txt"}
