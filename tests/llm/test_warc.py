"""Archives against what was put in, with chunks smaller than most payloads."""

import base64
import gzip
import hashlib
import random
from collections import Counter

import pyarrow.fs as pafs
import pytest

from rosterlake.llm import warc
from rosterlake.llm.queries import QUERIES
from rosterlake.llm.warc import read_warc, write_warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    firsts = {}
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            firsts[data] = min(firsts.get(data, page), page)
    out, seen = Counter(), set()
    for page, html in rows:
        data = (html or "").encode()
        first = firsts.get(data)
        again = len(data) >= least and ((page, data) in seen or first is not None and page != first)
        seen.add((page, data))
        out[(page, len(data), digest(data), "revisit" if again else "response", first if again else None)] += 1
    return out


def pages():
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("aé<\n\r ") for _ in range(rng.randrange(0, 70)))) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(40)] + [(-5, rows[3][1]), (500, None), (501, ""), (502, None)]
    rows += [rows[2], rows[2], (2, "other text of page 2"), (None, rows[4][1]), (None, "only here"), (900, "WARC/1.1\r\n\r\n" * 900)]
    return rows


@pytest.mark.parametrize(("least", "archive"), [(0, 1 << 26), (30, 500)])
def test_round_trip(spark, tmp_path, least, archive):
    rows = pages()
    frame = spark.createDataFrame(
        [(p, f"http://x/{p}\r\nWARC-Type: none", h, "x", 1) for p, h in rows],
        "page_id long, url string, html string, digest string, k int",
    )
    folder = f"file://{tmp_path}/archives"
    archives = write_warc(frame, folder, least_bytes=least, chunk_bytes=16, archive_bytes=archive)
    found = read_warc(archives).collect()
    assert Counter(map(tuple, found)) == expected(rows, least)
    assert sum(r.records for r in archives.collect()) == len(rows)
    files, path = pafs.FileSystem.from_uri(folder)
    names = [f.base_name for f in files.get_file_info(pafs.FileSelector(path))]
    assert all(n.endswith(".warc.gz") for n in names) and (len(names) > 3) == (archive == 500)


def test_payloads_are_dealt_and_sorted_as_chunks(spark, tmp_path, monkeypatch):
    """Repeated rows of many chunks: their chunks meet in one task and must not mix."""
    rows = [(7, f"{i % 3} " + "payload " * 40) for i in range(30)] + [(i, "shared " * 50) for i in range(20)]
    frame = spark.createDataFrame([(p, "u", h) for p, h in rows], "page_id long, url string, html string").repartition(5)
    plans = []

    def kept(df, purpose, store=warc.stored):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, purpose)

    monkeypatch.setattr(warc, "stored", kept)
    archives = write_warc(frame, f"file://{tmp_path}/archives", chunk_bytes=16)
    assert Counter(map(tuple, read_warc(archives).collect())) == expected(rows)
    above, below = plans[-1].split("RepartitionByExpression [k#", 1)
    assert "substring" in below and "substring" not in above  # cut below the exchange, not above it


def test_a_damaged_archive_is_refused(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "payload")], "page_id long, url string, html string")
    archives = write_warc(frame, f"file://{tmp_path}/archives")
    name = archives.first().archive.removeprefix("file://")
    with gzip.open(name) as file:
        data = file.read().replace(b"payload\r\n", b"payl0ad\r\n")
    with gzip.open(name, "wb") as file:
        file.write(data)
    with pytest.raises(Exception, match="another digest"):
        read_warc(archives).collect()


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(write_warc(frame, f"file://{tmp_path}/archives")).collect() == []


def test_query(spark):
    pages_ = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    found = QUERIES["op9_warc"](spark, "/root/testdata/sf0.01").collect()
    assert Counter(map(tuple, found)) == expected([tuple(r) for r in pages_])
