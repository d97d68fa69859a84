"""Generated text through the column functions and through an archive."""

import csv
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterlake import functions as R
from rosterlake import layout as L
from rosterlake.functions.cleaning import WHITESPACE
from rosterlake.plans import build_bronze
from tests.fixtures import SOURCE_COLUMNS, make_archive, source_record, text_frame

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
padding = st.text(WHITESPACE, max_size=3)
inner = st.text(st.characters(exclude_categories=("Cs",), exclude_characters="\0"), max_size=8)
padded = st.tuples(padding, inner, padding).map("".join)


@FEW
@given(st.lists(padded, min_size=50, max_size=150))
def test_strip_equals_python(spark, values):
    frame = text_frame(spark, ["v"], [(v,) for v in values])
    row = frame.select(
        "v",
        R.strip(F.col("v")).alias("a"),
        R.strip_tidy(F.col("v")).alias("b"),
        R.has_text(F.col("v")).alias("c"),
    )
    for v, a, b, c in row.collect():
        assert (a, b, c) == (v.strip(), v.strip(), v.strip() != "")


field = st.text(st.sampled_from('ab,"\n \té;\\'), max_size=12)


@FEW
@given(
    names=st.lists(st.tuples(field, field), min_size=1, max_size=30),
    part_bytes=st.integers(1, 4000),
    line_end=st.sampled_from(["\n", "\r\n"]),
)
def test_text_survives_the_archive(spark, tmp_path_factory, names, part_bytes, line_end):
    folder = tmp_path_factory.mktemp("roundtrip")
    records = [source_record(**{L.LAST_NAME: a, L.ADDRESS_LINE_2: b}) for a, b in names]
    text = io.StringIO()
    writer = csv.DictWriter(text, SOURCE_COLUMNS, lineterminator=line_end, quoting=csv.QUOTE_ALL)
    writer.writeheader()
    writer.writerows(records)
    archive = make_archive(folder / "weekly.zip", text.getvalue())
    report = build_bronze(spark, archive, f"{folder}/out", part_bytes=part_bytes)
    stored = spark.read.parquet(f"{folder}/out/{report['output_filename']}")
    rows = stored.orderBy(*L.POSITION).drop(*L.POSITION).collect()
    assert [r.asDict() for r in rows] == records


@pytest.mark.parametrize("odd", ["a\rb", "a\r\nb", "\r", "\r\n"])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_carriage_returns_in_fields(spark, tmp_path, odd, line_end):
    records = [source_record(**{L.LAST_NAME: odd}), source_record()]
    text = io.StringIO(newline="")
    writer = csv.DictWriter(text, SOURCE_COLUMNS, lineterminator=line_end, quoting=csv.QUOTE_ALL)
    writer.writeheader()
    writer.writerows(records)
    build_bronze(spark, make_archive(tmp_path / "w.zip", text.getvalue()), f"{tmp_path}/out")
    stored = spark.read.parquet(f"{tmp_path}/out/w_massachusetts.parquet")
    rows = stored.orderBy(*L.POSITION).drop(*L.POSITION).collect()
    assert [r.asDict() for r in rows] == records
