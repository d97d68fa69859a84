"""Reading Bronze back in its order."""

import shutil

from rosterlake import layout as L
from rosterlake.operators import silver as S
from rosterlake.sources.tables import read_bronze, row_count
from tests.fixtures import bronze_frame, bronze_record


def test_numbered_files_are_read_in_numeric_order(spark, tmp_path):
    (tmp_path / "all").mkdir()
    for number in (100000, 99999, 3):
        record = bronze_record(provider_last_name=f"Name {number}")
        one = bronze_frame(spark, [record]).drop(*L.POSITION).coalesce(1)
        one.write.parquet(f"{tmp_path}/{number}")
        (written,) = (tmp_path / str(number)).glob("part-*.parquet")
        shutil.copy(written, tmp_path / "all" / f"part-{number:05d}-x.parquet")
    bronze = read_bronze(spark, f"{tmp_path}/all")
    names = [r[0] for r in bronze.orderBy(*L.POSITION).select(f"`{L.LAST_NAME}`").collect()]
    assert names == ["Name 3", "Name 99999", "Name 100000"]
    assert S.silver_providers(bronze).first().provider_last_name == "Name 3"


def test_row_count(spark, tmp_path):
    bronze_frame(spark, [bronze_record()] * 5).write.parquet(f"{tmp_path}/t")
    assert row_count(spark, f"{tmp_path}/t") == 5
