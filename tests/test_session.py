"""Session helpers."""

import os

import pytest

from rosterlake.session import (
    SCRATCH,
    clear_scratch,
    qualified,
    scratch_folder,
    scratch_space,
    split_bytes,
)


@pytest.mark.parametrize(
    "text, size", [("134217728b", 1 << 27), ("128MB", 1 << 27), ("64m", 1 << 26), ("1g", 1 << 30), ("5", 5)]
)
def test_split_bytes(spark, text, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", text)
    try:
        assert split_bytes(spark) == size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != other and one.startswith(f"file:{shared}/{spark.sparkContext.applicationId}/x-")


class OtherSession:
    """A session with other settings."""

    def __init__(self, spark, **settings):
        self.sparkContext, self.conf = spark.sparkContext, settings


def test_scratch_needs_a_shared_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(OtherSession(spark), "x")
    other = OtherSession(spark, **{SCRATCH: f"file:{tmp_path}"})
    assert scratch_folder(other, "x").startswith(f"file:{tmp_path}/")


def test_clearing_removes_the_applications_scratch(spark, tmp_path):
    other = OtherSession(spark, **{SCRATCH: f"file:{tmp_path}"})
    spark.range(3).write.parquet(scratch_folder(other, "x"))
    assert os.listdir(tmp_path)
    clear_scratch(other)
    assert not os.listdir(tmp_path)


def test_scratch_space_is_removed(spark):
    with scratch_space(spark, "x") as folder:
        spark.range(3).write.parquet(f"{folder}/t")
        assert os.path.exists(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_scratch_space_is_removed_after_a_failure(spark):
    with pytest.raises(KeyError):
        with scratch_space(spark, "x") as folder:
            spark.range(3).write.parquet(f"{folder}/t")
            raise KeyError
    assert not os.path.exists(folder.removeprefix("file:"))


def test_qualified_paths(spark):
    assert qualified(spark, "/a/b") == "file:/a/b"
    assert qualified(spark, "hdfs://n/a") == "hdfs://n/a"
