"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on at scale. Partition counts and sizes are the cluster's business: set
# `spark.sql.adaptive.coalescePartitions.initialPartitionNum` high (about shuffle bytes / 64 MB)
# and let adaptive execution merge small partitions and split skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

SCRATCH = "rosterlake.scratch.dir"


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def split_bytes(spark: SparkSession) -> int:
    """Spark's split size, which settings may give with a unit."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that tasks outside Spark's readers find the same one."""
    if "://" in path or path.startswith("file:"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return f"{default.rstrip('/')}{path}"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one that `spark.checkpoint.dir` names.

    That setting is fixed when a session starts; for one without it, `SCRATCH` names the folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH, None)
    if base is None:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return qualified(spark, f"{base.rstrip('/')}/{spark.sparkContext.applicationId}")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, which `clear_scratch` removes with all others."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this application has written to its scratch folder; for the end of a session."""
    remove_folder(spark, scratch_root(spark))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder of any file system with all it holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_space(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder that is removed afterwards, also when the work in it fails.

    Unpacked text takes many times the space of its archive.
    """
    folder = scratch_folder(spark, purpose)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)
