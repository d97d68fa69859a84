"""Parquet folders and JSON reports in one file; a rerun replaces the earlier output."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(frame: DataFrame, path: str) -> None:
    """K1, K3: the declared schema is kept even when no row is."""
    frame.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """K2, K4, K7, K9: a file with one JSON object a line, NULL fields included.

    The file is written beside its place and renamed over an earlier one, in one step where the file
    system renames in one: a reader finds either report whole. Reports are aggregates of a few rows.
    """
    jvm, conf = report.sparkSession._jvm.org.apache.hadoop.fs, report.sparkSession._jsc.hadoopConfiguration()
    target, draft = jvm.Path(path), jvm.Path(f"{path}.{uuid.uuid4().hex}.draft")
    files = target.getFileSystem(conf)
    target, draft = files.makeQualified(target), files.makeQualified(draft)
    try:
        report.coalesce(1).write.option("ignoreNullFields", False).json(draft.toString())
        (written,) = files.globStatus(jvm.Path(draft, "part-*.json"))
        if files.exists(target) and files.getFileStatus(target).isDirectory():  # of an earlier version
            files.delete(target, True)
        over = report.sparkSession._jvm.org.apache.hadoop.fs.Options.Rename
        options = report.sparkSession.sparkContext._gateway.new_array(over, 1)
        options[0] = over.OVERWRITE
        jvm.FileContext.getFileContext(target.toUri(), conf).rename(written.getPath(), target, options)
    finally:
        files.delete(draft, True)


def run_time_utc() -> Column:
    """The current time in UTC, ISO-8601 with offset."""
    zone = F.current_timezone()
    return F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), zone), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    )
