"""Stage reports: one JSON object per file or per written folder."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.errors import JOB_ERRORS, ReportError
from rosterlake.operators.contracts import unusable_counts


def read_report(
    spark: SparkSession, path: str, label: str, counts: Iterable[str], texts: Iterable[str] = ()
) -> DataFrame:
    """A report as one row of checked counts and non-empty texts.

    The schema is explicit and the parse strict: a count in quotes, a boolean or a fraction is
    refused, as are an array, several objects, a missing or a negative count.
    """
    counts, texts = list(counts), list(texts)
    stored = spark.read.text(path, wholetext=True)
    found = [row.value for row in stored.limit(2).collect()]
    try:
        is_object = len(found) == 1 and isinstance(json.loads(found[0]), dict)
    except ValueError as error:
        raise ReportError(f"The {label} at {path} is not JSON: {error}") from error
    if not is_object:
        raise ReportError(f"The {label} at {path} must hold one JSON object")
    schema = ", ".join([*[f"{c} long" for c in counts], *[f"{t} string" for t in texts]])
    report = stored.select(
        F.from_json("value", schema, {"mode": "FAILFAST"}).alias("report")
    ).select("report.*")
    try:
        row = report.first()
    except JOB_ERRORS as error:
        raise ReportError(f"The {label} at {path} has a value of the wrong type") from error
    unusable = unusable_counts(report, counts).first().unusable
    if unusable:
        raise ReportError(f"The {label} at {path} has invalid counts: {', '.join(unusable)}")
    blank = [name for name in texts if not row[name]]
    if blank:
        raise ReportError(f"The {label} at {path} has no {', '.join(blank)}")
    return report
