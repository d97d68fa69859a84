"""Typed errors: each names the contract that a snapshot or report breaks."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# What a failing Spark job raises; only some JVM errors have a PySpark class.
JOB_ERRORS = (PySparkException, Py4JJavaError)

# Stands in the message of a task that fails on malformed source text.
MALFORMED = "MALFORMED_SOURCE_RECORD"


class RosterError(Exception):
    """Base of all expected input problems."""


class ContractError(RosterError):
    """A table lacks required columns or numbered slot pairs."""


class ArchiveError(RosterError):
    """An archive is unreadable or does not hold exactly one main file."""


class MalformedSourceError(RosterError):
    """A delimited file ends in a quoted field, is not UTF-8, or has records that do not fit."""


class SnapshotKeyError(RosterError):
    """A provider snapshot has missing or repeated keys."""


class ReconciliationError(RosterError):
    """A loaded table does not hold as many rows as its source."""


class ReportError(RosterError):
    """A stage report is not one JSON object with usable counts."""
