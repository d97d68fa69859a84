"""A provider directory derived from `orders` and `customer`, for queries, bench and tests.

Each order is one directory record of the provider that its customer stands for, so providers
repeat, as they do in weekly files. The expressions are plain SQL that Spark and DuckDB read
alike; they only shape values (padding, blanks, malformed keys, several date formats, text that
needs CSV quoting) and leave out no row.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake import layout as L
from rosterlake.session import scratch_folder
from rosterlake.sources.archives import listing_tasks

_ID = "cast(1000000000 + o_custkey AS string)"
_MONTH = "lpad(cast(month(o_orderdate) AS string), 2, '0')"
_DAY = "lpad(cast(day(o_orderdate) AS string), 2, '0')"
_YEAR = "cast(year(o_orderdate) AS string)"
_MDY = f"concat({_MONTH}, '/', {_DAY}, '/', {_YEAR})"
_ISO = f"concat({_YEAR}, '-', {_MONTH}, '-', {_DAY})"
_ZIP5 = (
    "concat('02', lpad(cast(c_nationkey * 8"
    " + CASE WHEN o_custkey % 7 = 0 THEN year(o_orderdate) % 8 ELSE 0 END AS string), 3, '0'))"
)

# Source column -> expression over orders JOIN customer, in file order.
RECORD_EXPRESSIONS = {
    L.NPI: f"""CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN 'bad-key'
        WHEN o_orderkey % 83 = 0 THEN cast(o_custkey AS string)
        WHEN o_orderkey % 3 = 0 THEN concat(chr(160), ' ', {_ID}, chr(9)) ELSE {_ID} END""",
    L.ENTITY_TYPE: """CASE WHEN o_custkey % 5 = 0 THEN '2' WHEN o_orderkey % 53 = 0 THEN ''
        WHEN o_orderkey % 7 = 0 THEN ' 1 ' ELSE '1' END""",
    L.REPLACEMENT_NPI: "''",
    L.ORGANIZATION_NAME: "CASE WHEN o_custkey % 5 = 0 THEN c_name ELSE '' END",
    L.LAST_NAME: "c_name",
    L.FIRST_NAME: "concat(' ', o_orderpriority)",
    L.MIDDLE_NAME: "CASE WHEN o_orderkey % 6 = 0 THEN o_orderstatus ELSE '  ' END",
    L.NAME_PREFIX: "CASE WHEN o_orderkey % 2 = 0 THEN 'Dr.' ELSE '' END",
    L.NAME_SUFFIX: "CASE WHEN o_custkey % 25 = 0 THEN 'Jr.' ELSE '' END",
    L.CREDENTIAL: "CASE WHEN o_orderstatus = 'F' THEN 'M.D.' ELSE '' END",
    "Certification Date": _MDY,  # not part of the contract: Bronze leaves it out
    L.ADDRESS_LINE_1: """CASE WHEN o_orderkey % 23 = 0 THEN '   '
        ELSE concat(cast(o_orderkey AS string), ' Main Street') END""",
    L.ADDRESS_LINE_2: """CASE
        WHEN o_orderkey % 13 = 0 THEN concat('Suite "', cast(o_orderkey % 9 AS string), '", rear')
        WHEN o_orderkey % 17 = 1 THEN concat('Unit 1', chr(10), 'Rear entry') ELSE '' END""",
    L.CITY: "concat('City ', cast(c_nationkey AS string))",
    L.STATE: """CASE WHEN c_nationkey % 5 = 0 THEN 'NY' WHEN c_nationkey % 5 = 1 THEN ' ma'
        WHEN o_orderkey % 61 = 0 THEN '' ELSE 'MA' END""",
    L.ZIP: f"""CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN '2108'
        WHEN o_orderkey % 4 = 0 THEN concat({_ZIP5}, '-1234')
        WHEN o_orderkey % 4 = 1 THEN concat({_ZIP5}, '1234') ELSE {_ZIP5} END""",
    L.COUNTRY: "'US'",
    L.PHONE: """CASE WHEN o_orderkey % 29 = 0 THEN ''
        ELSE concat('617', lpad(cast(o_custkey AS string), 7, '0')) END""",
    L.FAX: "CASE WHEN o_orderkey % 10 = 0 THEN '6175550100' ELSE '' END",
    L.ENUMERATION_DATE: f"""CASE WHEN o_orderkey % 31 = 0 THEN 'unknown'
        WHEN o_orderkey % 43 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN {_ISO} ELSE {_MDY} END""",
    L.LAST_UPDATE_DATE: _MDY,
    L.DEACTIVATION_REASON: "CASE WHEN o_orderkey % 17 = 0 THEN 'DT' ELSE '' END",
    L.DEACTIVATION_DATE: """CASE WHEN o_orderkey % 17 = 0 THEN ' 02/03/2024'
        WHEN o_orderkey % 19 = 0 THEN '02/30/2024' ELSE '' END""",
    L.REACTIVATION_DATE: """CASE WHEN o_orderkey % 37 = 0 THEN '2024-03-01'
        WHEN o_orderkey % 41 = 0 THEN '2024-13-01' WHEN o_orderkey % 47 = 0 THEN '2/3/2024'
        WHEN o_orderkey % 59 = 0 THEN '01/01/2500' ELSE '' END""",
    f"{L.SLOT_CODE_PREFIX}1": """CASE c_mktsegment WHEN 'BUILDING' THEN '207Q00000X'
        WHEN 'MACHINERY' THEN ' 207r00000x' WHEN 'AUTOMOBILE' THEN '' ELSE '122300000X' END""",
    f"{L.SLOT_SWITCH_PREFIX}1": "CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE ' y' END",
    f"{L.SLOT_CODE_PREFIX}10": """CASE WHEN o_orderkey % 50 = 0 THEN '208000000X '
        WHEN o_orderkey % 50 = 7 THEN '363L00000X' ELSE ' ' END""",
    f"{L.SLOT_SWITCH_PREFIX}10": "CASE WHEN o_orderkey % 100 = 0 THEN 'N' ELSE '' END",
    f"{L.SLOT_CODE_PREFIX}2": """CASE WHEN o_orderkey % 40 = 0 THEN '207Q00000X'
        WHEN o_orderkey % 40 = 1 THEN '208D00000X' ELSE '' END""",
    f"{L.SLOT_SWITCH_PREFIX}2": "'N'",
}

# Every record belongs to one of two snapshots by its date.
RELEASE_EXPRESSION = (
    "CASE WHEN o_orderdate < timestamp '1998-04-16 00:00:00' THEN 'older' ELSE 'newer' END"
)
# Each month of a snapshot is an archive.
MONTH_EXPRESSION = f"concat({_YEAR}, {_MONTH})"


POSITION = "o_orderkey"
TASK_ROWS = 500_000


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that records are made of, with `release` and `month`: a tenth of a record's bytes.

    What moves or sorts records does so with these rows; `record_rows` spells them out afterwards.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumns(
        {"release": F.expr(RELEASE_EXPRESSION), "month": F.expr(MONTH_EXPRESSION)}
    )


def record_rows(rows: DataFrame) -> DataFrame:
    """The records of `customer_orders` rows, with position."""
    return rows.select(
        *[F.expr(text).alias(name) for name, text in RECORD_EXPRESSIONS.items()],
        F.col(POSITION).alias("_source_row"),
        "release",
        "month",
    )


def derived_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records with position and `release`, as expressions over the given tables."""
    return record_rows(customer_orders(spark, sf_dir))


def dealt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in tasks of like size, sorted by release: rows are dealt and sorted before they are spelled out."""
    tasks = max(listing_tasks(spark), spark.read.parquet(f"{sf_dir}/orders.parquet").count() // TASK_ROWS)
    return record_rows(customer_orders(spark, sf_dir).repartition(tasks, POSITION).sortWithinPartitions("release"))


def write_records(spark: SparkSession, sf_dir: str) -> str:
    """The records as a Parquet table with one partition per release. Returns its path."""
    path = scratch_folder(spark, "records")
    dealt_records(spark, sf_dir).write.partitionBy("release").parquet(path)
    return path


_written: dict[tuple, str] = {}
_writing = threading.RLock()


def once(write: Callable[..., str], spark: SparkSession, sf_dir: str, *more: str) -> str:
    """What `write` returns; it runs once per application, data folder and further arguments."""
    key = (write.__name__, spark.sparkContext.applicationId, sf_dir, *more)
    with _writing:
        if key not in _written:
            _written[key] = write(spark, sf_dir, *more)
        return _written[key]


def directory_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, read from their table as a pipeline reads Bronze."""
    return spark.read.parquet(once(write_records, spark, sf_dir))


def release(records: DataFrame, name: str) -> DataFrame:
    return records.where(F.col("release") == name)
