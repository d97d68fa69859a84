"""Gold tables and views in the catalog.

Each replacement loads new versions of all tables. The names that readers use are views that pick the
version that one more view names, `current_version`, so a single step switches all tables. Within a
query Spark looks each view up once, so all tables that it reads are of one version.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterlake.errors import ReconciliationError
from rosterlake.layout import DirectoryProfile
from rosterlake.operators.gold import QUERIES, VIEWS, code_list
from rosterlake.sources.tables import row_count

TABLES = ("providers", "provider_taxonomies")
POINTER = "current_version"
_LOW = 0xFFFFFFFF


def content_sums(columns: list[str]) -> dict[str, Column]:
    """V8: aggregates that tell multisets of rows apart, in any order: their number and sums of two row hashes.

    Null flags are hashed along, since hashes skip nulls. Halves are
    summed as decimals, so no number of rows overflows.
    """
    own = [F.col(f"`{c}`") for c in columns]
    flags = [c.isNull() for c in own]
    sums = {"rows": F.count(F.lit(1))}
    for n, mixed in enumerate((F.xxhash64(*own, *flags), F.xxhash64(F.lit(1), *flags, *own))):
        sums[f"low_{n}"] = F.coalesce(F.sum(mixed.bitwiseAND(_LOW).cast("decimal(20,0)")), F.lit(0))
        sums[f"high_{n}"] = F.coalesce(F.sum(F.shiftrightunsigned(mixed, 32).cast("decimal(20,0)")), F.lit(0))
    return {name: column.alias(name) for name, column in sums.items()}


def content(frame: DataFrame) -> dict[str, int]:
    """The sums of a table's rows."""
    return frame.agg(*content_sums(sorted(frame.columns)).values()).first().asDict()


def current_version(spark: SparkSession, database: str) -> str | None:
    """The version that readers see, if tables have been published."""
    try:
        return spark.table(f"{database}.{POINTER}").first().version
    except AnalysisException:
        return None


def _load(spark: SparkSession, path: str, loaded: str, buckets: int | None) -> tuple[int, dict, dict]:
    """(source rows, sums of the rows that went in, sums of the rows that came out)."""
    frame = spark.read.parquet(path)
    rows, seen = row_count(spark, path), Observation()
    if buckets:
        frame = frame.repartition(buckets, "npi")
    # behind the shuffle, so that the writing tasks count, each once
    writer = frame.observe(seen, *content_sums(sorted(frame.columns)).values()).write.format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, "npi").sortBy("npi")
    writer.saveAsTable(loaded)
    return rows, seen.get, content(spark.table(loaded))


def _view(table: str, database: str, versions: list[str]) -> str:
    """The rows of the version that the pointer names; all other branches are folded away."""
    pointer = f"(SELECT version FROM {database}.{POINTER})"
    parts = [f"SELECT * FROM {database}.{table}__{v} WHERE {pointer} = '{v}'" for v in versions]
    known = ", ".join(f"'{v}'" for v in versions)
    # a query that is planned while tables are replaced may know the views of before and the pointer of after
    parts.append(
        f"SELECT * FROM {database}.{table}__{versions[0]} WHERE {pointer} NOT IN ({known})"
        " AND raise_error('The tables were replaced while the query was planned; run it again') IS NULL"
    )
    return f"CREATE OR REPLACE VIEW {database}.{table} AS {' UNION ALL '.join(parts)}"


def _point(spark: SparkSession, database: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{POINTER} AS SELECT '{version}' AS version")


def replace_tables(
    spark: SparkSession, sources: dict[str, str], database: str, buckets: int | None = None
) -> dict[str, tuple[int, int]]:
    """Load new versions of all tables, compare counts and contents, then switch.

    The switch is one step for all tables: a reader finds whole tables of one version. A load that
    fails, or that does not hold its source's rows, drops its own version and nothing else. The
    version before stays until the next replacement, for queries that have begun on it; of two
    writers at a time, the one that switches last wins. With `buckets`, all versions are clustered
    by provider, so joins between them need no shuffle.
    """
    version = f"{time.time_ns():016x}_{uuid.uuid4().hex[:8]}"  # names sort by age
    before = current_version(spark, database)
    try:
        counts, wrong = {}, []
        for table, path in sources.items():
            rows, read, loaded = _load(spark, path, f"{database}.{table}__{version}", buckets)
            counts[table] = (rows, loaded["rows"])
            if rows != loaded["rows"]:
                wrong.append(f"{table}: {rows} source rows, {loaded['rows']} loaded rows")
            elif read != loaded:
                wrong.append(f"{table}: the {rows} loaded rows are not those of the source")
        if wrong:
            raise ReconciliationError("; ".join(wrong))
    except BaseException:
        for table in sources:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{table}__{version}")
        raise
    if before is None:
        _point(spark, database, version)
    for table in sources:
        spark.sql(_view(table, database, [version, before] if before else [version]))
    _point(spark, database, version)
    for table in sources:
        listed = spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__*'").collect()
        for name in sorted(found.tableName for found in listed):
            if before and name < f"{table}__{before}":
                spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return counts


def reconciliation(spark: SparkSession, sources: dict[str, str], database: str) -> DataFrame:
    """V8: per published table (table_name, source_rows, loaded_rows, content_matches)."""
    sides = []
    for table, path in sources.items():
        for side, frame in (("source", spark.read.parquet(path)), ("loaded", spark.table(f"{database}.{table}"))):
            sums = content_sums(sorted(frame.columns)).values()
            sides.append(frame.agg(*sums).select(F.lit(table).alias("table_name"), F.lit(side).alias("side"), "*"))
    both = reduce(DataFrame.unionByName, sides).groupBy("table_name")
    own = lambda side: F.max(F.when(F.col("side") == side, F.col("rows")))
    sums = [c for c in sides[0].columns if c not in ("table_name", "side")]
    return both.agg(
        own("source").alias("source_rows"),
        own("loaded").alias("loaded_rows"),
        (F.count_distinct(F.struct(*sums)) == 1).alias("content_matches"),
    )


def _qualified(text: str, database: str, profile: DirectoryProfile) -> str:
    names = {name: f"{database}.{name}" for name in (*TABLES, *VIEWS)}
    return text.format(**names, cohort_codes=code_list(profile))


def replace_views(
    spark: SparkSession, database: str, profile: DirectoryProfile = DirectoryProfile()
) -> None:
    """K6: the four views over the catalog tables."""
    for name, text in VIEWS.items():
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} AS {_qualified(text, database, profile)}"
        )


def gold_query(
    spark: SparkSession, name: str, database: str, profile: DirectoryProfile = DirectoryProfile()
):
    """Q1-Q7 over the catalog."""
    return spark.sql(_qualified(QUERIES[name], database, profile))
