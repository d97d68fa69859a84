"""Helpers that several operators share: stored intermediate tables, components, clean names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rosterlake.session import remove_folder, scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    This cuts lineage and outlives any executor: a lost task reads the files again.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, purpose)
    df.write.parquet(folder)
    found = spark.read.schema(df.schema).parquet(folder)
    found.stored_folder = folder
    return found


def discard(*tables: DataFrame) -> None:
    """Removes what `stored` has written, once what was made of it is stored itself."""
    for df in tables:
        remove_folder(df.sparkSession, df.stored_folder)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over `links` (a, b), for each linked node.

    Alternates large-star and small-star steps, each a grouping with partial minima and a join
    that adaptive execution can split, so that a node with a third of all links is no one task's
    burden. Self-links are ignored; nodes without links get no row. Nodes must not be null.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "components",
    )
    state = _state(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = stored(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.*").where(F.col("u") != F.col("v")).distinct(), "components")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(roots)
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(mixed.bitwiseAND(0xFFFFFFFF)),
            F.sum(F.shiftrightunsigned(mixed, 32)),
        ).first()
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the rows do not have yet."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def appended(df: DataFrame, text_col: str, fields: dict[str, str], work: Callable[[list], list[list]]) -> DataFrame:
    """The rows with new columns that `work` computes from the texts of an Arrow batch.

    `fields` maps each new column to its DDL type; `work` returns one list of values per field.
    Other columns pass through as they are.
    """
    schema = StructType([*df.schema, *StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in fields.items()))])
    kinds = [f.type for f in to_arrow_schema(StructType(schema.fields[len(df.columns) :]))]
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = work(batch.column(at).to_pylist())
            new = [pa.array(v, type=kind) for v, kind in zip(values, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)
