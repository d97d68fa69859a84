"""Shards of bounded bytes by extendible hashing, in DataFrame functions only."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import stored

KEY_BITS, ROW_BITS = 28, 32
BITS = KEY_BITS + ROW_BITS
SHARD_BYTES = 1 << 20
#: Bits by which the directory is finer than shards of even size would need.
SPARE_BITS = 6


def _bits(digest: Column, first: int, width: int) -> Column:
    """`width` bits of a hexadecimal digest, from its digit `first` (from 1) on."""
    return F.conv(F.substring(digest, first, width // 4), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftright("h", BITS - depth)


def shard_ids(
    rows: DataFrame, key_col: str, bytes_col: str, max_bytes: int = SHARD_BYTES, content_col: str | None = None
) -> DataFrame:
    """(key, n_bytes, shard, depth, shard_rows, shard_bytes) for each row of `rows`.

    A shard is a hash prefix of `depth` bits, given as a string of 0 and 1 (empty: everything).
    Only buckets above `max_bytes` with more than one row are split, each on its next bit, so no
    shard is larger unless it is a single row. The first 28 bits come from the key; should a key
    be too large for a shard, 32 more come from its content and row, so a key that holds a third
    of all rows is split as well. Null keys are one key, null bytes count as 0, repeated rows are
    rows of their own, an empty table gives no rows.
    """
    key = F.coalesce(F.col(key_col).cast("string"), F.lit("null"))
    content = F.col(content_col).cast("string") if content_col else F.lit("")
    narrow = stored(
        rows.select(
            F.col(key_col).alias("key"),
            F.coalesce(F.col(bytes_col).cast("long"), F.lit(0)).alias("n_bytes"),
            (
                _bits(F.md5(key), 1, KEY_BITS) * F.lit(1 << ROW_BITS)
                + _bits(F.md5(F.concat_ws(":", key, content, F.monotonically_increasing_id().cast("string"))), 1, ROW_BITS)
            ).alias("h"),
        ),
        "sharding",
    )
    total = narrow.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    depth = min(BITS, max(1, math.ceil(math.log2(max(1, total / max_bytes))) + SPARE_BITS))
    parts, open_rows, base = [], narrow, 0
    while True:
        nodes = stored(_nodes(open_rows, base, depth, max_bytes), "shard-nodes")
        parts.append(_assigned(open_rows, nodes, base, depth))
        still = nodes.where((F.col("d") == depth) & ~F.col("fits")).select(F.col("p").alias("cell"))
        if still.isEmpty():
            break
        # only rows of buckets that are still too large are looked at again
        open_rows = open_rows.withColumn("cell", _prefix(depth)).join(still, "cell", "left_semi").drop("cell")
        base, depth = depth, min(BITS, depth + 2 * SPARE_BITS)
    return _named(reduce(DataFrame.unionByName, parts)).withColumnRenamed("key", key_col)


def _nodes(rows: DataFrame, base: int, depth: int, max_bytes: int) -> DataFrame:
    """(d, p, bytes, n, fits): the buckets of every prefix length from base to depth."""
    cells = rows.groupBy(_prefix(depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
    up = cells.select(F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("d"), "cell", "bytes", "n")
    nodes = up.groupBy("d", _above(depth).alias("p")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    return nodes.withColumn("fits", (F.col("bytes") <= max_bytes) | (F.col("n") <= 1) | (F.col("d") >= BITS))


def _above(depth: int) -> Column:
    """The first `d` bits of `cell`, which has `depth`."""
    return F.call_function("shiftright", F.col("cell"), (F.lit(depth) - F.col("d")).cast("int"))


def _assigned(rows: DataFrame, nodes: DataFrame, base: int, depth: int) -> DataFrame:
    """The rows whose bucket fits, with that bucket, through the directory of all cells."""
    parents = nodes.where(~F.col("fits")).select((F.col("d") + 1).alias("d"), F.col("p").alias("above"))
    split = nodes.withColumn("above", F.shiftright("p", 1)).join(parents, ["d", "above"], "left_semi").drop("above")
    whole = nodes.where((F.col("d") == 0) & (F.lit(base) == 0))
    leaves = split.unionByName(whole).where("fits").select("d", "p", "bytes", "n")
    cells = nodes.where(F.col("d") == depth).select(F.col("p").alias("cell"))
    up = cells.select("cell", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("d")).withColumn("p", _above(depth))
    directory = up.join(leaves, ["d", "p"])
    return rows.withColumn("cell", _prefix(depth)).join(directory, "cell").drop("cell")


def _named(rows: DataFrame) -> DataFrame:
    bits = F.when(F.col("d") == 0, F.lit("")).otherwise(F.lpad(F.bin("p"), F.col("d"), F.lit("0")))
    return rows.select(
        "key",
        "n_bytes",
        bits.alias("shard"),
        F.col("d").cast("int").alias("depth"),
        F.col("n").alias("shard_rows"),
        F.col("bytes").alias("shard_bytes"),
    )
