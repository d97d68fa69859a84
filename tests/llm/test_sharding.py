"""Extendible hashing: bounded shards, split no further than needed."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rosterlake.llm.sharding import shard_ids


def shards(rows, limit):
    found = defaultdict(list)
    for r in rows:
        found[r.shard].append(r)
    for shard, own in found.items():
        assert {r.depth for r in own} == {len(shard)}
        assert {r.shard_rows for r in own} == {len(own)}
        assert {r.shard_bytes for r in own} == {sum(r.n_bytes for r in own)}
        assert len(own) == 1 or own[0].shard_bytes <= limit
        assert not any(shard != other and shard.startswith(other) for other in found)
    for shard in found:  # its parent was too large
        if shard:
            below = [r for s, own in found.items() if s.startswith(shard[:-1]) for r in own]
            assert len(below) > 1 and sum(r.n_bytes for r in below) > limit
    return found


@pytest.mark.parametrize("limit", [100, 1000, 10**9])
def test_shards_are_bounded(spark, limit):
    rng = random.Random(limit)
    rows = [(i, rng.choice([0, 5, 40, 300]), "extra") for i in range(800)] + [(9, None, "x"), (None, 7, "y")]
    frame = spark.createDataFrame(rows, "doc_id long, n_bytes long, shard string")
    found = shard_ids(frame, "doc_id", "n_bytes", limit)
    assert Counter(r.doc_id for r in found.collect()) == Counter(r[0] for r in rows)
    assert (len(shards(found.collect(), limit)) == 1) == (limit == 10**9)


def test_hot_key_is_split(spark):
    frame = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.lit(50).alias("size")
    )
    found = shard_ids(frame, "key", "size", 5000).collect()
    assert len(found) == 6000
    own = shards(found, 5000)
    assert len([s for s, rows in own.items() if any(r.key == "hot" for r in rows)]) >= 20


def test_empty_table(spark):
    assert shard_ids(spark.createDataFrame([], "k long, b long"), "k", "b").collect() == []
