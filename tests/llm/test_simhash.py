"""SimHash groups against a brute-force version."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from rosterlake.llm.simhash import (
    ball,
    fingerprint_groups,
    fingerprint_of,
    near_fingerprints,
    segments,
    simhash_groups,
    without_near_copies,
)

SCHEMA = "doc_id long, text string, fp string, component_id int"


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs, near):
    root = {i: i for i, _ in pairs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in pairs:
        for j, b in pairs:
            if i < j and near(a, b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in pairs}


def texts():
    rng = random.Random(7)
    words = ["ab", "Éc", "DE", "fg", "hij", "k", "l m", "zé", "O"]
    made = [None, "", " \t\n", "one", "One", "a b c", "a  b\x0bc\n", "x " * 3000]
    for _ in range(30):
        base = [rng.choice(words) + str(rng.randrange(50)) for _ in range(rng.randrange(3, 90))]
        made.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "edit"
            made.append(rng.choice([" ", "\n", "  "]).join(copy))
    return made


def test_fingerprints_equal_the_plain_definition():
    for text in texts():
        assert fingerprint_of(text) & (1 << 64) - 1 == slow_fingerprint(text)


@pytest.mark.parametrize(
    ("max_bits", "count"), [(0, None), (1, None), (2, None), (3, None), (4, None), (7, None), (4, 2), (4, 5), (7, 3)]
)
def test_segments_cover_all_bits(max_bits, count):
    parts = segments(max_bits, count)
    assert count is None or len(parts) == count
    assert sum(width for _, width, _ in parts) == 64
    assert sum(radius + 1 for *_, radius in parts) == max_bits + 1


def test_groups_equal_brute_force(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())]
    found = simhash_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [(i, slow_fingerprint(t)) for i, t, *_ in rows]
    expected = slow_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{fp:016x}" for i, fp in fps}
    assert {r.doc_id: r.component_id for r in found} == expected


def test_wrong_numbers_of_segments_are_refused():
    for count in (0, 6):
        with pytest.raises(ValueError, match="1 to 5 segments"):
            segments(4, count)


def test_balls_hold_every_difference_once():
    assert [len(ball(32, radius)) for radius in (0, 1, 2)] == [0, 32, 32 + 496]
    assert sorted(ball(6, 2)) == [m for m in range(1, 64) if m.bit_count() <= 2]


@pytest.mark.parametrize("parts", [None, 2, 5])
def test_every_near_pair_is_found(spark, parts):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(40)}
    for value in list(values):
        for n in range(7):
            values.add(value ^ sum(1 << b for b in rng.sample(range(64), n)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, grp int")
    found = {frozenset((r.a, r.b)) for r in near_fingerprints(frame, 4, parts).collect()}
    expected = {
        frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    }
    assert len(expected) > 200 and found == expected


@pytest.mark.parametrize("parts", [None, 2])
def test_dense_and_chained_fingerprints(spark, parts):
    rng = random.Random(3)
    values = {0, 15, 0xFF, 0xFFF, (1 << 64) - 1}
    centre = rng.getrandbits(64)
    for _ in range(250):
        values.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1)
    values |= {rng.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = fingerprint_groups(spark.createDataFrame([(v,) for v in signed], "fp long"), parts=parts).collect()
    expected = slow_components([(v, v) for v in signed], lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert len(found) == len(signed)
    assert {r.fp: r.root for r in found} == expected


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, None)], "doc_id long, text string")
    found = simhash_groups(frame).groupBy("doc_id", "component_id").agg(F.count("*").alias("n")).collect()
    assert {(r.doc_id, r.component_id, r.n) for r in found} == {(1, 1, 2), (None, 1, 1), (2, 2, 1)}
    assert simhash_groups(frame.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "one", "x"), (None, "only here", "x"), (None, "only here", "x"), (20, "another text of 20", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, text_key string")
    kept = without_near_copies(frame)
    groups = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_groups(frame).collect()}
    assert kept.columns == frame.columns
    found = [(r.doc_id, f"{slow_fingerprint(r.text):016x}") for r in kept.collect()]
    assert len(found) == len(set(found)) == 1 + len({(c, f if c is None else 0) for (_, f), c in groups.items()})
    assert all(groups[f] == f[0] for f in found)
    assert sum(i == 20 for i, _ in found) == 2  # two groups, each with this smallest id
    assert without_near_copies(frame.limit(0)).count() == 0
