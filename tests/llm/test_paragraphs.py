"""Paragraph classes against brute-force Jaccard similarities."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import paragraphs
from rosterlake.llm.paragraphs import (
    band_hashes,
    bands_for,
    paragraphs_of,
    repeated_paragraphs,
    shingled,
    without_repeated_paragraphs,
)
from test_simhash import slow_components


def shingles(paragraph):
    words = paragraph.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    return len(a & b) >= 0.8 * len(a | b) - 1e-9


def corpus(seed=3):
    rng = random.Random(seed)
    words = [a + b for a in "bdfgkl" for b in ("a", "É", "on", "ti")]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [line(n) for n in (1, 3, 4, 5, 9, 10, 30, 60, 61, 200)]

    def edited(text):
        own = text.split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(own) + 1)
            own[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
        return rng.choice([" ", "\t"]).join(own)

    texts = [None, "", " \n\t\n", "\n\n".join(shared)]
    for _ in range(70):
        own = [line(rng.randrange(1, 80)) for _ in range(rng.randrange(4))]
        own += [edited(rng.choice(shared)) for _ in range(rng.randrange(4))]
        rng.shuffle(own)
        texts.append(rng.choice(["\n", "\r\n", "\n \n"]).join(own))
    rows = [(i * 2, t) for i, t in enumerate(texts)]
    return rows + [(8, texts[4]), (8, texts[4]), (None, texts[3]), (3, texts[3].upper()), (5, "a b c d e\na b c d e")]


def expected(rows):
    found = [(r, no, shingles(p)) for r, (_, t) in enumerate(rows) for no, p in enumerate(paragraphs_of(t))]
    root = slow_components([(i, s) for i, (*_, s) in enumerate(found)], similar)
    classes = {}
    for i, (r, no, _) in enumerate(found):
        classes.setdefault(root[i], []).append((rows[r][0] is None, rows[r][0] or 0, r, no))
    out = {r: [] for r in range(len(rows))}
    for members in classes.values():
        for member in members:
            if len(members) > 1:
                out[member[2]].append((member[3], None if member == min(members) else min(members)[:2]))
    return out


ROWS = corpus()
EXPECTED = expected(ROWS)


def test_classes_equal_brute_force(spark):
    frame = spark.createDataFrame([(r, i, t) for r, (i, t) in enumerate(ROWS)], "row long, id long, text string")
    found = {r.row: r for r in repeated_paragraphs(frame.repartition(3)).collect()}
    assert len(found) == len(ROWS)
    for r, (i, text) in enumerate(ROWS):
        own = sorted(EXPECTED[r], key=lambda x: x[0])
        assert (found[r].id, found[r].n_paragraphs, found[r].n_repeated) == (i, len(paragraphs_of(text)), len(own))
        gone = [(no, keeper) for no, keeper in own if keeper is not None]
        assert found[r].removed == [no for no, _ in gone]
        assert found[r].kept_in == [None if unknown else keeper for _, (unknown, keeper) in gone]


def test_embedded_passages_are_found(spark):
    rng = random.Random(12)
    words = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "")]

    def prose(n):
        own = [rng.choice(words) + rng.choice([""] * 9 + [".", "!"]) for _ in range(n)]
        return " ".join(own)

    passage = ". ".join(prose(12) for _ in range(5))
    rows = [(k, prose(40) + " and " + passage.replace(" ", "\n" if k == 3 else " ", 9) + " so " + prose(40)) for k in range(2, 5)]
    rows += [(k, prose(150)) for k in range(10, 20)] + [(30, None), (31, ""), (None, passage)]
    frame = spark.createDataFrame([(r, i, t) for r, (i, t) in enumerate(rows)], "row long, id long, text string")
    found = {r.id: r for r in repeated_paragraphs(frame).collect()}
    assert found[2].n_passages > 0 and found[2].passages_in == []
    assert found[4].passages_in == [2] and found[None].passages_in == [2]
    assert all(found[i].n_passages == 0 for i in [*range(10, 20), 30, 31])
    counts = {}
    for _, text in rows:
        for p in paragraphs.passages_of(text):
            counts[p] = counts.get(p, 0) + 1
    assert {i: r.n_passages for i, r in found.items()} == {
        i: sum(counts[p] > 1 for p in paragraphs.passages_of(t)) for i, t in rows
    }


def test_passages():
    assert paragraphs.passages_of("A b. C d e\nF! g", 3) == [b"a b. c d e", b"c d e"]
    assert paragraphs.passages_of(None) == paragraphs.passages_of(" \n") == paragraphs.passages_of("a b c.") == []


def test_texts_lose_their_repeats(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, row string")
    out = without_repeated_paragraphs(frame)
    assert out.columns == frame.columns
    left = out.collect()
    assert len(left) == len(ROWS)
    everything = [p for r in left for p in paragraphs_of(r.text)]
    removed = sum(keeper is not None for own in EXPECTED.values() for _, keeper in own)
    assert len(everything) == sum(len(paragraphs_of(t)) for _, t in ROWS) - removed
    assert len({frozenset(shingles(p)) for p in everything}) == len(everything)
    assert out.where(F.col("doc_id") == 0).first().text is None


def test_bands_find_pairs_at_the_threshold():
    rng, bands = np.random.default_rng(8), bands_for()
    both = [rng.integers(0, 1 << 63, 100, dtype=np.uint64) for _ in range(1500)]
    a, b = (np.concatenate([x[i : i + 90] for x in both]) for i in (0, 10))  # similarity 0.8
    offsets = np.arange(0, 1501 * 90, 90)
    found = (band_hashes(a, offsets, bands) == band_hashes(b, offsets, bands)).any(axis=1)
    assert found.mean() >= 0.99


@pytest.mark.parametrize("n", range(1, 12))
def test_small_sets_need_to_be_equal(n):
    own = np.arange(10, 10 + n, dtype=np.uint64)
    offsets, rng = np.array([0, n, 4 * n]), np.random.default_rng(n)
    one, other = band_hashes(np.concatenate([own, rng.permutation(np.tile(own, 3))]), offsets, 6)
    assert (one == other).all()
    assert (len(set(one.tolist())) == 1) == (n / (n + 1) < 0.8)


def test_shingles_of_long_contents(monkeypatch):
    words = [f"w{i}" for i in range(700)]
    contents = [" ".join(words[a:b]).encode() for a, b in ((0, 700), (0, 1), (5, 9), (5, 10), (100, 700), (0, 4))]
    plain, offsets = shingled(contents)
    assert np.diff(offsets).tolist() == [696, 1, 1, 1, 596, 1]
    assert (plain[5:6] != plain[0]).all() and plain[offsets[3]] == plain[5]
    assert np.array_equal(plain[100:696], plain[offsets[4] : offsets[5]])
    assert len(np.unique(plain)) == 696 + 3
    monkeypatch.setattr(paragraphs, "_PART", 300)
    again, same = shingled(contents)
    assert np.array_equal(plain, again) and np.array_equal(offsets, same)


def test_empty_table(spark):
    assert repeated_paragraphs(spark.createDataFrame([], "row long, id long, text string")).count() == 0


def test_members_are_compared_in_a_keyed_join(spark):
    frame = spark.createDataFrame([(r, i, t) for r, (i, t) in enumerate(ROWS)], "row long, id long, text string")
    frame = frame.withColumn("k", F.xxhash64("id", "text"))
    bands = bands_for()
    found = paragraphs._paragraph_rows(frame, bands, 0.8).where("no IS NOT NULL")
    firsts = [F.first(c).alias(c) for c in ("k", "no", *[f"b{i}" for i in range(bands)])]
    links = paragraphs._similar_links(found.groupBy("h").agg(F.count("*").alias("n"), *firsts), frame, bands, 0.8)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
