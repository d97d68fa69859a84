"""Benchmark hits against a brute-force version."""

import hashlib
import pickle
import random
import re

import numpy as np
import pytest

from rosterlake.llm.decontamination import SLICE_BYTES, Windows, WindowTable, benchmark_hits, decontaminated, without
from rosterlake.llm.queries import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(text, items, window=13):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        tested = words(other)
        length = min(window, len(tested))
        wanted = {tuple(tested[i : i + length]) for i in range(len(tested) - length + 1)} if tested else set()
        for i in range(len(own) - length + 1 if wanted else 0):
            if tuple(own[i : i + length]) in wanted:
                hit.update(range(i, i + length))
                found.add(item)
    return len(own), sorted(hit), found


def cases():
    rng = random.Random(5)
    vocabulary = ["the", "of", "é", "Ab1", "x", "ñu", "end"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 5, 13, 14, 30]))) for i in range(15)]
    items += [(90, None), (91, " ,."), (92, items[4][1]), (93, items[4][1].upper()), (4, items[4][1])]
    docs = [None, "", "  ", "...", text(3000)]
    for _ in range(40):
        inside = rng.choice(items[:15])[1]
        docs.append(text(rng.randrange(60)) + inside + text(rng.randrange(60)))
    return list(enumerate(docs)) + [(5, docs[5])], items


@pytest.mark.parametrize("slice_bytes", [1 << 24, 200])
def test_hits_equal_brute_force(spark, slice_bytes):
    docs, items = cases()
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, benchmark_hits string")
    benchmark = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    rows, name = benchmark_hits(frame, benchmark, slice_bytes=slice_bytes)
    found = rows.collect()
    assert rows.columns == [*frame.columns, name] and len(found) == len(docs)
    for row in found:
        n, hit, ids = slow(row.text, items)
        spans = [tuple(s) for s in row[name].spans]
        assert (row[name].n_words, row[name].n_hit) == (n, len(hit))
        assert sorted(row[name].item_ids) == sorted(ids)
        assert [i for a, b in spans for i in range(a, b)] == hit
        assert all(spans[k][1] < spans[k + 1][0] for k in range(len(spans) - 1))


def test_removal(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    judged = {i: slow(t, items) for i, t in docs}
    kept = [i for i, t in docs if not (judged[i][1] and 20 * len(judged[i][1]) >= judged[i][0])]
    assert sorted(r.doc_id for r in decontaminated(frame, benchmark).collect()) == sorted(kept)
    for row in decontaminated(frame, benchmark, remove="spans").collect():
        hit = set(judged[row.doc_id][1])
        assert words(row.text) == [w for k, w in enumerate(words(dict(docs)[row.doc_id])) if k not in hit]
    assert without("A, b-c d!", [{"start": 1, "end": 3}]) == "A,  d!"


def test_a_full_slice_takes_little_memory():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 200_000, SLICE_BYTES // 7)
    items = [(k, " ".join(f"w{x}" for x in part)) for k, part in enumerate(np.array_split(words, 4000))]
    assert sum(len(t) for _, t in items) > SLICE_BYTES * 0.9
    windows = Windows(items)
    assert len(pickle.dumps(windows)) < 90 << 20
    arrays = sum(a.nbytes for t in windows.tables for a in (t.hashes, t.places, t.items, t.offsets)) + windows.known.nbytes
    assert arrays < 80 << 20
    n, spans, found = windows.hits("x " + items[7][1] + " y " + " ".join(items[9][1].split()[:12]))
    assert (spans, found) == ([(1, 1 + len(items[7][1].split()))], [7]) and n > 600


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    """Hashes that differ in the lowest bit only: most windows collide until other ones are tried."""
    plain, tries = WindowTable.hashed, []

    def poor(self, numbers, starts):
        tries.append(self.seed)
        hashes = plain(self, numbers, starts)
        return hashes & np.uint64(1) if self.seed < 2 else hashes

    monkeypatch.setattr(WindowTable, "hashed", poor)
    docs, items = cases()
    windows = Windows(items)
    assert max(tries) == 2
    for _, text in docs:
        n, hit, ids = slow(text, items)
        found = windows.hits(text)
        assert (found[0], [i for a, b in found[1] for i in range(a, b)]) == (n, hit) and {*found[2]} == ids


def test_empty_tables(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminated(frame, benchmark.limit(0)).count() == len(docs)
    assert decontaminated(frame.limit(0), benchmark).count() == 0


def test_query(spark, tmp_path):
    docs, items = cases()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for row in QUERIES["op4_benchmark_decontamination"](spark, str(tmp_path)).collect():
        n, hit, ids = slow(dict(docs)[row.doc_id], items)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, len(hit), len(ids), digest)
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= n)
