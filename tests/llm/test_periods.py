"""Periodic runs of words against comparing every word with every other."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from rosterlake.llm.periods import WaveletMatrix, periodic_runs, runs, word_hashes
from rosterlake.llm.queries import QUERIES


def slow(words, least=12):
    """{(start, end): smallest period} of all maximal runs."""
    values = np.unique(np.array([hash(w) for w in words], np.int64), return_inverse=True)[1]
    found = {}
    for q in range(1, len(words) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (values[:-q] == values[q:]).astype(np.int8), [0]])))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end + q - start >= max(least, 2 * q):
                found.setdefault((start, end + q), q)
    return found


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    rows = sorted(((s, e - s, q) for (s, e), q in slow(words).items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, size, q in rows for i in range(s + q, s + size)}
    best = min(rows, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(rows), *best, best[1] and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in rows).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def made(seed):
    rng = random.Random(seed)
    for _ in range(150):
        n, letters = rng.randrange(90), rng.choice([1, 2, 2, 3, 5, 50])
        words = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words
    yield fibonacci(300)
    yield [bin(i).count("1") % 2 for i in range(256)]
    yield [7] * 500
    yield ([1] * 40 + [2]) * 6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_equal_brute_force(seed):
    texts = list(made(seed))
    random.Random(seed).shuffle(texts)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    wanted = [(s + o, e + o, q) for t, o in zip(texts, offsets.tolist(), strict=False) for (s, e), q in slow(t).items()]
    found = [tuple(r) for r in runs(np.array([w for t in texts for w in t], np.int64), offsets).tolist()]
    assert found == sorted(wanted, key=lambda r: (r[0], r[2])) and len(found) > 100


def test_order_queries():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        matrix = WaveletMatrix(values)
        low = rng.integers(0, n, 200)
        high = low + 1 + (rng.random(200) * (n - low)).astype(np.int64)
        bound = rng.integers(0, 2 * n + 2, 200)
        parts = [np.sort(values[a:b]) for a, b in zip(low, high, strict=True)]
        assert matrix.below(low, high, bound).tolist() == [int((p < x).sum()) for p, x in zip(parts, bound, strict=True)]
        k = (rng.random(200) * (high - low)).astype(np.int64)
        assert matrix.smallest(low, high, k).tolist() == [int(p[i]) for p, i in zip(parts, k, strict=True)]


def test_words_are_parted_by_ascii_space_only():
    text = "é\x1cb c\tb b\n\r\x0b\x0cé\x1cb c  ".encode()
    start, end, hashes = word_hashes(np.frombuffer(text, np.uint8))
    words = [text[a:b] for a, b in zip(start, end, strict=True)]
    assert words == text.split() and len(set(words)) == len(set(hashes.tolist())) == 2


def test_edge_rows(spark):
    loop = " ".join(f"w{i % 5}" for i in range(40))
    rows = [(1, None, "a"), (2, "", "b"), (None, loop, None), (3, "x " * 11, "c"), (3, "x " * 12, "c"), (3, "x " * 12, "c"), (4, "word " * 300_000, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, found string").repartition(3)
    out, name = periodic_runs(frame)
    assert name == "_found" and out.columns == ["doc_id", "text", "found", "_found"]
    got = sorted(((r.doc_id or 0, r["_found"].n_runs, r["_found"].length, r["_found"].period) for r in out.collect()), key=str)
    assert got == sorted([(0, 1, 40, 5), (1, 0, None, None), (2, 0, None, None), (3, 0, None, None), (3, 1, 12, 1), (3, 1, 12, 1), (4, 1, 300_000, 1)], key=str)
    kept = {r.doc_id: bytes(r["_found"].collapsed) for r in out.where("doc_id is null or doc_id = 4").collect()}
    assert kept == {None: b"w0 w1 w2 w3 w4", 4: b"word"}
    assert periodic_runs(frame.limit(0))[0].collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf = f"/root/testdata/{sf}"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    frame = QUERIES["op13_periodic_runs"](spark, sf)
    assert frame.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = sorted(tuple(r) for r in frame.collect())
    assert found == sorted(expected(*d) for d in docs) and sum(r[1] for r in found) > 5
