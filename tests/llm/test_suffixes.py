"""Removal of repeated byte strings against a brute-force version, with short thresholds."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rosterlake.llm import suffixes
from rosterlake.llm.queries import QUERIES
from rosterlake.llm.suffixes import anchors, parts, without_repeats


def slow(texts, least):
    seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for text in texts:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - least + 1):
            if seen[text[i : i + least]] > 1:
                gone[i : i + least] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((len(text), [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)], kept))
    return out


def corpus(least, seed):
    rng = random.Random(seed)
    text = lambda n, letters="abcdefgh é\n": "".join(rng.choice(letters) for _ in range(n))
    passages = [text(least + rng.randrange(-6, 3 * least)) for _ in range(8)]
    made = [None, "", "a", text(least), "z" * (4 * least), "ab" * (3 * least), text(9 * least, "xy")]
    for _ in range(25):
        made.append(text(rng.randrange(2 * least)) + rng.choice(passages) + text(rng.randrange(2 * least)))
    base = text(12 * least)
    for _ in range(10):  # near copies
        at = rng.randrange(len(base))
        made.append(base[:at] + "#" * rng.randrange(3) + base[at + rng.randrange(3) :])
    shared = text(least - 1)  # a passage just too short, in many texts
    made += [text(20) + shared + text(20) for _ in range(20)]
    made += [passages[0], passages[0], passages[1] + passages[1]]
    return made


@pytest.mark.parametrize(("least", "gram", "seed"), [(40, 5, 1), (40, 10, 2), (64, 8, 3), (33, 33, 4)])
def test_spans_equal_brute_force(spark, least, gram, seed):
    texts = corpus(least, seed)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, None, "x"), (5, texts[5], "x"), (None, texts[9], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, k string").repartition(4)
    found = without_repeats(frame, least=least, gram=gram).collect()
    plain = slow([(t or "").encode() for _, t, _ in rows], least)
    wanted = Counter((i, n, tuple(spans), kept) for (i, *_), (n, spans, kept) in zip(rows, plain, strict=True))
    assert Counter((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in found) == wanted
    assert any(r.spans for r in found) and any(not r.spans and r.n_bytes > least for r in found)


def test_every_window_has_one_anchor_that_its_bytes_decide():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 30, 1000, 1000, 4950, 5000])
    first, last, at, _ = anchors(data, offsets, 60, 10)
    covered, places = [], {}
    for a, b, x in zip(first, last, at, strict=True):
        for s in range(a, b + 1):
            covered.append(s)
            places.setdefault(data[s : s + 60].tobytes(), set()).add(int(x - s))
            assert 0 <= x - s <= 50
    starts = [s for a, b in zip(offsets, offsets[1:], strict=False) for s in range(a, b - 59)]
    assert covered == starts and all(len(p) == 1 for p in places.values())


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_PART", 1000)
    offsets = np.array([0, 400, 900, 5000, 5100])
    got = list(parts(offsets, 40))
    windows = [s for a, b, start, end in got for lo, hi in [(start, end)] for s in range(lo, hi - 39)]
    inside = [s for a, b in zip(offsets, offsets[1:], strict=False) for s in range(a, b - 39)]
    assert set(inside) <= set(windows) and all(end - start <= 1000 for *_, start, end in got)
    long = [(a, start, end) for a, b, start, end in got if a == 2 and b == 3]
    assert [e for *_, e in long][:-1] == [s + 39 for _, s, _ in long][1:]


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_suffix_dedup"](spark, sf).collect()}
    for (doc, _), (n, spans, kept) in zip(docs, slow([t for _, t in docs], 400), strict=True):
        removed = sum(b - a for a, b in spans)
        assert found[doc][:4] == (n, removed, len(spans), hashlib.sha256(kept).hexdigest())
    again = slow_passages([t for _, t in docs], 51)
    assert {doc for doc, row in found.items() if row[4]} == {doc for (doc, _), hit in zip(docs, again, strict=True) if hit}
    assert 0 < sum(again) < len(docs)


def slow_passages(texts, least):
    """Whether some `least` words of each text stand anywhere else."""
    own = [[tuple(w[i : i + least]) for i in range(len(w) - least + 1)] for w in (t.split() for t in texts)]
    seen = Counter(window for windows in own for window in windows)
    return [any(seen[w] > 1 for w in windows) for windows in own]


@pytest.mark.parametrize(("least", "gram", "seed"), [(6, 2, 1), (9, 3, 2), (12, 4, 3), (5, 5, 4)])
def test_passages_equal_brute_force(spark, least, gram, seed, monkeypatch):
    rng = random.Random(seed)
    words = lambda n, k=400: [f"{rng.choice('aé b'.split())}{rng.randrange(k)}" for _ in range(n)]
    shared = [words(least + rng.randrange(-1, 3)) for _ in range(30)]
    texts = [" ".join([*words(rng.randrange(40)), *rng.choice(shared), *words(rng.randrange(40))]) for _ in range(60)]
    common = words(gram + 1)  # a phrase too short, in many texts
    texts += [" \n".join([*words(20), *common, *words(20)]) for _ in range(60)]
    base = words(8 * least)
    texts += [" ".join([*base[:i], "#", *base[i + 1 :]]) for i in range(0, 8 * least, 3)]
    texts += ["", " ", "z " * (4 * least), "y " * (least - 1), "y " * least, " ".join(words(30, 2)), texts[0], "w" * 5000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string").repartition(4)
    wanted = {i for i, hit in enumerate(slow_passages([t.encode() for t in texts], least)) if hit}
    assert {r.k for r in suffixes.repeated_passages(frame, least, gram).collect()} == wanted
    assert 10 < len(wanted) < len(texts) - 10


def test_passages_of_long_texts_are_read_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    text = " ".join(f"w{x}" for x in rng.integers(0, 50, 5000)).encode()
    whole = suffixes._text_words(memoryview(text))
    monkeypatch.setattr(suffixes, "_PART", 700)
    assert np.array_equal(suffixes._text_words(memoryview(text)), whole)
    monkeypatch.setattr(suffixes, "_WORDS", 512)
    starts = [at + s for at, (first, last, *_) in suffixes.word_anchors(whole, 20, 4) for a, b in zip(first, last, strict=True) for s in range(a, b + 1)]
    assert starts == list(range(len(whole) - 19))
