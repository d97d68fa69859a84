"""Exact nearest examples against brute force, held-out accuracy, and edge cases."""

import math
import random
import zlib

import numpy as np
import pytest

from rosterlake.llm.queries import QUERIES
from rosterlake.llm.toxicity import BlockMaxIndex, _without_near_copies, isotonic, toxicity_scores


def vectors(n, terms, seed):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        own = {rng.randrange(terms): rng.choice([1.0, 2.0, 3.5]) for _ in range(rng.randrange(1, 7))}
        norm = math.sqrt(sum(w * w for w in own.values()))
        made.append({t: w / norm for t, w in own.items()})
    return made


@pytest.mark.parametrize("terms", [3, 40, 400])
def test_nearest_are_exact(terms):
    examples = vectors(700, terms, 1)
    index = BlockMaxIndex(examples, list(range(700)), [i % 2 for i in range(700)], rows=16)
    for query in vectors(60, terms, 2):
        places, cosines = index.nearest(query, k=10)
        every = sorted((sum(w * e.get(t, 0) for t, w in query.items()) for e in examples), reverse=True)
        assert np.allclose(cosines, [c for c in every[:10] if c > 0])
        for place, cosine in zip(places, cosines, strict=True):
            other = examples[index.ids[place]]
            assert cosine == pytest.approx(sum(w * other.get(t, 0) for t, w in query.items()))


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    votes = rng.random(2000)
    xs, ys = isotonic(votes, (rng.random(2000) < votes).astype(float), 0.5)
    assert (np.diff(xs) > 0).all() and (np.diff(ys) > 0).all()
    assert np.abs(np.interp([0.2, 0.5, 0.8], xs, ys) - [0.2, 0.5, 0.8]).max() < 0.1


def corpus(n=900):
    rng = random.Random(11)
    words = [a + b + c for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = i % 8 == 0
        if toxic:
            own[rng.randrange(len(own))] = rng.choice(["Vilea", "vileso", "NASTY", "vile" + rng.choice(words)])
        docs.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    extra = [(10_000, None), (10_001, ""), (10_002, "vilexx " + "x " * 30_000), (None, "vilea"), (0, docs[0][1])]
    frame = spark.createDataFrame([(*d, 1) for d in docs + extra], "doc_id long, text string, toxicity int")
    known = spark.createDataFrame(
        [(*x, 9) for x in labels] + [(3, None, 9), (None, 1, 9), (5, 0, 9)], "doc_id long, toxic int, text int"
    )
    scored, name = toxicity_scores(frame, known)
    rows = scored.collect()
    assert scored.columns == [*frame.columns, name] and len(rows) == len(docs) + len(extra)
    by_id = {r.doc_id: r[name] for r in rows}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 150
    assert sum(by_id[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r[name].score <= 1 and r[name].predicted == (r[name].score >= 0.3) for r in rows)
    assert by_id[10_000] == by_id[10_001] and by_id[10_000].predicted == 0
    assert by_id[10_002].predicted == 1 and by_id[None].predicted == 1
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for r in rows for i in r[name].evidence)
    # held-out labels are never read
    turned = spark.createDataFrame([(i, x if i not in held else 1 - x) for i, x in labels], "doc_id long, toxic int")
    again, other = toxicity_scores(frame, turned)
    assert {r.doc_id: r[other].score for r in again.collect()} == {r.doc_id: r[name].score for r in rows}


def test_only_near_copies_of_one_label_go(spark):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, base = text(60), text(200)
    edited = lambda k: " ".join([*base[:k], "other", *base[k + 1 :]])
    rows = [(i, i % 2, " ".join(text(60) + passage + text(60))) for i in range(100)]  # Jaccard below 0.3
    rows += [(200, 0, " ".join(base)), (201, 0, edited(20)), (202, 1, edited(90)), (203, 1, edited(150))]
    # each of a chain is near the next only, so the third stays as the second is gone
    chain = [base[60 + 9 * k :] + text(9 * k) for k in range(3)]
    rows += [(300 + k, 0, " ".join(["chain", *c])) for k, c in enumerate(chain)]
    rows += [(400, 1, "!!"), (401, 1, None), (402, 1, "a b"), (403, 1, "A, b"), (404, 1, "a c")]
    found = _without_near_copies(spark.createDataFrame(rows, "id long, label int, text string").repartition(5))
    assert found.columns == ["id", "label", "text"]
    kept, near = [], lambda a, b: len(a & b) >= 0.8 * len(a | b)
    for i, label, t in rows:
        words = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        own = {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
        if not any(label == other and near(own, s) for _, other, s in kept):
            kept.append((i, label, own))
    assert sorted(r.id for r in found.collect()) == [i for i, *_ in kept]
    assert {*range(100), 200, 202, 300, 302, 400, 402, 404} <= {i for i, *_ in kept} and not {201, 203, 301, 401, 403} & {i for i, *_ in kept}


def test_without_labels_or_rows(spark):
    docs, labels = corpus(40)
    frame, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored, name = toxicity_scores(frame, known.limit(0))
    assert {r[name].score for r in scored.collect()} == {0.0}
    scored, name = toxicity_scores(frame.limit(0), known)
    assert scored.count() == 0


def test_query(spark):
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.001")
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    for row in rows.collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
