"""The pipeline's stages, each against a plain version on its own input."""

from collections import Counter

import corpus_pipeline
from rosterlake.llm.common import stored
from rosterlake.llm.queries import QUERIES
from test_decontamination import slow
from test_mixing import slow_targets
from test_simhash import slow_components, slow_fingerprint
from test_tokens import WORDS, expected

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    inputs, frames = [spark.read.parquet(f"{SF}/documents.parquet")], []
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, inputs[-1], SF), "stage"))
        inputs.append(frames[-1])
    rows = [frame.collect() for frame in inputs]
    assert all(frame.columns == inputs[0].columns for frame in frames[:-1])
    toxic = {r.doc_id for r in QUERIES["op1_toxicity"](spark, SF).collect() if r.predicted}
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0]} - toxic

    fps = [(r.doc_id, slow_fingerprint(r.text)) for r in rows[1]]
    groups = slow_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert sorted(r.doc_id for r in rows[2]) == sorted(set(groups.values()))

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    judged = {r.doc_id: slow(r.text, items) for r in rows[2]}
    assert {r.doc_id for r in rows[3]} == {i for i, (n, hit, _) in judged.items() if not hit or 20 * len(hit) < n}

    sizes, taken = Counter(), Counter()
    for r in rows[3]:
        sizes[r.source] += len(r.text.encode().split())
    for r in rows[4]:
        taken[r.source] += len(r.text.encode().split())
    assert all(abs(taken[s] - target) <= 1 for s, target in slow_targets(sizes).items())
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2

    found = sorted((tuple(r) for r in rows[5]), key=lambda r: r[1])
    plain = expected([(r.doc_id, r.text) for r in rows[4]], WORDS)
    assert [r[0] for r in found] == [r[0] for r in plain]
    assert sorted((r[0], *r[2:]) for r in found) == sorted((r[0], *r[2:]) for r in plain)
    assert [r[1] for r in found] == [sum(x[2] for x in found[:k]) for k in range(len(found))]


def test_run(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity"
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
