"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import appended, fresh, stored
from rosterlake.llm.paragraphs import band_hashes, bands_for, content_of, shingled

#: Bounds of what is fitted: labelled examples in the index, and terms in its vocabulary.
SAMPLE_ROWS = 24_000
VOCABULARY = 4096
#: Terms in fewer examples are not considered.
LEAST_EXAMPLES = 3
#: Similarity of near copies among the examples, and hashes of a band that finds them.
NEAR = 0.8
NEAR_ROWS = 5
PREFIXES = (4, 5)
NEIGHBOURS = 25
BLOCK_ROWS = 64
THRESHOLD = 0.3
HELD_OUT = 2
EVIDENCE = 5
_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """A word's terms: the word, and its beginnings, so that unseen endings are known too."""
    return [f"={word}", *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class Vocabulary:
    """Counts the chosen terms in texts by one automaton over all of them."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = terms
        self.automaton = None

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "automaton": None}

    def build(self) -> None:
        wanted: dict[str, list[int]] = {}
        for k, term in enumerate(self.terms):
            whole = term[0] == "="
            wanted.setdefault(term[1:] if whole else term[:-1], [-1, -1])[0 if whole else 1] = k
        self.automaton = ahocorasick.Automaton()
        for string, (whole, start) in wanted.items():
            self.automaton.add_word(string, (len(string), whole, start))
        self.automaton.make_automaton()

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        if not text or not self.terms:
            return found
        if self.automaton is None:
            self.build()
        text = text.lower()
        for end, (length, whole, start) in self.automaton.iter(text):
            before, after = text[end - length : end - length + 1] if end >= length else "", text[end + 1 : end + 2]
            if before.isalnum() or before == "_":
                continue
            if start >= 0:
                found[start] = found.get(start, 0) + 1
            if whole >= 0 and not (after.isalnum() or after == "_"):
                found[whole] = found.get(whole, 0) + 1
        return found


class BlockMaxIndex:
    """Examples in blocks, with postings per term and block and each term's largest weight there.

    A block is looked into only while the sum of its terms' largest weights can still reach the
    k-th best cosine found, so the k nearest examples are exact. Ties go to the earlier example.
    """

    def __init__(self, vectors: list[dict[int, float]], ids: list, labels: list[int], rows: int = BLOCK_ROWS) -> None:
        # examples that share their heaviest term meet in a block, so that blocks differ in their maxima
        heaviest = [max(v, key=lambda t: (v[t], -t)) for v in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (heaviest[i], -vectors[i][heaviest[i]], i))
        self.ids = [ids[i] for i in order]
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.rows, self.blocks = rows, -(-len(order) // rows)
        postings: dict[int, list[tuple[int, float]]] = {}
        for place, i in enumerate(order):
            for term, weight in vectors[i].items():
                postings.setdefault(term, []).append((place, weight))
        self.postings = {}
        for term, own in postings.items():
            places, weights = np.array([p for p, _ in own]), np.array([w for _, w in own])
            blocks, starts = np.unique(places // rows, return_index=True)
            self.postings[term] = (blocks, np.maximum.reduceat(weights, starts), places, places // rows, weights)

    def nearest(self, query: dict[int, float], k: int = NEIGHBOURS, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k nearest examples of positive cosine, best first."""
        bounds, own = np.zeros(self.blocks), []
        for term, weight in query.items():
            if term in self.postings:
                blocks, most, places, blocks_of, weights = self.postings[term]
                bounds[blocks] += weight * most
                own.append((weight, places, blocks_of, weights))
        order = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds)]
        falling = -bounds[order]
        best_at, best, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 2
        while at < len(order):
            end = at + step
            if len(best) == k:  # only blocks that can still reach the k-th best
                end = min(end, int(np.searchsorted(falling, 1e-9 - best[-1], side="right")))
                if end <= at:
                    break
            looked, cosines = np.zeros(self.blocks, bool), np.zeros(len(self.ids))
            looked[order[at:end]] = True
            for weight, places, blocks_of, weights in own:
                inside = looked[blocks_of]
                cosines[places[inside]] += weight * weights[inside]
            if leave_out >= 0:
                cosines[leave_out] = 0
            found = np.flatnonzero(cosines)
            best_at, best = np.concatenate([best_at, found]), np.concatenate([best, cosines[found]])
            ranked = np.lexsort((best_at, -np.round(best, 9)))[:k]
            best_at, best = best_at[ranked], best[ranked]
            at, step = end, 2 * step
        return best_at, best


class Scorer:
    """What is broadcast: vocabulary, weights, index and calibration; bounded by the two limits."""

    def __init__(self, terms: list[str], idf: list[float], examples: list[tuple]) -> None:
        """examples: (id, counts of terms, label)."""
        self.vocabulary, self.idf = Vocabulary(terms), idf
        vectors = [self.vector(counts) for _, counts, _ in examples]
        known = [i for i, v in enumerate(vectors) if v]
        labels = [label for *_, label in examples]
        rest = [label for label, v in zip(labels, vectors, strict=True) if not v]
        self.base = sum(labels) / len(labels) if labels else 0.0
        #: the share of label 1 among examples without any term of the vocabulary
        self.none = (sum(rest) + self.base) / (len(rest) + 1)
        self.index = BlockMaxIndex([vectors[i] for i in known], [examples[i][0] for i in known], [labels[i] for i in known])
        self.xs, self.ys = np.zeros(1), np.zeros(1)
        if known:
            place = {id_: k for k, id_ in enumerate(self.index.ids)}
            votes = [self.vote(vectors[i], place[examples[i][0]])[0] for i in known]
            self.xs, self.ys = isotonic(np.array(votes), np.array([labels[i] for i in known], float), self.base)

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        weights = {t: (1 + math.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}

    def vote(self, vector: dict[int, float], leave_out: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Neighbours vote by nearness; a vote of the base rate keeps few distant ones modest."""
        places, cosines = self.index.nearest(vector, leave_out=leave_out)
        weights = 1 / (1.1 - np.minimum(cosines, 1.0))
        total = float((weights * self.index.labels[places]).sum() + self.base)
        return total / (float(weights.sum()) + 1), places, cosines

    def score(self, text: str | None) -> tuple[float, list, list[float]]:
        counts = self.vocabulary.counts(text)
        if not counts:
            return self.none, [], []
        vote, places, cosines = self.vote(self.vector(counts))
        # equal calibrated scores keep the order of their votes
        score = 0.999 * float(np.interp(vote, self.xs, self.ys)) + 0.001 * vote
        return score, [self.index.ids[p] for p in places[:EVIDENCE]], cosines[:EVIDENCE].tolist()


def isotonic(votes: np.ndarray, labels: np.ndarray, base: float, least: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising map from votes to label rates: pooled neighbours over bins of equal votes."""
    order = np.argsort(votes, kind="stable")
    votes, labels, bins, start = votes[order], labels[order], [], 0
    while start < len(votes):
        end = min(start + least, len(votes))
        while end < len(votes) and votes[end] == votes[end - 1]:
            end += 1
        bins.append([votes[start:end].mean(), labels[start:end].sum() + base, end - start + 1.0])
        start = end
    pooled: list[list[float]] = []
    for x, hits, n in bins:
        pooled.append([x * n, hits, n])
        while len(pooled) > 1 and pooled[-2][1] / pooled[-2][2] >= pooled[-1][1] / pooled[-1][2]:
            last = pooled.pop()
            pooled[-1] = [a + b for a, b in zip(pooled[-1], last, strict=True)]
    return np.array([x / n for x, _, n in pooled]), np.array([h / n for _, h, n in pooled])


def _telling_terms(examples: DataFrame, limit: int) -> list[str]:
    """The terms that go with label 1 most clearly, by likelihood ratio against the base rate.

    The ratio asked for grows with the number of terms considered, so that about one of them gets
    in by chance, however large the sample is.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, hits = Counter(), Counter()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                own = {t for w in set(_WORD.findall((text or "").lower())) for t in terms_of(w)}
                n.update(own)
                if label:
                    hits.update(own)
            yield pd.DataFrame({"term": [*n], "n": [*n.values()], "hits": [hits[t] for t in n]})

    rows, positive = examples.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positive < rows:
        return []
    counted = examples.select("text", "label").mapInPandas(count, "term string, n long, hits long")
    summed = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    summed = stored(summed.where(F.col("n") >= LEAST_EXAMPLES), "toxicity-terms")
    least = 2 * math.log(summed.count() + 1)
    rate = positive / rows
    part = lambda k, p: F.when(k > 0, k * F.ln(k / (F.col("n") * p))).otherwise(0.0)
    ratio = 2 * (part(F.col("hits"), rate) + part(F.col("n") - F.col("hits"), 1 - rate))
    telling = summed.where(F.col("hits") > F.col("n") * rate).withColumn("ratio", ratio).where(F.col("ratio") >= least)
    return [r.term for r in telling.orderBy(F.desc("ratio"), "term").limit(limit).collect()]


def _triples(texts: list) -> tuple[np.ndarray, np.ndarray]:
    return shingled([content_of(" ".join(_WORD.findall((text or "").lower()))) for text in texts], 3)


def _without_near_copies(examples: DataFrame) -> DataFrame:
    """The examples (id, label, text) without near copies of one that stays, in the order of ids.

    Near copies have the same label and word triples of a Jaccard similarity of `NEAR` or more;
    copies with a few edits would make all their words look telling, too. Bands of MinHashes only
    tell which examples to compare: the driver joins up those that meet in one, from the sample's
    hashes, and a task compares each with those that stay among its own.
    """
    bands = bands_for(NEAR, NEAR_ROWS)

    def sketch(texts: list) -> list[list]:
        return [band_hashes(*_triples(texts), bands, NEAR, NEAR_ROWS).view(np.int64).tolist() if texts else []]

    sketched = stored(appended(examples, "text", {"bands": "array<bigint>"}, sketch), "toxicity-sketches")
    kind = examples.schema["id"].dataType.simpleString()
    hashes = [(r.id, r.label, r.bands) for r in sketched.select("id", "label", "bands").collect()]
    meeting = [(hashes[k][0], group) for k, group in _joined([(label, own) for _, label, own in hashes])]
    if not meeting:
        return sketched.drop("bands")
    groups = examples.sparkSession.createDataFrame(meeting, f"id {kind}, grp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, met, sets = None, {}, []
        for batch in batches:
            copies = []
            texts, groups, labels = (batch[c].to_pylist() for c in ("text", "grp", "label"))
            for text, grp, label, own in zip(texts, groups, labels, batch["bands"].to_pylist(), strict=True):
                if grp != current:
                    current, met, sets = grp, {}, []
                triples = np.unique(_triples([text])[0])
                places = [(label, no, h) for no, h in enumerate(own)]
                others = {k for place in places for k in met.get(place, ())}
                copies.append(any(_are_near(triples, sets[k]) for k in others))
                if not copies[-1]:
                    for place in places:
                        met.setdefault(place, []).append(len(sets))
                    sets.append(triples)
            yield pa.RecordBatch.from_arrays([batch["id"].filter(pa.array(copies, pa.bool_()))], names=["id"])

    grouped = sketched.join(F.broadcast(groups), "id").repartition("grp").sortWithinPartitions("grp", "id")
    copies = stored(grouped.select("id", "grp", "label", "bands", "text").mapInArrow(run, f"id {kind}"), "toxicity-copies")
    return stored(sketched.drop("bands").join(F.broadcast(copies), "id", "left_anti"), "toxicity-distinct")


def _are_near(s: np.ndarray, t: np.ndarray) -> bool:
    if min(len(s), len(t)) < NEAR * max(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both >= NEAR * (len(s) + len(t) - both) - 1e-9


def _joined(rows: list[tuple[int, list[int]]]) -> list[tuple[int, int]]:
    """(place, group) of the rows (label, band hashes) that meet another of their label in a band."""
    parent, first = list(range(len(rows))), {}

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for k, (label, own) in enumerate(rows):
        for no, h in enumerate(own):
            other = root(first.setdefault((label, no, h), k))
            parent[root(k)] = other
    sizes = Counter(root(k) for k in range(len(rows)))
    return [(k, root(k)) for k in range(len(rows)) if sizes[root(k)] > 1]


def _document_frequencies(texts: DataFrame, vocabulary: Broadcast) -> tuple[int, dict[int, int]]:
    """(documents, documents with each term), over all documents, summed in tasks first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                df.update(vocabulary.value.counts(text).keys())
            df[-1] += len(batch)
        yield pd.DataFrame({"term": [*df], "n": [*df.values()]}, dtype="int64")

    rows = texts.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    found = {r[0]: r[1] for r in rows}
    return found.pop(-1, 0), found


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    vocabulary_size: int = VOCABULARY,
) -> Scorer:
    """The scorer fitted on at most `sample_rows` labelled examples that are not held out.

    One example is taken per distinct text, and per label one of near copies, as copies would make
    every word of theirs look telling; several labels of one document are averaged. Terms' document frequencies come from all
    documents. The driver holds only the sample's counts of vocabulary terms.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~is_held_out("id"))
    known = known.groupBy("id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    keys = texts.select("id", F.xxhash64("text").alias("key")).join(known, "id")
    distinct = keys.groupBy("key").agg(F.min(F.struct("id", "label")).alias("one")).select("one.*").distinct()
    chosen = stored(distinct.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "toxicity-sample")
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    examples = _without_near_copies(stored(found, "toxicity-examples"))
    terms = _telling_terms(examples, vocabulary_size)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(terms))
    n, df = _document_frequencies(texts, vocabulary)
    idf = [math.log((1 + n) / (1 + df.get(k, 0))) + 1 for k in range(len(terms))]

    def work(batch: list) -> list[list]:
        counts = [vocabulary.value.counts(t) for t in batch]
        return [[[*c] for c in counts], [[*c.values()] for c in counts]]

    reduced = appended(examples, "text", {"terms": "array<int>", "counts": "array<int>"}, work).drop("text")
    rows = sorted(reduced.collect(), key=lambda r: str(r.id))
    return Scorer(terms, idf, [(r.id, dict(zip(r.terms, r.counts, strict=True)), r.label) for r in rows])


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    **bounds: int,
) -> tuple[DataFrame, str]:
    """The rows of `docs` with a new column, whose name is returned too: a struct of score (0 to 1),
    predicted, evidence (ids of the nearest labelled examples) and cosines (theirs).

    Scores depend on the text alone. Null, empty and other texts without a telling term get the
    rate of label 1 among such examples and no evidence. Without usable labels all scores are 0.
    Repeated rows are scored alike, an empty table gives no rows.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, id_col, text_col, label_col, **bounds))
    kind = docs.schema[id_col].dataType.simpleString()

    def work(texts: list) -> list[list]:
        found = []
        for text in texts:
            score, evidence, cosines = scorer.value.score(text)
            found.append({"score": score, "predicted": int(score >= threshold), "evidence": evidence, "cosines": cosines})
        return [found]

    name = fresh(docs, "toxicity")
    typed = f"struct<score: double, predicted: int, evidence: array<{kind}>, cosines: array<double>>"
    return appended(docs, text_col, {name: typed}, work), name


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are not predicted toxic."""
    scored, name = toxicity_scores(docs, labels, **options)
    return scored.where(F.col(name)["predicted"] == 0).drop(name)
