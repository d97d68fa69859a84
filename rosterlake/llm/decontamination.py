"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned for."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import appended, fresh, stored

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
ONE_IN = 20
#: Benchmark text whose windows are broadcast at a time; a larger benchmark takes several scans.
SLICE_BYTES = 16 << 20
#: ASCII letters become lower case; other ASCII characters but digits separate words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class WindowTable:
    """The windows of one length: sorted hashes, a place of each in the numbered words, and its items."""

    def __init__(self, numbers: np.ndarray, places: np.ndarray, owners: np.ndarray, length: int) -> None:
        self.length, self.seed = length, 0
        while not self.built(numbers, places, owners):  # two windows have one hash: take other hashes
            self.seed += 1

    def hashed(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        factors = np.random.default_rng(self.seed).integers(0, 1 << 64, self.length, dtype=np.uint64) | np.uint64(1)
        total = np.zeros(len(starts), np.uint64)
        for j, factor in enumerate(factors):
            own = (numbers[starts + j].astype(np.uint64) + np.uint64(1)) * factor
            total += (own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return total

    def built(self, numbers: np.ndarray, places: np.ndarray, owners: np.ndarray) -> bool:
        hashes = self.hashed(numbers, places)
        order = np.lexsort((owners, hashes))
        hashes, places, owners = hashes[order], places[order], owners[order]
        first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        group = np.cumsum(first) - 1
        self.hashes, self.places = hashes[first], places[first].astype(np.int32)
        if not all((numbers[places + j] == numbers[self.places[group] + j]).all() for j in range(self.length)):
            return False
        again = np.concatenate([[True], (owners[1:] != owners[:-1]) | first[1:]])  # an item counts once
        self.items = owners[again].astype(np.int32)
        self.offsets = np.searchsorted(group[again], np.arange(len(self.hashes) + 1)).astype(np.int32)
        return True

    def found(self, numbers: np.ndarray, starts: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(start, items) of the windows at `starts` that are in the table, compared word by word."""
        for at in range(0, len(starts), 1 << 16):
            own = starts[at : at + (1 << 16)]
            hashes = self.hashed(numbers, own)
            nearest = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = self.hashes[nearest] == hashes
            own, nearest = own[same], nearest[same]
            equal = np.ones(len(own), bool)
            for j in range(self.length):
                equal &= numbers[own + j] == known[self.places[nearest] + j]
            for start, k in zip(own[equal].tolist(), nearest[equal].tolist(), strict=True):
                yield start, self.items[self.offsets[k] : self.offsets[k + 1]]


class Windows:
    """The hash set: each window of word numbers, with the items that have it, in flat arrays.

    Some 25 bytes a benchmark word and 100 a distinct one.
    """

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids = [item for item, _ in items]
        number, parts = self.numbers, []
        for _, text in items:
            parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words_of(text)), np.int32))
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.known = np.concatenate([np.zeros(0, np.int32), *parts])
        self.tables = []
        for length in sorted({*np.minimum(sizes, window).tolist()} - {0}):
            own = np.flatnonzero(np.minimum(sizes, window) == length)
            counts = sizes[own] - length + 1
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            self.tables.append(WindowTable(self.known, np.repeat(starts[own], counts) + nth, np.repeat(own, counts), length))

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], list]:
        """(words, maximal spans of hit words, items found) of one text.

        Word numbers stand for whole words, so equal windows of numbers are equal windows of words.
        """
        words = words_of(text)
        number = self.numbers.get
        numbers = np.fromiter((number(w, -1) for w in words), np.int32, len(words))
        unknown = np.concatenate([[0], np.cumsum(numbers < 0)])
        spans, found = [], set()
        for table in self.tables:
            if table.length > len(words):
                continue
            starts = np.flatnonzero(unknown[table.length :] == unknown[: -table.length])
            for at, owners in table.found(numbers, starts, self.known):
                found.update(owners.tolist())
                spans.append((at, at + table.length))
        return len(words), merged(spans), [self.ids[k] for k in sorted(found)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans' union as maximal spans in order."""
    result: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
) -> tuple[DataFrame, str]:
    """The rows of `docs` with a new column, whose name is returned too: a struct of n_words, n_hit,
    spans (maximal runs of hit words, as word numbers from start up to end) and item_ids (distinct).

    The benchmark's size is measured first. Up to `slice_bytes` of its text are broadcast at a time;
    a larger one is cut by a hash of its items, and each slice scans the rows once more, adding to
    what the slices before it found, so that memory is bounded and nothing is left out. Null and
    empty texts have no words and no hits, items without words no windows; repeated rows are
    documents of their own, repeated items one item; with an empty benchmark nothing is hit.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, math.ceil(total / slice_bytes))
    name, rows = fresh(docs, "benchmark_hits"), docs
    typed = f"struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, item_ids: array<{kind}>>"
    columns = [fresh(docs, f"benchmark_hits_{k}") for k in range(slices)]
    for k, column in enumerate(columns):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k).distinct()
        windows = spark.sparkContext.broadcast(Windows([tuple(r) for r in own.collect()], window))

        def work(texts: list, windows=windows) -> list[list]:
            found = []
            for n, spans, ids in map(windows.value.hits, texts):
                found.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "item_ids": ids})
            return [found]

        rows = appended(rows, text_col, {column: typed}, work)
        if k < slices - 1:
            rows = stored(rows, "decontamination")
    parts = [F.col(c) for c in columns]
    spans = parts[0]["spans"] if slices == 1 else _union(F.array_sort(F.concat(*[p["spans"] for p in parts])))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    result = F.struct(
        parts[0]["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        spans.alias("spans"),
        F.array_distinct(F.concat(*[p["item_ids"] for p in parts])).alias("item_ids"),
    )
    return rows.withColumn(name, result).drop(*columns), name


def _union(spans):
    """Maximal spans of a sorted array of spans that may overlap."""
    empty = F.slice(spans, 1, 0)

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        apart = (F.size(done) == 0) | (span["start"] > F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(span))).otherwise(joined)

    return F.aggregate(spans, empty, add)


def is_contaminated(hits: str, one_in: int = ONE_IN):
    return (F.col(hits)["n_hit"] > 0) & (one_in * F.col(hits)["n_hit"] >= F.col(hits)["n_words"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` without contaminated documents, or without the hit words (`spans`).

    Removing spans cuts each from its first word's start to its last word's end, in any document.
    """
    hits, name = benchmark_hits(docs, benchmark, text_col, **options)
    if remove == "documents":
        return hits.where(~is_contaminated(name)).drop(name)
    plain = hits.withColumn(name, F.col(name)["spans"])
    kept, (at, spans) = plain.columns, (plain.columns.index(text_col), plain.columns.index(name))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch[kept[at]] = [without(t, s) for t, s in zip(batch.iloc[:, at], batch.iloc[:, spans], strict=True)]
            yield batch

    touched = plain.where(F.size(name) > 0).mapInPandas(run, plain.schema)
    return plain.where(F.size(name) == 0).unionByName(touched).drop(name)


def without(text: str, spans: list) -> str:
    """The text without the words that the spans number."""
    data = text.encode("utf-8", "surrogatepass")
    letters = np.frombuffer(data.translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], letters.view(np.int8), [0]])))
    starts, ends, at, kept = edges[::2], edges[1::2], 0, []
    for span in spans:
        kept.append(data[at : starts[span["start"]]])
        at = ends[span["end"] - 1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
