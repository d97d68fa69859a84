"""Maximal periodic runs of words by internal pattern matching over each text's suffix array.

A run of period q is at least 2q words long, so it holds a dyadic block of B words, 2B - 1 <= q,
that occurs again q words later. Blocks are queries: their interval of the suffix array is known from
the ranks that prefix doubling gave, and a wavelet matrix over the array answers which occurrence
comes next in a window. Occurrences in a window of B starts form one arithmetic progression, whose
members are the candidate periods. Each candidate is extended to both sides as far as it holds.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rosterlake.llm.common import fresh

#: A run's least length in words.
LEAST = 12
#: Words of the texts that are searched together.
BATCH_WORDS = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class WaveletMatrix:
    """Order queries over ranges of an array of distinct numbers below 2^bits, many at a time."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values)).bit_length())
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            digit = (values >> bit) & 1 == 1
            self.ones.append(np.concatenate([[0], np.cumsum(digit)]))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[~digit], values[digit]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of values[low:high] are less than `bound`."""
        count, bound = np.zeros(len(low), np.int64), np.minimum(bound, (1 << self.bits) - 1)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            up, left, right = (bound >> bit) & 1 == 1, ones[low], ones[high]
            count += np.where(up, (high - low) - (right - left), 0)
            low, high = np.where(up, zeros + left, low - left), np.where(up, zeros + right, high - right)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest, from 0, of values[low:high]; k must be less than high - low."""
        found = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones, zeros = self.ones[level], self.zeros[level]
            left, right = ones[low], ones[high]
            less = (high - low) - (right - left)
            up = k >= less
            k = np.where(up, k - less, k)
            low, high = np.where(up, zeros + left, low - left), np.where(up, zeros + right, high - right)
            found |= up.astype(np.int64) << bit
        return found


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks): ranks[k][i] ranks the 2^k words from i on, equal where they are equal.

    `ends[i]` is where the text of position i ends; suffixes end there and stand by text and rank.
    Doubling stops when no two positions of a text share a rank.
    """
    n = len(words)
    places = np.arange(n)
    _, first = np.unique(words, return_inverse=True)
    _, texts = np.unique(ends, return_inverse=True)
    _, rank = np.unique(texts * n + first, return_inverse=True)
    ranks, span = [rank], 1
    while True:
        beyond = places + span
        key = rank * (n + 1) + np.where(beyond < ends, rank[np.minimum(beyond, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        if steps[-1] == n - 1:
            return order, ranks
        ranks.append(rank)
        span *= 2


def _common(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For a < b in one text, how many words are equal from a and from b on."""
    start, n = b, len(ends)
    end = ends[np.minimum(b, n - 1)]
    for k in range(len(ranks) - 1, -1, -1):
        fits = b + (1 << k) <= end
        equal = fits & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        a, b = np.where(equal, a + (1 << k), a), np.where(equal, b + (1 << k), b)
    return b - start


def _common_back(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For a < b in one text, how many words are equal before a and before b."""
    start, first = a, starts[a]
    for k in range(len(ranks) - 1, -1, -1):
        fits = a - (1 << k) >= first
        x, y = np.maximum(a - (1 << k), 0), np.maximum(b - (1 << k), 0)
        equal = fits & (ranks[k][x] == ranks[k][y])
        a, b = np.where(equal, a - (1 << k), a), np.where(equal, b - (1 << k), b)
    return start - a


def _candidates(order: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block's place, candidate period) for all dyadic blocks and their occurrences nearby."""
    n, matrix = len(order), WaveletMatrix(order)
    for k in range(1, len(ranks)):
        size = 1 << k
        sorted_ranks = ranks[k][order]
        blocks = np.arange(0, n, size)
        blocks = blocks[blocks + size <= ends[blocks]]
        if not len(blocks):
            continue
        low = np.searchsorted(sorted_ranks, ranks[k][blocks], side="left")
        high = np.searchsorted(sorted_ranks, ranks[k][blocks], side="right")
        blocks, low, high = (x[high - low > 1] for x in (blocks, low, high))
        # periods from 2B - 1 to 4B - 2, and all below for the smallest blocks, in windows of B starts
        windows = [(1, 2), (3, 4), (5, 6)] if k == 1 else [(2 * size - 1, 3 * size - 2), (3 * size - 1, 4 * size - 2)]
        for least, most in windows:
            before = matrix.below(low, high, blocks + least)
            count = matrix.below(low, high, blocks + most + 1) - before
            some = count > 0
            b, lo, hi, before, count = (x[some] for x in (blocks, low, high, before, count))
            if not len(b):
                continue
            first = matrix.smallest(lo, hi, before)
            second = matrix.smallest(lo, hi, np.where(count > 1, before + 1, before))
            step = second - first
            # a progression that goes on from the block itself holds multiples of its step alone
            many = np.flatnonzero(count > 2)
            own = np.zeros(len(b), bool)
            own[many] = (_common(ranks, b[many], b[many] + step[many], ends) >= first[many] - b[many]) & (
                (first[many] - b[many]) % step[many] == 0
            )
            b, first, step, count = (x[~own] for x in (b, first, step, count))
            nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            yield np.repeat(b, count), np.repeat(first - b, count) + nth * np.repeat(step, count)


def runs(words: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, smallest period) of all maximal runs, by start, then period.

    `words` are numbers that stand for the words of the texts that `offsets` divide; runs lie within
    a text and hold at least `least` words (12 or more) and two periods.
    """
    sizes = np.diff(offsets)
    starts, ends = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    if not len(words):
        return np.zeros((0, 3), np.int64)
    order, ranks = suffix_array(words, ends)
    found = [np.zeros((0, 3), np.int64)]
    for places, periods in _candidates(order, ranks, ends):
        other = places + periods
        right = _common(ranks, places, other, ends)
        left = _common_back(ranks, places, other, starts)
        start, end = places - left, other + right
        long = end - start >= np.maximum(least, 2 * periods)
        found.append(np.unique(np.stack([start, end, periods], 1)[long], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    if len(rows):  # a multiple of the smallest period reaches as far
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of each word of UTF-8 bytes."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    tables = _tables(len(data) + 1)
    np.cumsum(tables["byte"][data] * tables["up"][: len(data)], out=sums[1:])
    hashes = (sums[end] - sums[start]) * tables["down"][start]
    return start, end, (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> dict[str, np.ndarray]:
    """Random values of the bytes, and n powers at least of the base and of its inverse mod 2^64."""
    if len(_POWERS.get("up", ())) < n:
        _POWERS["byte"] = np.random.default_rng(13).integers(0, 1 << 64, 256, dtype=np.uint64)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            powers = np.full(max(n, 1 << 20), base, np.uint64)
            powers[0] = 1
            _POWERS[name] = np.multiply.accumulate(powers)
    return _POWERS


def planted_sources(n: int, doc_id: int | None) -> np.ndarray | None:
    """For each word of a text of n, the original word that the test damage puts there, or None."""
    hashed = zlib.crc32(str(doc_id).encode()) if doc_id is not None else zlib.crc32(b"")
    g = hashed // 10
    if hashed % 10 or not n:
        return None
    a = g % n
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % (1 + (n - a) // (3 + g % 8)))


def _repeating(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold some six words twice: each run of twelve words does."""
    n = len(offsets) - 1
    out = np.zeros(n, bool)
    if len(words) < 6:
        return out
    grams = words[: len(words) - 5].copy()
    for i in range(1, 6):
        grams = grams * np.uint64(_BASE) + words[i : len(words) - 5 + i]
    whose = np.repeat(np.arange(n), np.diff(offsets))
    grams, whose = grams[whose[: len(grams)] == whose[5:]], whose[5:][whose[: len(grams)] == whose[5:]]
    mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + whose.astype(np.uint64) * np.uint64(_BASE)
    order = np.argsort(mixed)
    twice = mixed[order[1:]] == mixed[order[:-1]]
    out[whose[order[1:][twice]]] = True
    return out


def _searched(group: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each of the texts, given as arrays of word hashes, by places in that text."""
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in group])]).astype(np.int64)
    hashes = np.concatenate([np.zeros(0, np.uint64), *group])
    live = np.flatnonzero(_repeating(hashes, offsets))
    results = [np.zeros((0, 3), np.int64)] * len(group)
    if not len(live):
        return results
    words = np.concatenate([group[i] for i in live])
    within = np.concatenate([[0], np.cumsum([len(group[i]) for i in live])]).astype(np.int64)
    found = runs(words, within)
    cuts = np.searchsorted(found[:, 0], within)
    for i, at, a, b in zip(live, within, cuts, cuts[1:], strict=False):
        results[i] = found[a:b] - np.array([at, at, 0])
    return results


def _dropped(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words lie in some run after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


_DDL = (
    "struct<n_runs: long, start: long, length: long, period: long, "
    "runs: array<struct<start: long, length: long, period: long>>, runs_sha256: string, "
    "collapsed: binary, collapsed_sha256: string>"
)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False, texts: bool = True
) -> tuple[DataFrame, str]:
    """The rows with one more column, whose name is returned: a struct of what repeats in a text.

    Words are what ASCII white space parts. `runs` are all maximal stretches of at least 12 words
    and two of their smallest period, by start, then period; start, length and period are those of
    the longest (ties: smallest start, then period). `collapsed` are the words, joined by one space,
    without those that lie in a run after its first period; it is null unless `texts` are wanted.
    Null and empty texts have no words and no runs; repeated rows have the same result each; an
    empty table gives no rows; other columns stay. With `planted`, one text in ten is made periodic
    from some word on, as decided by `id_col` (an integer, null as the empty string), and runs are
    those of the text so made. A text needs some 200 bytes of memory a word while it is searched.
    """
    name = fresh(docs, "found")
    schema = StructType([*docs.schema, *StructType.fromDDL(f"{name} {_DDL}")])
    kind = to_arrow_schema(StructType(schema.fields[-1:])).field(0).type
    at_text, at_id = docs.columns.index(text_col), docs.columns.index(id_col)

    def searched(rows: pa.RecordBatch) -> pa.Array:
        columns: dict[str, list] = {field.name: [] for field in kind}
        group, size = [], 0

        def finish() -> None:
            nonlocal group, size
            for (split, source, _), found in zip(group, _searched([g[2] for g in group]), strict=True):
                words = split if source is None else [split[i] for i in source.tolist()]
                lines = np.stack([found[:, 0], found[:, 1] - found[:, 0], found[:, 2]], 1).tolist()
                best = min(lines, key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
                if lines:
                    gone = _dropped(len(words), found)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words)
                values = (
                    len(lines), *best, [dict(zip(("start", "length", "period"), r, strict=True)) for r in lines],
                    hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in lines).encode()).hexdigest(),
                    kept if texts else None, hashlib.sha256(kept).hexdigest(),
                )
                for field, value in zip(columns, values, strict=True):
                    columns[field].append(value)
            group, size = [], 0

        for text, doc in zip(rows.column(at_text), rows.column(at_id).to_pylist(), strict=True):
            raw = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
            split = raw.to_pybytes().split()
            source = planted_sources(len(split), doc) if planted else None
            hashes = word_hashes(np.frombuffer(raw, np.uint8))[2]
            group.append((split, source, hashes if source is None else hashes[source]))
            size += len(split)
            if size >= BATCH_WORDS:
                finish()
        finish()
        return pa.StructArray.from_arrays([pa.array(columns[f.name], f.type) for f in kind], fields=list(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([*rows.columns, searched(rows)], names=schema.names)

    return docs.mapInArrow(run, schema), name
