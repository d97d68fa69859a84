"""Exact removal of long repeated byte strings by prefix doubling over content-defined positions.

A suffix array of all bytes needs some 16 bytes a position in each of its rounds, many times the
corpus. Here every window of `least` bytes is represented by one position in it, its anchor: the
place of the smallest hash of `GRAM` bytes. Equal windows have equal anchors at equal offsets, and
consecutive windows share theirs, so about one position in 180 is sorted and none is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import discard, stored

LEAST = 400
GRAM = 50
#: Windows that are compared together before each is compared alone.
CELL = 16
#: Bytes hashed at a time; a longer text is read in overlapping parts.
_PART_BITS = 20
_PART = 1 << _PART_BITS
_BASE = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def powers() -> dict[str, np.ndarray]:
    """Random values of the bytes, and powers of the base and of its inverse modulo 2^64."""
    if not _tables:
        _tables["byte"] = np.random.default_rng(400).integers(0, 1 << 64, 256, dtype=np.uint64)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            powers = np.full(_PART + 1, base, np.uint64)
            powers[0] = 1
            _tables[name] = np.multiply.accumulate(powers)
    return _tables


def anchors(data: np.ndarray, offsets: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first, last, anchor, hash of the anchor's gram) of each run of windows that share an anchor.

    `data` has the texts that `offsets` divide; windows lie within a text. Ties go to the leftmost.
    """
    if len(data) < least:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    tables = powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["byte"][data] * tables["up"][: len(data)], out=sums[1:])
    grams = (sums[gram:] - sums[:-gram]) * tables["down"][: len(data) - gram + 1]
    mixed = (grams ^ (grams >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    low = np.uint64(_PART_BITS)
    smallest = (mixed >> low << low) | np.arange(len(mixed), dtype=np.uint64)
    wide, span = least - gram + 1, 1
    while 2 * span <= wide:
        smallest = np.minimum(smallest[:-span], smallest[span:])
        span *= 2
    if span < wide:
        smallest = np.minimum(smallest[: span - wide], smallest[wide - span :])
    at = (smallest & np.uint64(_PART - 1)).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(at)]
    at[ends < np.arange(least, len(at) + least)] = -1  # no window starts there
    # a new run where the anchor changes; the last windows of a text part it from the next
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    real = at[first] >= 0
    first, last = first[real], last[real]
    return first, last, at[first], grams[at[first]]


def parts(offsets: np.ndarray, least: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, text after the last, first byte, byte after the last) of what is hashed at once."""
    text, n = 0, len(offsets) - 1
    while text < n:
        end = int(np.searchsorted(offsets, offsets[text] + _PART, side="right")) - 1
        if end > text:
            yield text, end, int(offsets[text]), int(offsets[end])
            text = end
            continue
        start = int(offsets[text])
        while start + least <= offsets[text + 1]:
            yield text, text + 1, start, int(min(start + _PART, offsets[text + 1]))
            start += _PART - least + 1
        text += 1


def _positions(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """(k, lo, wide, dx, gram, run): each run of windows, by its document's key k.

    lo is the first window's start, wide the number of windows less one, dx the anchor's distance
    from lo, and run a hash of all bytes that the run's windows cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch["text"], batch["k"].to_numpy()
            _, ends, values = texts.buffers()
            offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
            view = memoryview(data)
            for a, b, start, end in parts(offsets, least):
                own = np.clip(offsets[a : b + 1], start, end) - start
                first, last, at, grams = anchors(data[start:end], own, least, gram)
                if not len(first):
                    continue
                whose = np.searchsorted(own, first, side="right") - 1
                dx = at - first
                spans = zip((first + start).tolist(), (last + start + least).tolist(), dx.tolist(), strict=True)
                digests = [xxhash.xxh3_64_intdigest(view[s:e], d) for s, e, d in spans]
                yield pa.RecordBatch.from_pydict(
                    {
                        "k": keys[whose + a],
                        "lo": (first + start - offsets[whose + a]).astype(np.int32),
                        "wide": (last - first).astype(np.int32),
                        "dx": dx.astype(np.int32),
                        "gram": grams.view(np.int64),
                        "run": np.array(digests, np.uint64).view(np.int64),
                    }
                )

    return docs.mapInArrow(run, "k long, lo int, wide int, dx int, gram long, run long")


def _contexts(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The rows of `wanted` with the bytes `ctx` that their windows cover."""
    lists = wanted.groupBy("k").agg(F.collect_list(F.struct("gram", "run", "n", "lo", "wide", "dx")).alias("runs"))
    both = docs.join(lists, "k")
    fields = pa.schema(
        [("k", pa.int64()), ("gram", pa.int64()), ("run", pa.int64()), ("n", pa.int64()), ("lo", pa.int32()), ("wide", pa.int32()), ("dx", pa.int32()), ("ctx", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for key, text, runs in zip(batch["k"].to_pylist(), batch["text"], batch["runs"], strict=True):
                view = memoryview(text.as_buffer())
                for own in runs.as_py():
                    rows.append({"k": key, **own, "ctx": view[own["lo"] : own["lo"] + own["wide"] + least].tobytes()})
                    size += own["wide"] + least
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=fields)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    schema = "k long, gram long, run long, n long, lo int, wide int, dx int, ctx binary"
    return both.select("k", "text", "runs").mapInArrow(run, schema)


def _part(start: Column, length: Column) -> Column:
    """A hash of `length` bytes of the context from `start` (from 0) on."""
    return F.xxhash64(F.substring("ctx", start + 1, length))


def _doubled(contexts: DataFrame, least: int, gram: int) -> DataFrame:
    """(gram, run) of the runs whose anchors share `least` / 2 bytes on one side with another's.

    Every window reaches at least that far to one side of its anchor. The ranks of anchors by
    their first `gram` bytes are known; each round pairs them with those of the next, equally long
    string, at an offset that doubles, ranks the pairs, and drops what is unique.
    """
    lengths = []
    while 2 * gram <= least // 2:
        lengths.append(gram)
        gram *= 2
    gram, size = (lengths or [gram])[0], F.length("ctx")
    ahead, behind = [], []
    for n in lengths:
        ahead.append(F.when(F.col("dx") + 2 * n <= size, _part(F.col("dx") + n, F.lit(n))))
        start = F.col("dx") + gram - 2 * n
        behind.append(F.when(start >= 0, _part(start, F.lit(n))))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.array(*ahead).alias("next")),
        F.struct(F.lit(1).alias("side"), F.array(*behind).alias("next")),
    )
    ranks = contexts.select("gram", "run", F.explode(sides).alias("s")).select(
        "gram", "run", "s.*", F.col("gram").alias("rank")
    )
    for k in range(len(lengths)):
        ranks = ranks.where(F.col("next")[k].isNotNull())
        ranks = stored(ranks.withColumn("rank", F.xxhash64("side", "rank", F.col("next")[k])), "suffix-ranks")
        shared = ranks.groupBy("side", "rank").agg(F.count("*").alias("n")).where(F.col("n") > 1)
        ranks = ranks.join(shared.select("side", "rank"), ["side", "rank"], "left_semi")
    return ranks.select("gram", "run").distinct()


def _boundary_windows(contexts: DataFrame, least: int) -> DataFrame:
    """(k, start, end) of repeated windows of runs that do not repeat as a whole.

    Windows are told apart by t, the anchor's offset in them. Cells of `CELL` values of t are
    compared first: if the bytes common to a cell's windows are unique, none of them repeats; if
    all their bytes repeat, all do; only cells in between are compared window by window.
    """
    first, last = F.col("dx") - F.col("wide"), F.col("dx")
    low = lambda c: F.greatest(c * CELL, first)
    high = lambda c: F.least(c * CELL + (CELL - 1), last)
    each = F.transform(
        F.sequence(F.floor(first / CELL).cast("int"), F.floor(last / CELL).cast("int")),
        lambda c: F.struct(
            c.alias("cell"),
            _part(F.col("dx") - c * CELL, F.lit(least - CELL + 1)).alias("core"),
            F.xxhash64(F.substring("ctx", F.col("dx") - high(c) + 1, high(c) - low(c) + least), low(c), high(c)).alias("whole"),
        ),
    )
    cells = stored(contexts.select("gram", "run", "n", F.explode(each).alias("c")).select("gram", "run", "n", "c.*"), "suffix-cells")
    cores = cells.groupBy("gram", "cell", "core").agg(F.count("*").alias("sharing")).where(F.col("sharing") > 1)
    wholes = cells.groupBy("gram", "cell", "whole").agg(F.sum("n").alias("times"), F.min("run").alias("one"))
    judged = cells.join(cores, ["gram", "cell", "core"]).join(wholes, ["gram", "cell", "whole"])
    judged = stored(judged.withColumn("open", (F.col("times") == 1)), "suffix-judged")
    open_cores = judged.where("open").select("gram", "cell", "core").distinct()
    # of equal cells one stands for all
    compared = judged.where(F.col("run") == F.col("one")).join(open_cores, ["gram", "cell", "core"], "left_semi")
    rows = contexts.join(compared.select("gram", "run", "cell", "times", "open"), ["gram", "run"])
    t = F.explode(F.sequence(low(F.col("cell")), high(F.col("cell"))))
    windows = rows.select("*", t.alias("t")).select(
        "gram", "t", _part(F.col("dx") - F.col("t"), F.lit(least)).alias("window"), "times", "open", "k",
        (F.col("lo") + F.col("dx") - F.col("t")).alias("start"),
    )
    windows = stored(windows, "suffix-windows")
    repeated = windows.groupBy("gram", "t", "window").agg(F.sum("times").alias("times")).where(F.col("times") > 1)
    single = windows.where("open").join(repeated.select("gram", "t", "window"), ["gram", "t", "window"], "left_semi")
    whole = judged.where((F.col("n") == 1) & ~F.col("open")).select("gram", "run", "cell")
    whole = contexts.select("gram", "run", "k", "lo", "wide", "dx").join(whole, ["gram", "run"])
    return single.select("k", "start", (F.col("start") + least).alias("end")).unionByName(
        whole.select(
            "k",
            (F.col("lo") + F.col("dx") - high(F.col("cell"))).alias("start"),
            (F.col("lo") + F.col("dx") - low(F.col("cell")) + least).alias("end"),
        )
    )


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """(k, start, end): byte spans, some overlapping, that cover what repeats in rows (k, text)."""
    known = stored(_positions(docs, least, gram), "suffix-positions")
    runs = known.groupBy("gram", "run").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("k", "lo", "wide", "dx")]
    )
    shared = runs.groupBy("gram").agg(F.count("*").alias("runs"), F.max("n").alias("most"))
    shared = shared.where((F.col("runs") > 1) | (F.col("most") > 1))
    runs = stored(runs.join(shared.drop("most"), "gram"), "suffix-runs")
    copied = known.join(runs.where(F.col("n") > 1).select("gram", "run"), ["gram", "run"], "left_semi")
    copied = copied.select("k", F.col("lo").alias("start"), (F.col("lo") + F.col("wide") + least).alias("end"))
    wanted = runs.where(F.col("runs") > 1).drop("runs")
    contexts = stored(_contexts(docs, wanted, least), "suffix-contexts")
    contexts = contexts.join(_doubled(contexts, least, gram), ["gram", "run"], "left_semi")
    contexts = stored(contexts, "suffix-survivors")
    return copied.unionByName(_boundary_windows(contexts, least))


#: Words of a passage, and of the strings that stand for its windows.
WORDS, WORD_GRAM = 51, 8
#: Words searched at a time; a longer text is read in overlapping parts.
_WORDS = 1 << 20


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each word of bytes, which hold at most `_PART`; ASCII white space parts words."""
    tables, space = powers(), _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["byte"][data] * tables["up"][: len(data)], out=sums[1:])
    hashes = (sums[end] - sums[start]) * tables["down"][start]
    return start, (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _text_words(text: memoryview) -> np.ndarray:
    """The hashes of a text's words. Bytes are read part by part, cut at white space; a longer word counts by its parts."""
    found, at, data = [], 0, np.frombuffer(text, np.uint8)
    while at < len(data):
        stop = min(at + _PART, len(data))
        if stop < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:stop]])
            stop = at + int(spaces[-1]) + 1 if len(spaces) else stop
        found.append(_word_hashes(data[at:stop])[1])
        at = stop
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _rolling(words: np.ndarray) -> np.ndarray:
    """Sums from which `_stretch` has the hash of any stretch of words."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers()["up"][: len(words)], out=sums[1:])
    return sums


def _stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    hashes = (sums[end] - sums[start]) * powers()["down"][start]
    return (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def word_anchors(words: np.ndarray, least: int = WORDS, gram: int = WORD_GRAM) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """(offset, (first, last, anchor, hash of its gram, hash of all words)) of runs of windows that share an anchor."""
    at = 0
    while at + least <= len(words):
        own = words[at : at + _WORDS]
        sums = _rolling(own)
        starts = np.arange(len(own) - gram + 1)
        grams = _stretch(sums, starts, starts + gram)
        # the leftmost of the smallest grams, by halving windows as for bytes
        smallest, wide, span = grams & ~np.uint64(_WORDS - 1) | starts.astype(np.uint64), least - gram + 1, 1
        while 2 * span <= wide:
            smallest = np.minimum(smallest[:-span], smallest[span:])
            span *= 2
        if span < wide:
            smallest = np.minimum(smallest[: span - wide], smallest[wide - span :])
        anchor = (smallest & np.uint64(_WORDS - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        last = np.concatenate([first[1:], [len(anchor)]]) - 1
        runs = _stretch(sums, first, last + least) + (last - first).astype(np.uint64) + (anchor[first] - first).astype(np.uint64) * np.uint64(_BASE)
        yield at, (first, last, anchor[first], grams[anchor[first]], runs)
        at += len(own) - least + 1


def repeated_passages(docs: DataFrame, least: int = WORDS, gram: int = WORD_GRAM) -> DataFrame:
    """k of the rows (k, text) in which some `least` words stand that also start anywhere else.

    As for bytes, each run of windows that share an anchor is compared as a whole first: texts with
    a run that occurs twice are settled. The windows of the others are compared one by one with
    those, of all texts, that share their anchor's gram.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch["k"].to_pylist(), batch["text"], strict=True):
                for _, (first, _, _, grams, runs) in word_anchors(_text_words(memoryview(text.as_buffer())), least, gram):
                    yield pa.RecordBatch.from_pydict({"k": np.full(len(first), key), "gram": grams.view(np.int64), "run": runs.view(np.int64)})

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, wanted in zip(batch["k"].to_pylist(), batch["text"], batch["runs"], strict=True):
                own = {(r["gram"], r["run"]) for r in wanted.as_py()}
                words = _text_words(memoryview(text.as_buffer()))
                for at, (first, last, anchor, grams, runs) in word_anchors(words, least, gram):
                    sums = _rolling(words[at : at + _WORDS])
                    picked, seen = [], set()
                    for i, pair in enumerate(zip(grams.view(np.int64).tolist(), runs.view(np.int64).tolist(), strict=True)):
                        if pair in own and pair not in seen:  # runs that repeat here are settled
                            picked.append(i)
                            seen.add(pair)
                    for i in picked:
                        starts = np.arange(first[i], last[i] + 1)
                        n = len(starts)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "k": np.full(n, key), "gram": np.full(n, grams[i].view(np.int64)),
                                "t": (anchor[i] - starts).astype(np.int32), "window": _stretch(sums, starts, starts + least).view(np.int64),
                            }
                        )

    known = stored(docs.mapInArrow(_joined(scan), "k long, gram long, run long"), "passage-runs")
    runs = known.groupBy("gram", "run").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    runs = stored(runs, "passage-distinct")
    whole = known.join(runs.where("n > 1").select("gram", "run"), ["gram", "run"], "left_semi").select("k").distinct()
    whole = stored(whole, "passage-whole")
    several = runs.groupBy("gram").agg(F.count("*").alias("runs")).where("runs > 1").select("gram")
    # runs of texts that are not settled, and the runs of others that they may share a window with
    unsettled = runs.join(several, "gram", "left_semi").join(whole, "k", "left_anti").select("gram").distinct()
    asked = runs.join(unsettled, "gram", "left_semi").groupBy("k").agg(F.collect_list(F.struct("gram", "run")).alias("runs"))
    single = docs.join(asked, "k").select("k", "text", "runs").mapInArrow(_joined(windows), "k long, gram long, t int, window long")
    single = stored(single, "passage-windows")
    shared = single.groupBy("gram", "t", "window").agg(F.count("*").alias("n")).where("n > 1")
    found = single.join(shared, ["gram", "t", "window"], "left_semi").select("k")
    result = stored(found.unionByName(whole).distinct(), "passage-found")
    discard(known, runs, whole, single)
    return result


def _joined(work):
    """The work's small batches put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for made in work(batches):
            waiting.append(made)
            rows += made.num_rows
            if rows >= 50_000:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, rows = [], 0
        if rows:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    return run


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM, words: int = WORDS
) -> DataFrame:
    """(id, n_bytes, spans, kept, repeats_passage) per row: spans are the maximal removed runs of bytes.

    A byte goes if a string of `least` bytes over it also starts anywhere else, in the same text or
    another. Matches lie within texts and are judged on the input. Null is the empty text; repeated
    rows remove each other; an empty table gives no rows. Strings are compared by two independent
    64-bit hashes. `kept` are bytes: a cut may fall within a character. `repeats_passage` is 1 if
    some `words` consecutive words of the text also stand anywhere else, however few bytes they
    have, else 0; nothing is removed for it.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("id", "text"))
    passages = repeated_passages(rows.select("k", "text"), words).withColumn("repeats", F.lit(1))
    spans = repeated_spans(rows.select("k", "text"), least, gram)
    lists = spans.groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = rows.join(lists.join(passages, "k", "full"), "k", "left").select("id", "text", "spans", "repeats")
    typed = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, merged, kept = [], [], []
            for text, own in zip(batch["text"], batch["spans"], strict=True):
                view = memoryview(text.as_buffer())
                gone = union(own.as_py() or [])
                edges = [0, *[x for span in gone for x in span], len(view)]
                sizes.append(len(view))
                merged.append([{"start": a, "end": b} for a, b in gone])
                kept.append(b"".join(view[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(sizes, pa.int64()), pa.array(merged, typed), pa.array(kept, pa.binary()), batch["repeats"].fill_null(0)],
                names=["id", "n_bytes", "spans", "kept", "repeats_passage"],
            )

    schema = f"id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary, repeats_passage int"
    return both.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def union(spans: list[dict]) -> list[tuple[int, int]]:
    """The spans' union as maximal spans, in order; spans that touch are one."""
    result: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result
