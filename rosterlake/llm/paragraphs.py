"""Repeated paragraphs across documents: MinHash bands, exact Jaccard, components."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rosterlake.llm.common import components, fresh, stored
from rosterlake.llm.suffixes import powers

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Hashes of a band, and the chance that a pair at the threshold meets in one band at least.
BAND_ROWS = 2
RECALL = 0.997
#: Rows looked at together, bytes hashed at a time, and the length from which a word is hashed first.
_ROWS = 256
_PART = 1 << 20
_LONG = 1 << 15
#: Words of a passage, at least: what must repeat of one that is embedded in other text.
PASSAGE_WORDS = 16
_SENTENCE_END = re.compile(rb"(?<=[.!?]) ")
_MOST = np.uint64((1 << 64) - 1)


def bands_for(threshold: float = THRESHOLD, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands that find a pair at the threshold with the recall asked for."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def paragraphs_of(text: str | None) -> list[str]:
    """The text's lines without ASCII white space around them, blank ones left out."""
    return [line for part in (text or "").split("\n") if (line := part.strip(" \t\r\v\f"))]


def content_of(paragraph: str) -> bytes:
    """The paragraph's words, ASCII letters in lower case, joined by blanks."""
    words = paragraph.encode("utf-8", "replace").lower().split()
    return b" ".join(w if len(w) <= _LONG else b"\x00" + xxhash.xxh3_128_digest(w).hex().encode() for w in words)


def shingled(contents: list[bytes], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the hashes of each content's word shingles; fewer words are one shingle.

    Contents are hashed many at a time; a long one in parts that share all but one word of a shingle.
    """
    hashes, counts, waiting, size = [], [0] * len(contents), [], 0

    def flush() -> None:
        if waiting:
            found, own = _hashed([part for _, part in waiting], words)
            hashes.append(found)
            for (k, _), n in zip(waiting, own.tolist(), strict=True):
                counts[k] += n

    for k, content in enumerate(contents):
        for part in _parts(content, words):
            if size + len(part) + 1 > _PART:
                flush()
                waiting, size = [], 0
            waiting.append((k, part))
            size += len(part) + 1
    flush()
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _parts(content: bytes, words: int) -> Iterator[bytes]:
    if len(content) < _PART // 2:
        yield content
        return
    found, at = content.split(b" "), 0
    sizes = np.cumsum([len(w) + 1 for w in found])
    while True:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _PART // 2))
        yield b" ".join(found[at:end])
        if end >= len(found):
            return
        at = end - words + 1


def _hashed(contents: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number of them of each content), of contents that are short together."""
    data = np.frombuffer(b"\n".join([*contents, b""]), np.uint8)
    tables = powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["byte"][data] * tables["up"][: len(data)], out=sums[1:])
    ends = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    whose = np.concatenate([[0], np.cumsum(data[ends] == 10)[:-1]])
    n_words = np.bincount(whose, minlength=len(contents))
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    counts = np.maximum(n_words - words + 1, 1)
    at = np.arange(len(ends))
    begins = at[at - first[whose] < counts[whose]]  # the words that a shingle begins with
    last = begins + np.minimum(words, n_words[whose[begins]]) - 1
    spans = (sums[ends[last]] - sums[starts[begins]]) * tables["down"][starts[begins]]
    return mixed(spans + (ends[last] - starts[begins]).astype(np.uint64)), counts


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def band_hashes(
    hashes: np.ndarray, offsets: np.ndarray, bands: int, threshold: float = THRESHOLD, rows: int = BAND_ROWS
) -> np.ndarray:
    """A row of band hashes per content.

    Above a threshold of 3/4, sets of up to three shingles are similar only if equal: one hash each.
    """
    starts = offsets[:-1]
    low, high = np.minimum.reduceat(hashes, starts), np.maximum.reduceat(hashes, starts)
    whose = np.repeat(np.arange(len(starts)), np.diff(offsets))
    between = (hashes != low[whose]) & (hashes != high[whose])
    middle = np.minimum.reduceat(np.where(between, hashes, _MOST), starts)
    other = np.maximum.reduceat(np.where(between, hashes, np.uint64(0)), starts)
    small = (middle >= other) | ~np.logical_or.reduceat(between, starts)
    small &= threshold > 0.75
    whole = mixed(low + mixed(np.where(middle == _MOST, 0, middle) + mixed(high)))
    rng = np.random.default_rng(5)
    odd = rng.integers(0, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    found = np.empty((len(starts), bands), np.uint64)
    for band in range(bands):
        value = np.full(len(starts), np.uint64(band + 1))
        for row in range(rows):
            value = mixed(value + np.minimum.reduceat(mixed(hashes * odd[band, row]), starts))
        found[:, band] = np.where(small, whole, value)
    return found


def _paragraph_rows(rows: DataFrame, bands: int, threshold: float) -> DataFrame:
    """(row, id, k, no, h, b0, b1, ...): each paragraph with its content's hash and band hashes.

    A text without paragraphs has one row with nulls for them.
    """
    kind = rows.schema["id"].dataType.simpleString()
    names = [f"b{i}" for i in range(bands)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                yield paragraphs(batch.slice(at, _ROWS))

    def paragraphs(batch: pa.RecordBatch) -> pa.RecordBatch:
        whose, numbers, contents = [], [], []
        for at, text in enumerate(batch["text"].to_pylist()):
            for no, paragraph in enumerate(paragraphs_of(text) or [None]):
                whose.append(at)
                numbers.append(None if paragraph is None else no)
                contents.append(b"" if paragraph is None else content_of(paragraph))
        if not contents:
            return pa.RecordBatch.from_pylist([], schema=to_arrow_schema(StructType.fromDDL(schema)))
        places, empty = pa.array(whose, pa.int32()), np.array([n is None for n in numbers], bool)
        matrix = band_hashes(*shingled(contents), bands, threshold).view(np.int64)
        known = np.array([xxhash.xxh3_64_intdigest(c) for c in contents], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch["row"].take(places), batch["id"].take(places), batch["k"].take(places), pa.array(numbers, pa.int32())]
            + [pa.array(np.ascontiguousarray(c), mask=empty) for c in (known, *matrix.T)],
            names=["row", "id", "k", "no", "h", *names],
        )

    schema = f"row long, id {kind}, k long, no int, h long, " + ", ".join(f"{n} long" for n in names)
    return rows.mapInArrow(run, schema)


def _shingle_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, shingles) of the paragraphs (k, no, h) of `wanted`, read again from their texts."""
    lists = wanted.groupBy("k").agg(F.collect_list(F.struct("no", "h")).alias("wanted"))
    schema = pa.schema([("h", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch["text"], batch["wanted"].to_pylist(), strict=True):
                paragraphs = paragraphs_of(text.as_py())
                hashes, offsets = shingled([content_of(paragraphs[one["no"]]) for one in own])
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one["h"] for one in own], pa.int64()), pa.array(sets, schema[1].type)], schema=schema
                )

    texts = rows.select("k", "text").join(lists, "k").select("text", "wanted")
    return texts.mapInArrow(run, "h long, shingles array<long>").dropDuplicates(["h"])


def _are_similar(threshold: float) -> Column:
    """Whether the shingle sets s and t have a Jaccard similarity of the threshold or more."""
    both = F.size(F.array_intersect("s", "t"))
    apart = F.size("s") + F.size("t") - both
    return both >= F.lit(threshold) * apart - 1e-9


def _similar_links(distinct: DataFrame, rows: DataFrame, bands: int, threshold: float) -> DataFrame:
    """(a, b): verified links that connect all similar contents which meet in a band.

    In a band's list each content is first compared with the most frequent one, which edited copies
    are closest to; lists whose members this connects need nothing else, however long they are. In
    the rest, members of different components are compared, within the join, which hands on links
    alone; a pair that meets in several bands is compared in the first.
    """
    names = [f"b{i}" for i in range(bands)]
    each = distinct.select("h", "n", F.explode(F.array_distinct(F.array(*names))).alias("band"))
    lists = each.groupBy("band").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.max_by("h", "n").alias("centre"))
    lists = lists.where(F.col("lo") < F.col("hi")).select("band", "centre")
    members = stored(each.drop("n").join(lists, "band"), "paragraph-bands")
    wanted = members.select("h").distinct().join(distinct.select("h", "k", "no"), "h")
    sets = stored(_shingle_sets(rows, wanted), "paragraph-shingles")
    pairs = members.select(F.col("h").alias("a"), F.col("centre").alias("b")).where(F.col("a") != F.col("b")).distinct()
    left = sets.select(F.col("h").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("h").alias("b"), F.col("shingles").alias("t"))
    star = pairs.join(left, "a").join(right, "b").where(_are_similar(threshold)).select("a", "b")
    star = stored(star, "paragraph-links")
    groups = components(star)
    placed = members.join(groups, members["h"] == groups["node"], "left").select(
        "band", "h", F.coalesce("component", "h").alias("grp")
    )
    spread = placed.groupBy("band").agg(F.min("grp").alias("least"), F.max("grp").alias("most"))
    mixed_lists = spread.where(F.col("least") < F.col("most")).select("band")
    placed = placed.join(mixed_lists, "band", "left_semi").join(sets, "h")
    placed = placed.join(distinct.select("h", F.array(*names).alias("own")), "h")
    placed = stored(placed.withColumn("size", F.size("shingles")), "paragraph-lists")
    left = placed.select(
        F.col("band").alias("p"), F.col("h").alias("a"), F.col("grp").alias("x"), F.col("own").alias("i"), F.col("size").alias("m"), F.col("shingles").alias("s")
    )
    right = placed.select(
        F.col("band").alias("q"), F.col("h").alias("b"), F.col("grp").alias("y"), F.col("own").alias("j"), F.col("size").alias("n"), F.col("shingles").alias("t")
    )
    meet_first = F.lit(False)
    for k in reversed(range(bands)):
        same = F.col("i")[k] == F.col("j")[k]
        meet_first = F.when(same, F.col("i")[k] == F.col("p")).otherwise(meet_first)
    sized = (F.col("m") >= F.lit(threshold) * F.col("n") - 1e-9) & (F.col("n") >= F.lit(threshold) * F.col("m") - 1e-9)
    compared = (F.col("p") == F.col("q")) & (F.col("x") < F.col("y")) & sized & meet_first & _are_similar(threshold)
    return star.unionByName(left.join(right, compared).select("a", "b"))


def passages_of(text: str | None, words: int = PASSAGE_WORDS) -> list[bytes]:
    """From each sentence on, the fewest whole sentences that have so many words together.

    Sentences end with a line or with `.`, `!` or `?` before white space. What surrounds a passage
    does not change the sentences in it, so one that repeats amid other lines is found by them.
    """
    sentences = [s for p in paragraphs_of(text) for s in _SENTENCE_END.split(content_of(p))]
    sizes = np.cumsum([0, *(s.count(b" ") + 1 for s in sentences)])
    joined, places = b" ".join(sentences), np.cumsum([0, *(len(s) + 1 for s in sentences)]).tolist()
    ends = np.searchsorted(sizes, sizes[:-1] + words).tolist()
    return [joined[places[i] : places[e] - 1] for i, e in enumerate(ends) if e < len(sizes)]


def _passage_rows(rows: DataFrame) -> DataFrame:
    """(row, id, no, h): the hash of each passage of each text."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                found = [[xxhash.xxh3_64_intdigest(p) for p in passages_of(t)] for t in part["text"].to_pylist()]
                sizes = [len(f) for f in found]
                places = pa.array(np.repeat(np.arange(len(found)), sizes))
                numbers = np.concatenate([np.zeros(0, np.int32), *(np.arange(n, dtype=np.int32) for n in sizes)])
                hashes = np.array([h for f in found for h in f], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part["row"].take(places), part["id"].take(places), pa.array(numbers), pa.array(hashes)],
                    names=["row", "id", "no", "h"],
                )

    return rows.select("row", "id", "text").mapInArrow(run, f"row long, id {kind}, no int, h long")


def _judged(named: DataFrame) -> DataFrame:
    """(row, no, gone, kept_in) of the rows (row, id, no, class) that are not alone in their class.

    The row with the smallest id stays (nulls last; then by row and number), the others are gone.
    """
    # each table is written, so that a join's sides are plain and a frequent class can be split
    repeated = named.groupBy("class").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("class")
    several = stored(named.join(stored(repeated, "repeated"), "class", "left_semi"), "several")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "row", "no")
    keepers = stored(several.groupBy("class").agg(F.min(order).alias("keeper")), "keepers")
    gone = (F.col("keeper.row") != F.col("row")) | (F.col("keeper.no") != F.col("no"))
    return several.join(keepers, "class").select("row", "no", gone.alias("gone"), F.col("keeper.id").alias("kept_in"))


def repeated_paragraphs(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """From rows (row, id, text): one row each of row, id, n_paragraphs, n_repeated, removed, kept_in,
    n_passages, passages_in.

    Paragraphs are lines. Those of a class have equal content or are connected by similarities of
    the threshold or more; n_repeated counts a text's paragraphs that are not alone in their class.
    The class's paragraph in the row with the smallest id (nulls last; then row and number) is kept,
    the others are `removed`: their numbers, with the ids in `kept_in` of the rows that keep theirs.
    n_passages counts passages (runs of sentences) that equal others, wherever lines begin, and
    `passages_in` has the ids of the rows that keep those which are not kept here. Null and blank
    texts have neither; `row` must be unique, ids may repeat.
    """
    bands = bands_for(threshold)
    rows = rows.withColumn("k", F.xxhash64("id", "text"))
    every = stored(_paragraph_rows(rows, bands, threshold), "paragraphs")
    found = every.where(F.col("no").isNotNull())
    distinct = found.groupBy("h").agg(
        F.first("k").alias("k"),
        F.first("no").alias("no"),
        F.count("*").alias("n"),
        *[F.first(f"b{i}").alias(f"b{i}") for i in range(bands)],
    )
    distinct = stored(distinct, "paragraph-contents")
    classes = components(_similar_links(distinct, rows, bands, threshold))
    named = found.join(classes, found["h"] == classes["node"], "left").select(
        "row", "id", "no", F.coalesce("component", "h").alias("class")
    )
    paragraphs = _judged(stored(named, "paragraph-classes"))
    passages = _judged(stored(_passage_rows(rows), "passages").withColumnRenamed("h", "class"))
    gone = F.when(F.col("gone"), F.struct("no", "kept_in"))
    own = paragraphs.groupBy("row").agg(
        F.count("*").alias("n_repeated"), F.sort_array(F.collect_list(gone)).alias("gone")
    )
    other = passages.groupBy("row").agg(
        F.count("*").alias("n_passages"),
        F.sort_array(F.collect_set(F.when(F.col("gone"), F.col("kept_in")))).alias("passages_in"),
    )
    counts = every.groupBy("row").agg(F.first("id").alias("id"), F.count("no").alias("n_paragraphs"))
    kind = rows.schema["id"].dataType.simpleString()
    joined = counts.join(own, "row", "left").join(other, "row", "left")
    joined = joined.withColumn("gone", F.coalesce("gone", F.array().cast(f"array<struct<no: int, kept_in: {kind}>>")))
    zero = F.lit(0).cast("long")
    return joined.select(
        "row",
        "id",
        "n_paragraphs",
        F.coalesce("n_repeated", zero).alias("n_repeated"),
        F.col("gone.no").alias("removed"),
        F.col("gone.kept_in").alias("kept_in"),
        F.coalesce("n_passages", zero).alias("n_passages"),
        F.coalesce("passages_in", F.array().cast(f"array<{kind}>")).alias("passages_in"),
    )


def without_repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of `docs`, their texts without repeated paragraphs; what is left is joined by line ends.

    Texts that lose nothing stay as they are.
    """
    row, gone = fresh(docs, "paragraph_row"), fresh(docs, "paragraphs_gone")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "paragraph-rows")
    found = repeated_paragraphs(kept.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")), threshold)
    removed = found.where(F.size("removed") > 0).select(F.col("row").alias(row), F.col("removed").alias(gone))
    joined = kept.join(removed, row, "left").select(*docs.columns, gone)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, numbers in zip(batch.column(at).to_pylist(), batch.column(len(docs_columns)).to_pylist(), strict=True):
                if numbers:
                    out = set(numbers)
                    text = "\n".join(p for no, p in enumerate(paragraphs_of(text)) if no not in out)
                texts.append(text)
            columns = [*batch.columns[: len(docs_columns)]]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return joined.mapInArrow(run, docs.schema)
