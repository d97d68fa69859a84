"""SimHash fingerprints and near duplicates within a few differing bits, by multi-index hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import appended, components, fresh, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Shingles hashed at a time, so that one very long text does not fill a worker's memory.
BLOCK = 1 << 18


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 if it is null or has no word.

    ASCII letters are lower-cased, words are runs without ASCII white space, shingles count as
    often as they occur, and a bit is set if more than half of the XXH64 values have it.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, key, fp): a 64-bit fingerprint per row of `docs`, and a hash that tells its text."""

    def work(texts: list) -> list[list]:
        return [[fingerprint_of(t, words) for t in texts]]

    chosen = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    return appended(chosen, "text", {"fp": "bigint"}, work).drop("text")


def segments(max_bits: int, parts: int | None = None) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each of `parts` segments of a 64-bit fingerprint.

    Two fingerprints within `max_bits` agree with one segment up to its radius, because the radii
    plus one sum to `max_bits + 1`. Fewer parts are wider and have larger balls: they list fewer
    chance matches, which grow with the square of the rows, for more probes a row. By default radii
    are at most 1.
    """
    parts = (max_bits + 2) // 2 if parts is None else parts
    if not 1 <= parts <= max_bits + 1:
        raise ValueError(f"{max_bits} bits take 1 to {max_bits + 1} segments, not {parts}")
    radii = [(max_bits + 1) // parts - 1 + (i < (max_bits + 1) % parts) for i in range(parts)]
    # a segment without a ball can be narrower: it is probed once
    widths, left = [], 64
    for i in range(len(radii)):
        widths.append(left // (len(radii) - i))
        left -= widths[-1]
    widths.reverse()
    firsts = np.cumsum([0, *widths[:-1]]).tolist()
    return list(zip(firsts, widths, radii, strict=True))


def ball(width: int, radius: int) -> list[int]:
    """The differences of up to `radius` bits, but for none, that values of `width` bits can have."""
    return [sum(1 << i for i in bits) for n in range(1, radius + 1) for bits in combinations(range(width), n)]


def _listed(distinct: DataFrame, max_bits: int, parts: int | None, *columns: str) -> DataFrame:
    """(k, value, *columns): each fingerprint under the value of each of its segments."""
    rows = [
        F.struct(F.lit(k).alias("k"), _value(first, width).alias("value"))
        for k, (first, width, _) in enumerate(segments(max_bits, parts))
    ]
    return distinct.select(*columns, F.explode(F.array(*rows)).alias("s")).select(*columns, "s.*")


def _value(first: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def star_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between each fingerprint and the smallest and largest of its segments' lists.

    Linear in the rows. In a dense group, where the number of links grows with its square, these
    few already connect most members.
    """
    table = _listed(distinct, max_bits, None, "fp")
    ends = table.groupBy("k", "value").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    ends = ends.where(F.col("lo") < F.col("hi"))
    near = table.join(ends, ["k", "value"])
    return near.select(F.col("fp").alias("a"), F.explode(F.array("lo", "hi")).alias("b")).where(
        (F.col("a") != F.col("b")) & (differing("a", "b") <= max_bits)
    )


def near_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(a, b): links of at most `max_bits` bits between rows (fp, grp) of different groups.

    Each fingerprint is listed under its segments' values and probes the small Hamming ball around
    each of them; matches are verified over all 64 bits. Of two values that differ, the one with the
    highest such bit set probes for the other, so half a ball finds every pair once.

    For 4 bits the default, 3 segments of 22, 21 and 21 bits, takes some 25 probes a fingerprint, and
    2 of 32 bits take some 282; chance matches a fingerprint are rows * 25 / 2^21 and
    rows * 282 / 2^32. So 2 parts cost less from some 20 million distinct fingerprints on.
    """
    probes = []
    for k, (first, width, radius) in enumerate(segments(max_bits, parts)):
        value = _value(first, width)
        probes.append(F.struct(F.lit(k).alias("k"), value.alias("value"), F.lit(True).alias("same")))
        for mask in ball(width, radius):
            lower = F.struct(
                F.lit(k).alias("k"), value.bitwiseXOR(F.lit(mask)).alias("value"), F.lit(False).alias("same")
            )
            probes.append(F.when(value.bitwiseAND(F.lit(1 << mask.bit_length() - 1)) != 0, lower))
    asked = distinct.select(
        F.col("fp").alias("a"),
        F.col("grp").alias("a_grp"),
        F.explode(F.array_compact(F.array(*probes))).alias("s"),
    ).select("a", "a_grp", "s.*")
    table = _listed(distinct, max_bits, parts, "fp", "grp").select(
        "k", "value", F.col("fp").alias("b"), F.col("grp").alias("b_grp")
    )
    return (
        asked.join(table, ["k", "value"])
        .where(
            (F.col("a_grp") != F.col("b_grp"))
            & (~F.col("same") | (F.col("a") < F.col("b")))
            & (differing("a", "b") <= max_bits)
        )
        .select("a", "b", "a_grp", "b_grp")
    )


def fingerprint_groups(distinct: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None) -> DataFrame:
    """(fp, root): one row per row of the distinct column `fp`, with the root of its group.

    First the linear star links, then all links between different groups of these: a dense group
    of near copies is mostly one group by then, so that its pairs are never listed.
    """
    first = components(star_links(distinct, max_bits))
    grouped = stored(
        distinct.join(first, distinct["fp"] == first["node"], "left").select(
            "fp", F.coalesce("component", "fp").alias("grp")
        ),
        "simhash-groups",
    )
    links = near_fingerprints(grouped, max_bits, parts).select(F.col("a_grp").alias("a"), F.col("b_grp").alias("b"))
    merged = components(links)
    return grouped.join(merged, grouped["grp"] == merged["node"], "left").select(
        "fp", F.coalesce("component", "grp").alias("root")
    )


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    parts: int | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id): near-duplicate groups of the rows of `docs`.

    Rows with one fingerprint are one node, so copies are never paired; component_id is the
    smallest id reachable over links of at most `max_bits` differing bits. Null and empty texts
    have fingerprint 0 and are linked like any other; `parts` is the number of segments that
    `near_fingerprints` looks up, which changes costs and no row; repeated rows each get their row; an empty
    table gives none. Rows with a null id get a null component unless their group has an id.
    """
    known, named = _grouped(docs, id_col, text_col, words, max_bits, parts)
    return known.join(named, "fp").select(
        F.col("id").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int, parts: int | None
) -> tuple[DataFrame, DataFrame]:
    """(id, key, fp) of all rows, and (fp, root, component_id) of the distinct fingerprints."""
    known = stored(fingerprints(docs, id_col, text_col, words), "simhash")
    firsts = stored(known.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    rooted = firsts.join(fingerprint_groups(firsts.select("fp"), max_bits, parts), "fp")
    rooted = stored(rooted, "simhash-rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return known, rooted.join(smallest, "root").select("fp", "root", "component_id")


def without_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    parts: int | None = None,
) -> DataFrame:
    """One row of `docs` of each group: that with the smallest id (nulls last, then any one text).

    Fingerprints and groups are narrow; the texts are shuffled once, to pick the rows that stay.
    """
    known, named = _grouped(docs, id_col, text_col, words, max_bits, parts)
    order = F.struct(F.col("id").isNull(), "id", "key")
    kept = known.join(named, "fp").groupBy("root").agg(F.min(order).alias("one")).select("one.id", "one.key")
    key = fresh(docs, "text_key")
    rows = docs.withColumn(key, F.xxhash64(text_col))
    kept = kept.select(F.col("id").alias(fresh(rows, "kept_id")), F.col("key").alias(fresh(rows, "kept_key")))
    same = rows[id_col].eqNullSafe(kept[kept.columns[0]]) & (rows[key] == kept[kept.columns[1]])
    return rows.join(kept, same, "left_semi").dropDuplicates([id_col, key]).drop(key)
