"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import stored

#: Of each kind of source: (curriculum time, weight) knots, joined by straight lines. The integral
#: is the source's weight in the mix: 3, 1 and 2. Kinds repeat over the sources in order.
Schedule = Sequence[tuple[float, float]]
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 2.0), (1.0, 4.0)),
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 2.0), (0.5, 2.0), (1.0, 2.0)),
)
SHARE = 1.5
MAX_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"
#: Documents ordered by one task at a time.
BUCKET_ROWS = 2_000


def areas(schedule: Schedule) -> list[float]:
    """The weight integrated up to each knot."""
    total, found = 0.0, [0.0]
    for (t0, r0), (t1, r1) in zip(schedule, schedule[1:], strict=False):
        total += (t1 - t0) * (r0 + r1) / 2
        found.append(total)
    return found


def time_of(share: Column, schedule: Schedule) -> Column:
    """The curriculum time by which the schedule has asked for `share` (0 to 1) of its words."""
    reached = areas(schedule)
    wanted = share * F.lit(reached[-1])
    result = F.lit(float(schedule[-1][0]))
    for k in reversed(range(len(schedule) - 1)):
        (t0, r0), (t1, r1) = schedule[k], schedule[k + 1]
        rest = wanted - F.lit(reached[k])
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * (r1 - r0) / (t1 - t0)) * rest, F.lit(0.0)))
        # the root that stays exact where the weight hardly changes
        inside = F.when(rest <= 0, F.lit(float(t0))).otherwise(F.lit(t0) + 2 * rest / (F.lit(r0) + root))
        result = F.when(wanted < F.lit(reached[k + 1]), inside).otherwise(result)
    return result


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule], share: float, max_repeats: int) -> DataFrame:
    """(unknown, source, kind, source_size, target) from one row (unknown, source, source_size) each.

    Targets are proportional to weights, none above `max_repeats` times its source: ordered by the
    factor at which each source is exhausted, a prefix is exhausted and the rest share what is left.
    """
    kinds, weights = len(schedules), [areas(s)[-1] for s in schedules]
    in_order = Window.orderBy("unknown", "source")
    ranked = sizes.withColumn("kind", (F.row_number().over(in_order) - 1) % kinds)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("kind") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.lit(max_repeats) * F.col("source_size"))
    budget = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    order = Window.orderBy(F.col("limit") / F.col("weight"), "unknown", "source")
    done, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("budget", budget)
        .withColumn("left", F.col("budget") - F.coalesce(F.sum("limit").over(done), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(later))
        .withColumn("exhausted", F.col("limit") * F.col("weights") <= F.col("left") * F.col("weight"))
    )
    # the first source in this order that is not exhausted fixes the factor for all after it
    first = F.min(F.when(~F.col("exhausted"), F.struct(F.col("limit") / F.col("weight"), F.col("left"), F.col("weights"))))
    rest = filled.withColumn("rest", first.over(Window.partitionBy()))
    target = F.when(F.col("exhausted"), F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.col("rest.left") / F.col("rest.weights")
    )
    return rest.select("unknown", "source", "kind", "source_size", target.alias("target"))


def planned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    bucket_rows: int = BUCKET_ROWS,
    carry: bool = False,
) -> DataFrame:
    """Per row of `docs`: id, size, source_size, target, taken, and takes, an array of
    (position, n_words) for each time that the mix reads it.

    A source's documents are read in the order of a hash of their id, again from the start when
    they are through, until its target is met; the last document read may be cut short. A position
    is the curriculum time at which the source's schedule has asked for the middle of the words
    read. Prefix sums run over hash buckets of bounded size first, so a source that holds most rows
    is ordered by many tasks. Null texts have size 0 and are not taken, null sources are one source
    (the last), repeated rows are documents of their own, an empty table gives none. With `carry`
    the whole row goes along as `row`.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        # the null source without a null, so that windows and joins are dealt out alike
        F.col(source_col).isNull().alias("unknown"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        words_in(F.col(text_col)).alias("size"),
        F.coalesce(F.md5(F.col(id_col).cast("string")), F.lit("")).alias("hash"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    if not carry:
        base = stored(base, "mixing")  # words are counted once
    per_source = base.groupBy("unknown", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    rows = per_source.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(rows / bucket_rows))
    lead = F.coalesce(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long"), F.lit(0))
    placed = base.withColumn("bucket", F.shiftright(lead * F.lit(buckets), 32))
    targets = source_targets(per_source.drop("n"), schedules, share, max_repeats)
    sums = placed.groupBy("unknown", "source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("unknown", "source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    starts = starts.drop("bucket_size").join(targets, ["unknown", "source"])
    cells = ["unknown", "source", "bucket"]
    within = Window.partitionBy(*cells).orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inner = placed.withColumn("inner", F.sum("size").over(within) - F.col("size"))
    both = inner.join(starts, cells)
    wanted = F.round("target").cast("long")
    takes = []
    for turn in range(max_repeats):
        at = F.lit(turn) * F.col("source_size") + F.col("start") + F.col("inner")
        n = F.greatest(F.least(wanted - at, F.col("size")), F.lit(0))
        middle = (at + n / F.lit(2)) / F.greatest(F.col("target"), F.lit(1.0))
        position = time_of(middle, schedules[-1])
        for kind, schedule in enumerate(schedules[:-1]):
            position = F.when(F.col("kind") == kind, time_of(middle, schedule)).otherwise(position)
        takes.append(F.when(n > 0, F.struct(position.alias("position"), n.alias("n_words"))))
    result = both.withColumn("takes", F.array_compact(F.array(*takes)))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda total, take: total + take["n_words"])
    columns = [F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), "takes"]
    return result.select(*columns, *(["row"] if carry else []))


def training_order(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, position, n_words): each time that the mix reads a document, range-sorted by position.

    This is the order of the rows of `mixed`.
    """
    each = planned(docs, id_col, **options).select(id_col, F.explode("takes").alias("take"))
    ordered = each.orderBy("take.position", F.col(f"`{id_col}`"), "take.n_words")
    return ordered.select(id_col, "take.position", "take.n_words")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, range-sorted by training position.

    The columns are those of `docs`. A document that is cut short keeps its first words, joined by
    blanks.
    """
    plan = planned(docs, id_col, text_col, source_col, carry=True, **options)
    each = plan.select("row", "size", F.explode("takes").alias("take"))
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(f"({WORD})"), 1), 1, F.col("take.n_words").cast("int")))
    text = F.when(F.col("take.n_words") < F.col("size"), cut).otherwise(F.col(f"row.`{text_col}`"))
    ordered = each.orderBy("take.position", F.col(f"row.`{id_col}`"), "take.n_words")
    return ordered.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
