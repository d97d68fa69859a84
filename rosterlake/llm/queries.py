"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import stored, table
from rosterlake.llm.conversations import audited, damaged, repaired_digests
from rosterlake.llm.decontamination import benchmark_hits, is_contaminated
from rosterlake.llm.mixing import planned, training_order
from rosterlake.llm.neighbours import near_vectors
from rosterlake.llm.paragraphs import repeated_paragraphs
from rosterlake.llm.periods import periodic_runs
from rosterlake.llm.personal import KINDS, TELLING, personal_data
from rosterlake.llm.sharding import SHARD_BYTES, shard_ids
from rosterlake.llm.simhash import simhash_groups
from rosterlake.llm.suffixes import without_repeats
from rosterlake.llm.tokens import token_round_trip
from rosterlake.llm.toxicity import is_held_out, toxicity_scores
from rosterlake.llm.warc import warc_round_trip


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, found = toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", is_held_out("doc_id").alias("held_out"), f"{found}.*")


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "text")
    return repeated_paragraphs(rows).drop("row").withColumnRenamed("id", "doc_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, hits = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    found = F.col(hits)
    names = F.array_sort(F.transform(found["item_ids"], lambda item: item.cast("string")))
    return rows.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        is_contaminated(hits).alias("contaminated"),
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        "repeats_passage",
    )


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # this tokenizer drops white space and never joins what it parts; workers do nothing else here
    return token_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), by_word=True, memo_words=1_200_000)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = near_vectors(table(spark, sf_dir, "embeddings"))
    return rows


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planned(table(spark, sf_dir, "documents")).drop("takes")


def op8_mixing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return shard_ids(docs.select("doc_id", F.octet_length("text").alias("n_bytes")), "doc_id", "n_bytes")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    turns = damaged(rows)
    audits = stored(audited(turns), "conversation-audits")
    digests = repaired_digests(turns, audits)
    # a row per conversation on each side, the original ones too: null ids meet as well
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    sides = rows.select("conv_id").distinct().unionByName(audits, allowMissingColumns=True)
    sides = sides.unionByName(digests, allowMissingColumns=True).groupBy("conv_id")
    return sides.agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # texts without a digit or @ hold no spans: only the others go to Python
    text = F.when(F.col("text").rlike(TELLING), F.col("text")).alias("text")
    rows, found = personal_data(docs.select("doc_id", text), redact=False)
    base, added = F.col(f"{found}.base"), F.col(f"{found}.added")
    said = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])

    def of(spans: Column, kind: str) -> Column:
        return F.array_sort(F.filter(spans, lambda s: s["kind"] == kind))

    both = F.concat(base, added)
    return rows.select(
        "doc_id",
        *[F.size(of(base, kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.transform(base, said), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.flatten(F.array(*[of(both, kind) for kind in KINDS])), said), ",").alias("spans"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, found = periodic_runs(docs, planted=True, texts=False)
    exponent = F.expr(f"1000 * {found}.length div {found}.period").alias("exponent_milli")
    own = [f"{found}.{c}" for c in ("n_runs", "start", "length", "period")]
    return rows.select("doc_id", *own, exponent, f"{found}.runs_sha256", f"{found}.collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_paragraph_dedup": op2_paragraph_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_output": op6_token_output,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_mixing": op8_mixing,
    "op8_mixing_order": op8_mixing_order,
    "op9_warc": op9_warc,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_personal_data": op12_personal_data,
    "op13_periodic_runs": op13_periodic_runs,
}

#: The rows of `planned`, but for what is taken: each document's place among the words of its source.
_PLACED = r"""
    WITH sized AS (
        SELECT doc_id, source, md5(doc_id::VARCHAR) AS hash,
               coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM documents),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind,
               CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                    WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
        FROM sized GROUP BY source),
    filled AS (
        SELECT *, 2 * source_size AS most, 2 * source_size / weight AS factor,
               1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
               sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
        FROM sources),
    first_left AS (
        SELECT remaining AS rest, weights AS shares FROM filled WHERE most * weights > remaining * weight
        ORDER BY factor, source NULLS LAST LIMIT 1),
    targets AS (
        SELECT source, source_size, kind,
               CASE WHEN most * weights <= remaining * weight THEN most::DOUBLE
                    ELSE weight * rest / shares END AS target
        FROM filled LEFT JOIN first_left ON true),
    placed AS (
        SELECT sized.*, source_size, kind, target,
               sum(size) OVER (PARTITION BY sized.source ORDER BY hash, doc_id
                               ROWS UNBOUNDED PRECEDING) - size AS start
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
"""

ORACLE: dict[str, str] = {
    "op8_mixing": _PLACED + """
        SELECT doc_id, size, source_size, target,
               (least(greatest(round(target) - start, 0), size)
                + least(greatest(round(target) - source_size - start, 0), size))::BIGINT AS taken
        FROM placed""",
    # the time t solves wanted = r0 * t + slope / 2 * t * t, the integral of each schedule of SCHEDULES
    "op8_mixing_order": _PLACED + """
        , read AS (
            SELECT doc_id, kind, target, turn * source_size + start AS place,
                   greatest(least(round(target) - (turn * source_size + start), size), 0)::BIGINT AS n_words
            FROM placed, range(0, 2) AS turns(turn)),
        shares AS (
            SELECT doc_id, n_words, kind,
                   (place::DOUBLE + n_words::DOUBLE / 2) / greatest(target, 1.0::DOUBLE)
                     * CASE kind WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS wanted
            FROM read WHERE n_words > 0)
        SELECT doc_id, n_words,
               CASE kind
                    WHEN 0 THEN CASE WHEN wanted < 3 THEN 2 * wanted / (2 + sqrt(4 + 4 * wanted)) ELSE 1 END
                    WHEN 1 THEN CASE WHEN wanted < 1 THEN 2 * wanted / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2 * wanted, 0)))
                                     ELSE 1 END
                    ELSE CASE WHEN wanted < 1 THEN 2 * wanted / 4
                              WHEN wanted < 2 THEN 0.5::DOUBLE + 2 * greatest(wanted - 1, 0) / 4 ELSE 1 END
               END::DOUBLE AS position
        FROM shares""",
    "op10_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                   ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT AS h
            FROM documents),
        nodes AS (
            SELECT d, h >> (28 - d) AS p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
            FROM hashed, range(0, 29) AS t(d) GROUP BY ALL),
        fitting AS (
            SELECT hashed.*, nodes.d, p, shard_bytes, shard_rows,
                   row_number() OVER (PARTITION BY doc_id ORDER BY nodes.d) AS nth
            FROM hashed JOIN nodes ON h >> (28 - nodes.d)::INTEGER = p
            WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
        SELECT doc_id, n_bytes, CASE d WHEN 0 THEN '' ELSE lpad(to_base(p, 2), d::INTEGER, '0') END AS shard,
               d::INTEGER AS depth, shard_rows, shard_bytes
        FROM fitting WHERE nth = 1""",
}
