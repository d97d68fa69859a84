"""ZIP archives and plain files that Spark derives from the given tables."""

from __future__ import annotations

import sys
import uuid
import zipfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.session import scratch_folder
from rosterlake.sources.archives import listing_tasks, open_filesystem, publish
from workload.records import POSITION, RECORD_EXPRESSIONS, customer_orders, record_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBER = "npidata_pfile_{month}01-{month}28"
CSV_OPTIONS = {
    "escape": '"',
    "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
ARCHIVE_TASKS = 256  # more than archives, so that few share a task and none needs to spill
EMPTIED = 3
FOLDERS = 1000


def write_archives(spark: SparkSession, sf_dir: str) -> str:
    """One ZIP per release and month of orders, with the records as CSV. Returns the folder.

    Orders, far narrower than their records, are dealt to archives and sorted; each task spells out
    the records' lines and streams them into its archives. What is written is the ZIP files alone.
    """
    folder = scratch_folder(spark, "archives")
    dealt = (
        customer_orders(spark, sf_dir)
        .repartition(max(ARCHIVE_TASKS, listing_tasks(spark)), "release", "month")
        .sortWithinPartitions("release", "month", POSITION)
    )
    line = F.to_csv(F.struct(*[F.col(f"`{name}`") for name in RECORD_EXPRESSIONS]), CSV_OPTIONS)
    lines = record_rows(dealt).select(
        "release", F.coalesce("month", F.lit("")).alias("month"), line.cast("binary").alias("line")
    )
    header = (",".join(f'"{name}"' for name in RECORD_EXPRESSIONS) + "\n").encode()

    def zip_months(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_filesystem(folder)
        for drafts in ("drafts", "zips"):
            filesystem.create_dir(f"{base}/{drafts}", recursive=True)
        runs = ((key, run["line"]) for batch in batches for key, run in batch.groupby(["release", "month"]))
        for (name, month), same in groupby(runs, key=itemgetter(0)):
            target, draft = f"{base}/zips/extract_{name}_{month}.zip", f"{base}/drafts/{uuid.uuid4().hex}"
            member_name = MEMBER.format(month=month)
            with (
                filesystem.open_output_stream(draft) as sink,
                zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive,
            ):
                archive.writestr(f"{member_name}_fileheader.csv", "header only\n")
                archive.writestr(f"docs/readme_{name}.txt", "reference file\n")
                with archive.open(f"{member_name}.csv", "w", force_zip64=True) as member:
                    member.write(header)
                    for _, run in same:
                        member.write(b"\n".join(run) + b"\n")
            publish(filesystem, draft, target)
            yield pd.DataFrame({"archive": [target]})

    lines.mapInPandas(zip_months, "archive string").write.parquet(f"{folder}/written")
    return f"{folder}/zips"


def write_documents(spark: SparkSession, sf_dir: str) -> str:
    """Each document as one text file, and an empty file beside that of `EMPTIED`. Returns the files' glob.

    Tasks write the files themselves, into folders that each hold a share of them: the committer of
    Spark's partitioned writer moves file by file on the driver, and one folder of all is listed by
    one task. Texts of one document are lines of one file; a task that runs again writes the same.
    """
    folder = scratch_folder(spark, "documents")
    documents: DataFrame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = documents.select(
        F.format_string("%03d", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDERS))).alias("share"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("doc"),
        F.col("text").cast("binary").alias("text"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, base = open_filesystem(f"{folder}/files")
        shares, files = set(), 0
        rows = (row for batch in batches for row in zip(batch["share"], batch["doc"], batch["text"]))
        for (share, doc), same in groupby(rows, key=itemgetter(0, 1)):
            if share not in shares:
                filesystem.create_dir(f"{base}/{share}", recursive=True)
                shares.add(share)
            target = f"{base}/{share}/doc_id={doc}"
            with filesystem.open_output_stream(draft := f"{target}.{uuid.uuid4().hex}.draft") as sink:
                for *_, text in same:
                    sink.write((text or b"") + b"\n")
            publish(filesystem, draft, f"{target}.txt")
            files += 1
        yield pd.DataFrame({"files": [files]})

    together = names.repartition("share", "doc").sortWithinPartitions("share", "doc")
    together.mapInPandas(write, "files long").write.parquet(f"{folder}/written")
    empty = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/files/empty/doc_id={EMPTIED}.txt")
    files = empty.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(empty).close()
    return f"{folder}/files/*/*.txt"
