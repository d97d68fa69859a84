"""WARC archives through a table of payload chunks, with digests carried from chunk to chunk."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import stored
from rosterlake.session import scratch_folder

#: Payload bytes of a chunk; no record is held as a whole but in the row that the scan reads.
CHUNK_BYTES = 1 << 20
#: Payload bytes of an archive, about.
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLOCK = 1 << 16


def chunk_table(rows: DataFrame, payload_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The other columns, with chunk, last and payload: at most `chunk_bytes` bytes of it a row.

    Each payload has at least one chunk, of no bytes if need be. Chunks follow each other in order
    within a task, so that what reads them can carry a digest along.
    """
    others = [c for c in rows.columns if c != payload_col]
    count = F.greatest(F.ceil(F.octet_length(payload_col) / chunk_bytes), F.lit(1)).cast("int")
    cut = rows.select(*others, payload_col, F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk"))
    part = F.substring(F.col(payload_col), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    last = (F.col("chunk") + 1) * chunk_bytes >= F.octet_length(payload_col)
    return cut.select(*others, "chunk", last.alias("last"), part.alias("payload"))


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def payload_digests(chunks: DataFrame) -> DataFrame:
    """(record, k, n_bytes, digest) from chunk rows (record, k, chunk, last, payload)."""
    kind = chunks.schema["record"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size = hashlib.sha1(), 0
        for batch in batches:
            done, rows = [], zip(batch["chunk"].to_pylist(), batch["last"].to_pylist(), batch["payload"], strict=True)
            for at, (chunk, last, payload) in enumerate(rows):
                if chunk == 0:
                    digest, size = hashlib.sha1(), 0
                view = payload.as_buffer()
                digest.update(view)
                size += view.size
                if last:
                    done.append((at, size, base32_sha1(digest)))
            places = pa.array([d[0] for d in done], pa.int32())
            sizes, digests = pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["record"].take(places), batch["k"].take(places), sizes, digests],
                names=["record", "k", "n_bytes", "digest"],
            )

    return chunks.mapInArrow(run, f"record {kind}, k long, n_bytes long, digest string")


def record_id(page: str | None, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{nth}')}>"


def headers(kind: str, page: str | None, nth: int, url: str | None, size: int, digest: str, first: str | None) -> bytes:
    """A record's WARC and HTTP headers; a revisit has the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = "".join(c for c in url or "" if c.isprintable())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page, nth)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(http) + (size if kind == 'response' else 0)}",
    ]
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, 0)}"]
        lines += [f"X-Refers-To-Page-ID: {first}"] if first is not None else []
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str | None = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes gzipped archives into `folder`, a record per row of `pages`; (archive, records) rows.

    Payloads are UTF-8 text or binary, null is empty. Of records with equal payloads of at least
    `least_bytes` bytes, the one with the smallest id is a response and the others revisit it; of
    repeated rows the first written is. Rows with a null id come after all others. Archives appear
    under their final names in one step, so that a task run twice leaves one of them. Payloads are
    shuffled once, by record, and sorted as rows of at most `chunk_bytes` bytes.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("record"),
        (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
        payload.alias("payload"),
        F.xxhash64(F.col(id_col), payload).alias("k"),
    )
    chunks = chunk_table(rows.select("record", "k", "payload"), "payload", chunk_bytes)
    digests = stored(payload_digests(chunks), "warc-digests")
    total = digests.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    archives = max(1, math.ceil(total / archive_bytes))
    firsts = digests.groupBy("digest", "n_bytes").agg(F.min("record").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where((F.col("n_bytes") >= least_bytes) & (F.col("n") > 1)).drop("n")
    roles = digests.distinct().join(firsts, ["digest", "n_bytes"], "left").select(
        F.col("k").alias("key"), F.col("record").alias("own"), "n_bytes", "digest", "first"
    )
    # chunks are cut before they are dealt; `row` keeps those of repeated rows apart
    cut = chunk_table(rows.withColumn("row", F.monotonically_increasing_id()), "payload", chunk_bytes)
    # both sides dealt alike, so that the join needs no other exchange of payloads
    left, right = cut.repartition(archives, "k"), roles.repartition(archives, "key")
    both = left.join(right, (F.col("k") == F.col("key")) & F.col("record").eqNullSafe(F.col("own")))
    revisits = F.col("first").isNotNull() & ~F.col("record").eqNullSafe(F.col("first"))
    # of a revisit's payload nothing is written: one row without it is enough
    ready = both.where(~revisits | (F.col("chunk") == 0)).select(
        F.col("record").cast("string").alias("record"),
        F.col("first").cast("string").alias("first"),
        revisits.alias("revisit"),
        (F.col("n_bytes") >= least_bytes).alias("large"),
        "url",
        "n_bytes",
        "digest",
        "row",
        "chunk",
        (revisits | F.col("last")).alias("last"),
        F.when(revisits, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    ).sortWithinPartitions("digest", "record", "row", "chunk")
    written = ready.mapInArrow(_writer(folder), "archive string, records long")
    return stored(written, "warc-index").where(F.col("records") > 0)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name, draft = f"{base}/{part:06d}.warc.gz", f"{base}/_{uuid.uuid4().hex}"
        records, seen, nth, member, stream = 0, None, 0, None, None
        for batch in batches:
            for row, payload in zip(batch.drop_columns(["payload"]).to_pylist(), batch["payload"], strict=True):
                if stream is None:
                    stream = files.open_output_stream(draft, compression=None)
                if row["chunk"] == 0:
                    same = seen == (row["digest"], row["record"])
                    nth, seen = nth + 1 if same else 0, (row["digest"], row["record"])
                    again = same and row["large"] and not row["revisit"]
                    kind = "revisit" if row["revisit"] or again else "response"
                    first = row["record"] if again else row["first"]
                    member = zlib.compressobj(LEVEL, wbits=31)
                    start = headers(kind, row["record"], nth, row["url"], row["n_bytes"], row["digest"], first)
                    stream.write(member.compress(start))
                if kind == "response":
                    stream.write(member.compress(payload.as_buffer()))
                if row["last"]:
                    stream.write(member.compress(b"\r\n\r\n") + member.flush())
                    records += 1
        if stream is not None:
            stream.close()
            files.move(draft, name)
        result = {"archive": [f"{folder}/{part:06d}.warc.gz"], "records": [records]}
        yield pa.RecordBatch.from_pydict(result, schema=pa.schema([("archive", pa.string()), ("records", pa.int64())]))

    return run


def read_warc(archives: DataFrame, id_type: str = "bigint") -> DataFrame:
    """A row per record of the archives named in the column `archive`.

    page_id, payload_bytes, payload_digest, record_type and refers_to; the digest of a response is
    computed from what is read, block by block, and must be the one its header states.
    """
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    kinds = pa.schema([(f, pa.int64() if f == "payload_bytes" else pa.string()) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch["archive"].to_pylist():
                files, path = pafs.FileSystem.from_uri(archive)
                with files.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as data:
                    rows = []
                    for row in records_of(data):
                        rows.append(row)
                        if len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    each = archives.select("archive").repartition(max(1, archives.count()))  # a task per archive
    read = each.mapInArrow(run, schema)
    return read.select(
        F.col("page_id").cast(id_type), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(id_type)
    )


def records_of(data) -> Iterator[dict]:
    """The records of one decompressed stream, read in blocks."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"Not a WARC record: {line[:40]!r}")
        outer = _fields(data)
        status = data.readline()
        inner = _fields(data)
        http = len(status) + sum(len(k) + len(v) + 4 for k, v in inner.items()) + 2
        left, digest = int(outer["Content-Length"]) - http, hashlib.sha1()
        size = int(inner["Content-Length"])
        stated = outer["WARC-Payload-Digest"].removeprefix("sha1:")
        if outer["WARC-Type"] == "response":
            if left != size:
                raise ValueError(f"Record {outer['WARC-Record-ID']} states two lengths")
            while left > 0:
                block = data.read(min(left, _BLOCK))
                if not block:
                    raise ValueError(f"Record {outer['WARC-Record-ID']} is cut off")
                digest.update(block)
                left -= len(block)
            if base32_sha1(digest) != stated:
                raise ValueError(f"Record {outer['WARC-Record-ID']} has another digest than its header")
        yield {
            "page_id": outer.get("X-Page-ID"),
            "payload_bytes": size,
            "payload_digest": stated,
            "record_type": outer["WARC-Type"],
            "refers_to": outer.get("X-Refers-To-Page-ID"),
        }


def _fields(data) -> dict[str, str]:
    found = {}
    while (line := data.readline()).strip():
        name, _, value = line.decode("utf-8").partition(":")
        found[name] = value.strip()
    return found


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Archives the pages below the shared folder and reads the archives back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    archives = write_warc(pages, folder, id_col, url_col, payload_col)
    return read_warc(archives, pages.schema[id_col].dataType.simpleString())
