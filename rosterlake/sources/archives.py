"""ZIP archives: member listing, landing of the main file, digests.

Spark has no ZIP codec, so one task per archive streams bytes; a DEFLATE stream cannot be split.
The task digests the archive on the way and cuts the stream into part files at record ends; Spark
parses those in parallel. Small archives share tasks. File names are fixed by content
position and each file appears in one step, so a retried or duplicated task rewrites the same
files.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import re
import sys
import uuid
import zipfile
from collections.abc import Iterator
from functools import partial, reduce
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.errors import MALFORMED, ArchiveError
from rosterlake.layout import HEADER_FILE_SUFFIX, MAIN_FILE_PREFIX, MAIN_FILE_SUFFIX
from rosterlake.session import split_bytes

# Tasks get these helpers with the job; workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 20
NAMES = 10_000
SMALLEST_PART = 4 << 20
LANDED = "archive string, part string, bytes long, records long, header string, sha256 string"


def open_filesystem(uri: str):
    """(file system, path) of a location as Spark writes it, such as `file:/x` or `s3a://b/x`."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")


def _open(uri: str):
    filesystem, path = open_filesystem(uri)
    return filesystem.open_input_file(path)


def _alternatives(pattern: str) -> list[str]:
    """The patterns without braces that a glob with braces stands for."""
    found = re.search(r"(?<!\\)\{((?:[^{}\\]|\\.)*)\}", pattern)
    if not found:
        return [pattern]
    parts = re.split(r"(?<!\\),", found.group(1))
    return [p for part in parts for p in _alternatives(pattern[: found.start()] + part + pattern[found.end() :])]


_SPECIAL = re.compile(r"\\(.)|\[([!^]?)((?:\\.|[^\]\\])+)\]|(\*)|(\?)|(.)", re.DOTALL)


def _name_pattern(component: str) -> str | None:
    """A regular expression for one name of a glob; None if it stands for itself."""
    parts, special = [], False
    for escaped, negated, names, any_text, any_one, plain in _SPECIAL.findall(component):
        special |= bool(names or any_text or any_one)
        if names:
            parts.append(f"[{'^' if negated else ''}{names}]")
        else:
            parts.append(".*" if any_text else "." if any_one else re.escape(escaped or plain))
    return "".join(parts) if special else None


def _listed(uri: str) -> list[tuple[str, bool, int]]:
    """(name, is a folder, length) of what a folder holds, without checksum files of files beside them."""
    from pyarrow import fs

    filesystem, path = open_filesystem(uri)
    try:
        found = filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True))
    except NotADirectoryError:
        return []
    names = {f.base_name for f in found}
    return [
        (f.base_name, f.type == fs.FileType.Directory, f.size or 0)
        for f in found
        if not (f.base_name.startswith(".") and f.base_name.endswith(".crc") and f.base_name[1:-4] in names)
    ]


def archive_files(spark: SparkSession, archives: str) -> DataFrame:
    """Path and length of each file that a path, folder or glob names; contents are not read.

    Tasks list the folders, one level of the glob after another, so that neither the driver nor one
    task sees all names. Files of every name and length count, but for checksum files: `.x.crc`
    beside `x`. Of a folder that is named, the files in it count.
    """
    from pyarrow import fs

    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf, tasks = spark.sparkContext._jsc.hadoopConfiguration(), listing_tasks(spark)
    frames = []
    for pattern in _alternatives(archives):
        path = where(pattern)
        names = path.getFileSystem(conf).makeQualified(path).toString().split("/")
        kinds = [_name_pattern(name) for name in names]
        first = next((i for i, kind in enumerate(kinds) if kind is not None), len(names))
        unescaped = [re.sub(r"\\(.)", r"\1", name) for name in names]
        frame = spark.createDataFrame([("/".join(unescaped[:first]) or "/",)], "archive string")

        def level(batches: Iterator[pd.DataFrame], kind: str | None, name: str) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = []
                for uri in batch["archive"]:
                    held = [name] if kind is None else [n for n, *_ in _listed(uri) if re.fullmatch(kind, n, re.DOTALL)]
                    found += [f"{uri.rstrip('/')}/{n}" for n in held]
                    if len(found) >= NAMES:
                        yield pd.DataFrame({"archive": found}, dtype=str)
                        found = []
                yield pd.DataFrame({"archive": found}, dtype=str)

        def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = []
                for uri in batch["archive"]:
                    filesystem, path = open_filesystem(uri)
                    info = filesystem.get_file_info(path)
                    if info.type == fs.FileType.File:
                        found.append((uri, info.size))
                    elif info.type == fs.FileType.Directory:
                        found += [(f"{uri.rstrip('/')}/{n}", size) for n, is_folder, size in _listed(uri) if not is_folder]
                yield pd.DataFrame(found, columns=["archive", "length"])

        for at in range(first, len(names)):
            step = partial(level, kind=kinds[at], name=unescaped[at])
            frame = frame.mapInPandas(step, "archive string")
            if kinds[at] is not None:
                frame = frame.repartition(tasks)
        frames.append(frame.mapInPandas(files, "archive string, length long"))
    return reduce(DataFrame.unionByName, frames).distinct() if len(frames) > 1 else frames[0]


def listing_tasks(spark: SparkSession) -> int:
    """Tasks over rows that are short and stand for files: by cores, since their bytes tell nothing."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri in batch["archive"]:
            try:
                with _open(uri) as stream, zipfile.ZipFile(stream) as opened:
                    found = [(uri, m.filename, m.file_size, None) for m in opened.infolist()]
            except (zipfile.BadZipFile, ValueError) as error:  # ValueError: too short to seek
                found = [(uri, None, None, str(error))]
            yield pd.DataFrame(found, columns=["archive", "member", "bytes", "problem"])


def archive_members(spark: SparkSession, archives: str) -> DataFrame:
    """(archive, member, bytes, problem), from the archives' directories alone."""
    files = archive_files(spark, archives).repartition(listing_tasks(spark))
    return files.mapInPandas(
        _list_members, "archive string, member string, bytes long, problem string"
    )


def is_main_member() -> Column:
    """A main-file name, and not its header companion."""
    member = F.col("member")
    return (
        F.substring_index(member, "/", -1).startswith(MAIN_FILE_PREFIX)
        & F.lower(member).endswith(MAIN_FILE_SUFFIX)
        & ~F.lower(member).endswith(HEADER_FILE_SUFFIX)
    )


def main_members(spark: SparkSession, archives: str) -> DataFrame:
    """The main member of each archive; every archive must hold exactly one."""
    members = archive_members(spark, archives)
    per_archive = members.groupBy("archive").agg(
        F.count_if(is_main_member()).alias("found"),
        F.min(F.when(is_main_member(), F.col("member"))).alias("one"),
        F.max(F.when(is_main_member(), F.col("member"))).alias("other"),
        F.max("problem").alias("problem"),
    )
    is_wrong = F.col("problem").isNotNull() | (F.col("found") != 1)
    first_wrong = F.min(F.when(is_wrong, F.struct("archive", "found", "one", "other", "problem")))
    checked = per_archive.agg(
        F.count(F.lit(1)).alias("archives"), first_wrong.alias("wrong")
    ).first()
    if checked.archives == 0:
        raise ArchiveError(f"{archives} names no archive")
    wrong = checked.wrong
    if wrong is not None:
        if wrong.problem is not None:
            raise ArchiveError(f"{wrong.archive} is not a readable ZIP file: {wrong.problem}")
        if wrong.found == 0:
            raise ArchiveError(
                f"{wrong.archive} holds no main file named like "
                f"'{MAIN_FILE_PREFIX}YYYYMMDD-YYYYMMDD{MAIN_FILE_SUFFIX}'"
            )
        raise ArchiveError(
            f"{wrong.archive} holds {wrong.found} possible main files, "
            f"such as {wrong.one} and {wrong.other}"
        )
    return members.where(is_main_member()).select("archive", "member", "bytes")


class RecordScanner:
    """Finds record ends in blocks of CSV text: line ends outside quoted fields.

    A quote opens a field only at the field's start; within it, two quotes are one. Any other quote
    is text. While all quotes of a block look like that, counting them tells what is quoted; a block
    with stray quotes is matched field by field.
    """

    def __init__(self) -> None:
        self.inside = False  # a quoted field
        self.before = b"\n"  # the byte before the next block
        self.decoder = codecs.getincrementaldecoder("utf-8")()

    def ends(self, block: bytes) -> np.ndarray:
        """Places of the record ends in the next block, which must not end within a run of quotes."""
        try:
            self.decoder.decode(block)
        except UnicodeDecodeError as error:
            raise ValueError(f"{MALFORMED}: the text is not UTF-8") from error
        data = np.frombuffer(block, np.uint8)
        lines, quotes = np.flatnonzero(data == 10), np.flatnonzero(data == 34)
        if not self.plain(data, quotes):
            return self.matched(block, lines)
        if len(quotes) % 2:
            self.inside, was = not self.inside, self.inside
        else:
            was = self.inside
        self.before = block[-1:]
        return lines[(np.searchsorted(quotes, lines) + was) % 2 == 0]

    def plain(self, data: np.ndarray, quotes: np.ndarray) -> bool:
        """Whether each opening quote follows a comma, a line end, or the quote that it escapes."""
        opening = quotes[int(self.inside) :: 2]
        previous = np.where(opening > 0, data[opening - 1], self.before[0])
        return bool(np.isin(previous, (44, 10, 34)).all())

    def matched(self, block: bytes, lines: np.ndarray) -> np.ndarray:
        """The same by matching quoted fields, from each field's start."""
        text, spans, at = self.before + block, [], 1
        if self.inside:
            at = _REST.match(text, 1).end()
            self.inside = text[at - 1 : at] != b'"' or at == 1
            spans.append((1, at))
        if not self.inside:
            for field in _QUOTED.finditer(text, at):
                spans.append(field.span())
                self.inside = not field.group(1)
        self.before = block[-1:]
        if not spans:
            return lines
        starts, stops = np.array(spans).T - 1
        nearest = np.searchsorted(starts, lines, side="right") - 1
        return lines[(nearest < 0) | (lines >= stops[nearest])]

    def close(self) -> None:
        if self.inside:
            raise ValueError(f"{MALFORMED}: the text ends within a quoted field")
        try:
            self.decoder.decode(b"", final=True)
        except UnicodeDecodeError as error:
            raise ValueError(f"{MALFORMED}: the text is not UTF-8") from error


_REST = re.compile(rb'[^"]*(?:""[^"]*)*(?:"|\Z)')
_QUOTED = re.compile(rb'(?<=[,\n])"[^"]*(?:""[^"]*)*("|\Z)')


def _blocks(stream) -> Iterator[bytes]:
    """The stream in blocks that do not end with a quote or a carriage return, so that an escape and
    a line end are seen whole."""
    while block := stream.read(BLOCK):
        while block.endswith((b'"', b"\r")) and (more := stream.read(1)):
            block += more
        yield block


def _record_blocks(stream, part_bytes: int, line_feeds: bool = False) -> Iterator[tuple[bytes, int, bool]]:
    """(bytes, records that end in them, ends a part); a part ends at the end of a record.

    Records may end with a line feed or with both characters, also within one file; with
    `line_feeds`, they leave with a line feed alone. Line ends within fields stay as they are. Blank
    lines are no records. A last record without a line end counts as well.
    """
    scanner, written, pending = RecordScanner(), 0, False
    for block in _blocks(stream):
        ends = scanner.ends(block)
        data = np.frombuffer(block, np.uint8)
        returns = ends[(ends > 0) & (data[ends - 1] == 13)] - 1
        if line_feeds and len(returns):
            block = np.delete(data, returns).tobytes()
            ends = ends - np.searchsorted(returns, ends)
        sizes, before = np.diff(ends, prepend=-1) - 1, np.frombuffer(block, np.uint8)[ends - 1]
        real = (sizes > 1) | ((sizes == 1) & (before != 13))
        real[:1] |= pending  # that record began in an earlier block
        counts = np.concatenate([[0], np.cumsum(real)])
        last = block[ends[-1] + 1 :] if len(ends) else block
        pending = bool(last.strip(b"\r")) or (pending and not len(ends))
        start, done = 0, 0
        while written + len(block) - start >= part_bytes:
            at = int(np.searchsorted(ends, max(start, start + part_bytes - written - 1)))
            if at == len(ends):
                break
            cut = int(ends[at]) + 1
            yield block[start:cut], int(counts[at + 1] - done), True
            written, start, done = 0, cut, int(counts[at + 1])
        if start < len(block):
            written += len(block) - start
            yield block[start:], int(counts[-1] - done), False
    scanner.close()
    if pending:
        yield b"", 1, False


class DigestingReader(io.RawIOBase):
    """A file whose bytes are digested in order while it is read; what is skipped is read for it.

    Reads count once `follow` is set: a ZIP file is opened by its directory, which stands last.
    """

    def __init__(self, stream) -> None:
        self.stream, self.digest, self.done, self.follow = stream, hashlib.sha256(), 0, False

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.stream.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        return self.stream.seek(offset, whence)

    def read(self, size: int = -1) -> bytes:
        at = self.stream.tell()
        if self.follow and at > self.done:
            self._catch_up(at)
        data = self.stream.read(size) if size is not None and size >= 0 else self.stream.read()
        if self.follow and at + len(data) > self.done:
            self.digest.update(memoryview(data)[self.done - at :])
            self.done = at + len(data)
        return data

    def _catch_up(self, stop: int | None) -> None:
        self.stream.seek(self.done)
        while block := self.stream.read(BLOCK if stop is None else min(BLOCK, stop - self.done)):
            self.digest.update(block)
            self.done += len(block)

    def sha256(self) -> str:
        """The digest of the whole file."""
        self._catch_up(None)
        return self.digest.hexdigest()


def publish(filesystem, draft: str, target: str) -> None:
    """Gives a whole file its name, in one step; attempts of one task write the same."""
    try:
        filesystem.move(draft, target)
    except OSError:  # some stores refuse to replace what another attempt published
        if not filesystem.get_file_info(target).is_file:
            raise
        filesystem.delete_file(draft)


def _land_member(
    uri: str, member: str, folder: str, part_bytes: int, first: int = 0
) -> Iterator[tuple]:
    """Copy one member to part files, numbered from `first` on, that each start with the header.

    The archive is digested in the same pass; the last part's row has the digest.
    """
    name = uri.rstrip("/").rsplit("/", 1)[-1]
    target = f"{name}~{hashlib.sha256(uri.encode()).hexdigest()[:8]}"
    filesystem, base = open_filesystem(f"{folder}/{target}")
    filesystem.create_dir(base, recursive=True)

    def finish(number: int, sink, draft: str, size: int, records: int) -> tuple:
        sink.close()
        publish(filesystem, draft, f"{base}/part-{first + number:010d}.csv")
        return uri, f"{target}/part-{first + number:010d}.csv", size, records, _decoded(header)

    with _open(uri) as raw, zipfile.ZipFile(stream := DigestingReader(raw)) as opened:
        stream.follow = True
        text = opened.open(member)
        header = text.readline().removeprefix(b"\xef\xbb\xbf")
        if header.endswith(b"\r\n"):
            header = header[:-2] + b"\n"
        number, size, records, sink, draft, waiting = 0, 0, 0, None, None, None
        for block, ended, ends in _record_blocks(text, part_bytes, line_feeds=True):
            if sink is None:
                draft = f"{base}/_draft-{uuid.uuid4().hex}"
                sink = filesystem.open_output_stream(draft)
                sink.write(header)
            sink.write(block)
            size, records = size + len(block), records + ended
            if ends:
                if waiting:
                    yield *waiting, None
                waiting = finish(number, sink, draft, size, records)
                number, size, records, sink = number + 1, 0, 0, None
        if sink is None and number == 0:  # a header without records
            draft = f"{base}/_draft-{uuid.uuid4().hex}"
            sink = filesystem.open_output_stream(draft)
            sink.write(header)
        if sink is not None:
            if waiting:
                yield *waiting, None
            waiting = finish(number, sink, draft, size, records)
        text.close()
        yield *waiting, stream.sha256()


def _decoded(header: bytes) -> str:
    try:
        return header.decode("utf-8")
    except UnicodeDecodeError as error:
        raise ValueError(f"{MALFORMED}: the header is not UTF-8") from error


def land_archives(
    spark: SparkSession, archives: str, folder: str, part_bytes: int | None = None
) -> DataFrame:
    """Copy each archive's main member to CSV parts below `folder`/parts.

    Returns the written list of parts, one row each with the number of its records. Unless `part_bytes` is given, a member is
    cut into about one part per core, of at most Spark's split size.
    """
    if part_bytes is not None and part_bytes < 1:
        raise ValueError("part_bytes must be a positive whole number")
    split, cores = split_bytes(spark), spark.sparkContext.defaultParallelism
    parts = f"{folder}/parts"
    names = [field.split()[0] for field in LANDED.split(", ")]

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch["archive"], batch["member"], batch["target"], batch["first"])
            for uri, member, target, first in rows:
                for landed in _land_member(uri, member, parts, target, first):
                    yield pd.DataFrame([landed], columns=names)

    listing = f"{folder}/landed"
    # parts are numbered through, in order of archives; some numbers stay unused
    target = F.least(F.lit(split), F.greatest(F.lit(SMALLEST_PART), F.floor(F.col("bytes") / cores)))
    target = F.lit(part_bytes) if part_bytes else target
    before = Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1)
    members = main_members(spark, archives).withColumn("target", target.cast("long"))
    numbered = members.withColumn("most", F.floor(F.col("bytes") / F.col("target")) + 1)
    numbered = numbered.withColumn("first", F.coalesce(F.sum("most").over(before), F.lit(0)))
    every = numbered.agg(F.count("*").alias("archives"), F.sum("bytes").alias("bytes")).first()
    # small archives share tasks: two rounds of them at least, and a split's bytes a task
    wanted = min(every.archives, max(2 * cores, every.bytes // split))
    tasks = numbered.select("archive", "member", "target", "first").repartition(wanted)
    tasks.mapInPandas(copy, LANDED).write.parquet(listing)
    return spark.read.parquet(listing)


def _digest_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for uri in batch["archive"]:
            digest = hashlib.sha256()
            with _open(uri) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["archive"], "sha256": digests})


def file_digests(spark: SparkSession, paths: str) -> DataFrame:
    """SHA-256 of every file that `paths` names, streamed block by block."""
    files = archive_files(spark, paths).select("archive").repartition(listing_tasks(spark))
    return files.mapInPandas(_digest_files, "path string, sha256 string")
