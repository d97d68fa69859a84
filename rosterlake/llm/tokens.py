"""Token ids as Arrow files of equal-length sequences with masks, and random access to them."""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import stored
from rosterlake.session import scratch_folder

END_ID = 2
SEQUENCE = 2048
#: Sequences of a record batch: 256 KiB of ids.
BATCH = 64
#: Text bytes of a shard, about: one task writes it, batch by batch.
SHARD_BYTES = 32 << 20
#: Text encoded at a time, and words whose ids a worker keeps: some 120 bytes each.
PIECE_BYTES = 1 << 20
MEMO_WORDS = 400_000
_SPACE = re.compile(rb"[\t-\r ]")
#: Punctuation right after a letter or digit starts a token of its own.
_PUNCTUATION = b",.;:!?"


class Encoder:
    """Texts to ids by a tokenizer of the tokenizers library, in bounded memory.

    With `by_word`, for tokenizers that ignore case, drop white space, part words from punctuation
    and leave a lower-case ASCII word to the model as it is, words are encoded apart and the ids of
    up to `memo_words` are kept; when there are more, those stay that have come up again since they
    were last sorted out. Texts are then cut at white space too, so that a very long one is never
    held as tokens. Otherwise texts are encoded whole.
    """

    def __init__(self, path: str, by_word: bool, memo_words: int = MEMO_WORDS) -> None:
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = "1", "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word, self.memo_words = Tokenizer.from_file(path), by_word, memo_words
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.memo: dict[bytes, bytes] = {}
        self.again: set[bytes] = set()

    def __call__(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, bool]]:
        """(ids, whether a text ends with them), for all texts in order."""
        waiting, size = [], 0
        for text in texts:
            if not self.by_word:
                found = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False)
                yield np.array(found.ids, self.type), True
                continue
            for piece, last in pieces(text):
                waiting.append((piece.split(), last))
                size += len(piece)
                if size >= PIECE_BYTES:
                    yield from self.encoded(waiting)
                    waiting, size = [], 0
        yield from self.encoded(waiting)

    def encoded(self, waiting: list[tuple[list[bytes], bool]]) -> Iterator[tuple[np.ndarray, bool]]:
        words = set().union(*(own for own, _ in waiting))
        new = words.difference(self.memo)
        if len(self.memo) + 2 * len(new) > self.memo_words:  # a word may come with its stem
            self.again.update(words - new)
            kept = self.again if 2 * len(self.again) < self.memo_words else words - new
            self.memo, self.again = {w: self.memo[w] for w in kept}, set()
        else:
            self.again.update(words - new)
        if new:
            self.learn(new)
        for own, last in waiting:
            yield np.frombuffer(b"".join(map(self.memo.__getitem__, own)), self.type), last

    def learn(self, new: set[bytes]) -> None:
        """Ids of the new words, from those of their lower-case stems and the punctuation after."""
        memo, stems = self.memo, {}
        for word in new:
            if b"<|" in word:  # added tokens are matched before letters become lower case
                continue
            stem = word.rstrip(_PUNCTUATION)
            if stem is not word and not stem[-1:].isalnum():  # of bytes: an ASCII letter or digit
                stem = word
            low = stem.lower() if stem.isascii() else stem
            if low != word:
                stems[word] = (low, word[len(stem) :])
        wanted = new.difference(stems).union(*stems.values())
        wanted.discard(b"")
        rest, model, kind = [], self.tokenizer.model, self.type.type
        for word in wanted.difference(memo):
            if word.isascii() and word.isalpha():  # the rules before the model leave these as they are
                memo[word] = np.array([t.id for t in model.tokenize(word.decode())], kind).tobytes()
            else:
                rest.append(word)
        found = self.tokenizer.encode(
            [w.decode("utf-8", "replace") for w in rest], is_pretokenized=True, add_special_tokens=False
        )
        ids, owners = np.array(found.ids, self.type).tobytes(), np.array(found.word_ids, np.int64)
        cuts = (np.searchsorted(owners, np.arange(len(rest) + 1)) * self.type.itemsize).tolist()
        memo.update((w, ids[a:b]) for w, a, b in zip(rest, cuts, cuts[1:], strict=False))
        memo[b""] = b""
        memo.update([(word, memo[stem] + memo[end]) for word, (stem, end) in stems.items()])


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[tuple[bytes, bool]]:
    """(part, whether it is the last): parts of about `size` bytes, cut at ASCII white space only."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if not space:
            break
        yield text[at : space.start()], False
        at = space.end()
    yield text[at:], True


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, by_word: bool, memo_words: int = MEMO_WORDS) -> Encoder:
    """The worker's encoder, loaded once."""
    key = path, by_word, memo_words
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


class SequenceWriter:
    """Appends ids to one Arrow file as fixed-size lists `input_ids`, with `mask` false on padding."""

    def __init__(self, files: pafs.FileSystem, path: str, kind: np.dtype, length: int, batch: int, pad: int) -> None:
        self.length, self.room, self.kind, self.pad = length, length * batch, kind, pad
        ids = pa.list_(pa.field("item", pa.from_numpy_dtype(kind), nullable=False), length)
        mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), length)
        self.schema = pa.schema([pa.field("input_ids", ids, nullable=False), pa.field("mask", mask, nullable=False)])
        self.stream = files.open_output_stream(path, compression=None)
        self.file = pa.ipc.new_file(self.stream, self.schema)
        self.parts: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.total += len(ids)
        while len(ids):
            part = ids[: self.room - self.waiting]
            self.parts.append(part)
            self.waiting += len(part)
            ids = ids[len(part) :]
            if self.waiting == self.room:
                self.flush()

    def flush(self) -> None:
        n = -(-self.waiting // self.length) * self.length
        ids, mask = np.full(n, self.pad, self.kind), np.arange(n) < self.waiting
        if self.parts:
            ids[: self.waiting] = np.concatenate(self.parts)
        arrays = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), type=field.type)
            for values, field in zip((ids, mask), self.schema, strict=True)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.parts, self.waiting = [], 0

    def close(self) -> None:
        if self.waiting:
            self.flush()
        self.file.close()
        self.stream.close()


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_word: bool = False,
    end_id: int = END_ID,
    length: int = SEQUENCE,
    batch: int = BATCH,
    shard_bytes: int = SHARD_BYTES,
    memo_words: int = MEMO_WORDS,
) -> DataFrame:
    """Writes shards into `folder`, in ascending id order; (shard, tokens) rows.

    Shard n is two Arrow files: `n.tokens.arrow`, batches of `batch` sequences of `length` ids with
    masks, filled without gaps up to the padding of the last; and `n.docs.arrow`, each document's id,
    first id in the shard and number of ids, in order. A document's ids end with `end_id`. Null
    texts have that id alone, null ids come first, repeated rows are documents of their own. Files
    appear under their names in one step, so that a task run twice leaves one of each.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_bytes))
    # rows of one id are dealt out by where they were read, should one id have most rows
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(shards, "id", "place")
    ordered = dealt.sortWithinPartitions("id", "place").drop("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        encode, shard, draft = encoder(tokenizer_path, by_word, memo_words), TaskContext.get().partitionId(), f"{base}/_{uuid.uuid4().hex}"
        tokens = stream = None
        for rows in batches:
            if not rows.num_rows:
                continue
            if tokens is None:
                tokens = SequenceWriter(files, f"{draft}.tokens", encode.type, length, batch, end_id)
                schema = pa.schema([("id", rows.schema.field("id").type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                stream = files.open_output_stream(f"{draft}.docs", compression=None)
                index = pa.ipc.new_file(stream, schema)
            starts = [tokens.total]
            for ids, last in encode(t.as_buffer().to_pybytes() if t.is_valid else b"" for t in rows["text"]):
                tokens.add(ids)
                if last:
                    tokens.add(np.array([end_id], encode.type))
                    starts.append(tokens.total)
            counts, starts = np.diff(starts), starts[:-1]
            index.write_batch(pa.RecordBatch.from_arrays([rows["id"], pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=schema))
        if tokens is not None:
            tokens.close()
            index.close()
            stream.close()
            for part in ("tokens", "docs"):
                files.move(f"{draft}.{part}", f"{base}/{shard:06d}.{part}.arrow")
            yield pa.RecordBatch.from_pydict({"shard": [shard], "tokens": [tokens.total]}, schema=_SHARDS)

    return stored(ordered.mapInArrow(run, "shard long, tokens long"), "token-shards")


_SHARDS = pa.schema([("shard", pa.int64()), ("tokens", pa.int64())])


class TokenShard:
    """One shard, opened for random access; local files are mapped and read without a copy."""

    def __init__(self, folder: str, shard: int) -> None:
        files, base = pafs.FileSystem.from_uri(folder)

        def opened(part: str) -> pa.RecordBatchFileReader:
            path = f"{base}/{shard:06d}.{part}.arrow"
            return pa.ipc.open_file(pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path))

        self.tokens, self.docs = opened("tokens"), opened("docs")
        self.length = self.tokens.schema.field("input_ids").type.list_size
        self.per_batch = self.tokens.get_batch(0).num_rows if self.tokens.num_record_batches else 1
        self.at, self.flat = -1, np.zeros(0)

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and mask of sequence k."""
        batch = self.tokens.get_batch(k // self.per_batch)
        part = batch.slice(k % self.per_batch, 1)
        return part["input_ids"].flatten().to_numpy(), part["mask"].flatten().to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from `start` on, in parts that lie in one batch each."""
        size = self.per_batch * self.length
        while n > 0:
            if start // size != self.at:
                self.at = start // size
                self.flat = self.tokens.get_batch(self.at)["input_ids"].flatten().to_numpy()
            part = self.flat[start % size : start % size + n]
            yield part
            start, n = start + len(part), n - len(part)


def read_tokens(shards: DataFrame, folder: str, id_type: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the files; start counts all ids before."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(batch["shard"].to_pylist(), batch["base"].to_pylist(), strict=True):
                shard = TokenShard(folder, number)
                for k in range(shard.docs.num_record_batches):
                    docs, crcs = shard.docs.get_batch(k), []
                    for start, n in zip(docs["start"].to_pylist(), docs["n_tokens"].to_pylist(), strict=True):
                        crc = 0
                        for part in shard.ids(start, n):
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                        crcs.append(crc)
                    starts = pa.array(docs["start"].to_numpy() + base)
                    arrays = [docs["id"], starts, docs["n_tokens"], pa.array(crcs, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "start", "n_tokens", "ids_crc32"])

    each = placed.select("shard", "base").repartition(max(1, shards.count()))  # a task per shard
    return each.mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids_crc32 long")


def token_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", by_word: bool = False, **sizes: int) -> DataFrame:
    """Writes the documents' ids below the shared folder and reads the files back."""
    folder = scratch_folder(docs.sparkSession, "tokens")
    shards = write_tokens(docs, folder, tokenizer_path, id_col, text_col, by_word, **sizes)
    return read_tokens(shards, folder, docs.schema[id_col].dataType.simpleString()).withColumnRenamed("id", id_col)
