"""Token files against the tokenizer itself, with short sequences and small shards."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterlake.llm.queries import QUERIES
from rosterlake.llm.tokens import Encoder, TokenShard, pieces, read_tokens, write_tokens

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PLAIN = {path: Tokenizer.from_file(path) for path in (WORDS, BYTES)}
BY_WORD = Encoder(WORDS, by_word=True)


def expected(rows, path):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*PLAIN[path].encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ALPHABET = "aB,.;!'sé́̀ẞΣςßﬁ 　  \x1c\x85\x00\t\n\r<|>Å9²½🙂👍🏽ि̈"


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(ALPHABET), st.text(), st.lists(st.sampled_from(["<|endoftext|>", "don't", " ", "x1", "É", ",", ".", "?!", "'", "S", "“"])).map("".join)))
def test_words_encode_as_in_the_whole_text(text):
    text = text.encode("utf-8", "replace").decode()
    ids = [i for part, _ in BY_WORD([text.encode()]) for i in part.tolist()]
    assert ids == PLAIN[WORDS].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|EndOfText|>", "<|STARTOFTEXT|>", "A<|EndOfText|>b, X<|endoftext|>Y. <|ENDOFTEXT|>."])
def test_added_tokens_keep_their_case(text):
    ids = [i for part, _ in BY_WORD([text.encode()]) for i in part.tolist()]
    assert ids == PLAIN[WORDS].encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|EndOfText|>", "<|STARTOFTEXT|>", "<|", "A", "x", " ", ",", "."])).map("".join))
def test_words_around_added_tokens(text):
    ids = [i for part, _ in BY_WORD([text.encode()]) for i in part.tolist()]
    assert ids == PLAIN[WORDS].encode(text, add_special_tokens=False).ids


def test_pieces_cut_at_white_space():
    text = b"ab cd\tefgh\nijklmnopq r " * 50 + b"x" * 100
    parts, lasts = zip(*pieces(text, 7), strict=True)
    assert lasts == (False,) * (len(parts) - 1) + (True,)
    assert len(parts) > 100 and b" ".join(parts).split() == text.split()


def rows():
    rng = random.Random(2)
    words = ["the", "Of", "número", "naïve", "x9!", "日本", "\n", "don't"]
    made = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randrange(120)))) for i in range(80)]
    made += [(1, None), (2, ""), (4, " \n"), (5, "long " * 4000), (-7, "first")]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize(("path", "by_word"), [(WORDS, True), (WORDS, False), (BYTES, False)])
@pytest.mark.parametrize("shard_bytes", [1 << 25, 3000])
def test_round_trip(spark, tmp_path, path, by_word, shard_bytes):
    frame = spark.createDataFrame([(*r, "x") for r in rows()], "doc_id long, text string, id string").repartition(4)
    folder = f"file://{tmp_path}/tokens"
    shards = write_tokens(frame, folder, path, by_word=by_word, length=16, batch=3, shard_bytes=shard_bytes)
    found = read_tokens(shards, folder, "bigint").orderBy("start").collect()
    assert [tuple(r) for r in found] == expected(rows(), path)
    for number, total in shards.collect():
        shard = TokenShard(folder, number)
        assert pa.types.is_fixed_size_list(shard.tokens.schema.field("input_ids").type)
        masks = [shard.sequence(k)[1] for k in range(-(-total // 16))]
        assert int(np.concatenate(masks).sum()) == total and all(len(m) == 16 for m in masks)
        flat = np.concatenate([shard.sequence(k)[0] for k in range(-(-total // 16))])
        assert np.array_equal(flat[:total], np.concatenate(list(shard.ids(0, total))))


def test_repeated_ids_and_empty_table(spark, tmp_path):
    made = [(1, "a b"), (1, "a b"), (1, "c"), (None, "d"), (2, "e")]
    frame = spark.createDataFrame(made, "doc_id long, text string")
    folder = f"file://{tmp_path}/tokens"
    found = read_tokens(write_tokens(frame, folder, WORDS), folder, "bigint").orderBy("start").collect()
    assert [r.id for r in found] == [None, 1, 1, 1, 2]
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found[:-1]]))
    assert write_tokens(frame.limit(0), folder + "2", WORDS).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in QUERIES["op6_token_output"](spark, sf).orderBy("doc_id").collect()] == expected(docs, WORDS)
