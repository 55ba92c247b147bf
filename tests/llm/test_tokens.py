import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from seedloom.llm import byte_bpe, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = [
    None, "", " ", "\n\n", "  two  spaces ", "tab\tand nbsp  em", "it's THEY'LL don't 'sx", "a.b.c,d .. ,, x.,y",
    "J̌ é İstanbul K ǅ ﬁ ß", "日本語 テキスト 🙂🙂👨‍👩‍👧", "x" * 5000, "=" * 300 + " " * 77, "12345 1 2٣४",
    "<|endoftext|> <|startoftext|>x", "\x00\x1c \x1d \x85 ᠎ ﻿", "no\r\nline \n ends \n", " lead", "trail ", "á.b̈,",
]


def texts():
    rng = random.Random(8)
    parts = [t for t in ODD if t] + ["the", "of", "Über", "naïve,", "word.", "\n", " ", "  ", "\t", "'s", "é", "don't"]
    return ODD + ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(12)) for _ in range(120)]


@pytest.fixture(scope="module")
def rows():
    return [(i * 13 % 997, t) for i, t in enumerate(texts())]


def test_token_files(spark, rows, tmp_path):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int").repartition(3)
    token_files.encode_to_files(frame, str(tmp_path / "out"), WORDS)
    got = {r.doc_id: r for r in token_files.read_files(spark, str(tmp_path / "out")).collect()}
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    assert len(got) == len(rows)
    for doc_id, text in sorted(rows):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        row = got[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())), text
        assert bytes(row.ids) == ids.tobytes()
        start += len(ids)


def test_shards_hold_dictionary_hash_and_index():
    dictionary = b""
    frames = [token_files._compressor(dictionary).compress(np.arange(n, dtype="<u4").tobytes()) for n in (3, 0, 5)]
    image = token_files.pack_shard(frames, [3, 0, 5], hashlib.sha256(dictionary).digest())
    shard = token_files.Shard(image, dictionary)
    assert shard.ids(2).tolist() == [0, 1, 2, 3, 4] and len(shard.ids(1)) == 0
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.Shard(image, b"other")


def test_dictionary_is_trained_and_shared(spark, tmp_path):
    rng = random.Random(1)
    made = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "word"]) for _ in range(900)) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    token_files.encode_to_files(frame, str(tmp_path / "out"), WORDS)
    assert token_files.read_dictionary(spark, str(tmp_path / "out"))
    assert token_files.read_files(spark, str(tmp_path / "out")).count() == 400


def test_repeats_and_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (2, "a a"), (None, "c")], "doc_id long, text string")
    token_files.encode_to_files(frame, str(tmp_path / "a"), WORDS)
    got = sorted((r.start, r.doc_id) for r in token_files.read_files(spark, str(tmp_path / "a")).collect())
    assert got == [(0, None), (2, 2), (5, 2)]
    token_files.encode_to_files(frame.limit(0), str(tmp_path / "b"), WORDS)
    assert token_files.read_files(spark, str(tmp_path / "b")).count() == 0


def encoding():
    ranks = byte_bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, ids int").repartition(3)
    reference = encoding()
    digests = {r.doc_id: r for r in byte_bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN).collect()}
    encoded = byte_bpe.encode_documents(frame, RANKS, public_tokenizers.PATTERN)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    decoded = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    for doc_id, text in rows:
        want = reference.encode_ordinary(text or "")
        assert ids[doc_id] == want, text
        assert decoded[doc_id] == (text or "").encode()
        row = digests[doc_id]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_split_characters_come_out_whole(spark):
    emoji = "🙂é日"
    parts = encoding().encode_ordinary(emoji)
    frame = spark.createDataFrame([(1, parts), (2, parts[:1]), (3, None), (4, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode_documents(frame, RANKS, public_tokenizers.PATTERN).collect()}
    assert got[1] == emoji.encode() and emoji.encode().startswith(got[2]) and got[3] == got[4] == b""


def test_byte_bpe_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN).count() == 0


def test_memo_keeps_frequent_pieces():
    from seedloom.llm.arrays import PieceMemo

    memo = PieceMemo(lambda pieces: (np.array([len(p) for p in pieces], np.uint32), np.ones(len(pieces), np.int64)), limit=4)
    memo.look_up(["a", "bb"])
    memo.look_up(["a", "ccc", "dddd", "eeeee"])
    memo.make_room()
    assert list(memo.rows) == ["a"]
    assert memo.gather(memo.look_up(["bb", "a"])).tolist() == [2, 1]


def test_words_with_space_at_an_edge():
    words = ["", "a", "\n", "a\n", "\ta", "é", " x", "x ", "᠎y", "\x1cz", "z\x7f", "日本", "a b"]
    found = byte_bpe._odd(pa.array(words).slice(0), words)
    assert found.tolist() == [not w or byte_bpe._blank(w[0]) or byte_bpe._blank(w[-1]) for w in words]
    assert byte_bpe._odd(pa.array(words).slice(2, 3), words[2:5]).tolist() == [True] * 3
    assert byte_bpe._odd(pa.array([], pa.string()), []).tolist() == []
