"""Byte-level BPE from a rank file: encode whole texts, decode ids back to bytes.

The rank file gives bytes and rank of each token. ``build_tokenizer`` turns it into a
``tokenizers`` model: bytes become printable characters (``byte_characters``), the merge that
makes each token is found with the ranks below it, and the pattern cuts text first.

Encoding works on Arrow batches. Before a single space between two other characters the
pattern always starts a new match, so texts are cut there, each distinct piece is encoded
once, and character offsets give the ids of each piece. Decoding reverses the byte table;
a character split over several ids comes out whole, because bytes are joined before UTF-8.

Defined cases: null and empty texts have no ids; rows that repeat come out as often as they
go in; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.arrays import PieceMemo, Table, byte_characters, encode_each, encode_joined, text_slices, utf8_bytes


def load_ranks(rank_file: str) -> dict[bytes, int]:
    with open(rank_file, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes ``token`` when only lower ranks may merge before."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if rank >= limit:
            raise ValueError(f"no merge leads to {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> str:
    """JSON of a ``tokenizers`` model with the given ranks, without special tokens."""
    shown = byte_characters()
    text = {token: "".join(shown[byte] for byte in token) for token in ranks}
    by_rank = sorted((rank, token) for token, rank in ranks.items() if len(token) > 1)
    merges = [[text[part] for part in last_merge(token, ranks)] for _, token in by_rank]
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None}
    model |= {"end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
    model |= {"vocab": {text[token]: rank for token, rank in ranks.items()}, "merges": merges}
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    to_bytes = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, to_bytes]},
            "post_processor": None,
            "decoder": to_bytes,
            "model": model,
        }
    )


def piece_encoder(tokenizer, pattern: str):
    """Encoder of lists of pieces. A piece that is one match goes straight to the merges; pieces
    that begin and end a match for sure are joined; the others are encoded one by one."""
    one, merge = regex.compile(pattern), tokenizer.model.tokenize
    shown = dict(enumerate(byte_characters()))

    def direct(piece: str) -> list[int] | None:
        # Only characters on whose class every Unicode version agrees.
        if not piece or max(piece) > "\u024f" or one.match(piece).end() < len(piece):
            return None
        return [token.id for token in merge(piece.encode().decode("latin-1").translate(shown))]

    def rest(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch(pieces, add_special_tokens=False)]
        ids = np.array([number for part in found for number in part], np.uint32)
        return ids, np.fromiter(map(len, found), np.int64, len(found))

    def joined(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sure = {p for p in pieces if len(p) > 1 and p[0] == " " and not _blank(p[1]) and not _blank(p[-1])}
        several = [p for p in pieces if p in sure]
        ids, lengths = encode_joined(tokenizer, several, "")
        stops = np.cumsum(lengths)
        known = {p: ids[a:b].tolist() for p, a, b in zip(several, stops - lengths, stops, strict=True)}
        return encode_each(pieces, known.get, rest)

    return lambda pieces: encode_each(pieces, direct, joined)


class Coder:
    """Encoder and decoder of one Python worker."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        pattern = json.loads(tokenizer_json)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.memo = PieceMemo(piece_encoder(tokenizer, pattern))
        to_byte = {shown: byte for byte, shown in enumerate(byte_characters())}
        vocab = tokenizer.get_vocab()
        tokens = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, number in vocab.items():
            tokens[number] = bytes(to_byte[shown] for shown in token)
        self.tokens = Table(tokens)

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and ids per text."""
        memo = self.memo
        memo.make_room()
        lists = pc.split_pattern(text, " ")
        words = lists.flatten().dictionary_encode()
        codes = np.asarray(words.indices, np.int64)
        distinct = words.dictionary.to_pylist()
        ends = np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))
        firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        # A word that is empty or has white space at an edge does not start or end a piece.
        odd = _odd(words.dictionary, distinct)
        odd_texts = np.add.reduceat(odd[codes], firsts) > 0 if len(firsts) else np.zeros(0, bool)
        plain = np.ones(len(codes), bool)
        plain[firsts] = False
        plain &= ~np.repeat(odd_texts, ends - firsts)
        used = np.flatnonzero(np.bincount(codes[plain], minlength=len(distinct)))
        spaced = np.zeros(len(distinct), np.int64)
        spaced[used] = memo.look_up([" " + distinct[code] for code in used])
        rows = np.zeros(len(codes), np.int64)
        rows[plain] = spaced[codes[plain]]
        whole = firsts[~odd_texts]
        rows[whole] = memo.look_up([distinct[code] for code in codes[whole]])
        counts = ends - firsts
        if odd_texts.any():
            return self._encode_odd(rows, firsts, ends, odd_texts, codes, distinct)
        lengths = np.add.reduceat(memo.lengths[rows].astype(np.int64), firsts) if len(counts) else counts
        return memo.gather(rows), lengths

    def _encode_odd(self, rows, firsts, ends, odd_texts, codes, distinct):
        """As ``encode`` where some texts need words joined to pieces first."""
        memo, parts = self.memo, []
        for k, (first, end) in enumerate(zip(firsts, ends, strict=True)):
            if odd_texts[k]:
                parts.append(memo.look_up(join_words([distinct[code] for code in codes[first:end]])))
            else:
                parts.append(rows[first:end])
        lengths = np.array([memo.lengths[part].sum() for part in parts], np.int64)
        return memo.gather(np.concatenate(parts)), lengths

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids after each other, and bytes per id."""
        return self.tokens.join(ids)


def _odd(words: pa.Array, listed: list[str]) -> np.ndarray:
    """Which words are empty or have white space at an edge; ``listed`` are the same words."""
    data, offsets = utf8_bytes(words)
    odd = offsets[1:] == offsets[:-1]
    rows = np.flatnonzero(~odd)
    # Printable ASCII is told from the byte; other edges are looked at one by one.
    edges = np.stack([data[offsets[:-1][rows]], data[offsets[1:][rows] - 1]])
    for row in rows[((edges <= 0x20) | (edges >= 0x7F)).any(axis=0)].tolist():
        odd[row] = _blank(listed[row][0]) or _blank(listed[row][-1])
    return odd


def _blank(character: str) -> bool:
    return character.isspace() or character == "\u180e"


def join_words(words: list[str]) -> list[str]:
    """Pieces of a text from its words (cut at U+0020); only sure starts of a match are cut."""
    pieces, current = [], words[0]
    for before, word in zip(words, words[1:], strict=False):
        if before and word and not _blank(before[-1]) and not _blank(word[0]):
            pieces.append(current)
            current = " " + word
        else:
            current += " " + word
    return [*pieces, current]


_coders: dict[str, Coder] = {}


def coder(tokenizer_json: str) -> Coder:
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(tokenizer_json)
    return _coders[key]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _broadcast(docs: DataFrame, rank_file: str, pattern: str):
    """The tokenizer as one broadcast string; its size is that of the rank file, not of the data."""
    return docs.sparkSession.sparkContext.broadcast(build_tokenizer(load_ranks(rank_file), pattern))


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows ``doc_id``, ``ids array<int>`` of every whole text; one map over the table."""
    tokenizer = _broadcast(docs, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, lengths = coder(tokenizer.value).encode(batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Rows ``doc_id``, ``decoded binary`` from ``doc_id``, ``ids``; a null list decodes to no bytes."""
    tokenizer = _broadcast(encoded, rank_file, pattern)
    rows = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
            data, sizes = coder(tokenizer.value).decode(np.asarray(lists.flatten(), np.int64))
            stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
            starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
            decoded = [data[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, decoded binary")


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: both directions in one map.

    ``ids_sha256`` is over decimal ids joined by commas, ``decoded_sha256`` over the bytes that
    decoding the ids gives.
    """
    tokenizer = _broadcast(docs, rank_file, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            own = coder(tokenizer.value)
            ids, lengths = own.encode(batch.column("text"))
            numbers = ids.astype(np.int64)
            data, sizes = own.decode(numbers)
            digits, widths = _decimals(len(own.tokens.lengths)).join(numbers)
            id_sums, byte_sums = [], []
            stops = np.cumsum(lengths)
            byte_at = np.concatenate([[0], np.cumsum(sizes)])
            digit_at = np.concatenate([[0], np.cumsum(widths)])
            for start, stop in zip(stops - lengths, stops, strict=True):
                shown = digits[digit_at[start] : digit_at[stop]][:-1]
                id_sums.append(hashlib.sha256(shown).hexdigest())
                byte_sums.append(hashlib.sha256(data[byte_at[start] : byte_at[stop]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths.astype(np.int64)), pa.array(id_sums), pa.array(byte_sums)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = _rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


_decimal_tables: dict[int, Table] = {}


def _decimals(count: int) -> Table:
    """``"0,", "1,", ...``"""
    if count not in _decimal_tables:
        _decimal_tables[count] = Table([b"%d," % number for number in range(count)])
    return _decimal_tables[count]
