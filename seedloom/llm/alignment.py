"""Alignment of two tokenizers over the same texts, with corpus-wide counts of linked ids.

A text with a space before it is tokenised whole by a byte-level BPE (A) and by a piece model
(B), which adds that space itself. Offsets where a token of A and one of B both end, verified on
the bytes, cut the tokens into groups. Of these shared ends, those before tokens that start with
a space on both sides are anchors: they cut a document into windows of a few ids, and of the windows
of a slice of documents, each tuple of A ids and tuple of B ids is aligned once. Two tokens are
linked when their byte ranges overlap: one link for each stretch between neighbouring ends.

Counts go in two steps. A task folds the documents of a block (bounded in bytes) into the block's
distinct id pairs, each with the number of documents that hold it; Spark adds these up by pair
and finds the highest count of each A id (an A id has at most as many pairs as B has ids). The
totals then come back to each block's pairs, and a block with its totals gives the columns of its
documents. Documents themselves are shuffled as packed numbers of pairs only, once.

Defined cases: a text that is null, empty, or whose bytes either tokenizer does not give back has
no tokens: zeros, no groups; strings of special tokens are plain text; rows that repeat count as
documents of their own; a null doc_id stays null; a very long text is a block of its own; an
empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedloom.llm.arrays import PieceMemo, Table, byte_characters, ragged, text_slices
from seedloom.llm.byte_bpe import join_words
from seedloom.llm.tables import written

#: The pattern that ``ByteLevel`` pre-tokenisation stands for.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SLICE_BYTES = 500_000
BLOCK_BYTES = 16_000_000
#: Pieces of text whose ids a Python worker remembers. Never changes a result.
PIECES_KEPT = 250_000

_SIDE_B = np.uint32(1 << 31)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


class Tokenizers:
    """Both tokenizers of a Python worker; pieces of text (cut before spaces) are remembered."""

    def __init__(self, byte_level_json: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        vocab = self.a.get_vocab()
        to_byte = {shown: byte for byte, shown in enumerate(byte_characters())}
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            tokens[number] = bytes(to_byte.get(shown, 0) for shown in token)
        pieces = [self._piece(number) for number in range(self.b.get_piece_size())]
        self.a_bytes, self.b_bytes = Table(tokens), Table(pieces)
        self.a_spaced = np.array([token[:1] == b" " for token in tokens])
        self.b_spaced = np.array([piece[:1] == b" " for piece in pieces])
        # Merges of B stay between spaces if no piece has a space after another character.
        self.b_splits = not any(b" " in piece.lstrip(b" ") for piece in pieces)
        #: Each id with a comma, a bar or a semicolon after it.
        self.shown_ids = Table([b"%d%s" % (n, mark) for n in range(max(len(tokens), len(pieces))) for mark in (b",", b"|", b";")])
        self._plain = regex.compile(BYTE_LEVEL_PATTERN)
        self._shown = byte_characters()
        self.memo = PieceMemo(self._encode_pieces, limit=PIECES_KEPT)

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _of_a(self, pieces: list[str]) -> list[list[int]]:
        """Ids of A. Latin pieces are cut by the pattern here and go straight to the merges: on the
        classes of these characters every Unicode version agrees."""
        merge, cut, shown = self.a.model.tokenize, self._plain.findall, self._shown
        found: list[list[int]] = []
        others = []
        for place, piece in enumerate(pieces):
            if max(piece) > "\u024f":
                others.append(place)
                found.append([])
            elif piece.isascii() and piece.isprintable():
                found.append([t.id for m in cut(piece) for t in merge(m.replace(" ", shown[32]))])
            else:
                found.append([t.id for m in cut(piece) for t in merge("".join([shown[x] for x in m.encode()]))])
        encoded = self.a.encode_batch([pieces[place] for place in others], add_special_tokens=False)
        for place, encoding in zip(others, encoded, strict=True):
            found[place] = encoding.ids
        return found

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and then, marked, of B for texts that follow a space."""
        a_ids, a_counts = _flat(self._of_a([" " + piece for piece in pieces]))
        b_ids, b_counts = _flat(self.b.encode(pieces, num_threads=1))
        b_ids |= _SIDE_B
        counts = a_counts + b_counts
        ids = np.empty(int(counts.sum()), np.uint32)
        starts = np.cumsum(counts) - counts
        ids[ragged(starts, a_counts)] = a_ids
        ids[ragged(starts + a_counts, b_counts)] = b_ids
        return ids, counts

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and ids per text, ids of B and ids per text. Empty texts have none."""
        memo = self.memo
        memo.make_room()
        lists = pc.split_pattern(text, " ")
        words = lists.flatten().dictionary_encode()
        codes, distinct = np.asarray(words.indices, np.int64), words.dictionary.to_pylist()
        counts = np.asarray(pc.list_value_length(lists), np.int64)
        if not self.b_splits:
            return self._gather([memo.look_up([t] if t else []) for t in text.to_pylist()])
        # Where a word is empty or has white space at an edge, a cut before the next space is not sure.
        odd = np.fromiter((not w or w[0].isspace() or w[-1].isspace() or "᠎" in w for w in distinct), bool, len(distinct))
        stops = np.cumsum(counts)
        if not odd.any():
            return self._gather_flat(memo.look_up(distinct)[codes], counts)
        parts = []
        for start, stop in zip(stops - counts, stops, strict=True):
            own = [distinct[code] for code in codes[start:stop]]
            if any(odd[codes[start:stop]]):
                own = [piece[1:] for piece in join_words(["", *own])] if own != [""] else []
            parts.append(memo.look_up(own))
        return self._gather(parts)

    def _gather(self, parts: list[np.ndarray]):
        rows = np.concatenate([np.zeros(0, np.int64), *parts])
        return self._gather_flat(rows, np.fromiter(map(len, parts), np.int64, len(parts)))

    def _gather_flat(self, rows: np.ndarray, counts: np.ndarray):
        ids, lengths = self.memo.gather(rows), self.memo.lengths[rows].astype(np.int64)
        of_b = ids >= _SIDE_B
        before = np.concatenate([[0], np.cumsum(of_b)])
        token_ends = np.cumsum(np.concatenate([[0], lengths]))[np.concatenate([[0], np.cumsum(counts)])]
        b_counts = np.diff(before[token_ends])
        a_counts = np.diff(token_ends) - b_counts
        return ids[~of_b].astype(np.int64), a_counts, (ids[of_b] ^ _SIDE_B).astype(np.int64), b_counts


class Alignments:
    """Groups and links of distinct windows, given as A ids and B ids that cover the same bytes.

    ``shown`` holds the groups of all windows as text, ``links`` the id pairs (A id times 2**32
    plus B id) whose byte ranges overlap; both one window after the other.
    """

    def __init__(self, own: Tokenizers, a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray):
        a_ends, b_ends = np.cumsum(own.a_bytes.lengths[a]), np.cumsum(own.b_bytes.lengths[b])
        window = np.repeat(np.arange(len(a_sizes)), a_sizes)
        # Between two neighbouring ends, of either side, lies one token of each: a link.
        ends = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.links = (a[of_a] << 32) | b[of_b]
        self.link_counts = np.bincount(window[of_a], minlength=len(a_sizes))
        closes_a, closes_b = np.isin(a_ends, b_ends), np.isin(b_ends, a_ends)
        self.n_groups = np.bincount(window[closes_a], minlength=len(a_sizes))
        # Text: the A ids of a group, then its B ids; the last one of a side has another mark.
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        count_a = np.bincount(group_a)
        count_b = np.bincount(group_b)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(count_b) - count_b)[group_a]] = 3 * a + closes_a
        order[np.arange(len(b)) + np.cumsum(count_a)[group_b]] = 3 * b + 2 * closes_b
        self.shown, sizes = own.shown_ids.join(order)
        text_ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(a_sizes + b_sizes)]
        self.shown_sizes = np.diff(text_ends, prepend=0)


def _mixed(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash per run of ids that depends on their order."""
    place = np.arange(len(ids)) - np.repeat(starts, counts)
    x = (ids.astype(np.uint64) << np.uint64(20)) + place.astype(np.uint64) + np.uint64(salt)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return np.add.reduceat(x, starts)


class Windows:
    """Windows of all given documents (every one with verified bytes and at least one token)."""

    def __init__(self, own: Tokenizers, a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray):
        a_ends, b_ends = np.cumsum(own.a_bytes.lengths[a]), np.cumsum(own.b_bytes.lengths[b])
        at = np.searchsorted(b_ends, a_ends)
        shared = b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends
        document_ends = np.zeros(len(a), bool)
        document_ends[np.cumsum(a_counts) - 1] = True
        spaced = np.append(own.a_spaced[a[1:]], False) & np.append(own.b_spaced[b], False)[np.minimum(at + 1, len(b))]
        self.cuts = np.flatnonzero(shared & (spaced | document_ends))
        self.a, self.b = a, b
        self.a_starts, self.a_sizes = _runs(self.cuts + 1)
        self.b_starts, self.b_sizes = _runs(at[self.cuts] + 1)
        self.document = np.searchsorted(np.cumsum(a_counts), self.cuts, side="right")

    def aligned(self, own: Tokenizers) -> tuple[Alignments, np.ndarray]:
        """Alignments of the distinct windows, and the place of each window among them.

        Windows are looked up by their tuples of ids: a hash finds the first like it, and all ids
        are compared with that one's.
        """
        mixed = _mixed(self.a, self.a_starts, self.a_sizes, 1) * np.uint64(3)
        mixed += _mixed(self.b, self.b_starts, self.b_sizes, 7)
        _, first, place = np.unique(mixed, return_index=True, return_inverse=True)
        found = first[place]
        same = (self.a_sizes[found] == self.a_sizes).all() and (self.b_sizes[found] == self.b_sizes).all()
        same = same and np.array_equal(self.a[ragged(self.a_starts[found], self.a_sizes)], self.a)
        same = same and np.array_equal(self.b[ragged(self.b_starts[found], self.b_sizes)], self.b)
        if not same:  # two windows with one hash: align each
            first = place = np.arange(len(self.cuts))
        a_sizes, b_sizes = self.a_sizes[first], self.b_sizes[first]
        a, b = self.a[ragged(self.a_starts[first], a_sizes)], self.b[ragged(self.b_starts[first], b_sizes)]
        return Alignments(own, a, a_sizes, b, b_sizes), place


def _runs(stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)
    return starts, stops - starts


def _verified(own: Tokenizers, text: pa.Array, a, a_counts, b, b_counts) -> np.ndarray:
    """Texts that are not empty and that both sides give back, byte by byte."""
    wanted = [b" " + t.encode() if t else b"" for t in text.to_pylist()]
    sizes = np.fromiter(map(len, wanted), np.int64, len(wanted))
    good = sizes > 0
    data = np.frombuffer(b"".join(wanted), np.uint8)
    starts = np.cumsum(sizes) - sizes
    for table, ids, counts in ((own.a_bytes, a, a_counts), (own.b_bytes, b, b_counts)):
        joined, lengths = table.join(ids)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        own_sizes = np.diff(ends)
        if np.array_equal(own_sizes, sizes) and np.array_equal(joined, data):
            continue
        for k in np.flatnonzero(good):
            good[k] = own_sizes[k] == sizes[k] and np.array_equal(
                joined[ends[k] : ends[k + 1]], data[starts[k] : starts[k] + sizes[k]]
            )
    return good


class SliceAlignment:
    """Columns of the documents of one slice; links as (document, id pair, how often)."""

    def __init__(self, own: Tokenizers, text: pa.Array):
        a, a_counts, b, b_counts = own.encode(text)
        good = _verified(own, text, a, a_counts, b, b_counts)
        count = len(text)
        if not good.all():
            a, b = a[np.repeat(good, a_counts)], b[np.repeat(good, b_counts)]
        self.n_a, self.n_b = np.where(good, a_counts, 0), np.where(good, b_counts, 0)
        self.n_groups, self.n_links = np.zeros(count, np.int64), np.zeros(count, np.int64)
        self.groups = [b""] * count
        self.documents = self.pairs = self.times = np.zeros(0, np.int64)
        if not good.any():
            return
        kept = np.flatnonzero(good)
        windows = Windows(own, a, a_counts[kept], b, b_counts[kept])
        found, place = windows.aligned(own)
        document = kept[windows.document]
        self.n_groups = np.bincount(document, found.n_groups[place], count).astype(np.int64)
        sizes = found.shown_sizes[place]
        shown = found.shown[ragged((np.cumsum(found.shown_sizes) - found.shown_sizes)[place], sizes)]
        ends = np.cumsum(np.bincount(document, sizes, count).astype(np.int64))
        starts = np.concatenate([[0], ends[:-1]])
        for k in kept:
            self.groups[k] = shown[starts[k] : ends[k] - 1].tobytes()
        # Windows of a document that are alike come together first, then their links.
        pairs, pair_of = np.unique(found.links, return_inverse=True)
        key, often = np.unique(document * len(sizes) + place, return_counts=True)
        document, place = np.divmod(key, len(sizes))
        repeat = found.link_counts[place]
        flat = pair_of[ragged((np.cumsum(found.link_counts) - found.link_counts)[place], repeat)]
        key, back = np.unique(np.repeat(document, repeat) * len(pairs) + flat, return_inverse=True)
        self.times = np.bincount(back, np.repeat(often, repeat)).astype(np.int64)
        self.documents, numbers = np.divmod(key, len(pairs))
        self.pairs = pairs[numbers]
        self.n_links = np.bincount(self.documents, self.times, count).astype(np.int64)


_workers: dict[str, Tokenizers] = {}


def _worker(byte_level_json: str, piece_model: bytes) -> Tokenizers:
    """Tokenizers of this Python worker (one pair at a time)."""
    key = hashlib.sha256(byte_level_json.encode() + piece_model).hexdigest()
    if key not in _workers:
        _workers.clear()
        _workers[key] = Tokenizers(byte_level_json, piece_model)
    return _workers[key]


def _inputs(docs: DataFrame, byte_level_file: str, piece_file: str):
    with open(byte_level_file, encoding="utf-8") as file:
        byte_level = json.dumps(json.load(file))
    with open(piece_file, "rb") as file:
        pieces = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows, docs.sparkSession.sparkContext.broadcast((byte_level, pieces))


def align_documents(docs: DataFrame, byte_level_file: str, piece_file: str) -> DataFrame:
    """``doc_id, groups array<struct<a array<int>, b array<int>>>`` of each document, in order."""
    rows, model = _inputs(docs, byte_level_file, piece_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            found = SliceAlignment(_worker(*model.value), batch.column("text"))
            groups = pa.array([shown.decode() for shown in found.groups], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), groups], ["doc_id", "shown"])

    shown = rows.mapInArrow(run, "doc_id long, shown string")
    sides = F.transform(
        F.when(F.col("shown") == "", F.array().cast("array<string>")).otherwise(F.split("shown", ";")),
        lambda group: F.struct(
            F.split(F.split_part(group, F.lit("|"), F.lit(1)), ",").cast("array<int>").alias("a"),
            F.split(F.split_part(group, F.lit("|"), F.lit(2)), ",").cast("array<int>").alias("b"),
        ),
    )
    return shown.select("doc_id", sides.alias("groups"))


_BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, n_pairs array<long>, places binary, times binary, pairs array<long>, holders array<long>"
)
_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _block(number: int, found: list[tuple[pa.Array, SliceAlignment]]) -> pa.RecordBatch:
    """One row: documents of several slices over the block's distinct id pairs."""

    def joined(name: str) -> np.ndarray:
        return np.concatenate([getattr(part, name) for _, part in found])

    pairs, places = np.unique(joined("pairs"), return_inverse=True)
    n_pairs = np.concatenate([np.bincount(part.documents, minlength=len(ids)) for ids, part in found])
    starts = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
    steps = np.diff(places, prepend=0)
    steps[starts] = places[starts]  # each document's pairs ascend: keep the steps
    press = zstandard.ZstdCompressor(level=1).compress
    sums = [shown for _, part in found for shown in part.groups]
    doc_ids = pa.chunked_array([ids for ids, _ in found]).combine_chunks()

    def row(values) -> pa.Array:
        return pa.array([values], pa.list_(pa.int64()))

    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([number], pa.int64()),
            "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids),
            **{name: row(joined(name)) for name in ("n_a", "n_b", "n_groups", "n_links")},
            "groups": pa.array([sums], pa.list_(pa.string())),
            "n_pairs": row(n_pairs),
            "places": pa.array([press(steps.astype("<i4").tobytes())], pa.binary()),
            "times": pa.array([press(joined("times").astype("<u4").tobytes())], pa.binary()),
            "pairs": row(pairs),
            "holders": row(np.bincount(places, minlength=len(pairs))),
        }
    )


def _blocks(rows: DataFrame, model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in text_slices(batches, SLICE_BYTES):
            text = batch.column("text")
            aligned = SliceAlignment(_worker(*model.value), text)
            aligned.groups = [hashlib.sha256(shown).hexdigest() if shown else "" for shown in aligned.groups]
            found.append((batch.column("doc_id"), aligned))
            size += pc.sum(pc.binary_length(text)).as_py() + 100 * len(text)
            if size >= BLOCK_BYTES:
                yield _block(number, found)
                number, found, size = number + 1, [], 0
        if found:
            yield _block(number, found)

    return rows.mapInArrow(run, _BLOCK)


def _finish(blocks: Iterator[pa.RecordBatch], totals: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one block from its packed links and the totals of its pairs."""
    block = pa.Table.from_batches(list(blocks)).to_pylist()
    if not block:
        return
    (row,) = block
    count = np.zeros(len(row["pairs"]), np.int64)
    best = np.zeros(len(row["pairs"]), bool)
    for batch in totals:
        place = np.asarray(batch.column("place"), np.int64)
        count[place] = np.asarray(batch.column("count"), np.int64)
        best[place] = batch.column("best").to_numpy(zero_copy_only=False)
    open_up = zstandard.ZstdDecompressor().decompress
    steps = np.frombuffer(open_up(row["places"]), "<i4").astype(np.int64)
    times = np.frombuffer(open_up(row["times"]), "<u4").astype(np.int64)
    n_pairs = np.array(row["n_pairs"], np.int64)
    starts = np.cumsum(n_pairs) - n_pairs
    sums = np.cumsum(steps)
    places = sums - np.repeat(np.concatenate([[0], sums])[starts], n_pairs)
    n_best, count_sum = np.zeros(len(n_pairs), np.int64), np.zeros(len(n_pairs), np.int64)
    some = n_pairs > 0
    if some.any():
        n_best[some] = np.add.reduceat(times * best[places], starts[some])
        count_sum[some] = np.add.reduceat(times * count[places], starts[some])
    columns = [row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], n_best, count_sum]
    arrays = [pa.array(column, pa.int64()) for column in columns] + [pa.array(row["groups"], pa.string())]
    yield pa.RecordBatch.from_arrays(arrays, [field.split()[0] for field in _DOCUMENT.split(", ")])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, count, best``: documents that hold a pair (A id times 2**32 plus B id), and whether
    no pair of its A id has more."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
    counts = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.holders").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def align_corpus(docs: DataFrame, byte_level_file: str, piece_file: str) -> DataFrame:
    """One row per document: token, group and link numbers, links that are the most frequent of
    their A id, the sum of all links' corpus-wide counts, and the digest of the groups."""
    rows, model = _inputs(docs, byte_level_file, piece_file)
    blocks = written(_blocks(rows, model), "aligned-blocks")
    wanted = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair"))
    totals = wanted.join(pair_counts(blocks), "pair").select("of_block", "place", "count", "best")
    packed = blocks.drop("holders")
    return packed.groupBy("block").cogroup(totals.groupBy("of_block")).applyInArrow(_finish_tables, _DOCUMENT)


def _finish_tables(block: pa.Table, totals: pa.Table) -> pa.Table:
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _DOCUMENT.split(", ")])
    return pa.Table.from_batches(list(_finish(block.to_batches(), totals.to_batches())), schema)
