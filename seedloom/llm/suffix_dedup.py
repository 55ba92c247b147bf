"""Exact substring dedup: bytes covered by a long string that an earlier document holds too.

A byte goes if some ``length``-byte string over it also starts in a document with a smaller id.
Strings are judged on the input; matches never cross documents.

How one run-length index serves a corpus that no machine can hold:

0. Equal texts are one text: all but the document of smallest id lose everything.
1. Every window of ``length`` bytes has an anchor, the least hash among its ``GRAM``-byte
   strings; equal windows have equal anchors. Anchors are shared out by value, as packed blocks,
   to find those that two texts have. An anchor met twice in one slice is settled there, so
   a frequent anchor costs one entry a slice.
2. Runs of windows with one shared anchor are cut out as segments, once a slice. Segments of one
   anchor go to one shard; anchors with very many documents are divided by a second hash order
   first (``HOT_SHARE`` bounds that list). An anchor whose segments still exceed ``SHARD_BYTES``
   has several shards, dealt by segment. Equal segments meet in a shard and become one, with the
   smallest id; the only segment of an anchor has all its windows to itself.
3. Each shard builds a run-compressed Burrows-Wheeler transform of its other segments with sampled run
   ends (``RunLengthIndex``), streams all segments through it, and gives for each window the
   smallest id that holds it. Shards of one anchor give away their distinct windows, named by 128
   bits, with these ids, and get back the windows that another of them knows with a smaller one.
4. Windows whose smallest id is below the document's own mark its bytes.

Defined cases: a null or empty text has no bytes; texts shorter than ``length`` lose nothing;
rows with one doc_id never remove each other's bytes, and each gets its own row; a null doc_id
neither removes nor loses bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.arrays import ragged, text_slices, utf8_bytes
from seedloom.llm.run_length_index import RunLengthIndex
from seedloom.llm.shared_keys import BLOCKS, KEY_BITS, Resolved, blocks, first_turn, mix
from seedloom.llm.tables import written

LENGTH = 50
GRAM = 24
#: Anchors in one packed bucket, windows in one segment, bytes of segments in one shard.
BUCKET_ANCHORS = 3_000_000
SEGMENT_WINDOWS = 2_000
SHARD_BYTES = 400_000
#: An anchor with more documents than this, and than one in HOT_SHARE of all anchors, is divided.
HOT_DOCUMENTS = 20_000
HOT_SHARE = 1_000_000

#: Bytes hashed at a time: what is computed from them stays in the processor cache.
HASH_BLOCK = 1 << 14

_ODD = np.random.default_rng(20).integers(0, 1 << 63, 6, dtype=np.uint64).reshape(2, 3) | np.uint64(1)
#: Stands for bytes at which no whole window begins; anchors are smaller.
_NO_WINDOW = np.uint64(1 << KEY_BITS)


def window_anchors(data: np.ndarray, length: int, gram: int, order: int = 0) -> np.ndarray:
    """Anchor of the window that starts at each byte, while a whole window follows (48-bit values)."""
    found, width = np.empty(max(len(data) - length + 1, 0), np.uint64), length - gram + 1
    for at in range(0, len(found), HASH_BLOCK):
        least, seen = span_hashes(data[at : at + HASH_BLOCK + length - 1], gram, order) >> np.uint64(64 - KEY_BITS), 1
        while seen < width:
            more = min(seen, width - seen)
            least = np.minimum(least[:-more], least[more:])
            seen += more
        found[at : at + len(least)] = least
    return found


def span_hashes(data: np.ndarray, size: int, order: int = 0) -> np.ndarray:
    """64-bit hash of every string of ``size`` bytes in ``data``, which is no shorter."""
    data, n = np.ascontiguousarray(data), len(data) - size + 1
    if size < 8:
        words = [sum(data[k : k + n].astype(np.uint64) << np.uint64(8 * k) for k in range(size))]
    else:  # eight bytes at a time; the last ones may overlap those before
        words = [np.ndarray((n,), "<u8", data, at, (1,)) for at in sorted({*range(0, size - 7, 8), size - 8})]
    first, other, last = _ODD[order]
    value = np.full(n, last, np.uint64)
    for word in words:
        value ^= word
        value *= first
        value ^= value >> np.uint64(32)
    value *= other
    value ^= value >> np.uint64(29)
    value *= last
    return value


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places where one of the columns, all of one length, begins or has another value than before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    fresh = np.zeros(len(columns[0]), bool)
    fresh[0] = True
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(fresh)


def anchor_runs(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first window, number of windows and anchor of every run of windows in documents."""
    anchors = window_anchors(data, length, gram)
    tails = np.minimum(np.diff(offsets), length - 1)
    gaps = ragged(offsets[1:] - tails, tails)
    anchors[gaps[gaps < len(anchors)]] = _NO_WINDOW
    begin = _changes(anchors)
    count, value = np.diff(np.append(begin, len(anchors))), anchors[begin]
    real = value != _NO_WINDOW
    begin = begin[real]
    return np.searchsorted(offsets, begin, side="right") - 1, begin, count[real], value[real]


def divided_runs(
    data: np.ndarray, begin: np.ndarray, count: np.ndarray, value: np.ndarray, hot: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and value of runs; those of anchors in ``hot`` are parted where
    the second anchor changes, and their value mixes both."""
    heavy = np.isin(value, hot)
    if not heavy.any():
        return begin, count, value
    starts, windows = begin[heavy], count[heavy]
    sizes = windows + length - 1
    second = window_anchors(data[ragged(starts, sizes)], length, gram, order=1)
    second = second[ragged(np.cumsum(sizes) - sizes, windows)]
    mixed = mix(np.repeat(value[heavy], windows) ^ (second << np.uint64(16))) >> np.uint64(64 - KEY_BITS)
    fresh = _changes(mixed, np.repeat(np.arange(len(starts)), windows))
    parted = (ragged(starts, windows)[fresh], np.diff(np.append(fresh, len(mixed))), mixed[fresh])
    begin, count, value = (np.concatenate([a[~heavy], b]) for a, b in zip((begin, count, value), parted, strict=True))
    order = np.argsort(begin, kind="stable")
    return begin[order], count[order], value[order]


def _anchor_blocks(buckets: int, length: int, gram: int):
    """Distinct anchors of each slice's different texts, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(text_slices(batches), first_turn()):
            contents, first = np.unique(np.asarray(batch.column("content"), np.int64), return_index=True)
            data, offsets = utf8_bytes(batch.column("text").take(pa.array(first)))
            owner, _, _, value = anchor_runs(data, offsets, length, gram)
            order = np.lexsort((value, owner))
            owner, value = owner[order], value[order]
            once = _changes(value, owner)
            owner, value = owner[once], value[once]
            yield blocks(value, owner, np.zeros(len(value), np.uint8), contents, contents, buckets, turn)

    return run


_SHARED = "content long, anchors array<long>, hot long"


def _shared_anchors(hot_limit: int):
    """Per bucket: each text's anchors that another text has too; anchors with very many documents."""

    def resolve(table: pa.Table) -> pa.Table:
        found = Resolved(table)
        hot = found.counted[found.counts > hot_limit]
        turn = np.argsort(found.owner, kind="stable")
        keys, docs = found.keys[turn].astype(np.int64), found.owner[turn]
        begin = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else docs
        lists = pa.ListArray.from_arrays(np.append(begin, len(docs)).astype(np.int32), pa.array(keys))
        none = pa.nulls(len(hot), pa.int64())
        return pa.table(
            {
                "content": pa.concat_arrays([pa.array(found.ids[docs[begin]]), none]),
                "anchors": pa.concat_arrays([lists, pa.nulls(len(hot), lists.type)]),
                "hot": pa.concat_arrays([pa.nulls(len(begin), pa.int64()), pa.array(hot.astype(np.int64))]),
            }
        )

    return resolve


_SEGMENTS = "key binary, doc_id long, content long, place int, anchor long, segment binary, first long"


def _segments(hot, length: int, gram: int):
    """Segments of shared anchors: a row for each occurrence; the text once a slice, with its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            data, offsets = utf8_bytes(batch.column("text"))
            ids = np.asarray(batch.column("doc_id"), np.int64)
            shared = np.unique(np.asarray(batch.column("anchors").flatten(), np.int64).astype(np.uint64))
            # Whether an anchor is shared is asked of its first value, before hot ones are divided.
            _, begin, count, value = anchor_runs(data, offsets, length, gram)
            keep = np.isin(value, shared)
            begin, count, value = divided_runs(data, begin[keep], count[keep], value[keep], hot.value, length, gram)
            owner = np.searchsorted(offsets, begin, side="right") - 1
            # Long runs (repeating text) are cut; the pieces overlap by all but a byte of a window.
            pieces = -(-count // SEGMENT_WINDOWS)
            step = ragged(np.zeros(len(pieces), np.int64), pieces) * SEGMENT_WINDOWS
            owner, value = np.repeat(owner, pieces), np.repeat(value, pieces)
            begin, count = np.repeat(begin, pieces) + step, np.minimum(np.repeat(count, pieces) - step, SEGMENT_WINDOWS)
            raw = data.tobytes()
            texts = [raw[b : b + c + length - 1] for b, c in zip(begin.tolist(), count.tolist(), strict=True)]
            number: dict[bytes, int] = {}
            codes = np.fromiter((number.setdefault(t, len(number)) for t in texts), np.int64, len(texts))
            keys = [hashlib.blake2b(t, digest_size=16).digest() for t in number]
            first = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(first, codes, ids[owner])
            _, shown = np.unique(codes, return_index=True)
            once = np.zeros(len(codes), bool)
            once[shown] = True
            texts_once = [t if o else None for t, o in zip(texts, once.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[c] for c in codes.tolist()], pa.binary()),
                    pa.array(ids[owner]),
                    batch.column("content").take(pa.array(owner)),
                    pa.array((begin - offsets[owner]).astype(np.int32)),
                    pa.array(value.astype(np.int64)),
                    pa.array(texts_once, pa.binary()),
                    pa.array(first[codes], mask=~once),
                ],
                ["key", "doc_id", "content", "place", "anchor", "segment", "first"],
            )

    return run


_MARKS = "key binary, starts array<int>, stops array<int>, firsts array<long>"
_WINDOWS = "shard long, name binary, first long"


def in_shards(segments: DataFrame) -> DataFrame:
    """``key, anchor, segment, first, shard, split``: shards of about ``SHARD_BYTES``; ``split`` if others
    hold the anchor too. Rows of one key are in one shard."""
    each = segments.groupBy("anchor").agg(F.sum(F.octet_length("segment")).alias("n_bytes"))
    each = written(each, "anchor-bytes")
    total = each.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))
    # At most ``shards`` anchors are that heavy.
    heavy = F.broadcast(each.filter(F.col("n_bytes") > SHARD_BYTES))
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n_bytes") / SHARD_BYTES))
    split = F.col("n_bytes").isNotNull()
    return segments.join(heavy, "anchor", "left").select(
        "key",
        "anchor",
        "segment",
        "first",
        F.when(split, F.xxhash64("anchor", part)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).alias("shard"),
        split.alias("split"),
    )


class _Shard:
    """Different segments of a shard, each with its smallest id."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        halves = np.frombuffer(b"".join(table.column("key").to_pylist()), "<u8").reshape(-1, 2)
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        begin = _changes(halves[order, 0], halves[order, 1])
        first = np.asarray(table.column("first"), np.int64)[order]
        self.first = np.minimum.reduceat(first, begin) if len(begin) else first
        table = table.take(pa.array(order[begin]))
        self.keys, self.segments = table.column("key"), table.column("segment").to_pylist()
        self.anchors = np.asarray(table.column("anchor"), np.int64)

    def owners(self, length: int) -> np.ndarray:
        """Smallest owner of every window of the segments, one after the other.

        The windows of a segment that is the only one of its anchor are nowhere else; the others are
        looked up in an index.
        """
        counts = np.fromiter(map(len, self.segments), np.int64, len(self.segments)) - length + 1
        owners = np.repeat(self.first, counts)
        _, code, number = np.unique(self.anchors, return_inverse=True, return_counts=True)
        several = number[code] > 1
        if several.any():
            rows = np.flatnonzero(several)
            index = RunLengthIndex([self.segments[row] for row in rows.tolist()], self.first[rows], length)
            owners[np.repeat(several, counts)] = index.window_owners()
        return owners


def _marks(shard: _Shard, owners: np.ndarray, length: int) -> pa.Table:
    """Runs of windows with one smallest id, for every distinct segment of a shard."""
    counts = np.fromiter(map(len, shard.segments), np.int64, len(shard.segments)) - length + 1
    number = np.repeat(np.arange(len(counts)), counts)
    begin = _changes(owners, number)
    base = (np.cumsum(counts) - counts)[number[begin]]
    offsets = np.searchsorted(number[begin], np.arange(len(counts) + 1)).astype(np.int32)
    stops = np.append(begin[1:], len(owners)) if len(begin) else begin
    columns = {
        "starts": (begin - base).astype(np.int32),
        "stops": (stops - base + length - 1).astype(np.int32),
        "firsts": owners[begin],
    }
    return pa.table({"key": shard.keys} | {c: pa.ListArray.from_arrays(offsets, pa.array(v)) for c, v in columns.items()})


def _window_names(segments: list[bytes], length: int) -> np.ndarray:
    """16 bytes for every window of all segments, one after the other."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    places = ragged(np.cumsum(sizes) - sizes, sizes - length + 1)
    data = np.frombuffer(b"".join(segments), np.uint8)
    halves = [span_hashes(data, length, order)[places].astype("<u8") for order in (0, 1)]
    return np.stack(halves, axis=1).reshape(-1).view("S16")


def _index_shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        shard = _Shard(table)
        return _marks(shard, shard.owners(length), length)

    return run


def _shard_windows(length: int):
    """Distinct windows of a shard with their smallest ids."""

    def run(table: pa.Table) -> pa.Table:
        shard = _Shard(table)
        names, owners = _window_names(shard.segments, length), shard.owners(length)
        _, once = np.unique(names, return_index=True)
        shown = np.frombuffer(names[once].tobytes(), np.uint8)
        named = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(once), [None, pa.py_buffer(shown)])
        number = pa.array(np.full(len(once), table.column("shard")[0].as_py(), np.int64))
        return pa.table({"shard": number, "name": named.cast(pa.binary()), "first": owners[once]})

    return run


def _index_split_shard(length: int):
    """The same marks, where ``known`` has windows that another shard of the anchor knows with a smaller id."""

    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        shard = _Shard(table)
        owners = shard.owners(length)
        if known.num_rows and len(owners):
            names = np.array(known.column("name").to_pylist(), "S16")
            order = np.argsort(names)
            names, least = names[order], np.asarray(known.column("least"), np.int64)[order]
            wanted = _window_names(shard.segments, length)
            at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
            owners = np.where(names[at] == wanted, least[at], owners)
        return _marks(shard, owners, length)

    return run


def shard_marks(segments: DataFrame, length: int) -> DataFrame:
    """``_MARKS`` of segments ``key, segment, first, anchor``; a key may have several rows."""
    dealt = in_shards(segments)
    marks = dealt.filter("NOT split").groupBy("shard").applyInArrow(_index_shard(length), _MARKS)
    split = written(dealt.filter("split"), "split-shards")
    if split.isEmpty():
        return marks
    windows = written(split.groupBy("shard").applyInArrow(_shard_windows(length), _WINDOWS), "shard-windows")
    least = windows.groupBy("name").agg(F.min("first").alias("least"), F.max("first").alias("most")).filter("least < most")
    known = windows.join(least, "name").filter("least < first").select("shard", "name", "least")
    more = split.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_index_split_shard(length), _MARKS)
    return marks.unionAll(more)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        data, offsets = utf8_bytes(batch.column("text"))
        change = np.zeros(len(data) + 1, np.int32)
        lists = batch.column("spans")
        numbers = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
        flat = lists.flatten()
        base = np.repeat(offsets[:-1], numbers)
        np.add.at(change, base + np.asarray(flat.field("start"), np.int64), 1)
        np.add.at(change, base + np.asarray(flat.field("stop"), np.int64), -1)
        # All spans of a document end within it, so nothing is open at its end.
        gone = np.cumsum(change[:-1]) > 0
        begins = gone & ~np.concatenate([[False], gone[:-1]]) if len(gone) else gone
        inner = offsets[:-1][offsets[:-1] < len(gone)]
        begins[inner] = gone[inner]
        sums, removed, spans = [], [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            sums.append(hashlib.sha256(data[a:b][~gone[a:b]]).hexdigest())
            removed.append(int(gone[a:b].sum()))
            spans.append(int(begins[a:b].sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(sums, pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(firsts: DataFrame, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``content, start, stop``: byte ranges of texts that a document with a smaller id holds; they may overlap.

    ``docs`` has ``doc_id`` (long), ``content`` (hash of the text) and ``text``; ``firsts`` the
    smallest ``doc_id`` of each ``content``.
    """
    spark = docs.sparkSession
    usable = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    bytes_in = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = 2 * bytes_in // (length - gram + 2)
    buckets = max(1, math.ceil(expected / BUCKET_ANCHORS))
    hot_limit = max(HOT_DOCUMENTS, expected // HOT_SHARE)
    shared = written(
        usable.select("content", "text")
        .mapInArrow(_anchor_blocks(buckets, length, gram), BLOCKS)
        .groupBy("bucket")
        .applyInArrow(_shared_anchors(hot_limit), _SHARED),
        "shared-anchors",
    )
    # At most HOT_SHARE anchors can have more documents than that share of them.
    hot = np.array(sorted(row[0] for row in shared.select("hot").filter("hot IS NOT NULL").collect()), np.uint64)
    anchors = shared.filter("hot IS NULL").groupBy("content").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))
    # The first document of a text stands for its copies.
    segments = written(
        usable.select("doc_id", "content", "text")
        .join(anchors.join(firsts, "content"), ["doc_id", "content"])
        .mapInArrow(_segments(spark.sparkContext.broadcast(hot), length, gram), _SEGMENTS),
        "segments",
    )
    texts = segments.filter("segment IS NOT NULL").select("key", "anchor", "segment", "first")
    marks = written(shard_marks(texts, length), "marks")
    runs = F.filter(F.arrays_zip("starts", "stops", "firsts"), lambda r: r["firsts"] < F.col("doc_id"))
    return (
        segments.select("key", "doc_id", "content", "place")
        .join(marks, "key")
        .select("content", "place", F.explode(runs).alias("run"))
        .select(
            "content",
            (F.col("place") + F.col("run.starts")).alias("start"),
            (F.col("place") + F.col("run.stops")).alias("stop"),
        )
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("content", F.xxhash64("text", F.md5("text")))
    named = rows.filter("doc_id IS NOT NULL").select("doc_id", "content", F.octet_length("text").alias("size"))
    firsts = written(named.groupBy("content").agg(F.min("doc_id").alias("doc_id")), "first-of-text")
    spans = (
        repeated_spans(firsts, rows, length, gram)
        .groupBy("content")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    first = firsts.withColumnRenamed("doc_id", "first")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").cast("int").alias("stop")))
    # Written first, so that its shuffles are gone when the texts are shuffled to it.
    fates = written(
        named.filter(F.col("size") >= length)
        .distinct()
        .join(first, "content")
        .join(spans, "content", "left")
        .select("doc_id", "content", F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("spans")).alias("spans"))
        .filter("spans IS NOT NULL"),
        "fates",
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.join(fates, ["doc_id", "content"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, schema)
