"""Packing of tokenised documents into windows by multiway differencing (Karmarkar and Karp).

Each task streams its documents, so nothing is shuffled. A document is its ids and ``end_id``.
What exceeds a window is cut off in whole windows; the rest joins a group of about
``GROUP_WINDOWS`` windows. A few documents of a group are held back, those that are cut anyway
first, then the longest. The others are dealt to windows by differencing: a partial partition is
a vector of window sums, and the two with the largest imbalance merge with opposing order,
largest sum to smallest, until one is left. While a window exceeds the capacity, the number of
windows rises by one. The room that is left, about equal in all windows, is filled exactly with
pieces of the documents held back. So most documents stay whole and every window is full. What
is left at the end of a task, less than a window, is cut into sequences of powers of two.

A group is bounded by its windows, and documents of a few ids are bundled before they are dealt,
so neither memory nor work of a task grows with the table. Sequence ids are the task's number and
a count within it; a task that runs again makes the same sequences from the same rows.

Defined cases: a null or empty text is the end id alone; a very long text fills windows of its
own; a null doc_id and repeated rows are documents like others; ties go by arrival; an empty
table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.arrays import text_slices
from seedloom.llm.token_files import encode_texts

CAPACITY = 4096
END_ID = 2
GROUP_WINDOWS = 64
#: Documents of fewer ids are bundled until a bundle has this many.
BUNDLE = 64
#: Share of a group's ids held back at first to fill windows; rises while it is too small.
HELD_BACK = 0.06

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


@dataclass(frozen=True)
class Piece:
    """Ids ``start .. start + len(ids)`` of one document."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        first = Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens)
        return first, Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens)

    @property
    def whole(self) -> bool:
        return len(self.ids) == self.doc_tokens


def difference(sizes: list[int], windows: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """Deal ``sizes`` to ``windows`` bins by multiway differencing: item numbers and sums by bin."""
    nothing = ((),) * (windows - 1)
    heap = []
    for number, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, number, sums, [(number,), *nothing]))
    if windows == 1 or not heap:
        return [tuple(range(len(sizes))), *nothing], np.array([sum(sizes)] + [0] * (windows - 1), np.int64)
    heapq.heapify(heap)
    while len(heap) > 1:
        _, age, sums, bins = heapq.heappop(heap)
        _, other_age, more, others = heap[0]
        sums = sums + more[::-1]
        order = np.argsort(-sums, kind="stable")
        joined = [a + b for a, b in zip(bins, reversed(others), strict=True)]
        sums = sums[order]
        merged = (int(sums[-1] - sums[0]), min(age, other_age), sums, [joined[i] for i in order.tolist()])
        heapq.heapreplace(heap, merged)
    return heap[0][3], heap[0][2]


def deal(sizes: list[int], capacity: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """``difference`` with the least number of windows, from the sum's on, that holds all sizes."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        bins, sums = difference(sizes, windows)
        if sums.max(initial=0) <= capacity:
            return bins, sums
        windows += 1


def bundled(pieces: list[Piece], least: int) -> list[list[Piece]]:
    """Items to deal: pieces of ``least`` ids or more alone, shorter ones together."""
    items = [[piece] for piece in pieces if len(piece.ids) >= least]
    bundle, size = [], 0
    for piece in pieces:
        if len(piece.ids) < least:
            bundle.append(piece)
            size += len(piece.ids)
            if size >= least:
                items.append(bundle)
                bundle, size = [], 0
    return [*items, bundle] if bundle else items


def pack_group(pieces: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows from ``pieces`` (each shorter than a window), and the pieces left over.

    The ids left over are fewer than those held back, or than a window.
    """
    total = sum(len(piece.ids) for piece in pieces)
    if total < capacity:
        return [], pieces
    # Cut documents first, then the longest; the order of arrival settles ties.
    order = sorted(range(len(pieces)), key=lambda i: (pieces[i].whole, -len(pieces[i].ids), i))
    least_held, held, size = max(1, int(HELD_BACK * total)), 0, 0
    while True:
        while held < len(order) and size < least_held:
            size += len(pieces[order[held]].ids)
            held += 1
        chosen = set(order[:held])
        items = bundled([piece for i, piece in enumerate(pieces) if i not in chosen], min(BUNDLE, capacity))
        bins, sums = deal([sum(len(piece.ids) for piece in item) for item in items], capacity)
        if len(bins) * capacity <= total or held == len(order):
            break
        least_held = size + max(1, int(HELD_BACK * total))
    windows = [[piece for number in sorted(numbers) for piece in items[number]] for numbers in bins]
    rest = [pieces[i] for i in order[:held]][::-1]
    for window, room in zip(windows, (capacity - sums).tolist(), strict=True):
        while room:
            piece = rest.pop()
            if len(piece.ids) > room:
                piece, left = piece.cut(room)
                rest.append(left)
            window.append(piece)
            room -= len(piece.ids)
    return windows, rest[::-1]


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Sequences of power-of-two lengths, the longest first, that hold all ids of ``pieces``."""
    left, rest = sum(len(piece.ids) for piece in pieces), pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        sequence = []
        while room:
            piece = rest.pop()
            if len(piece.ids) > room:
                piece, later = piece.cut(room)
                rest.append(later)
            sequence.append(piece)
            room -= len(piece.ids)
        yield sequence


def sequences(pieces: Iterator[Piece], capacity: int, group_windows: int = GROUP_WINDOWS) -> Iterator[list[Piece]]:
    """All sequences of a stream of documents."""
    waiting, size = [], 0
    for piece in pieces:
        while len(piece.ids) >= capacity:
            full, piece = piece.cut(capacity)
            yield [full]
        if len(piece.ids):
            waiting.append(piece)
            size += len(piece.ids)
        if size >= group_windows * capacity:
            windows, waiting = pack_group(waiting, capacity)
            size = sum(len(piece.ids) for piece in waiting)
            yield from windows
    while size >= capacity:
        windows, waiting = pack_group(waiting, capacity)
        size = sum(len(piece.ids) for piece in waiting)
        yield from windows
    yield from powers_of_two(waiting)


def _documents(batches: Iterator[pa.RecordBatch], tokenizer_json: str, end_id: int) -> Iterator[Piece]:
    for batch in text_slices(batches):
        ids, lengths = encode_texts(batch.column("text"), tokenizer_json, end_id)
        stops = np.cumsum(lengths)
        starts = stops - lengths
        for doc_id, start, stop in zip(batch.column("doc_id").to_pylist(), starts.tolist(), stops.tolist(), strict=True):
            yield Piece(doc_id, 0, ids[start:stop], stop - start)


def _rows(numbered: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
    pieces = [(number, piece) for number, sequence in numbered for piece in sequence]
    lengths = np.array([len(piece.ids) for _, piece in pieces], np.int64)
    sizes = np.array([sum(len(piece.ids) for piece in sequence) for _, sequence in numbered], np.int64)
    first = np.repeat(np.cumsum(sizes) - sizes, [len(sequence) for _, sequence in numbered])
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([piece.doc_id for _, piece in pieces], pa.int64()),
            "start": pa.array([piece.start for _, piece in pieces], pa.int64()),
            "length": pa.array(lengths),
            "doc_tokens": pa.array([piece.doc_tokens for _, piece in pieces], pa.int64()),
            "sequence_id": pa.array([number for number, _ in pieces], pa.int64()),
            "offset": pa.array(np.cumsum(lengths) - lengths - first, pa.int64()),
            "ids": pa.array([piece.ids.tobytes() for _, piece in pieces], pa.binary()),
        }
    )


def pack_documents(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian u32)."""
    if capacity < 1:
        raise ValueError("a window holds one id at least")
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ready, size = TaskContext.get().partitionId() << 32, [], 0
        for sequence in sequences(_documents(batches, tokenizer.value, end_id), capacity):
            ready.append((number, sequence))
            number, size = number + 1, size + sum(len(piece.ids) for piece in sequence)
            if size >= GROUP_WINDOWS * CAPACITY:
                yield _rows(ready)
                ready, size = [], 0
        if ready:
            yield _rows(ready)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
