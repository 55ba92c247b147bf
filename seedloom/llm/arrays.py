"""Ragged numpy arrays, bounded slices of Arrow batches, and a bounded memo of encoded pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4_000_000


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that column ``text`` holds about ``limit`` bytes; one row is never cut.

    Null texts become empty. Memory in a task follows the slice and the longest text.
    """
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = pc.fill_null(batch.column(at).cast(pa.large_string()), "")
        batch = batch.set_column(at, "text", text)
        ends = np.cumsum(np.asarray(pc.binary_length(text)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_characters() -> list[str]:
    """A printable character for every byte: itself if printable, else the next from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte) if byte in kept else chr(next(others)) for byte in range(256)]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i]`` of every i, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def utf8_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings after each other, and their ``len + 1`` offsets from zero."""
    text = text.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    if not len(text) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(text) + 1, np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Table:
    """Byte strings by number; ``join`` concatenates many of them without a Python loop."""

    def __init__(self, items: Sequence[bytes]):
        self.lengths = np.fromiter(map(len, items), np.int64, len(items))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(items), np.uint8)

    def join(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers]
        return self.data[ragged(self.starts[numbers], lengths)], lengths


class PieceMemo:
    """Ids of text pieces, remembered for the life of a Python worker.

    ``encode`` gets a list of new pieces and returns (ids one after the other, ids per
    piece). Holds about ``limit`` pieces plus those of one slice; beyond that, pieces met in
    one slice only are forgotten. This bounds memory and never changes a result.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 700_000):
        self.encode, self.limit = encode, limit
        self._fill({}, np.zeros(1024, np.uint32), np.zeros(1024, np.int32))

    def _fill(self, rows: dict[str, int], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.rows, self.ids, self.lengths = rows, ids, lengths
        self.starts = np.cumsum(lengths, dtype=np.int64) - lengths
        self.slices = np.zeros(len(lengths), np.int32)
        self.used = int(lengths.sum())

    def make_room(self) -> None:
        """Call between slices: row numbers change."""
        if len(self.rows) <= self.limit:
            return
        words, often = list(self.rows), self.slices > 1
        kept = np.flatnonzero(often[: len(words)])
        if len(kept) > self.limit // 2:
            kept = kept[:0]
        rows = {words[row]: place for place, row in enumerate(kept)}
        self._fill(rows, self.gather(kept), self.lengths[kept])

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """Row of every piece; the ids of row r are ``ids[starts[r] : starts[r] + lengths[r]]``."""
        rows = self.rows
        new = [piece for piece in dict.fromkeys(pieces) if piece not in rows]
        if new:
            ids, lengths = self.encode(new)
            first, count = len(rows), len(new)
            self.ids = _room(self.ids, self.used + len(ids))
            self.starts, self.lengths = _room(self.starts, first + count), _room(self.lengths, first + count)
            self.slices = _room(self.slices, first + count)
            self.ids[self.used : self.used + len(ids)] = ids
            self.lengths[first : first + count] = lengths
            self.starts[first : first + count] = self.used + np.cumsum(lengths) - lengths
            self.used += len(ids)
            rows.update(zip(new, range(first, first + count), strict=True))
        found = np.fromiter(map(rows.__getitem__, pieces), np.int64, len(pieces))
        self.slices[found] += 1
        return found

    def gather(self, rows: np.ndarray) -> np.ndarray:
        return self.ids[ragged(self.starts[rows], self.lengths[rows].astype(np.int64))]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def encode_each(
    pieces: list[str],
    direct: Callable[[str], list[int] | None],
    rest: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces: from ``direct`` where it has an answer, else from ``rest``, in order."""
    found = [direct(piece) for piece in pieces]
    left = [piece for piece, ids in zip(pieces, found, strict=True) if ids is None]
    own = np.array([ids is not None for ids in found], bool)
    flat = np.fromiter((number for ids in found if ids is not None for number in ids), np.uint32)
    sizes = np.fromiter((len(ids) for ids in found if ids is not None), np.int64)
    if not left:
        return flat, sizes
    more, counts = rest(left)
    ids, lengths = np.concatenate([flat, more]), np.concatenate([sizes, counts])
    place = np.where(own, np.cumsum(own) - 1, len(sizes) + np.cumsum(~own) - 1)
    starts = np.cumsum(lengths) - lengths
    return ids[ragged(starts[place], lengths[place])], lengths[place]


def encode_joined(tokenizer, pieces: list[str], glue: str, block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Encode many pieces as a few long strings; character offsets tell which ids are whose."""
    all_ids, counts = [], np.zeros(len(pieces), np.int64)
    for at in range(0, len(pieces), block):
        part = pieces[at : at + block]
        begins = np.cumsum(np.fromiter((len(piece) + len(glue) for piece in part), np.int64, len(part)))
        found = tokenizer.encode(glue.join(part), add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        first = np.fromiter((start for start, _ in found.offsets), np.int64, len(ids))
        owner = np.searchsorted(begins, first, side="right")
        counts[at : at + len(part)] = np.bincount(owner, minlength=len(part))
        all_ids.append(ids)
    return (np.concatenate(all_ids) if all_ids else np.zeros(0, np.uint32)), counts
