"""Keys that several owners have, found by sharing packed keys out by value.

A slice of rows gives ``(key, owner)`` pairs; ``blocks`` packs them into a few binary rows, one
per bucket of key values. A key that two owners of the slice have is known to be shared: its
pairs travel apart, in buckets below zero, and its own bucket gets one mark per slice. So a
bucket holds a frequent key once a slice, not once an owner. Buckets below zero need no key in
common, so slices take them in turn, whatever they hold. ``resolve`` turns a bucket back into the
pairs of shared keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

KEY_BITS = 48
_BYTES = KEY_BITS // 8
BLOCKS = "bucket long, packed binary, place binary, flags binary, ids array<long>, others array<long>, multi binary, numbers binary"
_NAMES = ["bucket", "packed", "place", "flags", "ids", "others", "multi", "numbers"]
_KINDS = [
    pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()
]


def mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def first_turn() -> int:
    """Turn of a task's first slice; the others count on. A task that runs again gives the same turns."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()


def _unpack(packed: list[bytes]) -> np.ndarray:
    parts = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, _BYTES)
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, :_BYTES] = parts
    return whole.reshape(-1).view("<u8").astype(np.uint64)


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def blocks(
    value: np.ndarray, owner: np.ndarray, flags: np.ndarray, ids: np.ndarray, others: np.ndarray, buckets: int, turn: int
) -> pa.RecordBatch:
    """Rows of ``BLOCKS`` for keys ``value`` (below 2^48) of ``owner``, a place in ``ids`` and ``others``.

    ``turn`` is the slice's, see ``first_turn``.
    """
    order = np.lexsort((owner, value))
    value, owner, flags = value[order], owner[order], flags[order]
    begin = _starts(value)
    fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])[: len(value)]
    number = np.add.reduceat(fresh.astype(np.int64), begin) if len(value) else begin
    several = np.repeat(number > 1, np.diff(np.append(begin, len(value))))
    bucket = (value % np.uint64(buckets)).astype(np.int64)
    rows: list[tuple] = []

    def row(where: int, part: np.ndarray, known: np.ndarray) -> None:
        docs, place = np.unique(owner[part], return_inverse=True)
        rows.append(
            (
                where, _pack(value[part]), place.astype("<u4").tobytes(), flags[part].astype(np.uint8).tobytes(),
                ids[docs], others[docs], _pack(value[known]), number[np.searchsorted(begin, known)].astype("<u4").tobytes(),
            )
        )

    own = np.flatnonzero(~several)
    own = own[np.argsort(bucket[own], kind="stable")]
    heads = begin[number > 1]
    heads = heads[np.argsort(bucket[heads], kind="stable")]
    for b in np.union1d(bucket[own], bucket[heads]):
        part = own[slice(*np.searchsorted(bucket[own], [b, b + 1]))]
        row(int(b), part, heads[slice(*np.searchsorted(bucket[heads], [b, b + 1]))])
    if several.any():
        part = np.flatnonzero(several)
        row(-1 - turn % buckets, part, part[:0])
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


class Resolved:
    """Pairs of shared keys of one bucket: ``keys``, ``flags``, and the owners' ``ids`` and ``others``.

    ``counted`` and ``counts`` are the bucket's distinct keys and their numbers of owners.
    """

    def __init__(self, table: pa.Table):
        ids, others = (np.asarray(table.column(c).combine_chunks().flatten(), np.int64) for c in ("ids", "others"))
        listed = np.array([len(x) for x in table.column("ids")], np.int64)
        base = np.cumsum(listed) - listed
        places = [np.frombuffer(x, "<u4") for x in table.column("place").to_pylist()]
        owner = np.concatenate([p.astype(np.int64) + b for p, b in zip(places, base, strict=True)])
        keys = _unpack(table.column("packed").to_pylist())
        flags = np.frombuffer(b"".join(table.column("flags").to_pylist()), np.uint8)
        self.counted, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if table.column("bucket")[0].as_py() >= 0:
            multi = _unpack(table.column("multi").to_pylist())
            numbers = np.frombuffer(b"".join(table.column("numbers").to_pylist()), "<u4").astype(np.int64)
            order = np.argsort(keys, kind="stable")
            keys, owner, flags = keys[order], owner[order], flags[order]
            begin = _starts(keys)
            size = np.diff(np.append(begin, len(keys)))
            several = np.isin(keys, multi)
            if len(keys):
                # Rows with one id are one owner, wherever they come from.
                own = ids[owner]
                several |= np.repeat(np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin), size)
            both = np.concatenate([keys[begin], multi])
            self.counted, inverse = np.unique(both, return_inverse=True)
            self.counts = np.bincount(inverse, np.concatenate([size, numbers]), minlength=len(self.counted)).astype(np.int64)
            keys, owner, flags = keys[several], owner[several], flags[several]
        self.keys, self.flags = keys, flags
        self.owner, self.ids, self.others = owner, ids, others
