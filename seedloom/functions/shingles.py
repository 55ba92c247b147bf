"""Character shingles and MinHash sketches as Arrow column functions.

A text is reduced to ASCII letters and digits and Thai characters, lower-cased, and
cut into 5-character shingles. That alphabet has 125 characters, so five 7-bit codes
name a shingle exactly: sets of integers stand in for sets of strings without
collisions. Higher-order SQL functions evaluate 128 permutations per shingle row by
row and interpreted; numpy does the same arithmetic over whole arrays.
"""

from __future__ import annotations

import functools
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

SHINGLE = 5
NUM_PERM = 128
PRIME = 2_147_483_647  # 2**31 - 1
GENERATOR = 48_271  # primitive root of PRIME; its powers give the permutation coefficients
WORD = 2**32

# Kept characters, in code order: digits, Latin letters, U+0E01 to U+0E59.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0x0E01, 0x0E5A)))

_CODE = np.zeros(0x0E5B, dtype=np.int64)
for _position, _char in enumerate(ALPHABET, start=1):
    _CODE[ord(_char)] = _position
    if _char.isascii():
        _CODE[ord(_char.upper())] = _position


def coefficients() -> tuple[list[int], list[int]]:
    """Odd multipliers and offsets of the permutations ``x -> (a*x + b) mod 2**32``."""
    powers = [pow(GENERATOR, exponent, PRIME) for exponent in range(1, 2 * NUM_PERM + 1)]
    return [value | 1 for value in powers[:NUM_PERM]], powers[NUM_PERM:]


_A, _B = (np.array(values, dtype=np.uint32)[:, None] for values in coefficients())
_BLOCK = 1024  # shingles per step: 128 permutations of them stay in the processor cache


def shingle_codes(text: str | None) -> np.ndarray:
    """Sorted distinct shingle codes; empty when no character is kept."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = _CODE[np.minimum(points, len(_CODE) - 1)]
    codes = codes[codes > 0]
    if 0 < len(codes) < SHINGLE:
        codes = np.concatenate([codes, np.zeros(SHINGLE - len(codes), dtype=np.int64)])
    count = max(len(codes) - SHINGLE + 1, 0)
    packed = np.zeros(count, dtype=np.int64)
    for offset in range(SHINGLE):
        packed = (packed << 7) | codes[offset : offset + count]
    return np.unique(packed)


def signature(codes: np.ndarray) -> np.ndarray:
    """128 MinHash values of 32 bits.

    x**5 permutes the prime field and breaks up the packed structure of the codes first;
    the permutations then wrap around in plain 32-bit arithmetic.
    """
    x = codes % PRIME
    square = x * x % PRIME
    mixed = (square * square % PRIME * x % PRIME).astype(np.uint32)
    best = np.full(NUM_PERM, WORD - 1, dtype=np.uint32)
    scratch = np.empty((NUM_PERM, min(_BLOCK, len(mixed))), dtype=np.uint32)
    for start in range(0, len(mixed), _BLOCK):
        part = mixed[start : start + _BLOCK]
        hashed = scratch[:, : len(part)]
        np.multiply(_A, part, out=hashed)
        hashed += _B
        np.minimum(best, hashed.min(axis=1), out=best)
    return best.astype(np.int64)


def mixed_codes(codes: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of codes to 64 bits."""
    keys = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(29)
    return keys * np.uint64(0xD6E8FEB86659FD93)


def parity_bitmaps(codes: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """A row of ``words`` 64-bit words per set: parities of its elements by hash.

    Bits in which two sets differ are at most the elements in which they differ.
    """
    width = 64 * words
    place = (mixed_codes(codes) >> np.uint64(20)) % np.uint64(width)
    owner = np.repeat(np.arange(len(counts)), counts)
    bits = np.bincount(owner * width + place.astype(np.int64), minlength=len(counts) * width) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(counts), width), axis=1).view(np.uint64)


def pack_codes(codes: np.ndarray) -> bytes:
    """Sorted codes as compressed steps."""
    return zlib.compress(np.diff(codes, prepend=0).astype("<u8").tobytes(), 1)


def unpack_codes(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), "<u8").astype(np.int64))


def digest_of(codes: np.ndarray) -> str:
    return hashlib.blake2b(codes.tobytes(), digest_size=16).hexdigest()


def jaccard_of(left: np.ndarray, right: np.ndarray) -> float:
    if not len(left) or not len(right):
        return 0.0
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return shared / (len(left) + len(right) - shared)


def _texts(column: pa.Array) -> list[str | None]:
    return column.to_pylist()


@arrow_udf(T.ArrayType(T.LongType()))
def minhash_signature(text: pa.Array) -> pa.Array:
    """MinHash signature of a text; NULL when the text keeps no character."""
    sets = (shingle_codes(value) for value in _texts(text))
    return pa.array([signature(codes) if len(codes) else None for codes in sets], pa.list_(pa.int64()))


_SKETCH = pa.struct([("n_shingles", pa.int64()), ("digest", pa.string()), ("codes", pa.binary())])


@arrow_udf(
    T.StructType().add("n_shingles", T.LongType()).add("digest", T.StringType()).add("codes", T.BinaryType())
)
def sketch(text: pa.Array) -> pa.Array:
    """Shingle count, digest of the shingle set, and the packed set of a text."""
    rows = []
    for value in _texts(text):
        codes = shingle_codes(value)
        rows.append({"n_shingles": len(codes), "digest": digest_of(codes), "codes": pack_codes(codes)})
    return pa.array(rows, _SKETCH)


@arrow_udf(T.DoubleType())
def packed_jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    """Exact Jaccard similarity of two packed shingle sets."""
    codes = functools.lru_cache(maxsize=512)(unpack_codes)  # the same sets recur in a batch
    scores = [jaccard_of(codes(a), codes(b)) for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)]
    return pa.array(scores, pa.float64())
