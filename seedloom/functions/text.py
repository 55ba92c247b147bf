"""Column expressions for text trimming and deterministic, portable randomness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that Python's ``str.strip`` removes, derived from its own rule.
# All of them lie below U+3001.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Trim Unicode white space on both ends (Spark's ``trim`` only drops U+0020)."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def is_blank(value: Column | str) -> Column:
    """True for NULL, empty and all-white-space strings."""
    return F.coalesce(strip(value), F.lit("")) == ""


def order_key(seed: object, *parts: Column | str) -> Column:
    """md5 hex of ``seed:part:part...`` — a repeatable random order any engine can redo."""
    columns = [as_column(part).cast("string") for part in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *columns))


def key_slice(key: Column, word: int) -> Column:
    """The ``word``-th (0-3) unsigned 32-bit word of an md5 hex key, as bigint."""
    return F.conv(F.substring(key, 1 + 8 * word, 8), 16, 10).cast("bigint")
