"""Secret scan with SQL functions only: fixed patterns, plus windows of high Shannon entropy.

Base kinds come from patterns, matched leftmost and without overlap per kind; matches that
fail their length rule are dropped after matching, so they still use up their characters.

``entropy`` spans are added: candidate strings are runs of key characters. A window of
``WINDOW`` characters slides over each; the count of every character is kept while one
enters and one leaves, and with it the sum of ``c * log2(c)``, in whole millionths so that no
rounding adds up. Windows above the threshold of the candidate's character class are united.
Suppressed: candidates on the allow list, and spans that touch a base span.

Positions are code points from 0, end exclusive. Defined cases: a null or empty text has no
spans; repeated rows each get their result; an empty table gives no rows; other columns are
ignored. Everything is a map over one table, without any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind, pattern, and the group whose length has a minimum.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_KINDS = ("assign", "access", "hex")
# For runs of one class the shortest length is part of the pattern: a run that is too short
# holds no match of the right length either.
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
ASSIGN_LEAST = 6

WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Least entropy, in bits a character, of a window in a candidate of hex digits or of any characters.
HEX_BITS, MIXED_BITS = 2.8, 3.7
#: Candidates that are no keys: words, numbers, one-case names with dashes, examples, fillers.
ALLOWED = (
    r"^[A-Za-z]+$|^[0-9]+$|^[A-Za-z]+([-_/=+][A-Za-z]*)+$|(?i:example|placeholder|changeme)|(.)\1{7,}"
)


def _terms(window: int) -> list[int]:
    """``c * log2(c)`` in millionths for c = 0 .. window."""
    return [0, *(round(c * math.log2(c) * 1_000_000) for c in range(1, window + 1))]


def _sum_limit(bits: float, window: int) -> int:
    """A window has at least ``bits`` of entropy when its sum of terms is at most this."""
    return math.floor(window * (math.log2(window) - bits) * 1_000_000)


def matches_with_places(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<found, start, end>>`` of all matches, from the gaps that ``split`` leaves.

    ``found`` is the given group; a text without a match is scanned once.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), found.alias("found"))
    empty = F.array().cast("array<struct<found:string,start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + F.length(piece["gap"])
        end = begin + F.coalesce(F.length(piece["whole"]), F.lit(0))
        span = F.struct(piece["found"].alias("found"), begin.alias("start"), end.alias("end"))
        spans = F.when(piece["whole"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span)))
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(pieces, start, step, lambda s: s["spans"])).otherwise(empty)


def entropy_spans(candidate: Column, window: int = WINDOW) -> Column:
    """``array<struct<start, end>>`` of united windows of high entropy within a candidate string."""
    terms = F.array(*[F.lit(term).cast("long") for term in _terms(window)])
    limit = F.when(candidate.rlike("^[0-9A-Fa-f]+$"), F.lit(_sum_limit(HEX_BITS, window))).otherwise(
        F.lit(_sum_limit(MIXED_BITS, window))
    )
    places = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    zero = F.array_repeat(F.lit(0), len(ALPHABET))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    state = F.struct(F.lit(0).alias("at"), zero.alias("counts"), F.lit(0).cast("long").alias("total"), empty.alias("spans"))

    def step(s: Column, pair: Column) -> Column:
        enters, leaves = pair["enters"], pair["leaves"]
        counts = F.transform(
            s["counts"], lambda c, i: c + (i == enters).cast("int") - F.coalesce((i == leaves).cast("int"), F.lit(0))
        )
        # Terms change by the count that grows and the one that shrinks; none if they are the same.
        before = F.get(s["counts"], enters)
        grown = F.get(terms, before + 1) - F.get(terms, before)
        old = F.get(s["counts"], leaves)
        shrunk = F.coalesce(F.get(terms, old) - F.get(terms, old - 1), F.lit(0))
        total = F.when(enters.eqNullSafe(leaves), s["total"]).otherwise(s["total"] + grown - shrunk)
        at = s["at"] + 1
        return F.struct(
            at.alias("at"),
            counts.alias("counts"),
            total.alias("total"),
            F.when((at >= window) & (total <= limit), _with_window(s["spans"], at - window, at))
            .otherwise(s["spans"])
            .alias("spans"),
        )

    lagged = F.concat(F.array_repeat(F.lit(None).cast("int"), window), places)
    pairs = F.arrays_zip(places.alias("enters"), F.slice(lagged, F.lit(1), F.size(places)).alias("leaves"))
    return F.aggregate(pairs, state, step, lambda s: s["spans"])


def _with_window(spans: Column, start: Column, end: Column) -> Column:
    last = F.get(spans, F.size(spans) - 1)
    grown = F.concat(
        F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end")))
    )
    return F.when((F.size(spans) > 0) & (last["end"] >= start), grown).otherwise(
        F.concat(spans, F.array(F.struct(start.alias("start"), end.alias("end"))))
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans array<struct<start, rank, end, kind>>`` by start, then kind as listed."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = rows.select(
        "doc_id",
        F.filter(
            matches_with_places(text, PATTERNS["assign"], 2), lambda m: F.length(m["found"]) >= ASSIGN_LEAST
        ).alias("assign"),
        matches_with_places(text, PATTERNS["access"]).alias("access"),
        matches_with_places(text, PATTERNS["hex"]).alias("hex"),
        F.filter(matches_with_places(text, CANDIDATE), lambda m: ~m["found"].rlike(ALLOWED)).alias("candidates"),
    )

    def spans(kind: str) -> Column:
        rank = F.lit(BASE_KINDS.index(kind)).alias("rank")
        return F.transform(
            kind, lambda m: F.struct(m["start"].alias("start"), rank, m["end"].alias("end"), F.lit(kind).alias("kind"))
        )

    base = found.select("doc_id", F.concat(*map(spans, BASE_KINDS)).alias("base"), "candidates")
    added = F.flatten(
        F.transform(
            "candidates",
            lambda m: F.transform(
                entropy_spans(m["found"]),
                lambda s: F.struct(
                    (m["start"] + s["start"]).alias("start"),
                    F.lit(len(BASE_KINDS)).alias("rank"),
                    (m["start"] + s["end"]).alias("end"),
                    F.lit("entropy").alias("kind"),
                ),
            ),
        )
    )
    added = F.when(F.size("candidates") == 0, F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")).otherwise(added)
    clear = base.select("doc_id", "base", added.alias("added"))
    fresh = F.filter("added", lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    return clear.select("doc_id", F.array_sort(F.concat("base", fresh)).alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and digest of base spans, and all spans as text."""

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans")
    )
