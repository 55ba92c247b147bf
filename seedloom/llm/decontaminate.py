"""Benchmark passages in documents, with SQL functions only.

Words are lower-cased runs of letters and digits; shingles are five words (the whole item if it
is shorter). A window of a document has as many words as the item. An item leaks into a
document if the weighted Jaccard similarity of some window's shingles with the item's is at
least ``threshold``; weights follow rarity among the items, and shingles that the item lacks
weigh as the rarest.

1. Each item gives away its *anchors*: shingles with more than ``1 - threshold`` of its weight.
   A window similar enough must hold one, so one pass over the documents against the anchors
   loses nothing. Anchors go out in blocks of bounded size, each broadcast.
2. Every hit places all windows that hold it, wherever the item has the shingle.
3. Every such window is verified by exact weighted similarity.

Anchors take the place of the SimHash fingerprints and Hamming blocks this search was laid out
with: unweighted fingerprints in a radius can lose pairs that the weighted similarity accepts.
``simhash`` and ``blocks_agree`` stay as functions; ``find_leaks`` does not use them.

Defined cases: null or wordless texts and items match nothing; an item of fewer than five words
is one shingle; a document shorter than an item is one window; repeated documents each get
their rows, repeated items too; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.columns import with_computed
from seedloom.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
#: Hits are gathered by stretches of a document of this many items' length.
STRETCH = 4
#: Anchor rows in one broadcast: at most about 16 MB.
ANCHORS_PER_BLOCK = 250_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))


def shingles_of(hashes: Column, size: int = SHINGLE) -> Column:
    """Hash of every run of ``size`` words; fewer words make one shingle, none make none."""

    def run(i: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])

    long = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), run)
    return F.when(F.size(hashes) >= size, long).otherwise(
        F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(F.array().cast("array<long>"))
    )


def _runs(hashes: Column, size: int) -> Column:
    """Hash of every run of ``size`` words as the whole of a short item hashes."""
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(size))))


def simhash(shingles: Column) -> Column:
    """64 signs of the sums of the shingles' bits, packed into one long."""
    sums = F.aggregate(
        shingles,
        F.array_repeat(F.lit(0), 64),
        lambda total, s: F.transform(
            total, lambda x, bit: x + F.when(F.getbit(s, bit) == 1, F.lit(1)).otherwise(F.lit(-1))
        ),
    )
    signs = F.transform(sums, lambda x, bit: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(signs, F.lit(0).cast("long"), lambda packed, bit: packed.bitwiseOR(bit))


def blocks_agree(one: Column, other: Column, radius: int) -> Column:
    """True if one of ``radius + 1`` blocks of the fingerprints is the same (sure within the radius)."""
    differs = one.bitwiseXOR(other)
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    masks = [((1 << b) - (1 << a)) - (1 << 64 if b == 64 else 0) for a, b in zip(edges, edges[1:], strict=False)]
    return reduce(Column.__or__, [differs.bitwiseAND(F.lit(mask).cast("long")) == 0 for mask in masks])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_words, item_shingles, weights, rarest`` of items with words."""
    rows = benchmark.select("item_id", word_hashes(F.col("text")).alias("hashes")).filter(F.size("hashes") > 0)
    rows = with_computed(rows, {"item_shingles": F.array_distinct(shingles_of(F.col("hashes")))})
    # Repeated items (same id, same words) keep a row of their own.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    total = rows.agg(F.count("*").alias("items"))
    each = rows.select("row", F.explode("item_shingles").alias("shingle"))
    holders = each.groupBy("shingle").agg(F.count("*").alias("holders"))
    weighed = (
        each.join(holders, "shingle")
        .join(F.broadcast(total))  # one row
        .select("row", "items", F.struct("shingle", F.log1p(F.col("items") / F.col("holders")).alias("w")).alias("pair"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("pair")).alias("pairs"), F.log1p(F.first("items")).alias("rarest"))
    )
    return rows.join(weighed, "row").select(
        F.struct("item_id", "row").alias("item"),
        F.size("hashes").alias("item_words"),
        F.col("pairs.shingle").alias("item_shingles"),
        F.col("pairs.w").alias("weights"),
        "rarest",
    )


def anchors_of(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``shingle, item``: the rarest shingles, up to more than ``1 - threshold`` of the weight."""
    pairs = F.arrays_zip(F.col("weights").alias("w"), F.col("item_shingles").alias("s"))
    ranked = F.array_sort(F.transform(pairs, lambda p: F.struct((-p["w"]).alias("w"), p["s"].alias("s"))))
    total = F.aggregate("weights", F.lit(0.0), lambda t, w: t + w)
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<bigint>").alias("chosen"))
    limit = (1 - threshold) * total * (1 + 1e-9)

    def step(s: Column, p: Column) -> Column:
        enough = s["sum"] > limit
        return F.struct(
            F.when(enough, s["sum"]).otherwise(s["sum"] - p["w"]).alias("sum"),
            F.when(enough, s["chosen"]).otherwise(F.concat(s["chosen"], F.array(p["s"]))).alias("chosen"),
        )

    chosen = F.aggregate(ranked, start, step, lambda s: s["chosen"])
    return items.select(F.explode(chosen).alias("shingle"), "item")


def _hits(docs: DataFrame, anchors: DataFrame, per_block: int) -> DataFrame:
    """Documents' shingles that are anchors, one broadcast pass for each block of anchors."""
    blocks = max(1, math.ceil(anchors.count() / per_block))
    parts = []
    for block in range(blocks):
        part = anchors if blocks == 1 else anchors.filter(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == block)
        parts.append(docs.join(F.broadcast(part), "shingle"))
    return reduce(DataFrame.unionAll, parts)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, item_id, start, similarity``: the best window of each item in each document.

    ``start`` counts the document's words before the window; ties go to the earliest.
    """
    items = cut_lineage(benchmark_items(benchmark))
    lengths = items.select("item", "item_words")
    anchors = anchors_of(items, threshold).join(lengths, "item")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = with_computed(rows, {"hashes": word_hashes(F.col("text"))}).select(
        F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("doc"), "hashes"
    )
    # ``hashes`` travels by reference: only rows that meet an anchor are ever written out.
    exploded = [hashed.select("doc", "hashes", F.posexplode(shingles_of(F.col("hashes"))).alias("at", "shingle"))]
    # Items shorter than a shingle (at most four lengths) are looked for as runs of their own length.
    for row in items.filter(F.col("item_words") < SHINGLE).select("item_words").distinct().collect():
        size = row["item_words"]
        runs = _runs(F.col("hashes"), size)
        longer = hashed.filter(F.size("hashes") > size)
        exploded.append(longer.select("doc", "hashes", F.posexplode(runs).alias("at", "shingle")))
    n, words = F.col("item_words"), F.size("hashes")
    stretch = F.floor(F.col("at") / (STRETCH * n)).cast("int")
    begin = F.greatest(stretch * STRETCH * n - n, F.lit(0))
    hits = reduce(DataFrame.unionAll, [_hits(part, anchors, anchors_per_block) for part in exploded])
    # A stretch has the words of all windows that hold an anchor starting in it.
    placed = (
        hits.select(
            "doc",
            "item",
            "item_words",
            "at",
            stretch.alias("stretch"),
            begin.alias("begin"),
            F.greatest(words - n, F.lit(0)).alias("last"),
            F.slice("hashes", begin + 1, (STRETCH + 2) * n).alias("part"),
        )
        .groupBy("doc", "item", "item_words", "stretch", "begin", "last")
        .agg(F.sort_array(F.collect_set("at")).alias("ats"), F.first("part").alias("part"))
    )

    def starts(at: Column, i: Column) -> Column:
        """Starts of windows that hold the anchor at ``at`` and begin behind the one before."""
        first = F.greatest(at + F.least(n, F.lit(SHINGLE)) - n, F.coalesce(F.get("ats", i - 1) + 1, F.lit(0)), F.lit(0))
        final = F.least(at, F.col("last"))
        return F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<int>"))

    windows = placed.join(items.drop("item_words"), "item").withColumn(
        "start", F.explode(F.flatten(F.transform("ats", starts)))
    )
    windows = windows.withColumn("words", F.slice("part", F.col("start") - F.col("begin") + 1, n)).drop("part", "ats")
    joined = with_computed(windows, {"shingles": F.array_distinct(shingles_of(F.col("words")))})
    scored = with_computed(joined, {"similarity": weighted_similarity()}).filter(F.col("similarity") >= threshold - 1e-12)
    best = scored.groupBy("doc", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("place"))).alias("best")
    )
    return best.select(
        F.col("doc.doc_id").alias("doc_id"),
        F.col("item.item_id").alias("item_id"),
        (-F.col("best.place")).alias("start"),
        "best.similarity",
    )


def weighted_similarity() -> Column:
    """Weighted Jaccard of ``shingles`` with ``item_shingles`` under ``weights`` and ``rarest``."""
    pairs = F.arrays_zip(F.col("item_shingles").alias("s"), F.col("weights").alias("w"))
    shared = F.aggregate(
        pairs, F.lit(0.0), lambda t, p: t + F.when(F.array_contains("shingles", p["s"]), p["w"]).otherwise(F.lit(0.0))
    )
    total = F.aggregate("weights", F.lit(0.0), lambda t, w: t + w)
    strange = F.size(F.array_except("shingles", "item_shingles")) * F.col("rarest")
    return shared / (total + strange)
