"""Exact Jaccard join of word shingles: universe partition, pigeonhole and one-deletion neighbourhoods.

A document is the set of its distinct shingles of ``words`` words (lower-cased A-Z, cut at ASCII
white space; fewer words make one shingle). Two documents link when
``100 * intersection >= percent * union``; components are the closure of links.

*Size bands.* Linked sets lie in the same or the next band. ``H`` bounds the symmetric difference
of a set of a band with a linked one that is no smaller.
*Universe partition.* For each band, a hash deals all possible shingles to ``H + 1`` segments. If
the segment tolerances ``t`` of a larger set satisfy ``sum(t + 1) > H``, any smaller linked set
differs by at most ``t`` in some segment (pigeonhole). ``t = 0`` looks for the same subset,
``t = 1`` also for subsets with one shingle more or less (one-deletion neighbourhoods), ``t = -1``
skips the segment.
*Allocation by cost.* Smaller sets index all subsets, and one-deletion neighbourhoods of the first
segments of a band. The larger set chooses: it skips its costliest segments (empty ones, then
subsets that many sets of its slice have) and makes up for each by ``t = 1`` in one of the first.
Whatever it chooses keeps the sum, so the choice never costs a pair.

Keys meet by value (``shared_keys``). A key's sets are first verified against single ones of them;
sets that are then in one component need no further comparison, others are verified against all
sets of the key in other components. A histogram of shingle hashes bounds the intersection from above and drops hopeless
pairs; what is left is verified on the full sets. Equal sets are one set from the start, so
groups of copies cost nothing; no pairs inside a settled group are made.

Sets are compared as 64-bit shingle hashes and told apart by a 64-bit hash of all of them.

Defined cases: null, empty or wordless texts have no shingle and link with nothing; repeated rows
each get a row; a null doc_id takes part but is never the smallest; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.arrays import ragged, text_slices
from seedloom.llm.components import connected_components
from seedloom.llm.shared_keys import BLOCKS, KEY_BITS, Resolved, blocks, first_turn, mix
from seedloom.llm.tables import written

WORDS = 4
PERCENT = 85
BUCKET_KEYS = 1_000_000
SKETCH_BINS = 512
#: Bits of an entry: subset in the index, subset looked up, one-deletion in the index, looked up.
INDEX, PROBE, INDEX_LESS, PROBE_LESS = 1, 2, 4, 8
#: A segment counts as costly when this many sets of one slice have its subset.
COSTLY = 4
#: Most rounds against single sets of open keys; more rounds only mean fewer pairs afterwards.
ROUNDS = 1
#: Keys of more sets than this are compared in tiles of about so many sets.
CROWDED, TILE_SETS = 64, 512
#: Most entries of sets in a tile, keys looked at together, and first tiles of a group in one task.
TILE_ENTRIES, KEYS_AT_ONCE, TILES_IN_TASK = 100_000, 4_096, 8
#: A one-deletion neighbourhood needs this many shingles, so that what is left says something.
LEAST_FOR_DELETION = 3

_SEED = np.random.default_rng(7).integers(0, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


class Bands:
    """Size bands up to ``largest``, and for each the number of segments and of deletable ones."""

    def __init__(self, percent: int, largest: int):
        lows = [1]
        while lows[-1] <= largest:
            lows.append(lows[-1] * 100 // percent + 1)
        self.lows = np.array(lows, np.int64)
        segments = []
        for low, beyond in zip(lows, [*lows[1:], lows[-1] * 100 // percent + 1], strict=True):
            highest = (beyond - 1) + (beyond - 1) * 100 // percent
            sums = np.arange(max(2 * low, highest - 400), highest + 1)
            # Least intersection o of sets with sizes adding up to x: 100 o >= percent (x - o).
            segments.append(int((sums - 2 * (-(-percent * sums // (100 + percent)))).max()) + 1)
        self.segments = np.array(segments, np.int64)
        self.deletable = np.minimum(self.segments, 2 + self.segments // 32)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1


def shingle_sets(text: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    plain = pc.ascii_lower(text)
    for space in "\t\n\v\f\r":
        plain = pc.replace_substring(plain, space, " ")
    lists = pc.split_pattern(plain, " ")
    flat = lists.flatten()
    filled = np.asarray(pc.not_equal(flat, "").to_numpy(zero_copy_only=False), bool)
    owner = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists), np.int64))
    counts = np.bincount(owner[filled], minlength=len(lists))
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    word = hashes[np.asarray(coded.indices, np.int64)] if len(coded) else np.zeros(0, np.uint64)
    run = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for k in range(words):
        run = mix(run + word[k : k + len(run)] * _SEED[0])
    stops = np.cumsum(counts)
    sets = []
    for start, stop in zip(stops - counts, stops, strict=True):
        if stop - start >= words:
            sets.append(np.unique(run[start : stop - words + 1]))
        elif stop > start:
            sequence = word[start:stop].tobytes()
            sets.append(np.array([xxhash.xxh64_intdigest(sequence, seed=int(stop - start))], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(shingles: np.ndarray) -> bytes | None:
    """Histogram of shingle hashes; the sum of its minima with another is at least the intersection."""
    bins = np.bincount((mix(shingles * _SEED[1]) % np.uint64(SKETCH_BINS)).astype(np.int64), minlength=SKETCH_BINS)
    return bins.astype(np.uint8).tobytes() if bins.max() < 256 else None


def entries(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, place of the set, and flags of everything that the given distinct sets index and look up."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    bands = Bands(percent, int(sizes.max()))
    shingles = np.concatenate(sets)
    value = mix(shingles * _SEED[2])
    owner = np.repeat(np.arange(len(sets)), sizes)
    own = bands.of(sizes)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    indexed: np.ndarray | None = None
    for lower in (0, 1):
        band = own - lower
        segments = np.where(band >= 0, bands.segments[band], 0)
        deletable = bands.deletable[band]
        base = np.cumsum(segments) - segments
        used = (band >= 0)[owner]
        of, values = owner[used], value[used]
        segment = (mix(shingles[used] * _SEED[3]) % segments[of].astype(np.uint64)).astype(np.int64)
        at = base[of] + segment
        total = int(segments.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, at, values)
        count = np.bincount(at, minlength=total)
        set_of = np.repeat(np.arange(len(sets)), segments)
        number = ragged(np.zeros(len(sets), np.int64), segments)
        place = mix(band[set_of].astype(np.uint64) * _SEED[4] + number.astype(np.uint64) * _SEED[5])
        keys = mix(sums ^ place) >> np.uint64(64 - KEY_BITS)
        if indexed is None:
            indexed = np.sort(keys)
        # Cost of a segment: how many sets of this slice have the subset; empty ones cost most.
        cost = np.searchsorted(indexed, keys, side="right") - np.searchsorted(indexed, keys, side="left")
        cost = np.where(count == 0, len(sets) + 1, cost)
        costly = cost >= COSTLY
        helper = (number < deletable[set_of]) & (count >= LEAST_FOR_DELETION) & ~costly
        skips = np.minimum(np.bincount(set_of[costly], minlength=len(sets)), np.bincount(set_of[helper], minlength=len(sets)))
        skipped, raised = np.zeros(total, bool), np.zeros(total, bool)
        for picked, out, order in ((costly, skipped, -cost), (helper, raised, number)):
            rows = np.flatnonzero(picked)
            rows = rows[np.lexsort((order[rows], set_of[rows]))]
            first = np.searchsorted(set_of[rows], set_of[rows])
            out[rows[np.arange(len(rows)) - first < skips[set_of[rows]]]] = True
        if lower:
            kept = np.flatnonzero(~skipped)
            found.append((keys[kept], set_of[kept], np.full(len(kept), PROBE, np.uint8)))
        else:
            found.append((keys, set_of, np.where(skipped, INDEX, INDEX | PROBE).astype(np.uint8)))
        # One shingle less: the sum without its value.
        flags = np.where(raised[at], PROBE_LESS, 0)
        if not lower:
            flags |= np.where((number < deletable[set_of])[at] & (count[at] >= LEAST_FOR_DELETION), INDEX_LESS, 0)
        less = np.flatnonzero(flags)
        keys = mix((sums[at[less]] - values[less]) ^ place[at[less]]) >> np.uint64(64 - KEY_BITS)
        found.append((keys, of[less], flags[less].astype(np.uint8)))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


_DOCS = "doc_id long, n_shingles long, set_id long, sketch binary"


def _map(buckets: int, words: int, percent: int):
    """Blocks of keys, and in the same rows' ``docs`` the documents with their sets."""
    doc_type = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()), ("sketch", pa.binary())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, batch in enumerate(text_slices(batches), first_turn()):
            sets = shingle_sets(batch.column("text"), words)
            ids = [set_id(s) if len(s) else None for s in sets]
            first: dict[int, int] = {}
            docs = []
            for row, (doc_id, s, number) in enumerate(zip(batch.column("doc_id").to_pylist(), sets, ids, strict=True)):
                fresh = number is not None and first.setdefault(number, row) == row
                docs.append((doc_id, len(s), number, sketch(s) if fresh else None))
            if first:
                distinct = [sets[row] for row in first.values()]
                key, owner, flags = entries(distinct, percent)
                numbers = np.fromiter(first, np.int64, len(first))
                sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
                packed = blocks(key, owner, flags, numbers, sizes, buckets, turn)
                yield packed.append_column("docs", pa.nulls(packed.num_rows, doc_type))
            # Documents pass by their slice, in a bucket of their own kind.
            where = -1 - buckets - turn % buckets
            fields = [pa.array(c, f.type) for c, f in zip(zip(*docs, strict=True), doc_type.value_type, strict=True)]
            listed = pa.ListArray.from_arrays([0, len(docs)], pa.StructArray.from_arrays(fields, fields=list(doc_type.value_type)))
            empty = [pa.array([b""], pa.binary())] * 3 + [pa.array([[]], pa.list_(pa.int64()))] * 2 + [pa.array([b""], pa.binary())] * 2
            yield pa.RecordBatch.from_arrays([pa.array([where], pa.int64()), *empty, listed], [*_block_names(), "docs"])

    return run


def _block_names() -> list[str]:
    return [field.split()[0] for field in BLOCKS.split(", ")]


_MET = f"key long, set_id long, n long, flags int, {_DOCS.replace('set_id long', 'doc_set long')}"


def _reduce(buckets: int):
    """Entries of shared keys, or the documents of the bucket."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < -buckets:
            docs = table.column("docs").combine_chunks().flatten()
            none = pa.nulls(len(docs), pa.int64())
            columns = [none, none, none, pa.nulls(len(docs), pa.int32()), *docs.flatten()]
        else:
            found = Resolved(table)
            none = pa.nulls(len(found.keys), pa.int64())
            columns = [
                pa.array(found.keys.astype(np.int64)),
                pa.array(found.ids[found.owner]),
                pa.array(found.others[found.owner]),
                pa.array(found.flags.astype(np.int32)),
                none, none, none, pa.nulls(len(found.keys), pa.binary()),
            ]
        return pa.table(columns, names=["key", "set_id", "n", "flags", "doc_id", "n_shingles", "doc_set", "sketch"])

    return run


def _hopeful(percent: int):
    """Pairs whose histograms leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            one, other = batch.column("sketch_a"), batch.column("sketch_b")
            both = np.flatnonzero(np.asarray(pc.and_(pc.is_valid(one), pc.is_valid(other)).to_numpy(zero_copy_only=False)))
            for at in range(0, len(both), 20_000):
                rows = pa.array(both[at : at + 20_000])
                a, b = (np.frombuffer(b"".join(c.take(rows).to_pylist()), np.uint8).reshape(len(rows), -1) for c in (one, other))
                most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
                total = a.sum(axis=1, dtype=np.int64) + b.sum(axis=1, dtype=np.int64)
                keep[both[at : at + 20_000]] = 100 * most >= percent * (total - most)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


_GROUP = ["hub", "own", "tile"]
_TILE = (
    "hub long, own long, tile int, tiles int, ids array<long>, sizes array<long>, components array<long>, "
    "known array<boolean>, counts array<int>, keys array<long>, flags array<int>, sketches binary"
)


def _pack_tile(table: pa.Table) -> pa.Table:
    """One row for the sets of a tile: their keys lie one after the other, ``counts`` of them for each set."""
    table = table.combine_chunks()
    sketches = table.column("sketch").to_pylist()
    blank = bytes(SKETCH_BINS)
    entries_ = table.column("entries").combine_chunks()
    flat = entries_.flatten()
    columns = {
        "ids": table.column("set_id").combine_chunks(),
        "sizes": table.column("n").combine_chunks(),
        "components": table.column("component").combine_chunks(),
        "known": pa.array([s is not None for s in sketches]),
        "counts": pc.list_value_length(entries_),
        "keys": flat.field("key"),
        "flags": flat.field("flags"),
    }
    one = {c: table.column(c).slice(0, 1) for c in [*_GROUP, "tiles"]}
    lists = {c: pa.ListArray.from_arrays(np.array([0, len(v)], np.int32), v) for c, v in columns.items()}
    return pa.table(one | lists | {"sketches": pa.array([b"".join(s or blank for s in sketches)], pa.binary())})


class _Side:
    """The sets of one tile, from the columns that end in ``end``."""

    def __init__(self, batch: pa.RecordBatch, row: int, end: str):
        ids, sizes, components, known, counts, keys, flags = (
            batch.column(c + end)[row].values.to_numpy(zero_copy_only=False)
            for c in ("ids", "sizes", "components", "known", "counts", "keys", "flags")
        )
        self.ids, self.sizes, self.components, self.known = ids, sizes, components, known
        self.keys, self.flags, self.owner = keys, flags, np.repeat(np.arange(len(ids)), counts)
        self.sketches = np.frombuffer(batch.column("sketches" + end)[row].as_buffer(), np.uint8).reshape(-1, SKETCH_BINS)

    def having(self, keys: np.ndarray, sets: np.ndarray, bits: int) -> np.ndarray:
        """Which of the sorted ``sets`` have which of the sorted ``keys`` with one of the bits."""
        found = np.zeros((len(sets), len(keys)), np.float32)
        mine = (self.flags & bits > 0) & np.isin(self.owner, sets) & np.isin(self.keys, keys)
        found[np.searchsorted(sets, self.owner[mine]), np.searchsorted(keys, self.keys[mine])] = 1
        return found


def _meeting(one: _Side, other: _Side, keep: np.ndarray) -> np.ndarray:
    """The pairs of ``keep`` that have a key that one side indexes and the other looks up."""
    rows, columns = np.flatnonzero(keep.any(axis=1)), np.flatnonzero(keep.any(axis=0))
    met = np.zeros((len(rows), len(columns)), bool)
    keys = np.intersect1d(one.keys[np.isin(one.owner, rows)], other.keys[np.isin(other.owner, columns)])
    for at in range(0, len(keys), KEYS_AT_ONCE):
        part = keys[at : at + KEYS_AT_ONCE]
        for f, g in (
            (INDEX, PROBE | PROBE_LESS), (INDEX_LESS, PROBE), (PROBE | PROBE_LESS, INDEX), (PROBE, INDEX_LESS)
        ):
            met |= one.having(part, rows, f) @ other.having(part, columns, g).T > 0
    found = np.zeros_like(keep)
    found[np.ix_(rows, columns)] = met
    return keep & found


def _tile_pairs(percent: int):
    """Pairs of two tiles' sets that entries make and sizes, components and histograms allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one, other = _Side(batch, row, ""), _Side(batch, row, "2")
                sizes, sizes2 = one.sizes[:, None], other.sizes[None, :]
                keep = one.components[:, None] != other.components[None, :]
                keep &= 100 * np.minimum(sizes, sizes2) >= percent * np.maximum(sizes, sizes2)
                if batch.column("tile")[row] == batch.column("tile2")[row]:
                    keep = np.triu(keep)
                if not keep.any():
                    continue
                most = np.zeros(keep.shape, np.int32)
                for bin_ in range(SKETCH_BINS):
                    most += np.minimum(one.sketches[:, bin_, None], other.sketches[None, :, bin_])
                known = one.known[:, None] & other.known[None, :]
                keep &= ~known | (100 * most >= percent * (sizes + sizes2 - most))
                i, j = np.nonzero(_meeting(one, other, keep))
                a, b = one.ids[i], other.ids[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def _exact_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text"), words)
            # A repeated doc_id may bring a text of another set.
            right = [len(s) > 0 and set_id(s) == n for s, n in zip(sets, batch.column("set_id").to_pylist(), strict=True)]
            packed = pa.array([s.tobytes() for s in sets], pa.binary())
            whole = pa.RecordBatch.from_arrays([batch.column("set_id"), packed], ["set_id", "shingles"])
            yield whole.filter(pa.array(right, pa.bool_()))

    return run


def _exact(percent: int):
    """Pairs that link, from their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            one, other = batch.column("shingles_a"), batch.column("shingles_b")
            for row in range(batch.num_rows):
                a, b = (np.frombuffer(c[row].as_buffer(), "<u8") for c in (one, other))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep[row] = 100 * shared >= percent * (len(a) + len(b) - shared)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    return run


class _Join:
    """State of one join: documents, sets and the entries of shared keys."""

    def __init__(self, docs: DataFrame, words: int, percent: int):
        self.percent, self.words, self.source = percent, words, docs
        n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # A key for about three words of text at 85 percent, and six bytes a word; a set has as many
        # segments as two linked sets of its size may differ in.
        keys = n_bytes / 15 * (100 - percent) / (100 + percent) * 185 / 15
        buckets = max(1, math.ceil(keys / BUCKET_KEYS))
        met = written(
            docs.mapInArrow(_map(buckets, words, percent), f"{BLOCKS}, docs array<struct<{_struct(_DOCS)}>>")
            .groupBy("bucket")
            .applyInArrow(_reduce(buckets), _MET),
            "jaccard-keys",
        )
        self.documents = met.filter("key IS NULL").select(
            "doc_id", "n_shingles", F.col("doc_set").alias("set_id"), "sketch"
        )
        self.entries = met.filter("key IS NOT NULL").select("key", "set_id", "n", "flags")
        self.sets = written(
            self.documents.filter("set_id IS NOT NULL")
            .groupBy("set_id")
            .agg(F.min("doc_id").alias("doc_id"), F.first("sketch", ignorenulls=True).alias("sketch")),
            "jaccard-distinct",
        )

    def fitting(self, one, other):
        return 100 * F.least(one, other) >= self.percent * F.greatest(one, other)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of set ids that link."""
        sketches = self.sets.select("set_id", "sketch")
        hopeful = written(
            pairs.join(sketches.toDF("a", "sketch_a"), "a")
            .join(sketches.toDF("b", "sketch_b"), "b")
            .mapInArrow(_hopeful(self.percent), "a long, b long"),
            "jaccard-hopeful",
        )
        if hopeful.isEmpty():
            return hopeful
        wanted = hopeful.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        # The text of one document stands for each set.
        chosen = self.sets.join(wanted, "set_id").select("set_id", F.col("doc_id").alias("chosen_id"))
        texts = self.source.join(chosen, F.col("doc_id").eqNullSafe(F.col("chosen_id"))).select("set_id", "text")
        exact = texts.mapInArrow(_exact_sets(self.words), "set_id long, shingles binary")
        exact = written(exact.dropDuplicates(["set_id"]), "jaccard-sets")
        return written(
            hopeful.join(exact.toDF("a", "shingles_a"), "a")
            .join(exact.toDF("b", "shingles_b"), "b")
            .mapInArrow(_exact(self.percent), "a long, b long")
            .distinct(),
            "jaccard-links",
        )

    def links(self) -> DataFrame:
        """Enough links to connect every component.

        First the sets of each key are verified against one of them. While a key's sets are in
        several components, those outside two of them are verified against one set of each;
        this takes as many pairs as there are entries, and stops when it finds nothing new.
        Only then are sets verified against all sets of other components.
        """
        hubs = self.entries.groupBy("key").agg(F.min(F.struct("set_id", "n")).alias("hub"))
        found = self.verified(
            self.entries.join(hubs, "key")
            .filter((F.col("set_id") != F.col("hub.set_id")) & self.fitting(F.col("n"), F.col("hub.n")))
            .select(F.col("hub.set_id").alias("a"), F.col("set_id").alias("b"))
            .distinct()
        )
        placed = self.open_entries(self.entries, found)
        for number in range(ROUNDS):
            order = F.xxhash64("set_id", F.lit(number))
            chosen = F.struct(order.alias("order"), "set_id", "n", "component")
            ends = placed.groupBy("key").agg(
                F.min(F.when(F.col("component") == F.col("least"), chosen)).alias("one"),
                F.min(F.when(F.col("component") == F.col("most"), chosen)).alias("other"),
            )
            pairs = (
                placed.join(ends, "key")
                .select("set_id", "n", "component", F.explode(F.array("one", "other")).alias("hub"))
                .filter(F.col("component") != F.col("hub.component"))
                .filter(self.fitting(F.col("n"), F.col("hub.n")))
                .select(F.least("set_id", "hub.set_id").alias("a"), F.greatest("set_id", "hub.set_id").alias("b"))
                .distinct()
            )
            new = self.verified(pairs)
            if new.isEmpty():
                break
            found = found.unionAll(new)
            placed = self.open_entries(placed.select("key", "set_id", "n", "flags"), found)
        return found.unionAll(self.verified(self.cross_pairs(placed).unionAll(self.crowded_pairs(placed)).distinct()))

    def open_entries(self, entries: DataFrame, links: DataFrame) -> DataFrame:
        """Entries of keys whose sets are in several components, with the key's least and greatest."""
        components = connected_components(links).withColumnRenamed("id", "set_id")
        placed = entries.join(components, "set_id", "left").select(
            "key", "set_id", "n", "flags", F.coalesce("component_id", "set_id").alias("component")
        )
        ends = placed.groupBy("key").agg(
            F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size")
        )
        return written(placed.join(ends.filter("least <> most"), "key"), "jaccard-open")

    def cross_pairs(self, placed: DataFrame) -> DataFrame:
        """Pairs of sets in different components that entries of a key of at most ``CROWDED`` sets make."""
        rows = placed.filter(F.col("size") <= CROWDED)
        strays = rows.filter("component <> least").select(
            "key", *[F.col(c).alias(f"{c}_a") for c in ("set_id", "n", "flags", "component")]
        )
        one, other = F.col("flags_a"), F.col("flags")

        def meets(x, y):
            index_and_probe = (x.bitwiseAND(INDEX) != 0) & (y.bitwiseAND(PROBE | PROBE_LESS) != 0)
            return index_and_probe | ((x.bitwiseAND(INDEX_LESS) != 0) & (y.bitwiseAND(PROBE) != 0))

        return (
            strays.join(rows, "key")
            .filter(F.col("component_a") != F.col("component"))
            .filter(self.fitting(F.col("n_a"), F.col("n")) & (meets(one, other) | meets(other, one)))
            .select(F.least("set_id_a", "set_id").alias("a"), F.greatest("set_id_a", "set_id").alias("b"))
        )

    def crowded_pairs(self, placed: DataFrame) -> DataFrame:
        """The same for larger keys: tiles of sets are compared by their histograms as matrices, and
        only pairs that may link become rows.

        Near copies share many keys. Keys with one smallest set are compared at once, so that a pair is
        looked at once and not under every key it shares; ``own`` is -1 then. Where that would take more
        comparisons, since the keys' sets are mostly different ones, a key stays by itself.
        """
        rows = placed.filter(F.col("size") > CROWDED).groupBy("key", "set_id").agg(
            F.first("n").alias("n"), F.first("component").alias("component"), F.bit_or("flags").alias("flags")
        )
        rows = written(rows, "jaccard-crowded")
        keys = rows.groupBy("key").agg(F.min("set_id").alias("hub"), F.count("*").alias("in_key"))
        by_hub = rows.join(keys, "key").groupBy("hub").agg(
            F.countDistinct("set_id").cast("double").alias("sets"), F.sum("in_key").cast("double").alias("squares")
        )
        own = F.when(F.col("sets") * F.col("sets") <= F.col("squares"), F.lit(-1)).otherwise(F.col("key"))
        dealt = keys.join(by_hub, "hub").select("key", "hub", own.cast("long").alias("own"))
        members = written(
            rows.join(dealt, "key")
            .groupBy("hub", "own", "set_id")
            .agg(F.first("n").alias("n"), F.first("component").alias("component"), F.collect_list(F.struct("key", "flags")).alias("entries")),
            "jaccard-members",
        )
        wide = F.greatest(F.count("*") / TILE_SETS, F.sum(F.size("entries")) / TILE_ENTRIES)
        tiles = members.groupBy("hub", "own").agg(F.ceil(wide).cast("int").alias("tiles"))
        placed_sets = (
            members.join(tiles, ["hub", "own"])
            .withColumn("tile", F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int"))
            .join(self.sets.select("set_id", "sketch"), "set_id")
        )
        packed = written(placed_sets.groupBy(*_GROUP).applyInArrow(_pack_tile, _TILE), "jaccard-tiles")
        # The pairs of a group with many tiles are shared out by its first tile.
        shares = F.ceil(F.col("tiles") / TILES_IN_TASK).cast("int")
        one = packed.withColumn("share", F.pmod("tile", shares)).drop("tiles")
        other = packed.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("tiles")
        joined = ["hub", "own", "share"]
        other = other.select(*joined, *[F.col(c).alias(f"{c}2") for c in other.columns if c not in joined])
        return one.join(other, joined).filter("tile <= tile2").mapInArrow(_tile_pairs(self.percent), "a long, b long")


def _struct(fields: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (field.split() for field in fields.split(", ")))


def similar_documents(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; the component is the smallest doc_id in it."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    join = _Join(rows, words, percent)
    roots = connected_components(join.links()).withColumnRenamed("id", "set_id")
    rooted = join.sets.join(roots, "set_id", "left").select(
        "set_id", "doc_id", F.coalesce("component_id", "set_id").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_set = rooted.join(least, "root").select("set_id", "component_id")
    alone = join.documents.filter("set_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (
        join.documents.filter("set_id IS NOT NULL")
        .join(by_set, "set_id")
        .select("doc_id", "n_shingles", "component_id")
        .unionAll(alone)
    )
