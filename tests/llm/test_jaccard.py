import random

import numpy as np
import pyarrow as pa
import pytest

from seedloom.llm import jaccard as J
from tests.llm import brute


def near_copies(seed, sizes):
    """Texts with copies around the threshold, shared passages, and texts of few words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    made = [None, "", "  \t\n", "one", "one", "One two", "a b c", "a b c d", "a b c d e"]
    for size in sizes:
        base = [word() for _ in range(size)]
        if size > 30:
            base[5:5] = passage
        made.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, 5):
            copy = list(base)
            for _ in range(max(edits * size // 100, edits if size < 60 else 0)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [word()]
            made.append(" ".join(copy).upper() if edits == 2 else " \n ".join(copy))
    return made


@pytest.mark.parametrize(("words", "percent", "crowded"), [(4, 85, 64), (5, 80, 64), (4, 85, 1)])
def test_against_brute_force(spark, monkeypatch, words, percent, crowded):
    monkeypatch.setattr(J, "CROWDED", crowded)
    monkeypatch.setattr(J, "TILE_SETS", 3 if crowded == 1 else 512)
    monkeypatch.setattr(J, "ROUNDS", 0 if crowded == 1 else 3)
    made = near_copies(words, [6, 9, 14, 25, 45, 70, 120, 300, 900])
    rng = random.Random(1)
    ids = rng.sample(range(10_000), len(made))
    rows = list(zip(ids, made, strict=True))
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, set_id int")
    got = {r[0]: (r[1], r[2]) for r in J.similar_documents(frame.repartition(4), words, percent).collect()}
    assert got == brute.similar(rows, words, percent)


def test_every_pair_meets_under_a_key():
    """Pigeonhole: all linked pairs share a key that one indexes and the other looks up."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 6, 7, 12, 40, 150, 1000):
        sets = []
        for _ in range(12):
            base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            sets.append(base)
            for _ in range(6):
                gone = rng.integers(0, max(1, size // 8) + 1)
                more = rng.integers(0, 1 << 63, rng.integers(0, max(1, size // 12) + 1), dtype=np.uint64)
                copy = np.unique(np.concatenate([rng.permutation(base)[gone:], more]))
                if len(copy):
                    sets.append(copy)
        keys, owner, flags = J.entries(sets, 85)
        at = {}
        for k, o, f in zip(keys.tolist(), owner.tolist(), flags.tolist(), strict=True):
            at.setdefault(k, []).append((o, f))
        met = set()
        for members in at.values():
            for a, f in members:
                for b, g in members:
                    if a != b and (f & 1 and g & 10 or f & 4 and g & 2):
                        met.add((min(a, b), max(a, b)))
        for i, a in enumerate(sets):
            for j in range(i):
                shared = len(np.intersect1d(a, sets[j]))
                if 100 * shared >= 85 * (len(a) + len(sets[j]) - shared) and (len(a) != shared or len(sets[j]) != shared):
                    assert (j, i) in met


def test_costly_segments_are_made_up_for():
    """Sets that share most subsets with others of the slice skip them and use deletions."""
    rng = np.random.default_rng(2)
    common = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for _ in range(20)]
    _, _, flags = J.entries(sets, 85)
    assert (flags & J.PROBE_LESS).any() and (flags == J.INDEX).any()


def test_slices_that_start_alike_spread_over_buckets():
    """A hot set at the start of every slice, or wordless texts there, fill no bucket with all slices."""
    hot = [" ".join(f"w{k}" for k in range(n)) for n in (60, 61)]
    for start in (hot, [""] + hot):
        batches = [
            pa.RecordBatch.from_pydict({"doc_id": [10 * i + k for k in range(len(start) + 1)], "text": [*start, f"one more text {i}"]})
            for i in range(32)
        ]
        runs = [[b.column("bucket").to_pylist() for b in J._map(8, 4, 85)(iter(batches))] for _ in range(2)]
        where = [b for found in runs[0] for b in found]
        assert runs[0] == runs[1]
        for low, high in ((-16, -9), (-8, -1)):  # documents; keys that a slice shares
            count = [where.count(b) for b in range(low, high + 1)]
            assert count == [4] * 8


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (3, "A b C d E"), (4, "x"), (4, "y z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, J.similar_documents(frame).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (3, 2, 1), (4, 1, 4), (4, 1, 4)], key=repr)
    assert J.similar_documents(frame.limit(0)).count() == 0
    assert J.similar_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 2


def test_pairs_of_crowded_keys_are_made_once(spark, monkeypatch):
    """Near copies that share many keys are one pair each, not one for every key they share."""
    monkeypatch.setattr(J, "CROWDED", 8)
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    rows = []
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(600), 3):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    join = J._Join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)
    placed = join.open_entries(join.entries, spark.createDataFrame([], "a long, b long"))
    pairs = join.crowded_pairs(placed)
    found = pairs.distinct().count()
    assert found == 40 * 39 // 2
    assert pairs.count() <= 3 * found
