import random

import numpy as np
import pyarrow as pa

from seedloom.llm import suffix_dedup as S
from seedloom.llm.run_length_index import RunLengthIndex
from tests.llm import brute


def test_index_against_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        length, alphabet = rng.choice([2, 3, 5, 8, 50]), rng.choice([b"ab", bytes(range(256)), b"a"])
        base = bytes(rng.choice(alphabet) for _ in range(150))
        strings = []
        for _ in range(rng.randint(1, 12)):
            at = rng.randint(0, 100)
            strings.append(base[at : at + rng.randint(0, 120)])
        owners = np.array([rng.randint(0, 6) for _ in strings])
        index = RunLengthIndex(strings, owners, length)
        best = {}
        for s, o in zip(strings, owners, strict=True):
            for i in range(len(s) - length + 1):
                best[s[i : i + length]] = min(best.get(s[i : i + length], 99), o)
        for s, found in zip(strings, index.first_owners(), strict=True):
            assert [best[s[i : i + length]] for i in range(len(s) - length + 1)] == found.tolist()
        assert sorted(index.locate(np.arange(index.n)).tolist()) == list(range(index.n))


def test_repetitive_text_has_few_runs():
    strings = [b"abcdefghijklmnopqrstuvwxyz" * 20] * 50
    index = RunLengthIndex(strings, np.arange(50), 50)
    assert len(index.heads) < index.n / 100


def texts():
    rng = random.Random(9)
    words = ["über", "alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "😀", "theta"]
    passage = " ".join(rng.choice(words) for _ in range(30))
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    made += [made[3], made[3], made[5][:40] + passage + made[6], passage, passage[:49], passage[1:] + "x", None, ""]
    made += ["ab" * 3000, "ab" * 200 + "c" + "ab" * 100, "long " + passage * 40]
    return made


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, spans int, content string")
    got = sorted((tuple(r) for r in S.remove_repeats(frame.repartition(3), **options).collect()), key=repr)
    assert got == sorted(brute.repeats(rows, options.get("length", 50)), key=repr)


def test_against_brute_force(spark):
    made = texts()
    check(spark, [(i * 7 % 101, t) for i, t in enumerate(made)])


def test_ties_nulls_and_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT_DOCUMENTS", 3)
    monkeypatch.setattr(S, "BUCKET_ANCHORS", 50)
    monkeypatch.setattr(S, "SHARD_BYTES", 500)
    made = texts()
    rows = [(i, t) for i, t in enumerate(made)] + [(3, made[3]), (44, made[5]), (None, made[3]), (None, made[3])]
    check(spark, rows)


def test_hot_passage_in_different_surroundings(spark, monkeypatch):
    """Segments that reach beyond the passage never fold; no index holds all of an anchor's."""

    class Bounded(RunLengthIndex):
        def __init__(self, strings, owners, length):
            assert sum(map(len, strings)) <= 8_000, "shard too large"
            super().__init__(strings, owners, length)

    monkeypatch.setattr(S, "RunLengthIndex", Bounded)
    monkeypatch.setattr(S, "SHARD_BYTES", 2_000)
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = noise(90)
    rows = [(i, noise(rng.randint(0, 70)) + passage + noise(rng.randint(0, 70))) for i in range(300)]
    rows += [(1000 + i, rows[i * 7][1][5:-5]) for i in range(30)]
    rng.shuffle(rows)
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "")])


def test_index_holds_only_segments_that_share_an_anchor(monkeypatch):
    indexed = []

    class Recorded(RunLengthIndex):
        def __init__(self, strings, owners, length):
            indexed.extend(strings)
            super().__init__(strings, owners, length)

    monkeypatch.setattr(S, "RunLengthIndex", Recorded)
    rows = [(b"a" * 16, 1, b"alone here", 5), (b"b" * 16, 2, b"xcommon", 4), (b"c" * 16, 2, b"commony", 3)]
    rows.append((b"a" * 16, 1, b"alone here", 2))  # the same segment from another slice
    names = ["key", "anchor", "segment", "first"]
    table = pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) | {"shard": [0] * 4})
    marks = S._index_shard(5)(table).to_pylist()
    assert sorted(indexed) == [b"commony", b"xcommon"]
    found = {m["key"][:1]: list(zip(m["starts"], m["stops"], m["firsts"], strict=True)) for m in marks}
    assert found == {b"a": [(0, 10, 2)], b"b": [(0, 5, 4), (1, 7, 3)], b"c": [(0, 7, 3)]}
