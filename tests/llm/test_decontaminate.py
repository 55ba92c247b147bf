import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from seedloom.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(found):
    if len(found) < 5:
        return [tuple(found)] if found else []
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def brute(docs, items, threshold=0.8):
    with_words = [(i, words(t)) for i, t in items if words(t)]
    holders = Counter(s for _, w in with_words for s in set(shingles(w)))
    rarest, best = math.log1p(len(with_words)), {}
    for item_id, item in with_words:
        weights = {s: math.log1p(len(with_words) / holders[s]) for s in shingles(item)}
        for row, (_, text) in enumerate(docs):
            found = words(text)
            for at in range(max(len(found) - len(item), 0) + 1) if found else ():
                window = set(shingles(found[at : at + len(item)]))
                shared = sum(w for s, w in weights.items() if s in window)
                similarity = shared / (sum(weights.values()) + rarest * len(window - set(weights)))
                if similarity >= threshold - 1e-12 and similarity > best.get((row, item_id), (0, 0))[0] + 1e-12:
                    best[row, item_id] = (similarity, at)
    return Counter((docs[row][0], item, at, round(s, 9)) for (row, item), (s, at) in best.items())


def found(spark, docs, items, **options):
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item int")
    benchmark = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, row int")
    rows = D.find_leaks(frame, benchmark, **options).collect()
    return Counter((r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in rows)


def made():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([5, 8, 14, 25, 40, 60])))) for i in range(12)]
    items += [(20, "one two"), (21, ""), (22, None), (23, items[4][1] + " " + " ".join(prose(3)))]
    docs = [(i, " ".join(prose(rng.randint(0, 150)))) for i in range(15)]
    for item_id, text in items[:12]:
        part = text.split()
        shouted = ", ".join(part).upper() + "!!"
        docs.append((100 + item_id, " ".join([*prose(20), shouted, *prose(9)])))
        if len(part) >= 40:
            for at in (0, len(part) // 2, len(part) - 1):
                docs.append((200 + 10 * item_id + at % 10, " ".join([*prose(7), *part[:at], "changed", *part[at + 1 :], *prose(5)])))
            docs.append((400 + item_id, " ".join([*part[: len(part) // 2], "more", *part[len(part) // 2 :]])))
        docs.append((500 + item_id, " ".join(part[: len(part) * 9 // 10])))
    docs += [(900, None), (901, ""), (902, "... !!"), (903, "say one two three"), (904, "one two"), (905, items[2][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = made()
    got, want = found(spark, docs, items), brute(docs, items)
    assert got == want and len(want) > 15 and min(s for *_, s in want) < 0.95


def test_reordered_passages_against_brute_force(spark):
    rng = random.Random(21)
    prose = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate((100, 100, 140, 100))]
    docs = []
    for item_id, text in items:
        part = text.split()
        half, third = len(part) // 2, len(part) // 3
        docs.append((item_id, " ".join([*prose(150), *part[half:], *part[:half], *prose(150)])))
        docs.append((10 + item_id, " ".join([*prose(399), *part[2 * third :], *part[third : 2 * third], *part[:third], *prose(80)])))
        docs.append((20 + item_id, " ".join([*part[half:], *part[:half]])))
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) == 12


def test_rare_half_counts_whatever_the_common_half_says(spark):
    """Unweighted fingerprints of such pairs are often far apart; their similarity is above the threshold."""
    common = [f"c{k}" for k in range(100)]
    items, docs = [], []
    for i in range(120):
        rare = [f"r{i}x{k}" for k in range(100)]
        items.append((i, " ".join(rare + common)))
        docs.append((i, " ".join(rare + rare)))
    got = found(spark, docs, items)
    assert sorted((d, i, at) for d, i, at, _ in got) == [(i, i, 0) for i in range(120)]
    assert found(spark, docs[:2], items) == brute(docs[:2], items)


def test_blocks_of_anchors_and_repeats(spark):
    docs, items = made()
    docs = docs[15:30]
    repeated = docs + [docs[0], docs[0], (None, docs[0][1])]
    assert found(spark, repeated, items, anchors_per_block=7) == brute(repeated, items)


def test_hot_passage(spark):
    _, items = made()
    docs = [(i, f"w{i} " + items[5][1] + f" v{i}") for i in range(400)]
    assert sum(found(spark, docs, items).values()) >= 400


def test_empty_tables(spark):
    docs, items = made()
    assert not found(spark, [], items) and not found(spark, docs, []) and not found(spark, docs, [(1, None)])


def test_blocks_find_everything_within_the_radius(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a, flips = rng.getrandbits(64), rng.randint(0, D.RADIUS)
        b = a
        for bit in rng.sample(range(64), flips):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(pairs, "a long, b long")
    assert frame.filter(D.blocks_agree(frame["a"], frame["b"], D.RADIUS)).count() == len(pairs)
    assert frame.filter(D.blocks_agree(frame["a"], F.bitwise_not("a"), D.RADIUS)).count() == 0
