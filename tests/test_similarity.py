import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedloom.functions import shingles
from seedloom.operators import acceptance, near_copies, similarity, tiles

WORDS = [f"w{i:03d}" for i in range(400)]


def sentence(rng, n=60):
    return " ".join(rng.choices(WORDS, k=n))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


def grams(text):
    clean = "".join(ch for ch in text if ch.isascii() and ch.isalnum() or "ก" <= ch <= "๙").lower()
    if len(clean) < 5:
        return {clean} if clean else set()
    return {clean[i : i + 5] for i in range(len(clean) - 4)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def corpus():
    """Near copies around several bases, one of them a third of all rows, and loners."""
    rng = random.Random(11)
    hot = sentence(rng)
    rows = [edited(rng, hot, rng.choice([0, 0, 1, 2, 6])) for _ in range(100)]
    for _ in range(30):
        base = sentence(rng)
        rows += [base] + [edited(rng, base, rng.choice([0, 1, 1, 3, 8])) for _ in range(4)]
    rows += [sentence(rng) for _ in range(45)] + ["!!!", "", "ab", "AB", "é ab", "ก" * 9]
    rng.shuffle(rows)
    return rows


def test_shingle_codes_are_exact():
    rng = random.Random(2)
    for text in corpus()[:60] + ["", "a", "ABCD", "abcde", "กขคงจ ABC", "".join(map(chr, range(3000, 4000)))]:
        assert len(shingles.shingle_codes(text)) == len(grams(text))
    for _ in range(200):
        a, b = sentence(rng, 8), sentence(rng, 8)
        assert shingles.jaccard_of(shingles.shingle_codes(a), shingles.shingle_codes(b)) == pytest.approx(jaccard(grams(a), grams(b)))


def test_signature_estimates_jaccard():
    rng = random.Random(4)
    errors = []
    for _ in range(150):
        a = sentence(rng)
        b = edited(rng, a, rng.randint(0, 10))
        left, right = shingles.shingle_codes(a), shingles.shingle_codes(b)
        agree = (shingles.signature(left) == shingles.signature(right)).mean()
        errors.append(agree - jaccard(grams(a), grams(b)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.8, 0.9])
def test_near_duplicates_match_brute_force(spark, threshold):
    texts = corpus()
    sets = [grams(text) for text in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {r.id: r for r in similarity.near_duplicates(df, "id", "text", threshold=threshold).collect()}
    assert len(got) == len(texts)
    for i, own in enumerate(sets):
        earlier = [j for j in range(i) if jaccard(own, sets[j]) >= threshold]
        expected = "no_signal" if not own else "near_dup" if earlier else "unique"
        assert got[i].status == expected, (i, texts[i])
        assert got[i].dup_of == min(earlier, default=None)
        if earlier:
            assert got[i].similarity == pytest.approx(jaccard(own, sets[min(earlier)]))


@pytest.mark.parametrize(("crowded", "proposals", "keys"), [(3, 1, 200), (4096, 1, 50), (0, 8, 600_000)])
def test_near_duplicates_in_rounds_and_under_crowded_keys(spark, monkeypatch, crowded, proposals, keys):
    monkeypatch.setattr(near_copies, "CROWDED", crowded)
    monkeypatch.setattr(near_copies, "PROPOSALS", proposals)
    monkeypatch.setattr(near_copies, "KEYS_PER_BUCKET", keys)
    test_near_duplicates_match_brute_force(spark, 0.7)
    test_near_duplicates_of_an_index(spark)


@pytest.mark.parametrize(("threshold", "words"), [(0.7, 2_000_000), (0.9, 2_000_000), (0.7, 600)])
def test_what_near_copies_send(spark, monkeypatch, threshold, words):
    """Bitmaps of a table of several tiles are less than its packed sets, however many keys sets have."""
    rng = random.Random(6)
    texts = [sentence(rng, n) for n in (40, 90, 200, 450) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    sets = df.select("id", shingles.sketch("text").alias("s")).select("id", "s.*").cache()
    sent, pack = [], near_copies._packed
    monkeypatch.setattr(near_copies, "KEYS_PER_BUCKET", words)
    monkeypatch.setattr(near_copies, "_packed", lambda *args: sent.append(pack(*args)) or sent[-1])
    whole = sets.withColumn("above", F.lit(near_copies._LOWEST))
    near_copies.candidates(whole, None, threshold, 2, True).collect()
    n_bytes = sent[0].agg(F.sum(F.octet_length("bits") + F.octet_length("facts"))).first()[0]
    n_codes = sets.agg(F.sum(F.octet_length("codes"))).first()[0]
    assert n_bytes < (0.5 if words > 600 else 4) * n_codes


def test_tiles_meet_wherever_sizes_can_match(spark):
    sizes = [*range(1, 60), *range(60, 4000, 37)]
    sets = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "id bigint, n_shingles bigint")
    for threshold in (0.5, 0.7, 0.9, 1.0):
        planned = near_copies.plan_tiles(sets, threshold)
        met = {(planned.ranges()[x], planned.ranges()[y]) for x, y in near_copies.meeting(planned, None, threshold)}
        where = np.searchsorted(planned.least, sizes, side="right") - 1
        for i, n in enumerate(sizes):
            for j, m in enumerate(sizes):
                if n <= m and n >= threshold * m:
                    assert (where[i], where[j]) in met or (where[j], where[i]) in met


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "abcdefgh"), (1, "abcdefgh"), (3, None), (4, "y" * 200_000 + "z"), (5, "y" * 9 + "z"), (6, "ABCDEFGH")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "id bigint, text string, digest string, codes int")
    got = sorted((r.id, r.status, r.dup_of) for r in similarity.near_duplicates(df, "id", "text").collect())
    assert got == [
        (1, "unique", None), (1, "unique", None), (3, "no_signal", None),
        (4, "unique", None), (5, "near_dup", 4), (6, "near_dup", 1),
    ]
    assert similarity.near_duplicates(df.limit(0), "id", "text").count() == 0
    assert similarity.near_duplicates(df, "id", "text", index=df.limit(0)).filter("status = 'near_dup'").count() == 0


def test_near_duplicates_of_an_index(spark):
    texts = corpus()
    rows, index = texts[::2], texts[1::2]
    rows_df = spark.createDataFrame(list(enumerate(rows)), "id bigint, text string")
    index_df = spark.createDataFrame(list(enumerate(index)), "id bigint, text string")
    got = {r.id: r for r in similarity.near_duplicates(rows_df, "id", "text", index=index_df).collect()}
    sets = [grams(text) for text in index]
    for i, text in enumerate(rows):
        hits = [j for j, other in enumerate(sets) if jaccard(grams(text), other) >= 0.9]
        expected = "no_signal" if not grams(text) else "near_dup" if hits else "unique"
        assert got[i].status == expected
        assert got[i].dup_of == min(hits, default=None)


@pytest.mark.parametrize("earlier", [False, True])
def test_best_first_search_asks_few_cells(spark, monkeypatch, earlier):
    rng = np.random.default_rng(5)
    vectors = unit(rng, 400, d=16, clusters=12, noise=0.03)
    vectors[7] *= 3  # not of unit length: asks everywhere
    asks = []
    ask = tiles.ask_cells

    def counted(*args):
        asked = ask(*args)
        asks.append(asked.count())
        return asked

    monkeypatch.setattr(tiles, "ask_cells", counted)
    frame = vector_frame(spark, vectors)
    got = {r.seq: r.max_similarity for r in similarity.top_similarity(frame, frame, earlier, tile_rows=20).collect()}
    dots = vectors.astype(float) @ vectors.astype(float).T
    for i in range(len(vectors)):
        seen = dots[i, :i] if earlier else dots[i]
        assert got[i] == (pytest.approx(seen.max(), abs=1e-9) if len(seen) else None)
    assert len(asks) > 1 and sum(asks) < 0.6 * 20 * len(vectors)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_tiles_grow_with_the_table(spark, kind):
    vectors = unit(np.random.default_rng(8), 3000, d=4)
    frame = vector_frame(spark, vectors).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    packed = tiles.pack(frame, 10)
    assert packed.frame.count() <= 3 * tiles.PIVOTS  # not one for every ten rows
    bits = packed.frame.agg(F.sum(F.octet_length("data"))).first()[0]
    assert bits == 3000 * 4 * (4 if kind == "float" else 8)
    got = {r.seq: r.first for r in similarity.first_similar(frame, threshold=0.95, tile_rows=10).collect()}
    alike = np.tril(vectors.astype(float) @ vectors.astype(float).T >= 0.95, -1)
    assert got == {i: int(row.argmax()) for i, row in enumerate(alike) if row.any()}


def test_exact_copies(spark):
    seed = spark.createDataFrame([("a",), ("b",)], "text string")
    rows = spark.createDataFrame([(5, "c"), (3, "c"), (1, "a"), (9, "d")], "seq bigint, text string")
    got = {r.seq: r.is_copy for r in similarity.seed_copies(rows, seed).collect()}
    assert got == {5: False, 3: False, 1: True, 9: False}


def test_first_accepted_copy_wins(spark):
    rows = [
        (0, "x", "low_score", "c"), (1, "x", None, "c"), (2, "x", None, "c"), (3, "x", None, "a"),
        (4, "full", None, "d"), (5, "x", None, "d"), (6, "y", None, "d"), (7, "x", "judge_parse", "c"),
    ]
    df = spark.createDataFrame(rows, "seq bigint, label string, gate string, cleaned_text string")
    seed = spark.createDataFrame([("a",), ("b",)], "cleaned_text string")
    quota = {"x": 9, "y": 9, "full": 0}
    decided, progress = acceptance.greedy_accept(df, quota, 9, seed_texts=seed, exact_guard=True, window=3)
    assert {r.seq: r.reason for r in decided.collect()} == {
        0: "low_score", 1: None, 2: "exact_duplicate", 3: "exact_duplicate",
        4: "quota_full", 5: None, 6: "exact_duplicate", 7: "judge_parse",
    }
    assert progress.counts == {"x": 2}


def unit(rng, n, d=8, clusters=12, noise=0.25):
    centres = rng.normal(size=(clusters, d))
    vectors = centres[rng.integers(0, clusters, n)] + noise * rng.normal(size=(n, d))
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def vector_frame(spark, vectors, start=0):
    rows = [(start + i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "seq bigint, embedding array<float>")


@pytest.mark.parametrize("tile_rows", [10**9, 40])
def test_top_similarity(spark, tile_rows):
    rng = np.random.default_rng(1)
    own, index = unit(rng, 90), unit(rng, 130)
    got = similarity.top_similarity(vector_frame(spark, own), vector_frame(spark, index), tile_rows=tile_rows)
    best = (own.astype(float) @ index.astype(float).T).max(axis=1)
    assert [r.max_similarity for r in got.orderBy("seq").collect()] == pytest.approx(list(best))
    rows = vector_frame(spark, own)
    earlier = similarity.top_similarity(rows, rows, earlier_only=True, tile_rows=tile_rows).orderBy("seq").collect()
    near = similarity.top_similarity(vector_frame(spark, own), vector_frame(spark, index), at_least=0.8, tile_rows=tile_rows)
    assert {r.seq: r.max_similarity for r in near.collect()} == {
        i: pytest.approx(b) if b >= 0.8 else None for i, b in enumerate(best)
    }
    dots = own.astype(float) @ own.astype(float).T
    assert earlier[0].max_similarity is None
    assert [r.max_similarity for r in earlier[1:]] == pytest.approx([dots[i, :i].max() for i in range(1, 90)])


def test_empty_index_and_inclusive_threshold(spark):
    rows = vector_frame(spark, np.eye(2, dtype=np.float32))
    assert not any(r.is_redundant for r in similarity.semantic_redundant(rows, rows.limit(0)).collect())
    index = spark.createDataFrame([(0, [0.85, 0.0])], "seq bigint, embedding array<double>")
    probe = spark.createDataFrame([(1, [1.0, 0.0])], "seq bigint, embedding array<double>")
    assert similarity.semantic_redundant(probe, index).first().is_redundant


# --- greedy acceptance --------------------------------------------------------------


def sequential(rows, quota, target, seeds, threshold, collected=None, texts=None, seed_sets=()):
    """The loop the distributed form must equal."""
    counts, index, sets, out, stopped = dict(collected or {}), list(seeds), list(seed_sets), {}, False
    for seq, label, gate, vector in rows:
        if stopped or sum(counts.values()) >= target:
            out[seq] = ("target_reached", None)
            stopped = True
            continue
        if counts.get(label, 0) >= quota.get(label, 0):
            out[seq] = ("quota_full", None)
            continue
        if gate:
            out[seq] = (gate, None)
            continue
        best = max((float(np.dot(vector.astype(float), other)) for other in index), default=None)
        own = grams(texts[seq]) if texts else None
        copy = texts and any(jaccard(own, other) >= 0.9 for other in sets)
        if copy or (best is not None and best >= threshold):
            out[seq] = ("redundant", best)
            continue
        out[seq] = (None, best)
        counts[label] = counts.get(label, 0) + 1
        index.append(vector.astype(float))
        sets.append(own)
    return out


@pytest.mark.parametrize("case", range(6))
def test_greedy_equals_sequential_loop(spark, case):
    rng = np.random.default_rng(case)
    n = 260
    vectors = unit(rng, n, clusters=6 if case % 2 else 60)
    labels = rng.choice(["a", "b", "c", "unlisted"], n, p=[0.6, 0.2, 0.15, 0.05])
    gates = rng.choice(["", "invalid_text", "low_score", "judge_parse"], n, p=[0.7, 0.1, 0.1, 0.1])
    quota = {"a": int(rng.integers(1, 40)), "b": int(rng.integers(0, 10)), "c": 5}
    target = int(rng.integers(5, 45))
    collected = {"a": 2} if case in (2, 3) else None
    seeds = unit(rng, 3) if case >= 3 else np.zeros((0, 8))
    rows = [(i, str(labels[i]), str(gates[i]) or None, vectors[i]) for i in range(n)]
    df = spark.createDataFrame(
        [(i, label, gate, [float(x) for x in v]) for i, label, gate, v in rows],
        "seq bigint, label string, gate string, embedding array<float>",
    ).repartition(3)
    seed_df = vector_frame(spark, seeds.astype(np.float32)) if len(seeds) else None
    decided, progress = acceptance.greedy_accept(df, quota, target, seed_df, 0.85, window=16, collected=collected)
    want = sequential(rows, quota, target, [s.astype(np.float32).astype(float) for s in seeds], 0.85, collected)
    got = {r.seq: r for r in decided.collect()}
    assert len(got) == n
    for seq, (reason, best) in want.items():
        row = got[seq]
        assert row.reason == reason and row.status == ("accepted" if reason is None else "rejected"), (seq, row, reason)
        if reason in (None, "redundant") and best is not None:
            assert row.max_similarity == pytest.approx(best, abs=1e-6)
        else:
            assert row.max_similarity is None
    taken = {seq for seq, (reason, _) in want.items() if reason is None}
    assert {seq for seq, row in got.items() if row.status == "accepted"} == taken
    assert sum(progress.counts.values()) == len(taken) + sum((collected or {}).values())


@pytest.mark.parametrize(("case", "window"), [(1, 100_000), (2, 60), (3, 100_000)])
def test_parallel_rounds_equal_sequential_loop(spark, monkeypatch, case, window):
    """Hardly a row is left to be decided in order; cut labels free rows again."""
    monkeypatch.setattr(acceptance, "LAST_ROWS", 2)
    decide = acceptance.greedy_accept
    logs = []

    def with_window(*args, **named):
        decided, progress = decide(*args, **{**named, "window": window})
        logs.extend(progress.rounds)
        return decided, progress

    monkeypatch.setattr(acceptance, "greedy_accept", with_window)
    test_greedy_equals_sequential_loop(spark, case)
    assert any(n > 2 and 0 < taken < n for n, taken in logs)


def test_cut_label_frees_rows(spark, monkeypatch):
    """Row 2 is full, so what it held (4, which held 5) is decided anew."""
    monkeypatch.setattr(acceptance, "LAST_ROWS", 0)
    corner = np.eye(8)
    mix = lambda *parts: sum(parts) / np.linalg.norm(sum(parts))
    vectors = [corner[0], corner[1], corner[2], corner[3], mix(3 * corner[2], corner[4]), mix(3 * corner[2], 2 * corner[4])]
    labels = ["a", "a", "a", "b", "b", "b"]
    df = spark.createDataFrame(
        [(i, label, None, [float(x) for x in v]) for i, (label, v) in enumerate(zip(labels, vectors))],
        "seq bigint, label string, gate string, embedding array<float>",
    )
    decided, progress = acceptance.greedy_accept(df, {"a": 2, "b": 9}, 9, None, 0.85)
    assert {r.seq: r.reason for r in decided.collect()} == {
        0: None, 1: None, 2: "quota_full", 3: None, 4: None, 5: "redundant",
    }
    assert progress.cut == {"a": 1}


def test_near_copies_and_equal_texts_in_parallel_rounds(spark, monkeypatch):
    monkeypatch.setattr(acceptance, "LAST_ROWS", 2)
    test_greedy_with_near_copy_check(spark)
    test_first_accepted_copy_wins(spark)


def test_seed_index_of_several_tiles(spark, monkeypatch):
    """Seeds spread over tiles by numbers of their own, however many there are."""
    monkeypatch.setattr(acceptance, "top_similarity", lambda *a, **k: similarity.top_similarity(*a, **k, tile_rows=20))
    rng = np.random.default_rng(2)
    vectors, seeds = unit(rng, 120, clusters=40), unit(rng, 150, clusters=40)
    df = vector_frame(spark, vectors).withColumns({"label": F.lit("a"), "gate": F.lit(None).cast("string")})
    decided, _ = acceptance.greedy_accept(df, {"a": 50}, 50, vector_frame(spark, seeds), 0.85, window=30)
    want = sequential(
        [(i, "a", None, v) for i, v in enumerate(vectors)], {"a": 50}, 50, [s.astype(float) for s in seeds], 0.85
    )
    assert {r.seq: r.reason for r in decided.collect()} == {seq: reason for seq, (reason, _) in want.items()}


def test_hot_group_of_copies_takes_one_pass(spark):
    rng = np.random.default_rng(0)
    vectors = unit(rng, 600, d=64, clusters=600)
    vectors[::2] = vectors[0]
    df = vector_frame(spark, vectors).withColumns({"label": F.lit("a"), "gate": F.lit(None).cast("string")})
    decided, progress = acceptance.greedy_accept(df, {"a": 1000}, 1000, None, 0.85, window=100)
    want = sequential([(i, "a", None, v) for i, v in enumerate(vectors)], {"a": 1000}, 1000, [], 0.85)
    taken = {r.seq for r in decided.filter("status = 'accepted'").collect()}
    assert taken == {seq for seq, (reason, _) in want.items() if reason is None}
    assert progress.counts == {"a": len(taken)}


def test_greedy_with_near_copy_check(spark):
    rng = random.Random(8)
    base = sentence(rng)
    texts = [edited(rng, base, rng.choice([0, 1, 8])) if rng.random() < 0.4 else sentence(rng) for _ in range(60)]
    vectors = unit(np.random.default_rng(3), 60, d=64, clusters=60)
    df = spark.createDataFrame(
        [(i, "a", None, text, [float(x) for x in v]) for i, (text, v) in enumerate(zip(texts, vectors))],
        "seq bigint, label string, gate string, cleaned_text string, embedding array<float>",
    )
    seed_texts = spark.createDataFrame([(texts[7],)], "cleaned_text string")
    decided, _ = acceptance.greedy_accept(
        df, {"a": 100}, 100, None, 0.85, window=9, use_minhash=True, seed_texts=seed_texts
    )
    rows = [(i, "a", None, v) for i, v in enumerate(vectors)]
    want = sequential(rows, {"a": 100}, 100, [], 0.85, texts=texts, seed_sets=[grams(texts[7])])
    assert {r.seq: r.reason for r in decided.collect()} == {seq: reason for seq, (reason, _) in want.items()}


def test_loops_share_index_and_counts(spark):
    rng = np.random.default_rng(9)
    vectors = unit(rng, 90, clusters=20)
    df = vector_frame(spark, vectors).withColumns({"label": F.lit("a"), "gate": F.lit(None).cast("string")})
    batches = [df.filter(F.col("seq").between(30 * k, 30 * k + 29)) for k in range(3)]
    decided = acceptance.accept_in_loops(batches, {"a": 15}, 15, None, 0.85, window=8)
    want = sequential([(i, "a", None, v) for i, v in enumerate(vectors)], {"a": 15}, 15, [], 0.85)
    accepted = {r.seq for r in decided.filter("status = 'accepted'").collect()}
    assert accepted == {seq for seq, (reason, _) in want.items() if reason is None}
    progress = acceptance.loop_progress(decided).orderBy("loop").collect()
    assert progress[-1].collected == len(accepted)


def test_batches_behind_the_limit_are_in_the_ledger(spark):
    vectors = np.eye(25, dtype=np.float32)
    df = vector_frame(spark, vectors).withColumns({"label": F.lit("a"), "gate": F.lit(None).cast("string")})
    batches = [df.filter(F.col("seq") == k) for k in range(25)]
    decided = acceptance.accept_in_loops(batches, {"a": 30}, 30, None, 0.85, max_loops=3)
    got = {r.seq: (r.loop, r.reason) for r in decided.collect()}
    assert got == {k: (k + 1, None if k < 3 else "not_reached") for k in range(25)}
    assert acceptance.MAX_LOOPS == 20


def test_only_sets_of_candidate_pairs_are_sent_whole(spark):
    rng = random.Random(8)
    texts = [sentence(rng) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    plain = similarity.sketched(df, "id", "text", 0.9)
    asked = spark.createDataFrame([(7,), (7,), (200,)], "id bigint")
    codes = similarity.codes_of(asked, (similarity._distinct_sets(plain), plain))
    assert sorted(row.id for row in codes.collect()) == [7, 200]


def test_pairs_of_tiles_take_turns():
    tiles = near_copies.Tiles([1, 50], [49, 90], [3, 2], [4, 4], [300, 200])
    pairs = near_copies.meeting(tiles, None, 0.5)
    whole = near_copies._turns(pairs, tiles, tiles)
    assert whole == [pairs]
    one_tile = 8 * 100
    near_copies.SENT_AT_ONCE, before = 3 * one_tile, near_copies.SENT_AT_ONCE
    near_copies.SENT_TIMES, times = 0, near_copies.SENT_TIMES
    try:
        turns = near_copies._turns(pairs, tiles, tiles)
    finally:
        near_copies.SENT_AT_ONCE, near_copies.SENT_TIMES = before, times
    assert sum(turns, []) == pairs and {len(turn) for turn in turns} == {1}


def test_near_duplicates_in_turns(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "KEYS_PER_BUCKET", 400)
    monkeypatch.setattr(near_copies, "SENT_AT_ONCE", 20_000)
    monkeypatch.setattr(near_copies, "SENT_TIMES", 0)
    test_near_duplicates_match_brute_force(spark, 0.7)


def test_greedy_reads_texts_once(spark, monkeypatch):
    """Rounds compare digests and bitmaps; no table between them holds a text."""
    kept, cut = [], acceptance.cut_lineage
    monkeypatch.setattr(acceptance, "cut_lineage", lambda df: kept.append(df.columns) or cut(df))
    monkeypatch.setattr(acceptance, "LAST_ROWS", 2)
    texts = corpus()[:60]
    df = spark.createDataFrame([(i, "a", None, t) for i, t in enumerate(texts)], "seq bigint, label string, gate string, cleaned_text string")
    decided, _ = acceptance.greedy_accept(df, {"a": 60}, 60, use_minhash=True, seed_texts=df.limit(0))
    accepted = []
    for i, text in enumerate(texts):
        if all(jaccard(grams(text), grams(texts[j])) < 0.9 for j in accepted):
            accepted.append(i)
    assert sorted(r.seq for r in decided.filter("status = 'accepted'").collect()) == accepted
    assert kept and not any("cleaned_text" in columns for columns in kept)
