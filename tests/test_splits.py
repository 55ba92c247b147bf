import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seedloom.operators import quota, ranking, sft, splits


def rows_of(spark, counts):
    data, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            data.append((i, f"text {i}", label))
            i += 1
    return spark.createDataFrame(data, "doc_id bigint, text string, label string")


def order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), str(i)))


@pytest.mark.parametrize("leaf_rows", [3, 10_000])
def test_cutoffs_match_sorting(spark, leaf_rows, monkeypatch):
    rows = rows_of(spark, {"hot": 4000, "a": 30, "b": 2})
    keyed = rows.select("label", F.concat_ws(":", F.md5(F.concat(F.lit("9:"), "doc_id")), "doc_id").alias("key"))
    cuts = {"hot": [0, 1700, 4000], "a": [1, 29], "b": [2]}
    got = {(r.label, r.cut): r.cutoff for r in ranking.cutoff_keys(keyed, "label", "key", cuts, leaf_rows).collect()}
    keys = {}
    for row in keyed.collect():
        keys.setdefault(row.label, []).append(row.key)
    want = {
        (label, cut): sorted(keys[label])[n - 1] for label, sizes in cuts.items() for cut, n in enumerate(sizes) if n > 0
    }
    assert got == want


def test_dense_index(spark):
    rows = rows_of(spark, {"hot": 3000, "a": 1}).withColumn("key", F.md5(F.col("doc_id").cast("string")))
    indexed = ranking.dense_index(rows, "label", "key", "idx").collect()
    hot = sorted((r.key, r.idx) for r in indexed if r.label == "hot")
    assert [idx for _, idx in hot] == list(range(3000)) and len(indexed) == 3001


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 400), min_size=1, max_size=6), st.data())
@settings(max_examples=200, deadline=None)
def test_allocation_is_exact_and_close(counts, data):
    total = sum(counts.values())
    size = data.draw(st.integers(0, total))
    share = splits.allocate(counts, size)
    assert sum(share.values()) == size
    assert all(abs(share[label] - size * n / total) < 1 + 1e-9 and share[label] <= n for label, n in counts.items())


def test_sizes_use_double_arithmetic():
    assert splits.part_sizes(10, 0.1 + 0.2) == (6, 4)
    assert splits.part_sizes(5, 0.5) == (2, 3)


def test_seed_priority(spark):
    seed = rows_of(spark, {"x": 11, "y": 4, "z": 2})
    synthetic = rows_of(spark, {"x": 3}).withColumn("doc_id", F.col("doc_id") + 100)
    got = splits.split_seed_priority(synthetic, seed, "doc_id", 5).collect()
    sizes = Counter((r.split, r.label) for r in got)
    want_val = splits.first_part_quota({"x": 11, "y": 4, "z": 2}, 0.5)
    assert sizes[("train", "x")] == 3 and sum(want_val.values()) == 8
    for label, n in want_val.items():
        members = [r.doc_id for r in got if r.label == label and r.source == "seed"]
        assert {r.doc_id for r in got if r.split == "validation" and r.label == label} == set(order(members, 5)[:n])
    assert len(got) == len({r.doc_id for r in got}) == 20


def test_single_and_unstratifiable_seed(spark):
    empty = rows_of(spark, {"x": 1}).limit(0)
    one = splits.split_seed_priority(empty, rows_of(spark, {"x": 1}), "doc_id").collect()
    assert [r.split for r in one] == ["validation"]
    two = splits.split_seed_priority(empty, rows_of(spark, {"NDA": 1, "Employment": 1}), "doc_id").collect()
    assert sorted(r.split for r in two) == ["test", "validation"]


def test_three_way_paths(spark):
    counts = {"x": 60, "y": 30, "z": 10}
    sizes = Counter(r.split for r in splits.split_three_way(rows_of(spark, counts), "doc_id", 0.1, 0.1).collect())
    assert sizes == {"train": 80, "validation": 10, "test": 10}
    # a label with one row: no strata, and the held-out part is halved whatever the ratios
    lone = splits.split_three_way(rows_of(spark, {"x": 20, "y": 1}), "doc_id", 0.1, 0.3).collect()
    assert Counter(r.split for r in lone) == {"train": 12, "validation": 4, "test": 5}
    # strata hold for the first cut only: the held-out rows have labels with one row
    mixed = splits.split_three_way(rows_of(spark, {"x": 16, "y": 2, "z": 2}), "doc_id", 0.1, 0.1).collect()
    assert Counter(r.split for r in mixed) == {"train": 16, "validation": 2, "test": 2}
    with pytest.raises(ValueError):
        splits.split_three_way(rows_of(spark, {"x": 2, "y": 2}), "doc_id", 0.1, 0.1)


def test_execute_split_dispatch(spark):
    rows = rows_of(spark, {"x": 10, "y": 10})
    none = rows.limit(0)
    assert splits.execute_split(none, none, "doc_id") is None
    assert {r.split for r in splits.execute_split(rows, none, "doc_id").collect()} == {"train", "validation", "test"}
    assert {r.split for r in splits.execute_split(none, rows, "doc_id").collect()} == {"validation", "test"}


def test_report_and_chat(spark):
    rows = splits.split_three_way(rows_of(spark, {"ก": 20, 'q"\n': 20}), "doc_id", 0.1, 0.1)
    report = splits.split_report(rows, "r").first()
    assert (report.total_count, report.train_count, report.val_count, report.test_count) == (40, 32, 4, 4)
    assert report.labels == ['q"\n', "ก"] and report.label_distribution["train"] == {"ก": 16, 'q"\n': 16}
    chat = sft.sft_messages(rows, report.labels)
    contents = {r.label: [m.content for m in r.messages] for r in chat.collect()}
    assert contents["ก"][2] == '{"label": "ก"}' and contents['q"\n'][2] == '{"label": "q\\"\\n"}'
    assert contents["ก"][0] == "You are an expert document classifier."
    assert "categories are: q\"\n, ก. Return the result" in contents["ก"][1]
    checked = sft.sft_verify(chat, report.labels)
    assert checked.filter("target_ok").count() == 40
    assert sft.sft_verify(chat, ["ก"]).filter("NOT target_ok").count() == 20


def test_dataset_hash_ignores_order(spark):
    rows = rows_of(spark, {"x": 50, "y": 5})
    first = sft.dataset_hash(rows, ["text", "label"]).first()
    assert first == sft.dataset_hash(rows.orderBy(F.rand(1)).repartition(7), ["text", "label"]).first()
    assert first != sft.dataset_hash(rows.withColumn("label", F.lit("x")), ["text", "label"]).first()


# --- planning -----------------------------------------------------------------------


def test_quota_and_need(spark):
    seed = rows_of(spark, {"a": 3, "b": 1, "c": 2})
    plan = {r.label: r.target for r in quota.quota_plan(seed, 101).collect()}
    assert plan == {"a": 30, "b": 30, "c": 30, "unknown": 11}
    with_unknown = {r.label: r.target for r in quota.quota_plan(rows_of(spark, {"a": 1, "unknown": 2}), 100).collect()}
    assert with_unknown == {"a": 45, "unknown": 10}
    assert {r.label: r.target for r in quota.quota_plan(seed, 101, 0.0).collect()} == {"a": 34, "b": 34, "c": 34}
    with pytest.raises(ValueError):
        quota.quota_plan(seed.limit(0), 10)
    collected = spark.createDataFrame([("a", 30), ("b", 28)], "label string, collected bigint")
    need = {r.label: (r.need, r.n_prompts) for r in quota.quota_need(quota.quota_plan(seed, 101), collected).collect()}
    assert need == {"b": (2, 1), "c": (30, math.ceil(30 / 4 * 1.5)), "unknown": (11, math.ceil(11 / 4 * 1.5))}


def test_requests(spark):
    seed = rows_of(spark, {"hot": 500, "one": 1, "two": 2, "unknown": 4})
    need = spark.createDataFrame(
        [("hot", 25_000), ("one", 40), ("two", 40), ("unknown", 15)], "label string, n_prompts bigint"
    )
    slots = quota.request_slots(need)
    examples = quota.examples_by_label(seed, "doc_id", 1)
    got = quota.fewshot_requests(slots, examples, "t", 1).collect()
    assert sorted(r.request_id for r in got) == list(range(25_095))
    label_of = {r.doc_id: r.label for r in seed.collect()}
    for row in got:
        expected = 0 if row.label == "unknown" else min(3, {"hot": 500, "one": 1, "two": 2}[row.label])
        assert len(set(row.example_ids)) == len(row.examples) == expected
        assert all(label_of[i] == row.label for i in row.example_ids)
        assert row.difficulty in quota.DIFFICULTIES
        pool = quota.FALLBACK_UNKNOWN_RULES if row.label == "unknown" else quota.FALLBACK_RULES
        assert row.diversity_rule in pool
    hot = Counter(i for r in got if r.label == "hot" for i in r.example_ids)
    assert len(hot) == 500 and max(hot.values()) < 3 * min(hot.values())


def test_prompt_text(spark):
    from seedloom.operators import prompts

    rows = spark.createDataFrame(
        [(1, "t", "L", ["e1", "e2"], "easy", "r"), (2, "t", "unknown", [], "hard", "r")],
        "request_id int, task_description string, label string, examples array<string>, difficulty string, diversity_rule string",
    )
    first, second = (r.user_prompt for r in prompts.generation_prompts(rows).orderBy("request_id").collect())
    assert "(DO NOT COPY)]\n\n\n- e1\n\n- e2\n\n\n\nPlease provide EXACTLY 5" in first
    assert first.startswith("Task Description: t\nTarget Category/Label: 'L'\n")
    assert "(DO NOT COPY)]\n\nNo specific examples provided." in second and "'unknown' category" in second
