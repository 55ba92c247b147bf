import json
import random

import pytest
from pyspark.sql import functions as F

from seedloom.sources import ranges, reports, sinks
from seedloom.sources import seed as seeds
from workload import queries


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "8"}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def values():
    rng = random.Random(4)
    odd = ['a "quoted" }{][', "\\", '\\"', "}", "{[", "plain", "ü}é", "line\nbreak", "", '"', "[1, 2]", "},{"]
    rows = []
    for i in range(120):
        kind = rng.random()
        if kind < 0.15:
            rows.append(rng.choice([1, None, "x}", [1, {"a": "]"}], True, []]))
        else:
            rows.append({"text": rng.choice(odd) + str(i), "label": rng.choice(odd), "deep": {"x": [{"y": rng.choice(odd)}]}})
    return rows


@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_in_ranges(spark, small_splits, tmp_path, indent):
    path = str(tmp_path / "a.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(values(), file, ensure_ascii=False, indent=indent)
    assert ranges.pieces(spark, path, "}").rdd.getNumPartitions() > 5
    rows = seeds.read_seed_json(spark, path).withColumn("keys", F.map_keys("raw"))
    got = rows.orderBy("row_idx").collect()
    assert [r.row_idx for r in got] == list(range(len(values())))
    for row, value in zip(got, values(), strict=True):
        assert row.is_object == isinstance(value, dict) and row.defect is None
        if row.is_object:
            assert row["keys"] == ["text", "label", "deep"] and row.raw["text"] == value["text"]
            assert json.loads(row.raw["deep"]) == value["deep"]


def test_odd_json_files(spark, small_splits, tmp_path):
    cases = {
        '{"text": "a", "x": {"y": 1}}': [(True, None)],
        ' [ ] \n': [],
        "[1, 2]": [(False, None)] * 2,
        '[{"text": "a"}, {"text": "b"}': [(True, None), (True, "malformed")],
        '[{"text": "a"}, {"text" "b"}, {"text": "c"}]\n': [(True, None), (True, "malformed"), (True, None)],
        '"only text"': [(False, None)],
    }
    for number, (text, want) in enumerate(cases.items()):
        path = str(tmp_path / f"{number}.json")
        with open(path, "w", encoding="utf-8") as file:
            file.write(text)
        got = seeds.read_seed_json(spark, path, mode="quarantine").orderBy("row_idx").collect()
        shown = [(r.is_object or (r.raw is not None), r.defect) for r in got]
        if want and want[-1][1] == "malformed":
            assert [d for _, d in shown] == [d for _, d in want], text
        else:
            assert shown == want, text


def test_several_files_are_read_in_order(spark, small_splits, tmp_path):
    for name, first in (("b.json", 40), ("a.json", 0)):
        with open(tmp_path / name, "w", encoding="utf-8") as file:
            json.dump([{"text": f"row {first + k}", "label": "x"} for k in range(40)], file)
    got = seeds.read_seed_json(spark, str(tmp_path / "*.json")).orderBy("row_idx").collect()
    assert [r.raw["text"] for r in got] == [f"row {k}" for k in range(80)]


def test_prediction_lines_are_numbered_over_splits_and_files(spark, small_splits, tmp_path):
    lines = [json.dumps({"messages": [{"role": "user", "content": f"line {k}"}]}) if k % 7 else "" for k in range(400)]
    for name, part in (("b.jsonl", lines[250:]), ("a.jsonl", lines[:250])):
        (tmp_path / name).write_text("\n".join(part) + "\n")
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    got = reports.read_predictions(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [(r.row_idx, r.messages[0].content) for r in got] == list(enumerate(f"line {k}" for k in range(400) if k % 7))


@pytest.mark.parametrize("odd", ["plain", 'say ""x"", so', 'two\nlines, ""quoted""'])
def test_trials_of_whole_lines_are_read_in_ranges(spark, small_splits, tmp_path, odd):
    path = str(tmp_path / "trials_results.csv")
    with open(path, "w", encoding="utf-8") as file:
        file.write("number,note,value\n" + "".join(f'{k},"{odd}",{k}.5\n' for k in range(500)))
    rows = reports.read_trials(spark, [path], "r")
    assert rows.columns == ["run_id", "row_idx", "number", "note", "value"]
    splits = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert splits == 1 if "\n" in odd else splits > 3
    got = [tuple(r) for r in rows.orderBy("row_idx").collect()]
    assert got == [("r", k, str(k), odd.replace('""', '"'), f"{k}.5") for k in range(500)]


def test_json_arrays_of_several_tasks_are_read_in_order(spark, small_splits, tmp_path):
    path = str(tmp_path / "arrays")
    rows = spark.range(300).select(F.concat(F.lit('a "} ] '), "id").alias("text"), "id")
    sinks.write_json_arrays(rows.repartitionByRange(6, "id").sortWithinPartitions("id"), path)
    parts = sorted((tmp_path / "arrays").glob("part-*"))
    assert len(parts) == 6
    assert [v["id"] for part in parts for v in json.loads(part.read_text())] == list(range(300))
    got = seeds.read_seed_json(spark, path).orderBy("row_idx").collect()
    assert [(r.row_idx, r.raw["id"]) for r in got] == [(k, str(k)) for k in range(300)]
    sinks.write_json_arrays(rows.limit(0), path)
    assert seeds.read_seed_json(spark, path).count() == 0


def test_round_trips_write_in_several_tasks(spark, monkeypatch, tmp_path):
    """Sorted rows do not pass through one task on their way to a file."""
    spark.range(60).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200).alias("text"), F.lit("s").alias("source"),
        F.col("id").alias("o_orderkey"), F.lit("p").alias("o_orderpriority"), F.lit(1.5).alias("o_totalprice"),
    ).write.parquet(str(tmp_path / "documents.parquet"))
    (tmp_path / "orders.parquet").symlink_to(tmp_path / "documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name in ("json_array_round_trip", "predictions_round_trip", "trials_csv_round_trip"):
            monkeypatch.setattr(queries, "_scratch", lambda _, name=name: str(tmp_path / name))
            assert queries.QUERIES[name](spark, str(tmp_path)).count() == 60
            assert len(list((tmp_path / name).glob("part-*"))) > 2, name
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
