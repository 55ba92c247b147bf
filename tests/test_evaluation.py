import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seedloom.operators import evaluation, trials
from seedloom.plans import evaluation as evaluation_job
from seedloom.plans import tuning
from seedloom.sources import reports


def pair_frame(spark, pairs):
    return spark.createDataFrame(pairs, "gt string, pred string")


def expected_metrics(pairs):
    labels = sorted({g for g, _ in pairs} | {p for _, p in pairs})
    out = {}
    for label in labels:
        tp = sum(g == p == label for g, p in pairs)
        support, predicted = sum(g == label for g, _ in pairs), sum(p == label for _, p in pairs)
        out[label] = (tp / predicted if predicted else 0.0, tp / support if support else 0.0, 2 * tp / (support + predicted), support)
    return out


def test_metrics(spark):
    rng = random.Random(1)
    pairs = [(rng.choice("abc"), rng.choice("abcz")) for _ in range(400)]
    counts = evaluation.pair_counts(pair_frame(spark, pairs))
    want = expected_metrics(pairs)
    got = {r.label: r for r in evaluation.label_metrics(counts).collect()}
    assert set(got) == set("abc")
    for label, row in got.items():
        assert (row.precision, row.recall, row.f1, row.support) == pytest.approx(want[label])
    assert evaluation.accuracy(counts).first().accuracy == pytest.approx(sum(g == p for g, p in pairs) / 400)
    macro = evaluation.macro_f1(counts).first()
    assert macro.n_labels == 4 and macro.macro_f1 == pytest.approx(sum(w[2] for w in want.values()) / 4)
    cells = Counter(pairs)
    matrix = {(r.actual, r.predicted): r.n for r in evaluation.confusion_matrix(counts).collect()}
    assert matrix == {(a, b): cells[(a, b)] for a in "abc" for b in "abc"}
    report = evaluation.eval_report(pair_frame(spark, pairs)).first()
    assert report.labels == ["a", "b", "c"]
    assert report.confusion_matrix == [[cells[(a, b)] for b in "abc"] for a in "abc"]
    assert report.label_metrics["a"].support == want["a"][3]
    assert report.invalid_json_rate is None and report.unknown_rate == 0.0


def test_report_rates_and_dense_limit(spark, monkeypatch):
    rows = [("a", "a", "json", None), ("a", "unknown", "failed", None), ("b", "b", "line", None), ("b", "b", "json", "broken_turn")]
    pairs = spark.createDataFrame(rows, "gt string, pred string, parse_status string, defect string")
    report = evaluation.eval_report(pairs).first()
    assert report.invalid_json_rate == pytest.approx(2 / 3) and report.unknown_rate == pytest.approx(1 / 3)
    cells = evaluation.confusion_cells(evaluation.pair_counts(pairs)).collect()
    assert sorted(map(tuple, cells)) == [("a", "a", 1), ("a", "unknown", 1), ("b", "b", 1)]
    monkeypatch.setattr(evaluation, "MAX_DENSE_LABELS", 1)
    with pytest.raises(ValueError, match="confusion_cells"):
        evaluation.eval_report(pairs)


def test_no_pairs_give_no_rows(spark):
    empty = pair_frame(spark, [])
    counts = evaluation.pair_counts(empty)
    for frame in (evaluation.accuracy(counts), evaluation.macro_f1(counts), evaluation.label_metrics(counts),
                  evaluation.confusion_matrix(counts), evaluation.eval_report(empty)):
        assert frame.count() == 0


def chat(*turns):
    return json.dumps({"messages": [{"role": role, "content": content} for role, content in turns]}, ensure_ascii=False)


def test_run_evaluation(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "evaluation").mkdir()
    (tmp_path / "data/data_report.json").write_text('{"labels": ["NDA", "Work"]}')
    truth = ("assistant", '{"label": "NDA"}')
    lines = [
        chat(("system", "s"), ("user", "u"), truth, ("assistant", '{"label": "nda"}')),
        chat(("user", "u"), truth, ("assistant", '```json\n{"label": "work"}\n```')),
        chat(("user", "u"), truth, ("user", "not an answer")),
        chat(("user", "u"), ("assistant", '{"label": "Work"}')),
        "{broken",
        json.dumps({"messages": [{"role": "user"}, {"role": "assistant"}, {"role": "assistant", "content": "x"}]}),
        json.dumps({"other": 1}),
        "",
    ]
    (tmp_path / "evaluation/predictions.jsonl").write_text("\n".join(lines), encoding="utf-8")
    predictions = reports.read_predictions(spark, str(tmp_path / "evaluation/predictions.jsonl"))
    pairs = evaluation.eval_pairs(predictions, ["NDA", "Work"]).orderBy("row_idx").collect()
    assert [(r.gt, r.pred) for r in pairs if r.defect is None] == [
        ("NDA", "NDA"), ("NDA", "Work"), ("NDA", "unknown"), ("unknown", "Work"), ("unknown", "unknown"),
    ]
    assert [r.defect for r in pairs if r.defect] == ["malformed", "broken_turn"]
    report = evaluation_job.run_evaluation(spark, str(tmp_path)).first()
    assert report.accuracy == pytest.approx(0.4) and report.labels == ["NDA", "unknown"]
    back = reports.read_evaluation_report(spark, str(tmp_path / "evaluation/metrics.json")).first()
    assert back.accuracy == report.accuracy and back.confusion_matrix == report.confusion_matrix


def test_report_defaults(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"accuracy": 0.5}')
    row = reports.read_evaluation_report(spark, str(path)).first()
    assert (row.accuracy, row.macro_f1, row.label_metrics, row.confusion_matrix, row.labels) == (0.5, 0.0, {}, [], [])


def test_conversations_without_assembly(spark):
    turns = [
        (1, 0, "user", "q"), (1, 1, "assistant", "truth"), (1, 2, "assistant", "second"), (1, 3, "assistant", "answer"),
        (2, 0, "assistant", "opening"), (2, 1, "user", "last"),
        (3, 5, "assistant", "only"),
        (4, 0, "assistant", "first"), (4, 1, "assistant", "truth"), (4, 2, "assistant", "answer"),
    ]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: (r.ground_truth, r.prediction) for r in evaluation.conversation_pairs(df).collect()}
    assert got == {1: ("truth", "answer"), 2: (None, None), 3: (None, "only"), 4: ("truth", "answer")}


TRIALS = (
    "number,value,datetime_start,params_learning_rate,params_lora_r,params_per_device_train_batch_size,state\n"
    "0,0.9,x,0.001,8,2.0,COMPLETE\n1,,x,0.002,4,1,FAIL\n2,0.3,x,0.0005,16.0,4,COMPLETE\n3,0.3,x,0.1,32,1,COMPLETE\n"
    "4,nan,x,,,,FAIL\n5,1.5,x,,4,,COMPLETE\n"
)


def test_tuning(spark, tmp_path):
    folder = tmp_path / "training/output"
    folder.mkdir(parents=True)
    (folder / "trials_results.csv").write_text(TRIALS)
    params = tuning.run_tuning(spark, "r1", "m", base_dir=str(tmp_path)).first()
    assert (params.best_trial_id, params.learning_rate, params.lora_r, params.per_device_train_batch_size) == (2, 0.0005, 16, 4)
    assert (params.weight_decay, params.lora_alpha, params.lora_dropout, params.num_train_epochs) == (0.01, 16, 0.05, 5)
    assert params.lora_target_modules == ["q_proj", "v_proj", "k_proj", "o_proj"]
    worst = tuning.run_tuning(spark, "r1", "m", direction="MAXIMIZE", base_dir=str(tmp_path)).first()
    assert (worst.best_trial_id, worst.learning_rate, worst.lora_r) == (5, 1e-4, 4)
    assert tuning.run_tuning(spark, "none", "m", base_dir=str(tmp_path / "none")) is None
    table = reports.read_trials(spark, [str(folder / "missing.csv"), str(folder / "trials_results.csv")], "r1")
    clean = trials.clean_trials(table).orderBy("number").collect()
    assert [r.number for r in clean] == [0, 2, 3, 5] and clean[-1].params == {"lora_r": "4"}
    summary = trials.trial_summary(trials.clean_trials(table)).collect()
    assert len(summary) == 4 and {r.best_model_path for r in summary} == {"runs/r1/training/output/trial_2"}


def test_many_runs_and_all_null(spark):
    rows = spark.range(200).select(
        F.concat(F.lit("r"), F.col("id") % 7).alias("run_id"), F.col("id").alias("row_idx"), F.col("id").alias("number"),
        F.when(F.col("id") % 7 == 3, None).otherwise(F.col("id") % 5).alias("value"), F.lit("COMPLETE").alias("state"),
    )
    best = {r.run_id: (r.best_trial_id, r.best_value) for r in trials.best_trial(trials.clean_trials(rows)).collect()}
    assert set(best) == {f"r{i}" for i in range(7) if i != 3}
    for run, (number, value) in best.items():
        mine = [i for i in range(200) if f"r{i % 7}" == run]
        assert (number, value) == min(((i, i % 5) for i in mine), key=lambda pair: (pair[1], pair[0]))
