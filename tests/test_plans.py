import json
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedloom.operators import prompts, responses
from seedloom.operators.acceptance import TARGET_REACHED
from seedloom.plans import dataset, registry
from seedloom.session import ensure_checkpoint_dir


def test_unknown_task_type():
    with pytest.raises(ValueError):
        registry.task_operators("ner")
    assert registry.task_operators("classification").split


def test_step_declares_columns(spark):
    df = spark.range(2)
    with pytest.raises(ValueError, match="generated_text"):
        df.transform(dataset.clean_texts)
    assert df.withColumn("generated_text", F.lit('{"results": ["x"]}')).transform(dataset.clean_texts).count() == 2


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert configured.split(":")[-1] in ensure_checkpoint_dir(spark)


def fake_embedding(column):
    """A fixed random unit vector per text (nested, so that it travels with the job)."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(text: pd.Series) -> pd.Series:
        def vector(value):
            v = np.random.default_rng(zlib.crc32(value.encode())).normal(size=32)
            return (v / np.linalg.norm(v)).tolist()

        return text.map(vector)

    return embed(column)


def fake_models(requests):
    """Stand-in for generator, judge and embedder: five texts per request, some unusable."""
    texts = F.to_json(
        F.struct(
            F.transform(
                F.sequence(F.lit(1), F.lit(5)),
                lambda i: F.concat(F.lit("text "), F.md5(F.concat(F.col("shuffle_key"), i.cast("string")))),
            ).alias("results")
        )
    )
    generated = requests.select("request_id", "label", F.when(F.col("request_id") % 9 == 4, "oops").otherwise(texts).alias("generated_text"))
    candidates = generated.transform(dataset.clean_texts)
    judge = F.when(
        F.col("candidate_pos") == 4, '{"fidelity": 0.2, "naturalness": 0.2, "utility": 0.2, "reasoning": "no"}'
    ).otherwise('{"fidelity": 0.9, "naturalness": 0.9, "utility": 0.9, "reasoning": "yes"}')
    return candidates.select(
        "request_id", "candidate_pos", "cleaned_text", "generated_text", "batch_status",
        judge.alias("judge_raw_output"), fake_embedding("cleaned_text").alias("embedding"),
    )


def test_dataset_job(spark, tmp_path):
    rows = [{"text": f"seed text number {i}", "label": "AB"[i % 2], "note": i} for i in range(12)] + [{"text": "", "label": "A"}]
    source = tmp_path / "seed.jsonl"
    source.write_text("\n".join(map(json.dumps, rows)))
    base = str(tmp_path / "run")
    run = dataset.run_dataset_job(
        spark, str(source), "sort things", "run", 60, fake_models,
        lambda seed: seed.select(fake_embedding("text").alias("embedding")), base_dir=base, role="You sort.",
        models={"generation_model": "g1"}, rules=["only rule"],
    )
    accepted = run.ledger.filter("status = 'accepted'")
    counts = {r.label: r.n for r in accepted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {"A": 27, "B": 27, "unknown": 6}
    assert run.labels == ["A", "B", "unknown"]
    reasons = {r.reason for r in run.ledger.select("reason").distinct().collect()}
    assert {"low_score", "invalid_text", "quota_full"} <= reasons | {TARGET_REACHED, "quota_full"}
    failed = run.ledger.filter("generator_raw_output IS NOT NULL").first()
    assert failed.generator_raw_output == "oops" and failed.reason in ("invalid_text", "quota_full", TARGET_REACHED)
    assert (failed.run_id, failed.source, failed.generation_model) == ("run", "synthetic", "g1")
    assert {r.diversity_rule for r in run.ledger.filter("label <> 'unknown'").collect()} == {"only rule"}
    assert run.ledger.select("seq").distinct().count() == run.ledger.count()
    splits_seen = {(r.split, r.source): r.n for r in run.split_rows.groupBy("split", "source").agg(F.count("*").alias("n")).collect()}
    assert splits_seen == {("train", "synthetic"): 60, ("validation", "seed"): 6, ("test", "seed"): 6}
    report = spark.read.json(f"{base}/data/data_report.json").first()
    assert (report.train_count, report.val_count, report.test_count) == (60, 6, 6)
    assert report.dataset_hash.startswith("72-")
    assert report.labels == ["A", "B", "unknown"]
    chat = spark.read.text(f"{base}/data/chat")
    line = json.loads(chat.filter("split = 'test'").first().value)
    assert [m["role"] for m in line["messages"]] == ["system", "user", "assistant"]
    assert line["messages"][0]["content"] == "You sort." and chat.count() == 72
    assert spark.read.json(f"{base}/input/task_request.json").first().total_dropped_rows == 1
    assert spark.read.text(f"{base}/synthetic/generated.jsonl").count() == 60


def test_stopped_job_goes_on_after_the_last_committed_round(spark, tmp_path):
    seed = spark.createDataFrame([(i, f"seed {i}", "AB"[i % 2]) for i in range(8)], "row_idx long, text string, label string")
    vectors = seed.select(fake_embedding("text").alias("embedding"))
    asked = []

    def answer(stop_at=None):
        def models(requests):
            asked.append(requests.first().loop if "loop" in requests.columns else None)
            if stop_at and len(asked) == stop_at:
                raise RuntimeError("stopped")
            good = '{"fidelity": 0.9, "naturalness": 0.9, "utility": 0.9, "reasoning": "yes"}'
            only_first = F.when(F.col("candidate_pos") == 0, good).otherwise("no judgement")
            return fake_models(requests).withColumn("judge_raw_output", only_first)

        return models

    def job(models, folder=None, target=24):
        return dataset.run_generation(seed, vectors, models, "sort", target, max_loops=6, rounds_dir=folder)

    def shown(ledger):
        return sorted(tuple(r) for r in ledger.select("loop", "seq", "label", "status", "reason", "text").collect())

    whole = shown(job(answer()))
    rounds = max(loop for loop, *_ in whole)
    assert rounds > 3
    folder = str(tmp_path / "rounds")
    asked.clear()
    with pytest.raises(RuntimeError, match="stopped"):
        job(answer(stop_at=3), folder)
    asked.clear()
    assert shown(job(answer(), folder)) == whole
    assert len(asked) == rounds - 2
    asked.clear()
    assert shown(job(answer(), folder)) == whole and not asked
    with pytest.raises(ValueError, match="other inputs"):
        job(answer(), folder, target=25)


def test_inference_tables(spark):
    rows = spark.createDataFrame([("a doc", '{"label": "nda"}', [0.0, 0.0]), ("  ", "", [])], "text string, generated_text string, token_logprobs array<double>")
    guarded = prompts.guard_blank_requests(rows.select("text")).collect()
    assert [r.needs_model for r in guarded] == [True, False]
    assert (guarded[1].label, guarded[1].confidence, guarded[1].raw_output) == ("No input provided.", 0.0, "")
    request = prompts.inference_requests(rows, ["NDA"]).first()
    assert request.prompt == f"{prompts.DEFAULT_ROLE} {request.messages[1].content}"
    answers = responses.inference_responses(rows, ["NDA"]).collect()
    assert (answers[0].label, answers[0].confidence, answers[0].error) == ("NDA", 1.0, None)
