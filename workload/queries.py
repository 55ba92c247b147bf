"""One Spark query per operator; each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.functions.shingles import minhash_signature
from seedloom.operators import (
    acceptance,
    evaluation,
    intake,
    prompts,
    quota,
    responses,
    sft,
    similarity,
    splits,
    trials,
)
from seedloom.session import ensure_checkpoint_dir, spread_small
from seedloom.sources import reports, seed, sinks
from workload import inputs as data

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(*names: str) -> list[Column]:
    return [F.round(name, 6).alias(name) for name in names]


def joined(column: Column | str) -> Column:
    return F.array_join(column, "|")


# --- intake -------------------------------------------------------------------------


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.map_and_validate(data.raw_rows(spark, sf_dir), "document_content", "doc_class")


@query
def intake_mapped(spark, sf_dir):
    raw = data.raw_rows(spark, sf_dir)
    text_key, label_key = intake.discover_columns(raw)
    checked = intake.map_and_validate(raw, text_key, label_key)
    return checked.select(
        "row_idx", F.lit(text_key).alias("text_key"), F.lit(label_key).alias("label_key"), "text", "label"
    ).filter("reject_reason IS NULL")


@query
def intake_valid(spark, sf_dir):
    valid = intake.valid_rows(_checked(spark, sf_dir))
    return valid.select("row_idx", "text", "label", F.col("extra")["source"].alias("extra_source"))


@query
def intake_quarantine(spark, sf_dir):
    return intake.quarantined_rows(_checked(spark, sf_dir)).select("row_idx", "reject_reason")


@query
def intake_metadata(spark, sf_dir):
    report = intake.intake_metadata(_checked(spark, sf_dir))
    pairs = F.transform(
        F.array_sort(F.map_entries("label_distribution")),
        lambda entry: F.concat(entry["key"], F.lit("="), entry["value"].cast("string")),
    )
    return report.select(
        "total_raw_rows",
        "total_valid_rows",
        "total_dropped_rows",
        joined("unique_labels").alias("unique_labels"),
        joined(pairs).alias("label_distribution"),
    )


@query
def event_rows_unmapped(spark, sf_dir):
    """JSON object rows without a usable key fall back to the plain names and all drop."""
    rows = data.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_idx"),
        F.from_json("props", "map<string,string>").alias("raw"),
        F.lit(True).alias("is_object"),
    )
    checked = intake.map_and_validate(rows, *intake.discover_columns(rows))
    return checked.groupBy("reject_reason").agg(
        F.count("*").alias("n"), F.sum(F.col("extra")["k"].cast("bigint")).alias("sum_k")
    )


@query
def json_array_round_trip(spark, sf_dir):
    """Rows written as JSON arrays (compact, one line a file) and read back in ranges of the files."""
    path = _scratch(spark)
    rows = data.documents(spark, sf_dir).select("doc_id", "text", "source").orderBy("doc_id")
    sinks.write_json_arrays(rows.select("text", F.col("source").alias("label"), "doc_id"), path)
    raw = seed.read_seed_json(spark, path)
    return raw.select(
        "row_idx", F.col("raw")["text"].alias("text"), F.col("raw")["label"].alias("label"), F.col("raw")["doc_id"].alias("doc_id")
    )


@query
def trials_csv_round_trip(spark, sf_dir):
    """A trials table written as CSV, found among candidate places and read back."""
    path = _scratch(spark)
    trials_table = data.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("note"), F.col("o_totalprice").alias("value")
    )
    trials_table.orderBy("number").write.option("header", True).option("escape", '"').csv(path)
    read = reports.read_trials(spark, [f"{path}-absent", path], "run 1")
    return read.select("run_id", "number", "note", F.round(F.col("value").cast("double"), 2).alias("value"))


@query
def predictions_round_trip(spark, sf_dir):
    """Prediction lines, some of them broken, written and read back."""
    path = _scratch(spark)
    said = F.array(
        F.struct(F.lit("user").alias("role"), F.col("text").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("source").alias("content")),
    )
    line = F.to_json(F.struct(said.alias("messages")))
    broken = F.when(F.col("doc_id") % 7 == 3, F.concat(line, F.lit("}"))).otherwise(line)
    data.documents(spark, sf_dir).orderBy("doc_id").select(broken.alias("value")).write.text(path)
    read = reports.read_predictions(spark, path)
    return read.select(
        F.col("row_idx").alias("line"), F.size("messages").alias("turns"), F.get("messages", 1)["content"].alias("reply"), "defect"
    )


@query
def report_labels(spark, sf_dir):
    """The label list, written in a split report and read back."""
    path = _scratch(spark)
    rows = data.documents(spark, sf_dir)
    sinks.write_report(rows.agg(F.array_sort(F.collect_set("source")).alias("labels")), path)
    names = reports.read_label_list(spark, path)  # the category list
    return rows.groupBy("source").count().filter(F.col("source").isin(names)).select(
        F.col("source").alias("label"), F.col("count").alias("n_rows")
    )


@query
def label_distribution(spark, sf_dir):
    return intake.label_distribution(data.seed_rows(spark, sf_dir))


@query
def detected_labels(spark, sf_dir):
    labels = intake.detected_labels(data.documents(spark, sf_dir).select(F.col("source").alias("label")))
    return labels.select(joined("labels").alias("labels"))


@query
def label_conflicts(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select(F.col("doc_id").alias("row_idx"), "text", F.col("source").alias("label"))
    return intake.label_conflicts(rows)


@query
def intake_gate(spark, sf_dir):
    return intake.intake_gate(_checked(spark, sf_dir), include_unknown=True, unknown_ratio=0.1)


# --- sources and sinks --------------------------------------------------------------


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def _read_back(spark: SparkSession, path: str, raw: DataFrame) -> DataFrame:
    checked = intake.map_and_validate(raw, *intake.discover_columns(raw, in_file_order=True))
    return intake.valid_rows(checked).select(
        F.col("extra")["doc_id"].cast("bigint").alias("doc_id"), "text", "label"
    )


@query
def jsonl_round_trip(spark, sf_dir):
    path = f"{_scratch(spark)}.jsonl"
    sinks.write_jsonl(data.seed_rows(spark, sf_dir), path)
    return _read_back(spark, path, seed.read_seed(spark, path))


@query
def csv_round_trip(spark, sf_dir):
    path = f"{_scratch(spark)}.csv"
    rows = data.seed_rows(spark, sf_dir).withColumnsRenamed({"text": "Document Content ", "label": " Doc_Class"})
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return _read_back(spark, path, seed.read_seed(spark, path))


@query
def split_files_round_trip(spark, sf_dir):
    """Write the splits in one pass, read them back by folder."""
    path = _scratch(spark)
    sinks.write_splits(_seed_priority(spark, sf_dir).select("split", "doc_id", "label"), path)
    lines = spark.read.text(path)
    label = F.get_json_object("value", "$.label")
    return lines.groupBy("split", label.alias("label")).agg(F.count("*").alias("n"))


# --- generation planning ------------------------------------------------------------

_TARGET = 500


@query
def quota_plan(spark, sf_dir):
    return quota.quota_plan(data.seed_rows(spark, sf_dir), _TARGET)


def _need(spark, sf_dir):
    collected = data.synthetic_rows(spark, sf_dir).groupBy("label").agg(
        F.floor(F.count("*") / 5).cast("bigint").alias("collected")
    )
    return quota.quota_need(quota.quota_plan(data.seed_rows(spark, sf_dir), _TARGET), collected)


@query
def quota_need(spark, sf_dir):
    return _need(spark, sf_dir)


def _examples(spark, sf_dir):
    return quota.examples_by_label(data.seed_rows(spark, sf_dir), "doc_id", data.SEED)


@query
def examples_by_label(spark, sf_dir):
    return _examples(spark, sf_dir).select("label", "example_idx", "example_id")


def _requests(spark, sf_dir):
    slots = quota.request_slots(_need(spark, sf_dir))
    return quota.fewshot_requests(slots, _examples(spark, sf_dir), data.TASK, data.SEED)


@query
def fewshot_requests(spark, sf_dir):
    ids = F.transform("example_ids", lambda item: item.cast("string"))
    return _requests(spark, sf_dir).select(
        "request_id", "label", joined(ids).alias("example_ids"), "difficulty", "diversity_rule", "shuffle_key"
    )


@query
def generation_prompts(spark, sf_dir):
    return prompts.generation_prompts(_requests(spark, sf_dir)).select("request_id", "system_prompt", "user_prompt")


@query
def rule_prompt(spark, sf_dir):
    labels = intake.detected_labels(data.seed_rows(spark, sf_dir))
    return prompts.rule_prompt(labels, data.TASK)


@query
def rules_parsed(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select("doc_id", F.expr(data.RULES_REPLY).alias("raw_rules"))
    return responses.parse_rules(rows).select(
        "doc_id",
        "rules_status",
        joined("diversity_rules").alias("diversity_rules"),
        joined("unknown_diversity_rules").alias("unknown_diversity_rules"),
    )


# --- candidates ---------------------------------------------------------------------


@query
def candidate_explode(spark, sf_dir):
    return responses.explode_candidates(data.batches(spark, sf_dir)).select(
        "request_id", "label", "batch_status", "candidate_pos", "cleaned_text"
    )


@query
def candidate_valid(spark, sf_dir):
    rows = data.vector_candidates(spark, sf_dir)
    return rows.filter(responses.is_valid_candidate("cleaned_text")).select("seq", "label", "cleaned_text")


@query
def judge_prompts(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select(
        "doc_id",
        F.lit(data.TASK).alias("task_description"),
        F.col("lang").alias("label"),
        F.col("text").alias("cleaned_text"),
    )
    return prompts.judge_prompts(rows).select("doc_id", "judge_prompt")


@query
def judge_scores(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select("doc_id", F.expr(data.judge_reply("doc_id")).alias("judge_raw_output"))
    return responses.judge_scores(rows).select(
        "doc_id", *rounded("fidelity", "naturalness", "utility", "overall_score"), "reasoning", "judge_status"
    )


# --- similarity ---------------------------------------------------------------------


@query
def exact_dup_guard(spark, sf_dir):
    """Copies of a seed row or of an accepted row, among judged rows of two labels."""
    rows = data.synthetic_rows(spark, sf_dir).select(
        F.col("doc_id").alias("seq"),
        F.expr(data.GUARD_LABEL).alias("label"),
        F.col("text").alias("cleaned_text"),
        F.expr(data.judge_reply("doc_id")).alias("judge_raw_output"),
    )
    gated = acceptance.gate_reason(responses.judge_scores(rows))
    seeds = data.seed_rows(spark, sf_dir).select(F.col("text").alias("cleaned_text"))
    n = rows.count()
    decided, _ = acceptance.greedy_accept(
        gated, {"many": n, "few": data.GUARD_FEW}, n, seed_texts=seeds, exact_guard=True
    )
    return decided.select("seq", F.coalesce(F.col("reason") == acceptance.EXACT_DUPLICATE, F.lit(False)).alias("is_copy"))


def _signatures(spark, sf_dir):
    rows = spread_small(data.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", minhash_signature("text").alias("signature"))


@query
def minhash_signature_rows(spark, sf_dir):
    values = F.transform("signature", lambda item: item.cast("string"))
    return _signatures(spark, sf_dir).select("doc_id", joined(values).alias("signature"))


@query
def near_dup_flags(spark, sf_dir):
    flags = similarity.near_duplicates(data.documents(spark, sf_dir), "doc_id", "text")
    return flags.select("doc_id", "status", "dup_of", *rounded("similarity"))


@query
def near_dup_flags_70(spark, sf_dir):
    flags = similarity.near_duplicates(data.documents(spark, sf_dir), "doc_id", "text", threshold=0.7)
    return flags.select("doc_id", "status", "dup_of", *rounded("similarity"))


@query
def near_dup_of_seed(spark, sf_dir):
    """Generated rows that nearly copy a seed row."""
    rows, seeds = data.synthetic_rows(spark, sf_dir), data.seed_rows(spark, sf_dir)
    return similarity.near_duplicates(rows, "doc_id", "text", index=seeds).select(
        "doc_id", "status", "dup_of", *rounded("similarity")
    )


def _vectors(spark, sf_dir):
    return data.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")


@query
def semantic_redundant(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    flagged = similarity.semantic_redundant(rows, rows, data.SEMANTIC_THRESHOLD, earlier_only=True)
    return flagged.select("seq", *rounded("max_similarity"), "is_redundant")


# --- acceptance ---------------------------------------------------------------------


def _accept_quota(spark, sf_dir) -> dict[str, int]:
    labels = data.vector_candidates(spark, sf_dir).select("label", F.lit("x").alias("text"))
    plan = quota.quota_plan(labels.filter(F.col("label") != "unknown"), data.ACCEPT_TARGET)
    return {row["label"]: row["target"] for row in plan.collect()}


def _gated(spark, sf_dir):
    return acceptance.gate_reason(responses.judge_scores(data.vector_candidates(spark, sf_dir)))


def _decided(spark, sf_dir, candidates):
    quotas = _accept_quota(spark, sf_dir)
    return acceptance.greedy_accept(candidates, quotas, data.ACCEPT_TARGET, None, data.SEMANTIC_THRESHOLD)[0]


@query
def greedy_accept(spark, sf_dir):
    return _decided(spark, sf_dir, _gated(spark, sf_dir)).filter("status = 'accepted'").select("seq", "label")


@query
def greedy_accept_with_seeds(spark, sf_dir):
    """One class of vectors is the seed index, the others are offered."""
    gated = _gated(spark, sf_dir)
    seeds = gated.filter(F.col("label") == data.SEED_CLASS).select("embedding")
    rows = gated.filter(F.col("label") != data.SEED_CLASS)
    quotas = _accept_quota(spark, sf_dir)
    decided, _ = acceptance.greedy_accept(rows, quotas, data.ACCEPT_TARGET, seeds, data.SEMANTIC_THRESHOLD)
    return decided.filter("status = 'accepted'").select("seq", "label")


@query
def greedy_accept_all(spark, sf_dir):
    """Every vector with a free quota: redundancy alone decides."""
    rows = _vectors(spark, sf_dir).withColumns({"label": F.lit("any"), "gate": F.lit(None).cast("string")})
    n = rows.count()
    decided, _ = acceptance.greedy_accept(rows, {"any": n}, n, None, data.SEMANTIC_THRESHOLD)
    return decided.select("seq", "status")


@query
def greedy_accept_texts(spark, sf_dir):
    """Near-copied texts alone decide (no vectors), with the seed texts as index."""
    rows = data.synthetic_rows(spark, sf_dir).select(
        F.col("doc_id").alias("seq"),
        F.lit("any").alias("label"),
        F.lit(None).cast("string").alias("gate"),
        F.col("text").alias("cleaned_text"),
    )
    seeds = data.seed_rows(spark, sf_dir).select(F.col("text").alias("cleaned_text"))
    n = rows.count()
    decided, _ = acceptance.greedy_accept(rows, {"any": n}, n, use_minhash=True, seed_texts=seeds)
    return decided.select("seq", "status")


def _ledger(spark, sf_dir):
    gated = _gated(spark, sf_dir)
    return acceptance.candidate_ledger(gated, _decided(spark, sf_dir, gated), ["fidelity", "naturalness", "utility"])


@query
def sdg_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir).select(
        "seq", "label", "text", "status", "reason", *rounded("overall_score", "max_similarity"), "judge_raw_output"
    )


@query
def sdg_manifest(spark, sf_dir):
    return acceptance.manifest(_ledger(spark, sf_dir))


@query
def loop_progress(spark, sf_dir):
    """Three response batches (by vector id range) until the target is met."""
    gated = _gated(spark, sf_dir)
    size = gated.count()
    batch = F.least(F.floor(F.col("seq") * 3 / size), F.lit(2))
    parts = [gated.filter(batch == part) for part in range(3)]
    decided = acceptance.accept_in_loops(
        parts, _accept_quota(spark, sf_dir), data.ACCEPT_TARGET, None, data.SEMANTIC_THRESHOLD
    )
    return acceptance.loop_progress(decided)


# --- splits and training rows -------------------------------------------------------


def _seed_priority(spark, sf_dir):
    seeds, generated = data.seed_rows(spark, sf_dir), data.synthetic_rows(spark, sf_dir)
    return splits.split_seed_priority(generated, seeds, "doc_id", data.SEED)


def _three_way(spark, sf_dir):
    return splits.split_three_way(data.synthetic_rows(spark, sf_dir), "doc_id", 0.1, 0.2, data.SEED)


@query
def seed_split_distribution(spark, sf_dir):
    """Flagship: seed rows through intake, split with the generated rows, counted per split."""
    raw = data.raw_rows(spark, sf_dir)
    marked = data.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_idx"))
    checked = intake.map_and_validate(
        raw.join(marked, "row_idx", "left_semi"), *intake.discover_columns(raw)
    )
    seeds = intake.valid_rows(checked).select(F.col("row_idx").alias("doc_id"), "text", "label")
    generated = data.synthetic_rows(spark, sf_dir)
    return splits.split_distribution(splits.split_seed_priority(generated, seeds, "doc_id", data.SEED))


@query
def union_sources(spark, sf_dir):
    rows = splits.union_sources(data.synthetic_rows(spark, sf_dir), data.seed_rows(spark, sf_dir))
    return rows.groupBy("source", "label").agg(F.count("*").alias("n"))


@query
def stratifiable(spark, sf_dir):
    return splits.stratifiable(data.seed_rows(spark, sf_dir))


@query
def split_seed_priority(spark, sf_dir):
    return _seed_priority(spark, sf_dir).select("doc_id", "label", "source", "split")


@query
def split_three_way(spark, sf_dir):
    return _three_way(spark, sf_dir).select("doc_id", "label", "split")


@query
def split_report(spark, sf_dir):
    report = splits.split_report(_three_way(spark, sf_dir), "run_1")

    def counts(split: str) -> Column:
        entries = F.array_sort(F.map_entries(F.col("label_distribution")[split]))
        return joined(
            F.transform(entries, lambda entry: F.concat(entry["key"], F.lit("="), entry["value"].cast("string")))
        ).alias(f"{split}_labels")

    return report.select(
        "run_id", "total_count", "train_count", "val_count", "test_count", joined("labels").alias("labels"),
        counts("train"), counts("validation"), counts("test"),
    )


def _labels(spark, sf_dir) -> list[str]:
    return intake.label_list(data.documents(spark, sf_dir).select(F.col("lang").alias("label")))


def _chat(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select("doc_id", "text", F.col("lang").alias("label"))
    return sft.sft_messages(rows, _labels(spark, sf_dir), data.ROLE, data.TASK)


@query
def sft_messages(spark, sf_dir):
    def content(place: int) -> Column:
        return F.col("messages")[place]["content"]

    return _chat(spark, sf_dir).select(
        "doc_id",
        content(0).alias("system_content"),
        content(1).alias("user_content"),
        content(2).alias("assistant_content"),
    )


@query
def sft_verify(spark, sf_dir):
    checked = sft.sft_verify(_chat(spark, sf_dir).select("doc_id", "messages"), _labels(spark, sf_dir))
    return checked.groupBy("target_label", "target_ok").agg(F.count("*").alias("n"))


@query
def dataset_hash(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select("text", F.col("lang").alias("label"))
    return sft.dataset_hash(rows, ["text", "label"])


# --- trials -------------------------------------------------------------------------


def _trials(spark, sf_dir):
    return trials.clean_trials(data.trials(spark, sf_dir))


@query
def trials_clean(spark, sf_dir):
    return _trials(spark, sf_dir).select(
        "run_id", "number", "value", "state",
        *[F.col("params")[name].alias(name) for name in ("learning_rate", "lora_r", "lora_dropout")],
        F.size("params").alias("n_params"),
    )


@query
def best_trial(spark, sf_dir):
    return trials.best_trial(_trials(spark, sf_dir)).select(
        "run_id", "best_trial_id", "best_value", "best_state", "best_model_path", "n_trials"
    )


@query
def best_trial_maximize(spark, sf_dir):
    return trials.best_trial(_trials(spark, sf_dir), "Maximize").select("run_id", "best_trial_id", "best_value")


@query
def trial_summary(spark, sf_dir):
    return trials.trial_summary(_trials(spark, sf_dir)).select(
        "run_id", "trial_id", "metric_value", "status", "best_trial_id", "best_model_path"
    )


@query
def final_params(spark, sf_dir):
    resolved = trials.final_params(trials.best_trial(_trials(spark, sf_dir)), "base-model")
    return resolved.select(
        "run_id", "best_trial_id", "model_name", "learning_rate", "per_device_train_batch_size", "weight_decay",
        "lora_r", "lora_alpha", "lora_dropout", "num_train_epochs", "warmup_ratio", "optimizer",
    )


# --- responses and evaluation -------------------------------------------------------


@query
def response_parse_eval(spark, sf_dir):
    parsed = responses.parse_evaluation_response(data.replies(spark, sf_dir), "response")
    label = responses.snap_label("raw_label", _labels(spark, sf_dir))
    return parsed.select("doc_id", "raw_label", "raw_label_status", label.alias("label"))


@query
def response_parse_cascade(spark, sf_dir):
    parsed = responses.parse_interactive_response(data.replies(spark, sf_dir), "response")
    label = responses.snap_label("raw_label", _labels(spark, sf_dir))
    return parsed.select("doc_id", "raw_label", "raw_label_status", label.alias("label"))


@query
def label_snap(spark, sf_dir):
    raw = F.expr(
        "CASE doc_id % 6 WHEN 0 THEN upper(lang) WHEN 1 THEN 'x' || lang || 'y' WHEN 2 THEN substr(lang, 1, 1) "
        "WHEN 3 THEN '  ' WHEN 4 THEN '' ELSE source END"
    )
    labels = _labels(spark, sf_dir)
    return data.documents(spark, sf_dir).select("doc_id", raw.alias("raw")).select(
        "doc_id",
        responses.snap_label("raw", labels).alias("label"),
        responses.snap_label("raw", labels, compat=True).alias("compat_label"),
    )


@query
def parse_outcomes(spark, sf_dir):
    parsed = responses.parse_evaluation_response(data.replies(spark, sf_dir), "response")
    parsed = parsed.withColumn("label", responses.snap_label("raw_label", _labels(spark, sf_dir)))
    rates = responses.parse_outcomes(parsed, "source", "raw_label_status", "label")
    return rates.select("source", "n_responses", *rounded("invalid_json_rate", "unknown_rate"))


def _pairs(spark, sf_dir):
    return evaluation.eval_pairs(data.predictions(spark, sf_dir), _labels(spark, sf_dir))


def _counts(spark, sf_dir):
    return evaluation.pair_counts(_pairs(spark, sf_dir))


@query
def eval_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("doc_id", "gt", "pred", "parse_status")


@query
def conversation_pairs(spark, sf_dir):
    return evaluation.conversation_pairs(data.table(spark, sf_dir, "conversations"))


@query
def eval_accuracy(spark, sf_dir):
    return evaluation.accuracy(_counts(spark, sf_dir)).select("n_rows", *rounded("accuracy"))


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(_counts(spark, sf_dir))


@query
def label_metrics(spark, sf_dir):
    return evaluation.label_metrics(_counts(spark, sf_dir)).select("label", *rounded("precision", "recall", "f1"), "support")


@query
def macro_f1(spark, sf_dir):
    return evaluation.macro_f1(_counts(spark, sf_dir)).select("n_labels", *rounded("macro_f1"))


@query
def eval_report(spark, sf_dir):
    """The report, written, read back with defaults filled in, and flattened."""
    path = _scratch(spark)
    sinks.write_report(evaluation.eval_report(_pairs(spark, sf_dir)), path)
    report = reports.read_evaluation_report(spark, path)
    lines = F.transform("confusion_matrix", lambda row: F.array_join(row.cast("array<string>"), ","))
    return report.select(
        *rounded("accuracy", "macro_f1", "invalid_json_rate", "unknown_rate"),
        joined(lines).alias("confusion_matrix"),
        joined("labels").alias("labels"),
        F.size("label_metrics").alias("n_label_metrics"),
    )


# --- inference ----------------------------------------------------------------------


@query
def inference_requests(spark, sf_dir):
    rows = prompts.inference_requests(
        data.documents(spark, sf_dir).select("doc_id", "text"), _labels(spark, sf_dir), data.ROLE, data.TASK
    )
    return rows.select("doc_id", F.col("messages")[1]["content"].alias("user_content"), "prompt")


@query
def request_guard(spark, sf_dir):
    rows = data.documents(spark, sf_dir).select("doc_id", F.expr(data.RAW_TEXT).alias("text"))
    return prompts.guard_blank_requests(rows).select("doc_id", "needs_model", "label", "confidence", "raw_output")


@query
def token_confidence(spark, sf_dir):
    """Vectors stand in for token log-probabilities (made non-positive)."""
    rows = data.table(spark, sf_dir, "embeddings")
    logprobs = F.transform("embedding", lambda value: -F.abs(value.cast("double")))
    return rows.select("vec_id", F.round(responses.token_confidence(logprobs), 6).alias("confidence"))


@query
def inference_responses(spark, sf_dir):
    rows = data.replies(spark, sf_dir).withColumn("token_logprobs", F.expr("array(-doc_id % 7 / 10.0D, -0.5D)"))
    replies = responses.inference_responses(rows, _labels(spark, sf_dir), "response")
    return replies.select("doc_id", "label", *rounded("confidence"), "raw_output", "error")
