"""Dataset build: intake, generation rounds over supplied model output, split and chat rows.

Models run elsewhere. A round hands out a request table and takes back a candidate table;
everything before and after is a deterministic Spark job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.operators import acceptance, intake, prompts, quota, responses, sft, similarity, splits
from seedloom.operators.quota import MAX_LOOPS
from seedloom.operators.ranking import dense_index
from seedloom.plans.registry import step, task_operators
from seedloom.session import cut_lineage
from seedloom.sources import seed as seed_files
from seedloom.sources import sinks
from seedloom.sources.seed import path_exists

# Takes a request table (see ``fewshot_requests`` plus prompts) and returns candidates:
# ``request_id, candidate_pos, cleaned_text, judge_raw_output, embedding``, and for the ledger
# optionally ``generated_text, batch_status``.
Answer = Callable[[DataFrame], DataFrame]


@dataclass
class DatasetRun:
    seed: DataFrame
    ledger: DataFrame
    split_rows: DataFrame | None
    labels: list[str]
    shortfall: str | None = None


@step(inputs=["generated_text"], outputs=["cleaned_text", "candidate_pos"])
def clean_texts(generated: DataFrame) -> DataFrame:
    """Expand generator replies to one row per candidate text."""
    return responses.explode_candidates(generated)


def run_intake(
    spark: SparkSession,
    input_path: str,
    base_dir: str,
    task_type: str = "classification",
    unknown_share: float = quota.UNKNOWN_SHARE,
) -> DataFrame:
    """Read, map, validate; write the valid rows, the quarantine, the intake report and the gate."""
    operators = task_operators(task_type)
    raw = seed_files.read_seed(spark, input_path)
    checked = cut_lineage(operators.validate(raw, *operators.discover(raw, in_file_order=True)))
    valid = intake.valid_rows(checked)
    sinks.write_flat_jsonl(valid, ["text", "label"], "extra", f"{base_dir}/input/seed_raw.jsonl")
    sinks.write_jsonl(intake.quarantined_rows(checked), f"{base_dir}/input/quarantine.jsonl")
    sinks.write_report(intake.intake_metadata(checked), f"{base_dir}/input/task_request.json")
    gate = intake.intake_gate(checked, include_unknown=unknown_share > 0, unknown_ratio=unknown_share)
    sinks.write_report(gate, f"{base_dir}/input/seed_validation_report.json")
    return valid


def order_candidates(candidates: DataFrame, requests: DataFrame, first_seq: int) -> DataFrame:
    """Give candidates their label and a dense ``seq`` in the order requests were issued."""
    issued = candidates.join(requests.select("request_id", "label", "loop", "difficulty", "diversity_rule", "shuffle_key"), "request_id")
    keyed = issued.withColumns(
        {
            "_all": F.lit("all"),
            "_key": F.concat_ws(":", "shuffle_key", F.lpad(F.col("candidate_pos").cast("string"), 10, "0")),
        }
    )
    ordered = dense_index(keyed, "_all", "_key", "seq").drop("_all", "_key", "shuffle_key")
    return cut_lineage(ordered.withColumn("seq", F.col("seq") + first_seq))


def run_generation(
    seed: DataFrame,
    seed_embeddings: DataFrame,
    answer: Answer,
    task_description: str,
    target: int,
    id_col: str = "row_idx",
    random_seed: object = 0,
    task_type: str = "classification",
    max_loops: int = MAX_LOOPS,
    rules: Sequence[str] = quota.FALLBACK_RULES,
    unknown_rules: Sequence[str] = quota.FALLBACK_UNKNOWN_RULES,
    unknown_share: float = quota.UNKNOWN_SHARE,
    constants: Mapping[str, str] | None = None,
    threshold: float = similarity.SEMANTIC_THRESHOLD,
    use_minhash: bool = False,
    rounds_dir: str | None = None,
) -> DataFrame:
    """Issue requests and decide candidates, round by round, until the target is met.

    ``seed_embeddings`` has the ``embedding`` of each seed text. ``rules`` come from
    ``parse_rules``. ``constants`` (run, models …) are added to every ledger row. Returns
    the ledger.

    With ``rounds_dir`` each round is committed there: its ledger, its accepted vectors and, last, a
    marker with where numbering stands. A job that starts again on the same inputs reads committed
    rounds and goes on after the last one; other inputs in the same folder raise.
    """
    spark = seed.sparkSession
    operators = task_operators(task_type)
    plan = cut_lineage(quota.quota_plan(seed, target, unknown_share))
    targets = {row["label"]: row["target"] for row in plan.collect()}
    examples = cut_lineage(quota.examples_by_label(seed, id_col, random_seed))
    index = seed_embeddings.select("embedding")
    seed_texts = seed.select("text", F.col(id_col).alias("seq"))
    collected: dict[str, int] = {}
    ledgers: list[DataFrame] = []
    first_seq = first_request = 0
    inputs = [task_description, target, random_seed, task_type, rules, unknown_rules, unknown_share, threshold, use_minhash]
    made_from = _fingerprint(seed, inputs) if rounds_dir else ""
    for loop in range(1, max_loops + 1):
        if sum(collected.values()) >= target:
            break
        done = _committed(spark, rounds_dir, loop, made_from) if rounds_dir else None
        if done:
            ledger, vectors, first_seq, first_request = done
            ledgers.append(ledger)
            for row in acceptance.accepted_rows(ledger).groupBy("label").count().collect():
                collected[row["label"]] = collected.get(row["label"], 0) + row["count"]
            index = index.unionByName(vectors)
            continue
        tally = spark.createDataFrame(list(collected.items()), "label string, collected bigint")
        slots = quota.request_slots(quota.quota_need(plan, tally), first_request)
        requests = quota.fewshot_requests(
            slots, examples, task_description, random_seed, list(rules), list(unknown_rules), loop
        )
        requests = cut_lineage(prompts.generation_prompts(requests))
        candidates = order_candidates(answer(requests), requests, first_seq)
        first_seq += candidates.count()
        first_request += requests.count()
        gated = cut_lineage(acceptance.gate_reason(responses.judge_scores(candidates)))
        known = _known_texts(seed_texts, ledgers).withColumnRenamed("text", "cleaned_text")
        decided, progress = operators.accept(
            gated,
            targets,
            target,
            index,
            threshold=threshold,
            collected=collected,
            use_minhash=use_minhash,
            seed_texts=known,
            exact_guard=True,
        )
        provenance = ["loop", "difficulty", "diversity_rule", "fidelity", "naturalness", "utility", "reasoning"]
        fixed = {name: F.lit(value) for name, value in (constants or {}).items()}
        ledger = cut_lineage(acceptance.candidate_ledger(gated, decided, provenance).withColumns(fixed))
        ledgers.append(ledger)
        collected = progress.counts
        accepted = acceptance.accepted_rows(ledger).select("seq")
        vectors = gated.join(accepted, "seq", "left_semi").select("embedding")
        if rounds_dir:
            _commit(f"{rounds_dir}/{loop:04d}", ledger, vectors, (made_from, first_seq, first_request))
        index = cut_lineage(index.unionByName(vectors))
    return _union_all(ledgers)


_MARKER = "made_from string, first_seq bigint, first_request bigint"


def _fingerprint(seed: DataFrame, inputs: list) -> str:
    """What a round depends on: the parameters and, in any order, the seed rows."""
    row = F.xxhash64("text", "label").cast("decimal(38,0)")
    rows = seed.agg(F.count("*"), F.sum(row)).first()
    return hashlib.sha256(repr([*inputs, *map(str, rows)]).encode()).hexdigest()


def _commit(path: str, ledger: DataFrame, vectors: DataFrame, marker: tuple[str, int, int]) -> None:
    """Write a round; the marker comes last, so what a stopped job left half written is written again."""
    ledger.write.mode("overwrite").parquet(f"{path}/ledger")
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    ledger.sparkSession.createDataFrame([marker], _MARKER).coalesce(1).write.mode("overwrite").parquet(f"{path}/committed")


def _committed(spark: SparkSession, rounds_dir: str, loop: int, made_from: str) -> tuple[DataFrame, DataFrame, int, int] | None:
    path = f"{rounds_dir}/{loop:04d}"
    if not path_exists(spark, f"{path}/committed/_SUCCESS"):
        return None
    marker = spark.read.parquet(f"{path}/committed").first()
    if marker["made_from"] != made_from:
        raise ValueError(f"{rounds_dir} holds rounds of other inputs")
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("ledger", "vectors"))
    return *tables, marker["first_seq"], marker["first_request"]


def run_report(ledger: DataFrame, target: int, max_loops: int) -> DataFrame:
    """One row: target, accepted rows, loops used, and why the target was missed (or NULL)."""
    accepted = F.count(F.when(F.col("status") == acceptance.ACCEPTED, 1))
    loops = F.coalesce(F.max("loop"), F.lit(0))
    counts = ledger.agg(F.lit(target).alias("target"), accepted.alias("n_accepted"), loops.alias("loops"))
    missed = F.concat(
        F.col("n_accepted"), F.lit(f" of {target} rows after "), F.col("loops"), F.lit(f" of {max_loops} loops")
    )
    return counts.withColumn("shortfall", F.when(F.col("n_accepted") < target, missed))


def _known_texts(seed_texts: DataFrame, ledgers: list[DataFrame]) -> DataFrame:
    known = seed_texts.select("text")
    for ledger in ledgers:
        known = known.unionByName(acceptance.accepted_rows(ledger).select("text"))
    return known


def _union_all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def run_split(
    synthetic: DataFrame,
    seed: DataFrame,
    base_dir: str,
    run_id: str,
    id_col: str = "row_id",
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    random_seed: object = 0,
    task_type: str = "classification",
    **prompt_options: str,
) -> tuple[DataFrame | None, list[str]]:
    """Split rows (``id_col, text, label``), write raw and chat rows per split, and the report.

    ``prompt_options`` are ``role`` and ``task``. No rows at all means no output.
    """
    operators = task_operators(task_type)
    rows = operators.split(synthetic, seed, id_col, val_ratio, test_ratio, random_seed)
    if rows is None:
        return None, []
    labels = operators.detect_labels(splits.union_sources(synthetic, seed))
    rows = cut_lineage(rows.select(id_col, "text", "label", "source", "split"))
    chat = operators.convert(rows, labels, **prompt_options)
    sinks.write_splits(rows.select("text", "label", "split"), f"{base_dir}/data/raw")
    sinks.write_splits(chat.select("messages", "split"), f"{base_dir}/data/chat")
    digest = sft.dataset_hash(rows, ["text", "label", "split"]).first()
    report = splits.split_report(rows, run_id, task_type).withColumn(
        "dataset_hash", F.lit(f"{digest['n_rows']}-{digest['hash_high']}-{digest['hash_low']}")
    )
    sinks.write_report(report, f"{base_dir}/data/data_report.json")
    return rows, labels


def run_dataset_job(
    spark: SparkSession,
    input_path: str,
    task_description: str,
    run_id: str,
    target_count: int,
    answer: Answer,
    embed_seed: Callable[[DataFrame], DataFrame],
    base_dir: str | None = None,
    task_type: str = "classification",
    random_seed: object = 0,
    models: Mapping[str, str] | None = None,
    rules: Sequence[str] = quota.FALLBACK_RULES,
    unknown_rules: Sequence[str] = quota.FALLBACK_UNKNOWN_RULES,
    unknown_share: float = quota.UNKNOWN_SHARE,
    max_loops: int = MAX_LOOPS,
    threshold: float = similarity.SEMANTIC_THRESHOLD,
    use_minhash: bool = False,
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    **prompt_options: str,
) -> DatasetRun:
    """The whole build: seed file in, chat-format splits out.

    ``unknown_share=0`` leaves the unknown class out. A run that ends below its target says so
    in ``synthetic/run_report.json`` and in ``shortfall``.

    ``answer`` supplies candidates for requests and ``embed_seed`` the ``embedding`` of
    seed rows, both as tables. ``models`` names the generator, judge and rule models for
    the ledger.
    """
    base_dir = base_dir or f"runs/{run_id}"
    seed = cut_lineage(run_intake(spark, input_path, base_dir, task_type, unknown_share))
    constants = {"run_id": run_id, "task_type": task_type, "source": "synthetic", **(models or {})}
    ledger = run_generation(
        seed,
        embed_seed(seed),
        answer,
        task_description,
        target_count,
        random_seed=random_seed,
        task_type=task_type,
        rules=rules,
        unknown_rules=unknown_rules,
        constants=constants,
        max_loops=max_loops,
        unknown_share=unknown_share,
        threshold=threshold,
        use_minhash=use_minhash,
        rounds_dir=f"{base_dir}/synthetic/rounds",
    )
    sinks.write_ledger(ledger, f"{base_dir}/synthetic/ledger")
    accepted = acceptance.accepted_rows(ledger)
    sinks.write_jsonl(accepted.select("text", "label"), f"{base_dir}/synthetic/generated.jsonl")
    sinks.write_jsonl(acceptance.manifest(ledger), f"{base_dir}/synthetic/manifest.jsonl")
    report = run_report(ledger, target_count, max_loops)
    sinks.write_report(report, f"{base_dir}/synthetic/run_report.json")
    synthetic = accepted.select(F.concat(F.lit("g"), "seq").alias("row_id"), "text", "label")
    seed_rows = seed.select(F.concat(F.lit("s"), "row_idx").alias("row_id"), "text", "label")
    rows, labels = run_split(
        synthetic,
        seed_rows,
        base_dir,
        run_id,
        val_ratio=val_ratio,
        test_ratio=test_ratio,
        random_seed=random_seed,
        task_type=task_type,
        **prompt_options,
    )
    return DatasetRun(seed, ledger, rows, labels, report.first()["shortfall"])
