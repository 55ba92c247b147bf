"""Tuning trials: cleaning, best trial per run, and resolved training parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAM_PREFIX = "params_"

# Defaults of a training run; a final run always uses FINAL_EPOCHS.
FINAL_EPOCHS = 5
OVERRIDABLE = {
    "learning_rate": ("double", 1e-4),
    "per_device_train_batch_size": ("int", 2),
    "weight_decay": ("double", 0.01),
    "lora_r": ("int", 8),
    "lora_alpha": ("int", 16),
    "lora_dropout": ("double", 0.05),
}
CONSTANTS = {
    "model_max_length": 2048,
    "trust_remote_code": True,
    "q_lora": True,
    "lora_target_modules": ["q_proj", "v_proj", "k_proj", "o_proj"],
    "trainer_type": "TRL_SFT",
    "gradient_accumulation_steps": 4,
    "warmup_ratio": 0.1,
    "optimizer": "adamw_torch",
    "lr_scheduler_type": "cosine",
    "logging_steps": 10,
    "eval_steps": 50,
    "save_total_limit": 1,
    "early_stopping_patience": 3,
}


def clean_trials(trials: DataFrame) -> DataFrame:
    """Drop trials without a metric and fold ``params_*`` columns into one map.

    Input columns: ``run_id, row_idx, number, value, state`` and any ``params_*``.
    """
    folded = [name for name in trials.columns if name.startswith(PARAM_PREFIX)]
    entries = [
        F.struct(F.lit(name.replace(PARAM_PREFIX, "")).alias("key"), F.col(name).cast("string").alias("value"))
        for name in folded
    ]
    params = F.map_from_entries(F.array(*entries)) if entries else F.create_map().cast("map<string,string>")
    return (
        trials.withColumn("value", F.col("value").try_cast("double"))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(
            "run_id",
            "row_idx",
            F.coalesce(
                F.col("number").try_cast("bigint"), F.col("number").try_cast("double").try_cast("bigint")
            ).alias("number"),
            "value",
            F.col("state").cast("string").alias("state"),
            F.map_filter(params, lambda _, value: value.isNotNull()).alias("params"),
        )
    )


def _best(column: str | Column, direction: str) -> Column:
    """``column`` of the best trial; the lowest ``row_idx`` wins ties."""
    if direction.lower() == "minimize":
        return F.min_by(column, F.struct("value", "row_idx"))
    return F.max_by(column, F.struct(F.col("value"), -F.col("row_idx")))


def best_trial(trials: DataFrame, direction: str = "minimize") -> DataFrame:
    """Best trial per run with its parameters. One aggregation that combines on the map side."""
    detail = F.struct("number", "value", "state", "params")
    return (
        trials.groupBy("run_id")
        .agg(_best(detail, direction).alias("best"), F.count("*").alias("n_trials"))
        .select(
            "run_id",
            F.col("best.number").alias("best_trial_id"),
            F.col("best.value").alias("best_value"),
            F.col("best.state").alias("best_state"),
            F.col("best.params").alias("params"),
            model_path(F.col("run_id"), F.col("best.number")).alias("best_model_path"),
            "n_trials",
        )
    )


def model_path(run_id: Column, trial_id: Column) -> Column:
    return F.concat(
        F.lit("runs/"), run_id, F.lit("/training/output/trial_"), trial_id.cast("string")
    )


def trial_summary(trials: DataFrame, direction: str = "minimize") -> DataFrame:
    """All clean trials, each beside its run's best trial, as flat rows.

    A run's trials stay separate rows, so a run with very many trials never has to fit
    one array; the report of a single run is a filter on ``run_id``.
    """
    best = best_trial(trials, direction).select("run_id", "best_trial_id", "best_model_path")
    return trials.join(best, "run_id").select(
        "run_id",
        "row_idx",
        F.col("number").alias("trial_id"),
        "params",
        F.col("value").alias("metric_value"),
        F.col("state").alias("status"),
        "best_trial_id",
        "best_model_path",
    )


def final_params(best: DataFrame, model_name: str, epochs: int = FINAL_EPOCHS) -> DataFrame:
    """Resolved training parameters per run: the best trial's values over the defaults."""
    overrides = {}
    for name, (kind, default) in OVERRIDABLE.items():
        given = F.try_element_at("params", F.lit(name))
        value = given.try_cast("double")
        overrides[name] = F.coalesce(value.cast(kind), F.lit(default).cast(kind))
    constants = {name: F.lit(value) for name, value in CONSTANTS.items()}
    return best.select(
        "run_id",
        "best_trial_id",
        F.lit(model_name).alias("model_name"),
        *[column.alias(name) for name, column in overrides.items()],
        F.lit(epochs).alias("num_train_epochs"),
        *[column.alias(name) for name, column in constants.items()],
    )
