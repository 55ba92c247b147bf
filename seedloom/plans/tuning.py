"""Tuning results of one or many runs in, resolved training parameters out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seedloom.operators import trials
from seedloom.sources import reports, sinks


def resolve_parameters(
    tables: list[DataFrame], model_name: str, direction: str = "minimize", epochs: int = trials.FINAL_EPOCHS
) -> DataFrame:
    """Best trial and final parameters per run, over the trial tables of all runs."""
    cleaned = [trials.clean_trials(table) for table in tables]
    together = cleaned[0]
    for table in cleaned[1:]:
        together = together.unionByName(table)
    return trials.final_params(trials.best_trial(together, direction), model_name, epochs)


def run_tuning(
    spark: SparkSession, run_id: str, model_name: str, direction: str = "minimize", base_dir: str | None = None
) -> DataFrame | None:
    """Read a run's trials from the first place they exist; write and return its parameters.

    Without a trials file there is nothing to resolve and the result is None.
    """
    base_dir = base_dir or f"runs/{run_id}"
    places = [f"{base_dir}/training/output/trials_results.csv", *reports.trial_paths(run_id)]
    table = reports.read_trials(spark, places, run_id)
    if table is None:
        return None
    cleaned = trials.clean_trials(table)
    sinks.write_jsonl(trials.trial_summary(cleaned, direction), f"{base_dir}/evaluation/trials.jsonl")
    parameters = resolve_parameters([table], model_name, direction)
    sinks.write_report(parameters, f"{base_dir}/configs/final_params.json")
    return parameters
