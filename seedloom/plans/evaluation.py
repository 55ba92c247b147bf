"""Evaluation of a finished run: prediction conversations in, one report row out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seedloom.operators import evaluation
from seedloom.session import cut_lineage
from seedloom.sources import reports, sinks


def run_evaluation(spark: SparkSession, base_dir: str, compat: bool = False) -> DataFrame:
    """Read ``evaluation/predictions.jsonl`` and the split report; write ``evaluation/metrics.json``."""
    labels = reports.read_label_list(spark, f"{base_dir}/data/data_report.json")
    predictions = reports.read_predictions(spark, f"{base_dir}/evaluation/predictions.jsonl")
    pairs = evaluation.eval_pairs(predictions, labels, compat)
    report = cut_lineage(evaluation.eval_report(pairs))
    sinks.write_report(report, f"{base_dir}/evaluation/metrics.json")
    return report
