"""Readers for reports, tuning trials and prediction conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.functions.jsontext import is_json
from seedloom.functions.text import strip
from seedloom.sources import ranges
from seedloom.sources.seed import path_exists

MESSAGES = "array<struct<role:string,content:string>>"

EVALUATION_REPORT = (
    "accuracy double, macro_f1 double, invalid_json_rate double, unknown_rate double, "
    "label_metrics map<string,struct<precision:double,recall:double,f1:double,support:bigint>>, "
    "confusion_matrix array<array<bigint>>, labels array<string>"
)


def read_label_list(spark: SparkSession, path: str) -> list[str]:
    """The ``labels`` list of a split report; a missing or broken report gives ``[]``."""
    if not path_exists(spark, path):
        return []
    report = spark.read.schema("labels array<string>").option("multiLine", True).json(path).first()
    return list(report["labels"]) if report is not None and report["labels"] else []


def read_evaluation_report(spark: SparkSession, path: str) -> DataFrame:
    """Read evaluation reports, filling absent fields with empty defaults."""
    reports = spark.read.schema(EVALUATION_REPORT).option("multiLine", True).json(path)
    return fill_evaluation_defaults(reports)


def fill_evaluation_defaults(reports: DataFrame) -> DataFrame:
    schema = reports.schema
    defaults = {
        "accuracy": F.lit(0.0),
        "macro_f1": F.lit(0.0),
        "invalid_json_rate": F.lit(0.0),
        "unknown_rate": F.lit(0.0),
        "label_metrics": F.create_map(),
        "confusion_matrix": F.array(),
        "labels": F.array(),
    }
    return reports.withColumns(
        {name: F.coalesce(F.col(name), empty.cast(schema[name].dataType)) for name, empty in defaults.items()}
    )


#: A CSV line that is whole by itself: fields without quotes, or quoted ones with doubled quotes inside.
_FIELD = r'(?:"(?:[^"\r]++|"")*+"|[^",\r]*+)'
_WHOLE_LINE = rf"\A{_FIELD}(?:,{_FIELD})*+\z"


def read_trials(spark: SparkSession, candidates: list[str], run_id: str) -> DataFrame | None:
    """Read the first existing trials CSV of ``candidates`` as all-string columns, numbered in file order.

    Files whose lines are all whole records are read by several tasks each; one with line breaks
    inside quotes is read by one.
    """
    for path in candidates:
        if path_exists(spark, path):
            line = F.col("value")
            whole = (line.rlike(_WHOLE_LINE) & (F.trim(line) != "")) | (line == "")
            lines = spark.read.option("lineSep", "\n").text(path)
            broken = not lines.filter(~whole).isEmpty()
            rows = spark.read.option("header", True).option("multiLine", broken).option("escape", '"').csv(path)
            names = rows.columns
            numbered = ranges.in_file_order(
                ranges.with_place(rows.select(F.struct("*").alias("_row"), "_metadata")).drop("_metadata"), "row_idx"
            )
            return numbered.select(F.lit(run_id).alias("run_id"), "row_idx", *[F.col("_row")[name].alias(name) for name in names])
    return None


def trial_paths(run_id: str) -> list[str]:
    """Places a tuning run may leave its trials table, in order of preference."""
    # File name and folders.
    name = "trials_results.csv"
    return [f"runs/{run_id}/training/output/{name}", f"output/{name}", f"runs/{run_id}/output/{name}"]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Conversation lines as ``row_idx, messages, defect``; broken lines are flagged.

    ``row_idx`` counts the lines that are not blank, over all splits and files by name.
    """
    lines = ranges.with_place(spark.read.text(path).filter(strip("value") != ""))
    return ranges.in_file_order(lines, "row_idx").select(
        "row_idx",
        conversation(F.col("value")).alias("messages"),
        F.when(~is_json("value"), F.lit("malformed")).alias("defect"),
    )


def conversation(line: Column) -> Column:
    """The ``messages`` array of a JSON conversation line, NULL when the line is broken."""
    parsed = F.from_json(line, f"messages {MESSAGES}", {"allowSingleQuotes": "false"})
    return F.when(is_json(line), F.coalesce(parsed["messages"], F.array().cast(MESSAGES)))
