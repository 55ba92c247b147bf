"""Chat-format training rows, their verification and a content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.functions.jsontext import last_value, parse_objects, sole_object
from seedloom.operators.prompts import DEFAULT_ROLE, DEFAULT_TASK, classify_user, label_target, message


def sft_messages(
    rows: DataFrame, labels: list[str], role: str = DEFAULT_ROLE, task: str = DEFAULT_TASK
) -> DataFrame:
    """Add ``messages`` (system, user, assistant) to text/label rows.

    ``labels`` are those of the whole dataset, not of one split.
    """
    conversation = F.array(
        message("system", F.lit(role)),
        message("user", classify_user(F.col("text"), labels, task)),
        message("assistant", label_target(F.col("label"))),
    )
    return rows.withColumn("messages", conversation)


def sft_verify(conversations: DataFrame, labels: list[str]) -> DataFrame:
    """Add ``target_label`` re-read from the assistant turn and ``target_ok``."""
    target = F.get("messages", F.size("messages") - 1)
    label = F.when(target["role"] == "assistant", last_value(sole_object(parse_objects(target["content"])), "label"))
    known = F.array_contains(F.lit(labels), F.col("target_label")) if labels else F.lit(False)
    return conversations.withColumn("target_label", label).withColumn(
        "target_ok", F.coalesce(known, F.lit(False))
    )


def dataset_hash(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Order-independent content hash: the sum of per-row md5 words, and the row count.

    Sums combine on the map side, so any number of rows reduces to one row per partition.
    """
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    digest = F.md5(F.concat_ws("\x1f", *cells))
    word = lambda place: F.conv(F.substring(digest, place, 8), 16, 10).cast("decimal(20,0)")
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(word(1)), F.lit(0)).cast("string").alias("hash_high"),
        F.coalesce(F.sum(word(9)), F.lit(0)).cast("string").alias("hash_low"),
    )
