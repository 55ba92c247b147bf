"""Evaluation of prediction conversations.

Everything after the parse derives from one small table of (ground truth, prediction)
counts, so a run costs one scan and one map-side combined shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.columns import with_computed
from seedloom.operators.quota import UNKNOWN
from seedloom.operators.responses import parse_evaluation_response, snap_label
from seedloom.session import cut_lineage


#: Ground-truth labels a dense confusion matrix may have: four million cells in one row.
MAX_DENSE_LABELS = 2_000


def ground_truth_content(messages: Column) -> Column:
    """Content of the first assistant turn strictly between the first and the last turn."""
    between = F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 2, F.lit(0)))
    return F.get(F.filter(between, lambda turn: turn["role"] == "assistant"), F.lit(0))["content"]


def prediction_content(messages: Column) -> Column:
    """Content of the last turn if it is an assistant turn."""
    last = F.try_element_at(messages, F.lit(-1))
    return F.when(last["role"] == "assistant", last["content"])


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Ground-truth and prediction content per conversation from a flat turn table.

    Input ``conv_id, turn, role, text``. Only per-conversation minima and maxima are
    aggregated; no conversation is assembled, so a very long one stays distributed.
    """
    ends = turns.groupBy("conv_id").agg(
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
        F.max_by(F.when(F.col("role") == "assistant", F.col("text")), "turn").alias("prediction"),
    )
    inner = (
        turns.filter(F.col("role") == "assistant")
        .join(ends.select("conv_id", "first_turn", "last_turn"), "conv_id")
        .filter((F.col("turn") > F.col("first_turn")) & (F.col("turn") < F.col("last_turn")))
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("ground_truth"))
    )
    return ends.join(inner, "conv_id", "left").select("conv_id", "ground_truth", "prediction")


def eval_pairs(predictions: DataFrame, labels: list[str], compat: bool = False) -> DataFrame:
    """Add ``gt, pred, parse_status, defect`` to prediction conversations.

    A broken line, or a turn without role or content where one is needed, sets
    ``defect`` and leaves the pair out of the metrics as a whole.
    """
    roleless = F.exists("messages", lambda turn: turn["role"].isNull() | turn["content"].isNull())
    # Taken first, so that later steps carry short replies instead of whole conversations.
    staged = with_computed(
        predictions,
        {
            "_gt": ground_truth_content(F.col("messages")),
            "_pred": prediction_content(F.col("messages")),
            "_broken": F.coalesce(roleless, F.lit(False)),
        },
    )
    staged = parse_evaluation_response(staged, "_gt", "_gt_raw")
    staged = parse_evaluation_response(staged, "_pred", "_pred_raw")
    has_gt, has_pred = F.col("_gt").isNotNull(), F.col("_pred").isNotNull()
    known = F.col("defect") if "defect" in predictions.columns else F.lit(None).cast("string")
    defect = F.coalesce(known, F.when(F.col("_broken"), F.lit("broken_turn")))
    return staged.withColumns(
        {
            "gt": F.when(has_gt, snap_label("_gt_raw", labels, compat)).otherwise(UNKNOWN),
            "pred": F.when(has_pred, snap_label("_pred_raw", labels, compat)).otherwise(UNKNOWN),
            "parse_status": F.when(has_pred, F.col("_pred_raw_status")).otherwise("no_prediction"),
            "defect": defect,
        }
    ).drop("_gt", "_pred", "_broken", "_gt_raw", "_pred_raw", "_gt_raw_status", "_pred_raw_status")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """The (ground truth, prediction) count table of the usable pairs.

    ``n_json`` counts pairs whose prediction was read as JSON (null without ``parse_status``).
    """
    usable = pairs.filter(F.col("defect").isNull()) if "defect" in pairs.columns else pairs
    is_json = F.lit(None).cast("bigint")
    if "parse_status" in pairs.columns:
        is_json = F.when(F.col("parse_status") == "json", 1).otherwise(0).cast("bigint")
    return usable.groupBy("gt", "pred").agg(F.count("*").alias("n"), F.sum(is_json).alias("n_json"))


def outcome_rates(counts: DataFrame) -> DataFrame:
    """``invalid_json_rate`` (null if replies were not parsed here) and ``unknown_rate`` of all rows."""
    unknown = F.sum(F.when(F.col("pred") == UNKNOWN, F.col("n")).otherwise(0))
    rates = counts.agg(
        F.sum("n").alias("n_rows"),
        (1 - F.sum("n_json") / F.sum("n")).alias("invalid_json_rate"),
        (unknown / F.sum("n")).alias("unknown_rate"),
    )
    return rates.filter(F.col("n_rows") > 0).drop("n_rows")


def confusion_cells(counts: DataFrame) -> DataFrame:
    """``actual, predicted, n`` of the cells that occur, predictions outside the ground truth included."""
    return counts.select(F.col("gt").alias("actual"), F.col("pred").alias("predicted"), "n")


def accuracy(counts: DataFrame) -> DataFrame:
    """Share of all rows whose prediction equals the ground truth."""
    hits = F.sum(F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        (hits / F.sum("n")).alias("accuracy"),
    ).filter(F.col("n_rows") > 0)


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """``actual, predicted, n`` on the full grid of ground-truth labels, zero-filled.

    The grid is exploded from one array of the observed labels; predictions outside
    them are not part of the matrix.
    """
    grid = (
        counts.agg(F.array_sort(F.collect_set("gt")).alias("labels"))
        .select("labels", F.explode("labels").alias("actual"))
        .select("actual", F.explode("labels").alias("predicted"))
    )
    cells = counts.select(F.col("gt").alias("actual"), F.col("pred").alias("predicted"), "n")
    return grid.join(cells, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def all_label_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every label seen on either side (0 on division by 0)."""
    hit = F.when(F.col("gt") == F.col("pred"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.explode(
        F.array(
            F.struct(F.col("gt").alias("label"), F.col("n").alias("n_true"), zero.alias("n_pred"), hit.alias("tp")),
            F.struct(F.col("pred").alias("label"), zero.alias("n_true"), F.col("n").alias("n_pred"), zero.alias("tp")),
        )
    )
    summed = (
        counts.select(sides.alias("s"))
        .select("s.*")
        .groupBy("label")
        .agg(F.sum("tp").alias("tp"), F.sum("n_true").alias("support"), F.sum("n_pred").alias("n_pred"))
    )
    ratio = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    tp, support, n_pred = F.col("tp"), F.col("support"), F.col("n_pred")
    return summed.select(
        "label",
        ratio(tp, n_pred).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2.0 * tp, support + n_pred).alias("f1"),
        "support",
    )


def label_metrics(counts: DataFrame) -> DataFrame:
    """Metrics of the ground-truth labels only."""
    return all_label_metrics(counts).filter(F.col("support") > 0)


def macro_f1(counts: DataFrame) -> DataFrame:
    """Mean F1 over ground-truth and predicted labels together."""
    return (
        all_label_metrics(counts)
        .agg(F.count("*").alias("n_labels"), F.avg("f1").alias("macro_f1"))
        .filter(F.col("n_labels") > 0)
    )


def eval_report(pairs: DataFrame) -> DataFrame:
    """One-row report: accuracy, macro F1, outcome rates, per-label metrics, dense confusion matrix, labels.

    The count table is materialised, so the pairs are scanned once. A dense matrix of more than
    ``MAX_DENSE_LABELS`` ground-truth labels is no cell of a report: that raises, and
    ``confusion_cells`` has the cells that occur.
    """
    counts = cut_lineage(pair_counts(pairs))
    n_labels = counts.agg(F.count_distinct("gt")).first()[0]
    if n_labels > MAX_DENSE_LABELS:
        raise ValueError(f"{n_labels} labels are too many for a dense matrix; use confusion_cells")
    metrics = label_metrics(counts).agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("label", F.struct("precision", "recall", "f1", "support").alias("m"))))
        ).alias("label_metrics"),
        F.array_sort(F.collect_list("label")).alias("labels"),
    )
    lines = (
        confusion_matrix(counts)
        .groupBy("actual")
        .agg(F.array_sort(F.collect_list(F.struct("predicted", "n"))).alias("cells"))
        .select("actual", F.transform("cells", lambda cell: cell["n"]).alias("line"))
    )
    matrix = lines.agg(F.array_sort(F.collect_list(F.struct("actual", "line"))).alias("m")).select(
        F.transform("m", lambda row: row["line"]).alias("confusion_matrix")
    )
    return metrics.filter(F.size("labels") > 0).select(
        accuracy(counts).select("accuracy").scalar().alias("accuracy"),
        macro_f1(counts).select("macro_f1").scalar().alias("macro_f1"),
        outcome_rates(counts).select("invalid_json_rate").scalar().alias("invalid_json_rate"),
        outcome_rates(counts).select("unknown_rate").scalar().alias("unknown_rate"),
        "label_metrics",
        matrix.scalar().alias("confusion_matrix"),
        "labels",
    )
