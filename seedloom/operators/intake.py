"""Intake: column mapping, validation with quarantine, and label reports.

Input rows are ``row_idx bigint, raw map<string,string>, is_object boolean`` with an
optional ``defect string`` set by a reader.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.columns import with_computed
from seedloom.functions.jsontext import entries_for
from seedloom.functions.text import strip

# Column names recognised as text and as label.
TEXT_NAMES = ("text", "content", "document", "sentence", "input", "review", "body")
LABEL_NAMES = ("label", "category", "class", "target", "output", "tag")

# Reject reasons in the order they are tested.
NOT_OBJECT = "not_object"
MISSING_TEXT = "missing_text"
MISSING_LABEL = "missing_label"


def map_columns(keys: Iterable[str]) -> tuple[str, str]:
    """Pick the text and label keys; both fall back to the plain names if one is missing."""
    keys = list(keys)

    def best(names: tuple[str, ...]) -> str | None:
        folded = [(key, str(key).lower().strip()) for key in keys]
        exact = (key for key, low in folded if low in names)
        partial = (key for key, low in folded if any(name in low for name in names))
        return next(exact, None) or next(partial, None)

    text_key, label_key = best(TEXT_NAMES), best(LABEL_NAMES)
    return (text_key, label_key) if text_key and label_key else ("text", "label")


def discover_columns(raw: DataFrame, in_file_order: bool = False) -> tuple[str, str]:
    """Map columns from the first non-empty object row.

    With ``in_file_order`` (frames straight from a reader) Spark stops at the first
    partition that has a row; otherwise one narrow pass finds the lowest ``row_idx``.
    """
    usable = raw.filter(F.col("is_object") & (F.size("raw") > 0))
    keys = F.map_keys("raw")
    if in_file_order:
        row = usable.select(keys.alias("keys")).first()
    else:
        row = usable.agg(F.min_by(keys, "row_idx").alias("keys")).first()
    return map_columns(row["keys"] if row is not None and row["keys"] else [])


def _field(key: str, null_as_literal: bool) -> Column:
    """Trimmed value under ``key``; absent keys give ``""``, NULL values stay missing."""
    entry = F.try_element_at(entries_for(F.col("raw"), key), F.lit(-1))
    present = F.coalesce(entry["value"], F.lit("None")) if null_as_literal else entry["value"]
    return strip(F.when(entry.isNull(), F.lit("")).otherwise(present))


def map_and_validate(
    raw: DataFrame, text_key: str, label_key: str, null_as_literal: bool = False
) -> DataFrame:
    """Add ``text, label, extra, reject_reason`` (NULL reason means the row is valid)."""
    defect = F.col("defect") if "defect" in raw.columns else F.lit(None).cast("string")
    rows = with_computed(
        raw, {"text": _field(text_key, null_as_literal), "label": _field(label_key, null_as_literal)}
    )
    reason = (
        F.when(~F.col("is_object"), NOT_OBJECT)
        .when(F.coalesce("text", F.lit("")) == "", MISSING_TEXT)
        .when(F.coalesce("label", F.lit("")) == "", MISSING_LABEL)
    )
    taken = [text_key, label_key, "text", "label"]
    extra = F.map_filter("raw", lambda key, _: ~key.isin(taken))
    return rows.select(
        "row_idx",
        "raw",
        "text",
        "label",
        F.transform_values(extra, lambda _, value: F.coalesce(value, F.lit(""))).alias("extra"),
        F.coalesce(defect, reason).alias("reject_reason"),
    )


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).select("row_idx", "text", "label", "extra")


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull()).select("row_idx", "raw", "reject_reason")


def label_distribution(rows: DataFrame) -> DataFrame:
    """Rows per label; a missing label counts as ``unknown``."""
    label = F.coalesce("label", F.lit("unknown")).alias("label")
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def detected_labels(rows: DataFrame) -> DataFrame:
    """One row holding the distinct non-empty labels in code-point order."""
    return rows.agg(F.array_sort(F.collect_set(F.when(F.col("label") != "", F.col("label")))).alias("labels"))


def label_list(rows: DataFrame, limit: int = 100_000) -> list[str]:
    """Labels on the driver. The category list goes into every prompt, so it is small;
    ``limit`` guards against a mis-mapped column."""
    names = [row["label"] for row in rows.select("label").distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise ValueError(f"more than {limit} distinct labels; is the label column mapped correctly?")
    return sorted(name for name in names if name)


def intake_metadata(checked: DataFrame) -> DataFrame:
    """One report row: raw, valid and dropped counts, labels and their distribution.

    Counting per label first keeps the second aggregation down to a row per label.
    """
    valid = F.col("reject_reason").isNull()
    per_label = checked.groupBy(F.when(valid, F.col("label")).alias("label")).agg(F.count("*").alias("n"))
    named = F.when(F.col("label").isNotNull(), F.struct("label", "n"))
    ordered = F.array_sort(F.collect_list(named))
    count = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
    return per_label.agg(
        count("n").alias("total_raw_rows"),
        count(F.when(F.col("label").isNotNull(), F.col("n"))).alias("total_valid_rows"),
        count(F.when(F.col("label").isNull(), F.col("n"))).alias("total_dropped_rows"),
        F.transform(ordered, lambda entry: entry["label"]).alias("unique_labels"),
        F.map_from_entries(ordered).alias("label_distribution"),
    )


def label_conflicts(rows: DataFrame) -> DataFrame:
    """Texts that carry more than one distinct label: ``text_digest, n_labels, first_row_idx, n_rows``.

    Grouping on a digest keeps whole texts out of the shuffle. Counting per (text, label)
    first leaves one partial row per partition of a text copied into a third of all rows,
    and both steps are hash aggregations.
    """
    per_label = rows.groupBy(F.sha2("text", 256).alias("text_digest"), "label").agg(
        F.min("row_idx").alias("first"), F.count("*").alias("n")
    )
    return (
        per_label.groupBy("text_digest")
        .agg(F.count("label").alias("n_labels"), F.min("first").alias("first_row_idx"), F.sum("n").alias("n_rows"))
        .filter(F.col("n_labels") > 1)
    )


def intake_gate(
    checked: DataFrame, include_unknown: bool = True, unknown_ratio: float = 0.1
) -> DataFrame:
    """One row of dataset checks, with ``passed`` true when all of them hold."""
    valid = F.col("reject_reason").isNull()
    per_label = checked.groupBy(F.when(valid, F.col("label")).alias("label")).agg(F.count("*").alias("n"))
    conflicts = label_conflicts(checked.filter(valid)).agg(F.count("*").alias("n_conflicts"))
    n_conflicts = conflicts.scalar()
    ratio_ok = unknown_ratio == 0 if not include_unknown else 0.0 <= unknown_ratio <= 0.3
    counts = per_label.agg(
        F.count("label").alias("n_labels"),
        F.coalesce(F.sum(F.when(F.col("label").isNull(), F.col("n"))), F.lit(0)).alias("n_rejected"),
    )
    return counts.select(
        "n_labels",
        "n_rejected",
        n_conflicts.alias("n_conflicts"),
        (F.col("n_labels") >= 2).alias("enough_labels"),
        (F.col("n_rejected") == 0).alias("all_rows_complete"),
        F.lit(ratio_ok).alias("unknown_ratio_ok"),
    ).withColumn(
        "passed",
        F.col("enough_labels")
        & F.col("all_rows_complete")
        & F.col("unknown_ratio_ok")
        & (F.col("n_conflicts") == 0),
    )
