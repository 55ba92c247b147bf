"""Exactly sized, stratified, repeatable train / validation / test splits."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.functions.text import order_key
from seedloom.operators.intake import label_distribution
from seedloom.operators.ranking import split_by_cuts

TRAIN, VALIDATION, TEST = "train", "validation", "test"
_TEMP = "temp"
_ALL = "all"
_MAX_LABELS = 100_000


def union_sources(synthetic: DataFrame, seed: DataFrame) -> DataFrame:
    """Bag union of generated and seed rows with their ``source``."""
    return synthetic.withColumn("source", F.lit("synthetic")).unionByName(seed.withColumn("source", F.lit("seed")))


def label_counts(rows: DataFrame) -> dict[str, int]:
    """Rows per label on the driver: one entry per category, guarded by a size check."""
    counts = label_distribution(rows).limit(_MAX_LABELS + 1).collect()
    if len(counts) > _MAX_LABELS:
        raise ValueError(f"more than {_MAX_LABELS} distinct labels; stratification needs categories")
    return {row["label"]: row["n"] for row in counts}


def stratifiable(rows: DataFrame) -> DataFrame:
    """One row: row count, label count, smallest label and whether strata can be halved."""
    return label_distribution(rows).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count("*").alias("n_labels"),
        F.min("n").alias("smallest_label"),
        F.coalesce(F.min("n") >= 2, F.lit(False)).alias("stratifiable"),
    )


def is_stratifiable(counts: Mapping[str, int]) -> bool:
    return bool(counts) and min(counts.values()) >= 2


def part_sizes(total: int, second_fraction: float) -> tuple[int, int]:
    """Sizes of the first and second part; the second is rounded up (double arithmetic)."""
    second = math.ceil(total * second_fraction)
    return total - second, second


def allocate(counts: Mapping[str, int], size: int) -> dict[str, int]:
    """Share ``size`` slots among labels: floors first, then largest remainders, ties by label."""
    total = sum(counts.values())
    exact = {label: n / total * size for label, n in counts.items()}
    share = {label: math.floor(value) for label, value in exact.items()}
    by_remainder = sorted(counts, key=lambda label: (share[label] - exact[label], label))
    for label in by_remainder[: size - sum(share.values())]:
        share[label] += 1
    return share


def first_part_quota(counts: Mapping[str, int], second_fraction: float) -> dict[str, int]:
    """Rows of each label that go to the first part of a stratified two-way split."""
    sizes = part_sizes(sum(counts.values()), second_fraction)
    if min(sizes) < len(counts):
        raise ValueError(f"a part of {min(sizes)} rows cannot hold all {len(counts)} labels")
    return allocate(counts, sizes[0])


def _keyed(rows: DataFrame, id_col: str, seed: object) -> DataFrame:
    return rows.withColumns(
        {
            "_key": F.concat_ws(":", order_key(seed, id_col), F.col(id_col).cast("string")),
            "_stratum": F.coalesce("label", F.lit("unknown")),
            "_one": F.lit(_ALL),
        }
    )


def _finish(rows: DataFrame) -> DataFrame:
    return rows.drop("_key", "_stratum", "_one")


def halve_seed(seed_rows: DataFrame, id_col: str, seed: object) -> DataFrame:
    """Split seed rows half to validation, half to test; a single row goes to validation."""
    counts = label_counts(seed_rows)
    total = sum(counts.values())
    keyed = _keyed(seed_rows, id_col, seed)
    if total < 2:
        return _finish(keyed.withColumn("split", F.lit(VALIDATION)))
    if is_stratifiable(counts):
        cuts = {label: [n] for label, n in first_part_quota(counts, 0.5).items()}
        return _finish(split_by_cuts(keyed, "_stratum", "_key", cuts, [VALIDATION, TEST]))
    cuts = {_ALL: [part_sizes(total, 0.5)[0]]}
    return _finish(split_by_cuts(keyed, "_one", "_key", cuts, [VALIDATION, TEST]))


def split_seed_priority(synthetic: DataFrame, seed_rows: DataFrame, id_col: str, seed: object = 0) -> DataFrame:
    """Seed rows fill validation and test; all generated rows train."""
    halves = halve_seed(seed_rows, id_col, seed).withColumn("source", F.lit("seed"))
    training = synthetic.withColumns({"source": F.lit("synthetic"), "split": F.lit(TRAIN)})
    return training.unionByName(halves)


def split_three_way(
    rows: DataFrame, id_col: str, val_ratio: float = 0.1, test_ratio: float = 0.1, seed: object = 0
) -> DataFrame:
    """Split generated rows three ways by ratio; strata are kept wherever they can be."""
    counts = label_counts(rows)
    total = sum(counts.values())
    if total == 0:
        raise ValueError("no rows to split")
    held_out = val_ratio + test_ratio
    keyed = _keyed(rows, id_col, seed).withColumn("source", F.lit("synthetic"))
    if not is_stratifiable(counts):
        train, rest = part_sizes(total, held_out)
        cuts = {_ALL: [train, train + part_sizes(rest, 0.5)[0]]}
        return _finish(split_by_cuts(keyed, "_one", "_key", cuts, [TRAIN, VALIDATION, TEST]))

    train = first_part_quota(counts, held_out)
    left = {label: counts[label] - train[label] for label in counts if counts[label] > train[label]}
    test_share = test_ratio / held_out
    if is_stratifiable(left):
        validation = first_part_quota(left, test_share)
        cuts = {label: [train[label], train[label] + validation.get(label, 0)] for label in counts}
        return _finish(split_by_cuts(keyed, "_stratum", "_key", cuts, [TRAIN, VALIDATION, TEST]))

    # The held-out rows have a label with a single row: split them as one stratum.
    cuts = {label: [train[label]] for label in counts}
    staged = split_by_cuts(keyed, "_stratum", "_key", cuts, [TRAIN, _TEMP])
    temp = staged.filter(F.col("split") == _TEMP).drop("split")
    validation = part_sizes(sum(left.values()), test_share)[0]
    halves = split_by_cuts(temp, "_one", "_key", {_ALL: [validation]}, [VALIDATION, TEST])
    return _finish(staged.filter(F.col("split") == TRAIN).unionByName(halves))


def execute_split(
    synthetic: DataFrame,
    seed_rows: DataFrame,
    id_col: str,
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    seed: object = 0,
) -> DataFrame | None:
    """Seed-priority split when there are seed rows, else three-way; None without any rows."""
    if not seed_rows.isEmpty():
        return split_seed_priority(synthetic, seed_rows, id_col, seed)
    if synthetic.isEmpty():
        return None
    return split_three_way(synthetic, id_col, val_ratio, test_ratio, seed)


def split_distribution(rows: DataFrame) -> DataFrame:
    """Rows per split and label."""
    label = F.coalesce("label", F.lit("unknown")).alias("label")
    return rows.groupBy("split", label).agg(F.count("*").alias("n"))


def split_report(rows: DataFrame, run_id: str, task_type: str = "classification") -> DataFrame:
    """One row: counts per split, labels, and label counts per split.

    ``rows`` are the split rows; everything derives from the small (split, label) table.
    """
    table = split_distribution(rows)

    def size_of(split: str | None):
        counted = F.col("n") if split is None else F.when(F.col("split") == split, F.col("n"))
        return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")

    def counts_of(split: str):
        pairs = F.array_sort(F.collect_list(F.when(F.col("split") == split, F.struct("label", "n"))))
        return F.map_from_entries(pairs)

    return table.agg(
        F.lit(run_id).alias("run_id"),
        F.lit(task_type).alias("task_type"),
        size_of(None).alias("total_count"),
        size_of(TRAIN).alias("train_count"),
        size_of(VALIDATION).alias("val_count"),
        size_of(TEST).alias("test_count"),
        F.array_sort(F.collect_set(F.when(F.col("label") != "", F.col("label")))).alias("labels"),
        F.create_map(
            F.lit(TRAIN), counts_of(TRAIN), F.lit(VALIDATION), counts_of(VALIDATION), F.lit(TEST), counts_of(TEST)
        ).alias("label_distribution"),
    )
