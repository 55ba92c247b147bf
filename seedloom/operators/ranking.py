"""Exact ranks inside large groups without one task per group.

A group (a label) can hold a third of all rows, so a window over the group would put
that third into one task. Order keys are md5 hex strings, hence evenly spread: a
histogram over their prefixes locates any rank, and only the rows of the prefix that
holds the rank are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 3
LEAF_ROWS = 500_000


def dense_index(rows: DataFrame, group: str, key: str, name: str, digits: int = PREFIX_DIGITS) -> DataFrame:
    """Add a 0-based position of each row inside its group, ordered by ``key``.

    The window is keyed by (group, key prefix), so the work splits 16**digits ways per
    group; the offsets of the prefixes come from a small pre-aggregated table.
    """
    prefix = F.substring(F.col(key), 1, digits)
    sizes = rows.groupBy(group, prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, "_prefix", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(group, "_prefix").orderBy(key)
    return (
        rows.withColumn("_prefix", prefix)
        .join(offsets, [group, "_prefix"])
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_prefix", "_offset")
    )


def cutoff_keys(
    rows: DataFrame,
    group: str,
    key: str,
    cuts: Mapping[str, Sequence[int]],
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """For each group and cut size ``n``, the key of the group's ``n``-th row.

    ``cuts`` maps a group to non-decreasing sizes. Result columns are ``group, cut,
    cutoff`` with ``cut`` the position in the list; sizes below 1 have no row. The
    histogram is refined until the prefix holding a cut has at most ``leaf_rows`` rows.
    """
    spark = rows.sparkSession
    keyed = rows.select(group, key)
    wanted = [(name, cut, "", int(n)) for name, sizes in cuts.items() for cut, n in enumerate(sizes) if n > 0]
    schema = f"`{group}` string, cut int, prefix string, n_left bigint"
    digits = 0
    located = wanted
    while located:
        digits += PREFIX_DIGITS
        target = F.broadcast(spark.createDataFrame(located, schema))  # one row per label and cut
        located_size = _locate(keyed, target, group, key, digits).collect()
        located = [tuple(row)[:4] for row in located_size]
        if max(row["size"] for row in located_size) <= leaf_rows or digits >= 30:
            break
    if not located:
        return spark.createDataFrame([], f"`{group}` string, cut int, cutoff string")
    target = F.broadcast(spark.createDataFrame(located, schema))
    boundary = keyed.withColumn("prefix", F.substring(key, 1, digits)).join(target, [group, "prefix"])
    order = Window.partitionBy(group, "cut").orderBy(key)
    return (
        boundary.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == F.col("n_left"))
        .select(group, "cut", F.col(key).alias("cutoff"))
    )


def _locate(keyed: DataFrame, target: DataFrame, group: str, key: str, digits: int) -> DataFrame:
    """Narrow every cut to the key prefix, ``PREFIX_DIGITS`` longer, that holds it."""
    rows = keyed.withColumn("prefix", F.substring(key, 1, digits - PREFIX_DIGITS)).join(target, [group, "prefix"])
    longer = F.substring(F.col(key), 1, digits)
    sizes = rows.groupBy(group, "cut", "n_left", longer.alias("longer")).agg(F.count("*").alias("size"))
    order = Window.partitionBy(group, "cut").orderBy("longer")
    reached = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        sizes.withColumn("reached", reached)
        .filter((F.col("reached") >= F.col("n_left")) & (F.col("reached") - F.col("size") < F.col("n_left")))
        .select(
            group,
            "cut",
            F.col("longer").alias("prefix"),
            (F.col("n_left") - F.col("reached") + F.col("size")).alias("n_left"),
            "size",
        )
    )


def split_by_cuts(
    rows: DataFrame, group: str, key: str, cuts: Mapping[str, Sequence[int]], names: Sequence[str]
) -> DataFrame:
    """Add ``split``: rows up to the first cut get ``names[0]`` and so on; the rest the last name.

    The cutoffs are a handful of keys per group, so the final pass is map-only.
    """
    cutoffs = cutoff_keys(rows, group, key, cuts).collect()
    by_group: dict[str, list[str | None]] = {name: [""] * (len(names) - 1) for name in cuts}
    for row in cutoffs:
        by_group[row[group]][row["cut"]] = row["cutoff"]
    if len(by_group) == 1:
        located = rows.withColumn("_cutoffs", F.lit(next(iter(by_group.values()))))
    else:
        schema = f"`{group}` string, _cutoffs array<string>"
        table = rows.sparkSession.createDataFrame(list(by_group.items()), schema)
        located = rows.join(F.broadcast(table), group)  # one row per label, counted by the caller
    choice: Column = F.lit(names[-1])
    for position in range(len(names) - 2, -1, -1):
        below = F.col(key) <= F.get("_cutoffs", F.lit(position))
        choice = F.when(below, names[position]).otherwise(choice)
    return located.withColumn("split", choice).drop("_cutoffs")
