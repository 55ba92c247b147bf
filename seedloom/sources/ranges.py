"""Ranges of one file read by several tasks where records are not lines.

Spark's text reader splits a file at any separator. Pieces between separators keep their file,
the offset of their split and their place in it. What a piece means depends on what stands before
it (inside quotes or not, how deep in brackets), so each piece says what it would do in either
case and a prefix scan settles which: sums per split first (a row per split), then running sums
inside a split. No file passes through one task, and the scans read a few numbers per piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedloom.session import cut_lineage, ensure_checkpoint_dir

_PLACE = ["file", "start", "place"]
_RECORDS_PER_RUN = 65_536


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, start, place, piece, file_size``: text between separators; ``start`` is the split's offset."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),  # grows with the offset inside a split
        F.col("value").alias("piece"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def running(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """Add the sum of ``amount`` over all pieces of the file before each one."""
    staged = rows.withColumn("_amount", amount)
    sums = staged.groupBy("file", "start").agg(F.sum("_amount").alias("_sum"))
    before_split = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", "start", F.coalesce(F.sum("_sum").over(before_split), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("file", "start").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    found = staged.join(offsets, ["file", "start"]).withColumn(
        name, F.col("_offset") + F.coalesce(F.sum("_amount").over(inside), F.lit(0))
    )
    return cut_lineage(found.drop("_amount", "_offset"))


def with_place(rows: DataFrame) -> DataFrame:
    """Add ``file, start, place`` of rows just read from files; ``place`` counts up inside a task."""
    return rows.withColumns(
        {
            "file": F.col("_metadata.file_path"),
            "start": F.col("_metadata.file_block_start"),
            "place": F.monotonically_increasing_id(),
        }
    )


def in_file_order(rows: DataFrame, index: str) -> DataFrame:
    """Number rows with ``file, start, place`` without gaps, over files by name; ``place`` has to be without
    gaps inside a split. The rows are read twice: for a count per split, and for themselves."""
    splits = rows.groupBy("file", "start").agg(F.count("*").alias("_n"), F.min("place").alias("_least"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    offsets = cut_lineage(splits.select("file", "start", "_least", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    placed = rows.join(F.broadcast(offsets), ["file", "start"])
    number = F.col("_before") + F.col("place") - F.col("_least")
    return placed.withColumn(index, number).drop("file", "start", "place", "_least", "_before")


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _table(rows: DataFrame) -> DataFrame:
    """Rows as Parquet in the shared folder, so that scans read the columns they need."""
    path = f"{ensure_checkpoint_dir(rows.sparkSession)}/pieces-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def array_segments(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, text, is_array, is_last``: stretches of JSON files, each up to the end of one
    top-level object; the last one of a file holds what follows its last object.

    A file that starts with a bracket is an array. Elements that are no objects go with the object
    behind them, so an array of very many plain values and no object is one stretch.
    """
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    # Outside of strings, if the piece starts outside of one, or inside.
    outside = F.regexp_replace(bare, r'(?s)"[^"]*("|\z)', "")
    behind = F.regexp_replace(F.regexp_replace(bare, r'(?s)\A[^"]*("|\z)', ""), r'(?s)"[^"]*("|\z)', "")
    quotes = count_of(bare, '"') % 2
    table = _table(
        pieces(spark, path, "}").select(
            *_PLACE,
            "piece",
            "file_size",
            (F.octet_length("piece") + 1).alias("size"),
            quotes.alias("quotes"),
            (count_of(outside, "{[") - count_of(outside, "]")).alias("opened"),
            (count_of(behind, "{[") - count_of(behind, "]")).alias("opened_behind"),
            F.ltrim("piece").startswith("[").alias("bracket"),
        )
    )
    files = table.groupBy("file").agg(
        (F.sum("size") > F.first("file_size")).alias("_open"),  # no separator behind the last piece
        F.max(F.struct("start", "place")).alias("_last"),
        F.min_by("bracket", F.struct("start", "place")).alias("is_array"),
    )
    rows = running(table.drop("piece", "size", "file_size", "bracket"), F.col("quotes"), "before")
    inside = F.col("before") % 2 == 1
    last = F.struct("start", "place") == F.col("_last")
    # The separator closes an object unless it stands in a string, or is not there.
    closes = ((F.col("before") + F.col("quotes")) % 2 == 0) & ~(last & F.col("_open"))
    rows = rows.join(files, "file").select(
        *_PLACE,
        closes.cast("int").alias("closes"),
        F.when(inside, F.col("opened_behind")).otherwise(F.col("opened")).alias("opened"),
        (last & F.col("_open")).alias("unended"),
        F.when(F.col("is_array"), 1).otherwise(0).alias("top"),
    )
    steps = F.col("opened") - F.col("closes")
    rows = running(rows, steps, "depth")
    border = ((F.col("closes") == 1) & (F.col("depth") + steps <= F.col("top"))).cast("int")
    rows = running(rows, border, "record").select(*_PLACE, "record", "unended")
    ordered = F.array_sort(F.collect_list(F.struct("start", "place", "piece")))
    whole = table.select(*_PLACE, "piece").join(rows, _PLACE)
    joined = whole.groupBy("file", "record").agg(
        F.array_join(F.transform(ordered, lambda x: x["piece"]), "}").alias("text"), F.max("unended").alias("unended")
    )
    ends = joined.groupBy("file").agg(F.max("record").alias("_end"))
    return joined.join(ends, "file").join(files.select("file", "is_array"), "file").select(
        "file",
        "record",
        F.when(F.col("unended"), F.col("text")).otherwise(F.concat("text", F.lit("}"))).alias("text"),
        "is_array",
        (F.col("record") == F.col("_end")).alias("is_last"),
    )


def numbered(records: DataFrame, values: str, index: str) -> DataFrame:
    """Explode the array ``values`` of ``file, record`` rows; ``index`` counts over files by name and records."""
    run = F.expr(f"record div {_RECORDS_PER_RUN}")
    staged = cut_lineage(records.withColumns({"start": run, "place": F.col("record")}))
    placed = running(staged, F.coalesce(F.size(values), F.lit(0)), "_first")
    totals = staged.groupBy("file").agg(F.sum(F.size(values)).alias("_n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = totals.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_files"))
    return (
        placed.join(offsets, "file")
        .select("*", F.posexplode(values).alias("_at", "value"))
        .withColumn(index, F.col("_files") + F.col("_first") + F.col("_at"))
        .drop("start", "place", "_first", "_files", "_at", values)
    )
