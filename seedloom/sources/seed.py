"""Seed-file readers. Every reader yields ``row_idx, raw, is_object, defect``.

``raw`` is a ``map<string,string>`` that keeps the key order of the file, because
column mapping depends on it; schema inference would sort the keys. ``row_idx`` is
assigned before any shuffle, so it follows file order inside each file.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.functions.jsontext import is_json
from seedloom.functions.text import WHITESPACE, strip
from seedloom.sources import ranges

CORRUPT = "_corrupt_record"
MALFORMED = "malformed"
SURPLUS = "surplus_fields"


def normalize_headers(names: list[str | None]) -> list[str]:
    """Strip, lower-case, blanks to underscores; a missing header becomes ``col_{i}``."""
    return [
        name.strip().lower().replace(" ", "_") if name else f"col_{position}"
        for position, name in enumerate(names)
    ]


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a headed CSV; rows with too many fields carry ``defect='surplus_fields'``."""
    options = {"multiLine": True, "escape": '"', "encoding": "UTF-8"}
    header = spark.read.options(header=False, **options).csv(path).first()
    if header is None:
        return spark.createDataFrame([], _RAW_SCHEMA)
    names = normalize_headers(list(header))
    positions = {name: position for position, name in enumerate(names)}  # last duplicate wins
    fields = [f"f{position}" for position in range(len(names))]
    schema = ", ".join(f"{field} string" for field in [*fields, CORRUPT])
    rows = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=True, columnNameOfCorruptRecord=CORRUPT, **options)
        .csv(path)
    )
    raw = F.map_from_arrays(
        F.array(*[F.lit(name) for name in positions]),
        F.array(*[_csv_cell(fields[position]) for position in positions.values()]),
    )
    # A flagged record is either short or too long; count separators outside quotes.
    unquoted = F.regexp_replace(F.col(CORRUPT), r'"[^"]*"', "")
    too_long = F.regexp_count(unquoted, F.lit(",")) >= len(names)
    return rows.select(
        F.monotonically_increasing_id().alias("row_idx"),
        raw.alias("raw"),
        F.lit(True).alias("is_object"),
        F.when(F.coalesce(too_long, F.lit(False)), F.lit(SURPLUS)).alias("defect"),
    )


def _csv_cell(field: str) -> Column:
    # In a well-formed row Spark reads a blank cell as NULL where the file holds "".
    return F.when(F.col(CORRUPT).isNull(), F.coalesce(F.col(field), F.lit(""))).otherwise(F.col(field))


def read_seed_json(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Read files holding one JSON array each; a lone value becomes a single row.

    Ranges of a file are read by several tasks (``ranges``). A stretch of a file that is no list of
    JSON values is one malformed row; the others stay.
    """
    found = ranges.array_segments(spark, path).withColumn("text", strip("text"))
    found = found.filter((F.col("text") != "") | F.col("is_last"))
    closed = F.col("text").endswith("]")
    body = F.when(F.col("is_last") & closed, F.expr("substring(_body, 1, length(_body) - 1)")).otherwise(F.col("_body"))
    found = found.withColumn("_body", F.regexp_replace("text", r"\A[\[,]", "")).withColumn("_body", body)
    listed = F.concat(F.lit("["), F.col("_body"), F.lit("]"))
    elements = F.from_json("_listed", "array<string>", {"allowSingleQuotes": "false"})
    elements = F.transform(elements, lambda x: F.coalesce(x, F.lit("null")))
    proper = F.col("is_array") & is_json("_listed") & (closed | ~F.col("is_last"))
    lone = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(
        F.array(F.when(F.col("is_array"), strip("_body")).otherwise(F.col("text")))
    )
    values = found.withColumn("_listed", listed).select(
        "file", "record", (~proper).alias("unchecked"), (F.col("is_array") & ~proper).alias("broken"), F.when(proper, elements).otherwise(lone).alias("values")
    )
    return _object_rows(ranges.numbered(values, "values", "row_idx"), mode, "row_idx")


def read_seed_jsonl(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Read JSON lines, skipping blank ones."""
    lines = spark.read.text(path).select(F.lit(True).alias("unchecked"), strip("value").alias("value"))
    return _object_rows(lines.filter(F.col("value") != ""), mode)


_RAW_SCHEMA = "row_idx bigint, raw map<string,string>, is_object boolean, defect string"


def _object_rows(values: DataFrame, mode: str, index: str | None = None) -> DataFrame:
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}; use 'failfast' or 'quarantine'")
    looks_like_object = F.ltrim("value", F.lit(WHITESPACE)).startswith("{")
    typed = F.get(
        F.from_json(
            F.concat(F.lit("["), F.col("value"), F.lit("]")),
            "array<map<string,variant>>",
            {"allowSingleQuotes": "false"},
        ),
        F.lit(0),
    )
    malformed = F.col("unchecked") & ~is_json("value")
    if "broken" in values.columns:
        malformed = malformed | F.col("broken")
    defect = F.when(malformed, F.lit(MALFORMED))
    if mode == "failfast":
        message = F.concat(F.lit("malformed JSON row: "), F.col("value"))
        defect = F.when(malformed, F.raise_error(message)).otherwise(defect)
    return values.select(
        (F.col(index) if index else F.monotonically_increasing_id()).alias("row_idx"),
        F.when(looks_like_object, F.transform_values(typed, _scalar_text)).alias("raw"),
        looks_like_object.alias("is_object"),
        defect.cast("string").alias("defect"),
    )


def _scalar_text(_: Column, value: Column) -> Column:
    """Scalars as text; booleans spelled ``True``/``False``."""
    text = value.cast("string")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text)


_READERS = {".csv": read_seed_csv, ".json": read_seed_json, ".jsonl": read_seed_jsonl}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (file, folder or glob) exists on its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    matches = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return matches is not None and len(matches) > 0


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Choose a reader by extension; unknown extensions and missing files raise."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no seed file at {path}")
    extension = os.path.splitext(path)[1].lower()
    if extension not in _READERS:
        raise ValueError(f"unsupported seed format {extension!r}; expected one of {sorted(_READERS)}")
    return _READERS[extension](spark, path)


def read_rows(spark: SparkSession, path: str | None, schema: str = "text string, label string") -> DataFrame:
    """Read finished text/label rows for splitting; a missing path gives no rows.

    ``.json`` means array files; anything else, including a folder written by
    ``write_jsonl``, is read as splittable JSON lines.
    """
    if not path or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    array_file = path.lower().endswith(".json")
    return spark.read.schema(schema).option("multiLine", array_file).json(path)
