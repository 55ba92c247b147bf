"""Writers. Outputs stay partitioned: a path is a folder of part files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, UTF-8, non-ASCII characters unescaped."""
    df.select(F.to_json(F.struct("*"), _KEEP_NULLS).alias("value")).write.mode(mode).text(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One compact JSON array a part file, in the order of the rows; absent fields are left out."""

    def brackets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening = "["
        for batch in batches:
            if batch.num_rows:
                first, *rest = batch.column("value").to_pylist()
                values = [opening + first, *["," + value for value in rest]]
                opening = ","
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["value"])
        if opening == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    objects = df.select(F.to_json(F.struct("*")).alias("value"))
    objects.mapInArrow(brackets, "value string").write.mode(mode).option("lineSep", " ").text(path)


def write_flat_jsonl(df: DataFrame, columns: list[str], extra: str, path: str, mode: str = "overwrite") -> None:
    """JSON lines of string ``columns`` and, beside them, the entries of the map ``extra``.

    A column wins over an entry of the same name.
    """
    own = F.create_map(*[part for name in columns for part in (F.lit(name), F.col(name))])
    rest = F.map_filter(F.coalesce(extra, F.create_map().cast("map<string,string>")), lambda key, _: ~key.isin(columns))
    df.select(F.to_json(F.map_concat(own, rest), _KEEP_NULLS).alias("value")).write.mode(mode).text(path)


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write all splits in one pass as ``path/split=<name>/`` folders of JSON lines."""
    columns = [name for name in df.columns if name != "split"]
    line = F.to_json(F.struct(*columns), _KEEP_NULLS).alias("value")
    df.select(line, "split").write.mode(mode).partitionBy("split").text(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row report as a single JSON line."""
    df.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_ledger(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the acceptance ledger as Parquet, one folder per status for pruning."""
    df.write.mode(mode).partitionBy("status").parquet(path)
