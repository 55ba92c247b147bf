"""Column helpers that shape plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used.

    The optimizer copies a projected expression into every filter and expression that
    refers to it; for parsers that means parsing again for each use and generated code
    past the method size limit. Exploding a one-element array keeps the value in place
    and stays inside whole-stage code generation.
    """
    kept = [name for name in df.columns if name not in columns]
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.explode(F.array(values)).alias("_computed")).select(*kept, "_computed.*")
