"""Values that are computed once a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name`` = ``value``, computed once a row.

    A filter on a projected column is pushed below the projection, where each use
    of the column evaluates its expression again.  Nothing is pushed below or
    merged with a generator, so the value is the one element of an exploded array."""
    return df.withColumn(name, F.explode(F.array(value)))
