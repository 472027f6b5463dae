"""Keeping a costly column from being computed more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, computed once for everything that refers to it.

    The optimiser copies an ordinary projected expression into each filter and projection
    above it. A generator of one row per row is not copied.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))
