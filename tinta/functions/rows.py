"""Arrays to rows.

A plain ``explode`` makes the optimizer add a filter on the array's size, which computes a costly array
expression again (and pushes it down to the scan). The outer form with a filter on its result gives
the same rows and computes the array once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_rows(df: DataFrame, array: Column, name: str, *kept: str | Column) -> DataFrame:
    """One row per array element; elements are never NULL."""
    return df.select(*kept, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def posexplode_rows(df: DataFrame, array: Column, position: str, name: str, *kept: str | Column) -> DataFrame:
    """The same with the 0-based position of the element."""
    return df.select(*kept, F.posexplode_outer(array).alias(position, name)).where(F.col(name).isNotNull())
