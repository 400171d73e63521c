"""Sort keys with a stated position for NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_key(name: str) -> Column:
    """``"-name"`` sorts descending; NULL comes last either way."""
    if name.startswith("-"):
        return F.col(name[1:]).desc_nulls_last()
    return F.col(name).asc_nulls_last()


def order_rows(frame: DataFrame, *names: str) -> DataFrame:
    return frame.orderBy(*[sort_key(name) for name in names])


def top_rows(frame: DataFrame, k: int, *names: str) -> DataFrame:
    """First k rows of that order; Spark keeps k rows per task and never sorts the rest."""
    return order_rows(frame, *names).limit(k)


def preview(frame: DataFrame, rows: int = 20) -> DataFrame:
    """A bounded look at a result, in its own order."""
    return frame.limit(rows)


def with_place(frame: DataFrame, *names: str) -> DataFrame:
    """Rows of a grouped result with their place in that order, from 1."""
    place = F.row_number().over(Window.orderBy(*[sort_key(name) for name in names]))
    return frame.withColumn("place", place)
