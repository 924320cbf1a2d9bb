"""Dates given as text or as a column (for instance a scalar sub-query)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")
