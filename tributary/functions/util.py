"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)
