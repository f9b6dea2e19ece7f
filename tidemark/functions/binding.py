"""Computing an expression once where it is used many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row.

    A filter on a plain column is pushed below its projection and repeats the
    expression, so a JSON text would be parsed once per condition. Filters on
    generated columns stay above.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
