"""Exact money arithmetic: sums run on decimals, results leave as doubles."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    return col(c).cast("decimal(18,4)")


def money_sum(c: str | Column) -> Column:
    """Order-independent sum, so a retried or re-partitioned job gives the same value."""
    return F.sum(money(c)).cast("double")


def money_avg(c: str | Column) -> Column:
    return money_sum(c) / F.count(col(c))


def ratio(a: Column, b: Column) -> Column:
    """Division with NULL for a zero or missing divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))
