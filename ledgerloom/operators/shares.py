"""Shares of a total and orderings of small grouped results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RISK_ORDER = ["Low", "Medium", "High"]


def add_share(groups: DataFrame, count: str, name: str, digits: int) -> DataFrame:
    """Percentage of the total count per group. ``groups`` is a grouped result of a few rows."""
    total = F.sum(count).over(Window.partitionBy(F.lit(1)))
    return groups.withColumn(name, percentage(F.col(count), total, digits))


def percentage(part: Column, total: Column, digits: int) -> Column:
    return F.round(part / total * 100, digits)


def listed_first(value: Column, order: Sequence[str] = RISK_ORDER) -> Column:
    """Sort key: listed values in their order, all others last."""
    rank = F.lit(None).cast("int")
    for place, listed in reversed(list(enumerate(order, start=1))):
        rank = F.when(value == listed, F.lit(place)).otherwise(rank)
    return rank.asc_nulls_last()
