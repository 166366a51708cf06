"""Joins by key and by day that the balance operators and reports are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_own_row(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key has no row in ``other``; a null key matches nothing, so its rows stay."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def key_by_day(keys: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every row of ``keys`` on every day of the calendar (one row a day, so it may be broadcast)."""
    return keys.crossJoin(F.broadcast(calendar.select("day")))


def days_to_month_end(rows: DataFrame, calendar: DataFrame, column: str = "date") -> DataFrame:
    """Every row with each calendar ``day`` from its date to the end of that month: an equality on the month with a range within."""
    days = F.broadcast(calendar.select("day", F.trunc("day", "MM").alias("_month")))  # one row a day
    return rows.withColumn("_month", F.trunc(column, "MM")).join(days, "_month").filter(F.col("day") >= F.col(column)).drop("_month")


def attribute_by_day(rows: DataFrame, balances: DataFrame, keys: Sequence[str], attributes: Sequence[str], order: str = "load_seq") -> DataFrame:
    """Add the attributes of the balance row of the same key, that of the largest ``order`` where there are several: rows are never multiplied.

    Of several rows of that ``order`` the one with the largest attributes is taken, compared in turn.
    """
    place = F.when(F.col(order).isNotNull(), F.struct(order, *attributes))
    best = balances.groupBy(*keys).agg(F.max_by(F.struct(*attributes), place).alias("_best"))
    return rows.join(best, list(keys), "left").select(*rows.columns, "_best.*")


def with_dimension(rows: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Add columns of a dimension with one row per ``key``; rows without one get nulls."""
    return rows.join(dimension.select(key, *columns), key, "left")
