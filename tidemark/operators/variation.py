"""Variation of balances between two dates, and month results from accumulated lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import product_expense_flag
from tidemark.operators.calendar import pair_dates

KEYS = ("company", "module", "branch", "currency", "paper", "account", "operation", "rubro")
AMOUNTS = ("amount_mn", "amount_mo")


def pair_snapshots(rows: DataFrame, pairs: DataFrame, keys: Sequence[str] = KEYS, amounts: Sequence[str] = AMOUNTS) -> DataFrame:
    """Full outer pairing of each (date, previous): ``now`` and ``before`` tell whether the row exists on that side."""
    names = [*keys, *amounts, "origin_type"]
    current = rows.select("date", *names).join(F.broadcast(pairs), "date")  # one row a data date
    earlier = rows.select(F.col("date").alias("previous"), *names).join(F.broadcast(pairs), "previous")
    side = lambda df, mark: df.select("date", "previous", *keys, *[F.col(c).alias(f"{mark}_{c}") for c in (*amounts, "origin_type")], F.lit(True).alias(mark))
    return side(current, "now").join(side(earlier, "before"), ["date", "previous", *keys], "full_outer").withColumns({m: F.coalesce(F.col(m), F.lit(False)) for m in ("now", "before")})


def variation(rows: DataFrame, pairs: DataFrame, keys: Sequence[str] = KEYS, amounts: Sequence[str] = AMOUNTS) -> DataFrame:
    """Current and previous amounts and their difference for each (date, previous).

    A side counts as 0 because its row is absent, never because its amount is null: a null in a row that exists stays
    null. Rows that exist now alone have no previous date.
    """
    paired = pair_snapshots(rows, pairs, keys, amounts)
    zero = F.lit(0).cast("decimal(18,2)")
    out = {}
    for a in amounts:
        now, before = F.when(F.col("now"), F.col(f"now_{a}")).otherwise(zero), F.when(F.col("before"), F.col(f"before_{a}")).otherwise(zero)
        out |= {a: now, f"previous_{a}": before, f"variation_{a}": (now - before).cast("decimal(18,2)")}
    kind = F.when(F.col("now") & F.col("before"), "BOTH").when(F.col("now"), "NEW").otherwise("GONE")
    origin = F.coalesce("now_origin_type", "before_origin_type")
    flags = {"case": kind, "previous": F.when(F.col("before"), F.col("previous")), "origin_type": origin, "expense_flag": product_expense_flag(F.col("module"), origin)}
    return paired.withColumns(out | flags).select("date", "previous", *keys, *out, "case", "origin_type", "expense_flag")


def variation_range(rows: DataFrame, lo, hi, option: int = 4, keys: Sequence[str] = KEYS, amounts: Sequence[str] = AMOUNTS) -> DataFrame:
    """All data dates of a range in one pass; options 2 and 4 compare with the last month end, 3 with the data date before.

    A date of the range without a previous one fails the job before anything is returned.
    """
    pairs = pair_dates(rows.select("date").distinct(), option).filter(F.col("date").between(F.lit(lo), F.lit(hi)))
    pairs = pairs.withColumn("previous", F.coalesce("previous", F.raise_error(F.lit("a date of the range has no earlier one to compare with")).cast("date")))
    return variation(rows, pairs, keys, amounts)


def month_end_self_join(rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add previous_<value>, the value on the last day of the month before, if there is one."""
    ends = rows.filter(F.col("date") == F.last_day("date")).select(*keys, F.add_months(F.trunc("date", "MM"), 1).alias("_month"), *[F.col(v).alias(f"previous_{v}") for v in values])
    return rows.withColumn("_month", F.trunc("date", "MM")).join(ends, [*keys, "_month"], "left").drop("_month")


def month_result(rows: DataFrame, keys: Sequence[str], lines: Sequence[str]) -> DataFrame:
    """Add month_<line>: the accumulated line less its value at the end of the month before, absent ones as 0."""
    joined = month_end_self_join(rows, keys, lines)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.withColumns({f"month_{c}": (zero(c) - zero(f"previous_{c}")).cast("decimal(18,2)") for c in lines}).drop(*[f"previous_{c}" for c in lines])


def daily_results(rows: DataFrame, keys: Sequence[str], lines: Sequence[str]) -> DataFrame:
    """Result lines summed per key and day."""
    return rows.groupBy(*keys, "date").agg(*[F.sum(c).cast("decimal(18,2)").alias(c) for c in lines])
