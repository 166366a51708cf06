"""Business calendar: columns cod_calendar, day, is_business ('S' or 'N'); one row a day, so calendars may be broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.tables import materialize


def business() -> Column:
    return F.col("is_business") == "S"


def business_day_asof(calendar: DataFrame, inclusive: bool = True) -> DataFrame:
    """Add ``origin``, the last business day up to each day (or before it, for the strict form); null if there is none."""
    frame = Window.partitionBy("cod_calendar").orderBy("day").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return calendar.withColumn("origin", F.max(F.when(business(), F.col("day"))).over(frame))


def next_business_day(calendar: DataFrame) -> DataFrame:
    """Add ``next_business``, the first business day after each day."""
    frame = Window.partitionBy("cod_calendar").orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    return calendar.withColumn("next_business", F.min(F.when(business(), F.col("day"))).over(frame))


def pair_dates(dates: DataFrame, option: int) -> DataFrame:
    """(date, previous) for a column ``date``: the data date before (option 3) or the last data date that ends a month (2 and 4)."""
    if option not in (2, 3, 4):
        raise ValueError("option must be 2, 3 or 4")
    order = Window.orderBy("date")  # one row per data date
    ends = F.when(F.col("date") == F.last_day("date"), F.col("date"))
    previous = F.lag("date").over(order) if option == 3 else F.max(ends).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return dates.select("date").distinct().withColumn("previous", previous)


def resolve_range(df: DataFrame, column: str, mode: str, lo: date | None = None, hi: date | None = None, most_days: int = 366) -> tuple[date, date]:
    """Closed range of dates: DIARIO (one day, by default the latest of ``column``), RANGO (as given) or MES (the month of ``lo``)."""
    if mode == "DIARIO":
        lo = lo or df.agg(F.max(column)).first()[0]
        hi = lo
    elif mode == "MES" and lo is not None:
        lo = lo.replace(day=1)
        hi = (lo + timedelta(days=32)).replace(day=1) - timedelta(days=1)
    elif mode != "RANGO":
        raise ValueError("mode must be DIARIO, RANGO or MES, and MES needs a date")
    if lo is None or hi is None or lo > hi or (hi - lo).days >= most_days:
        raise ValueError("the range is missing, inverted or too long")
    return lo, hi


def report_start(df: DataFrame, column: str = "date", days: int = 60) -> DataFrame:
    """One row ``start``: the first of the month of the latest date less ``days``."""
    return df.agg(F.trunc(F.date_sub(F.max(column), days), "MM").alias("start"))


def operating_window(calendar: DataFrame, end: date, days: int, balances: DataFrame | None = None) -> DataFrame:
    """One row: end, read_from (last business day up to ``days`` before it), write_from (first of that month).

    Reading the row fails if the calendar has no business day to read from, if it ends before ``end``, or if
    ``balances`` (column date) has no row from read_from to end: all before anything is written.
    """
    read_from = F.max(F.when(business() & (F.col("day") <= F.date_sub(F.lit(end), days)), F.col("day")))
    out = calendar.agg(read_from.alias("read_from"), F.max("day").alias("last")).withColumn("end", F.lit(end))
    fail = lambda text: F.raise_error(F.lit(text)).cast("date")
    read_from = F.coalesce("read_from", fail("the calendar has no business day to read from"))
    out = out.withColumn("read_from", F.when(F.col("last") < F.col("end"), fail("the calendar ends before the processing day")).otherwise(read_from))
    if balances is not None:
        inside = balances.filter(F.col("date") <= F.lit(end)).agg(F.max("date").alias("newest"))  # one row
        none = F.col("newest").isNull() | (F.col("newest") < F.col("read_from"))
        out = out.crossJoin(F.broadcast(inside)).withColumn("read_from", F.when(none, fail("there are no balances in the range")).otherwise(F.col("read_from")))
    return out.select("end", "read_from", F.trunc("read_from", "MM").alias("write_from"))


def latest_before(rows: DataFrame, marks: DataFrame, group: Sequence[str], at: str, value: str) -> DataFrame:
    """Add to each row the ``value`` of the latest mark of its ``group`` whose ``at`` is not after the row's; null without one. Null values are no marks.

    Rows and marks are dealt together by ranges of (group, time), so that a group of any size is spread over tasks in the order of time. Within a range the
    latest mark is found by a window; what a range's rows have to take from earlier ones is one mark for each group and range, worked out from a table
    of a row a group and range.
    """
    both = rows.withColumns({value: F.lit(None).cast(marks.schema[value].dataType), "_row": F.lit(1)}).unionByName(marks.filter(F.col(value).isNotNull()).withColumn("_row", F.lit(0)), allowMissingColumns=True)
    dealt = materialize(both.repartitionByRange(*group, at, "_row").withColumn("_range", F.spark_partition_id()), "latest-before")
    here = Window.partitionBy("_range", *group).orderBy(at, "_row").rowsBetween(Window.unboundedPreceding, 0)
    found = dealt.withColumn(value, F.last(value, ignorenulls=True).over(here)).filter("_row = 1").drop("_row")
    ends = dealt.groupBy("_range", *group).agg(F.max_by(value, F.when(F.col("_row") == 0, F.col(at))).alias("_end"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    carried = ends.select("_range", *group, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    same = [found[c].eqNullSafe(carried[c]) for c in ("_range", *group)]
    joined = found.join(carried, reduce(lambda a, b: a & b, same), "left")
    return joined.select(*[F.coalesce(found[c], F.col("_carried")).alias(c) if c == value else found[c] for c in [*rows.columns, value]])
