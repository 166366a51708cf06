"""Daily consolidated balances: copies, projection, three chained fills with zeros, monthly change and averages.

Rows carry a short key and four more attributes, which make the long key. Fills are chained (each tests what the ones
before it made), so the long key stays unique per day; ``chained=False`` tests all of them against the base alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.calendar import business_day_asof, next_business_day
from tidemark.tables import materialize

SHORT = ("company", "branch", "module", "currency", "paper", "rubro")
ATTRIBUTES = ("title", "chapter", "term", "grp")
LONG = (*SHORT, *ATTRIBUTES)
MEASURES = ("mo", "mn")
MONEY = "decimal(18,2)"


def _month(day: str = "date"):
    return F.trunc(day, "MM")


def _zeros(rows: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    return rows.select("date", *LONG, *[F.lit(0).cast(MONEY).alias(m) for m in measures])


def _days(calendar: DataFrame, end: date, business: bool) -> DataFrame:
    """Days up to ``end`` with the month they belong to; one row a day, small enough to be broadcast."""
    days = calendar.filter(F.col("day") <= F.lit(end))
    days = days.filter("is_business = 'S'") if business else days
    return F.broadcast(days.select(F.col("day").alias("date"), _month("day").alias("_month")))


def copy_non_business(rows: DataFrame, calendar: DataFrame, lo: date, hi: date, keys: Sequence[str] = SHORT) -> DataFrame:
    """Copies of the business day before on days that are none, for keys without a row of their own that day."""
    days = business_day_asof(calendar, inclusive=False).filter((F.col("is_business") == "N") & F.col("day").between(F.lit(lo), F.lit(hi))).select("day", "origin")
    copies = rows.join(F.broadcast(days), F.col("date") == F.col("origin")).drop("date", "origin").withColumnRenamed("day", "date")
    return copies.join(rows.select("date", *keys).distinct(), ["date", *keys], "left_anti").select(*rows.columns)


def project_forward(rows: DataFrame, calendar: DataFrame, day: date) -> DataFrame:
    """The rows of ``day`` on every day up to the one before the next business day."""
    upcoming = next_business_day(calendar).filter(F.col("day") == F.lit(day)).select("next_business")
    ahead = calendar.crossJoin(F.broadcast(upcoming)).filter((F.col("day") > F.lit(day)) & (F.col("day") < F.col("next_business"))).select("day")
    return rows.filter(F.col("date") == F.lit(day)).crossJoin(F.broadcast(ahead)).drop("date").withColumnRenamed("day", "date").select(*rows.columns)


def representative(rows: DataFrame) -> DataFrame:
    """One row per short key and day, the first by title, branch, chapter, term, group."""
    order = Window.partitionBy("date", *SHORT).orderBy("title", "branch", "chapter", "term", "grp")
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def fill_to_month_end(rows: DataFrame, calendar: DataFrame, end: date) -> DataFrame:
    """Zeros on every day after the last real one of a short key's month, with the attributes of that day's representative."""
    last = representative(rows.filter("rubro <> '0'")).withColumn("_month", _month())
    newest = Window.partitionBy(*SHORT, "_month").orderBy(F.col("date").desc())
    last = last.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").filter(F.col("date") < F.last_day("date"))
    days = _days(calendar, end, business=False)
    grown = last.withColumnRenamed("date", "_last").join(days, "_month").filter(F.col("date") > F.col("_last"))
    return _zeros(grown)


def fill_next_month(rows: DataFrame, calendar: DataFrame, end: date) -> DataFrame:
    """Zeros on the business days of the month after one that a long key ended with a balance, if it has no row there."""
    at_end = rows.filter((F.col("date") == F.last_day("date")) & (F.col("mo") != 0)).select(*LONG, F.add_months(_month(), 1).alias("_month")).distinct()
    seen = rows.select(*LONG, _month().alias("_month")).distinct()
    return _zeros(at_end.join(seen, [*LONG, "_month"], "left_anti").join(_days(calendar, end, business=True), "_month"))


def fill_intra_month(rows: DataFrame, calendar: DataFrame, end: date) -> DataFrame:
    """Zeros on the business days that a long key misses in a month in which it appears."""
    months = rows.select(*LONG, _month().alias("_month")).distinct()
    grid = months.join(_days(calendar, end, business=True), "_month")
    return _zeros(grid.join(rows.select("date", *LONG), ["date", *LONG], "left_anti"))


def fill_all(rows: DataFrame, calendar: DataFrame, end: date, chained: bool = True) -> DataFrame:
    """Base and fills in turn; the steps are written to the shared folder, since each reads what was made so far several times."""
    out = rows = materialize(rows, "consolidated")
    for fill in (fill_to_month_end, fill_next_month, fill_intra_month):
        out = out.unionByName(materialize(fill(out if chained else rows, calendar, end), "consolidated"))
    return out


def monthly_change(rows: DataFrame, keys: Sequence[str] = LONG, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Add change_<measure>: the balance less that of the last day of the month before, in the same year; none counts as 0.

    January keeps the raw balance.
    """
    ends = rows.filter(F.col("date") == F.last_day("date")).groupBy(*keys, F.add_months(_month(), 1).alias("_month")).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    joined = rows.withColumn("_month", _month()).join(ends, [*keys, "_month"], "left")
    base = lambda m: F.when(F.month("date") == 1, 0).otherwise(F.coalesce(F.col(f"_{m}"), F.lit(0)))
    return joined.select(*rows.columns, *[(F.col(m) - base(m)).cast(MONEY).alias(f"change_{m}") for m in measures])


def changes(rows: DataFrame) -> DataFrame:
    """:func:`monthly_change` of consolidated rows by a window within a long key, which needs no join: the balance at the end of the month before, summed where a day has several rows."""
    before = Window.partitionBy(*LONG).orderBy("_number").rangeBetween(-1, -1)
    ends = [F.sum(F.when(F.col("date") == F.last_day("date"), F.col(m))).over(before).alias(f"_{m}") for m in MEASURES]
    found = rows.withColumn("_number", F.year("date") * 12 + F.month("date")).select("*", *ends)
    base_of = lambda m: F.when(F.month("date") == 1, 0).otherwise(F.coalesce(F.col(f"_{m}"), F.lit(0)))
    return found.select("date", *LONG, *MEASURES, *[(F.col(m) - base_of(m)).cast(MONEY).alias(f"change_{m}") for m in MEASURES])


def averages(rows: DataFrame, keys: Sequence[str] = LONG, measures: Sequence[str] = MEASURES, exact: bool = False) -> DataFrame:
    """Add avg_<measure>, the mean of the rows of the month so far; 0 where today's balance is 0."""
    span = Window.partitionBy(*keys, _month()).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    mean = lambda m: F.sum(m).over(span).cast("double") / F.count("*").over(span)
    kind = "double" if exact else "decimal(18,4)"
    return rows.withColumns({f"avg_{m}": F.when(F.col(m) == 0, F.lit(0.0)).otherwise(mean(m)).cast(kind) for m in measures})


def consolidated_window(day: date, days: int = 45) -> tuple[date, date]:
    """(read_from, write_from): 30 days more are read than written, since averages and changes need the month before whole."""
    if days <= 0:
        raise ValueError("the number of days must be positive")
    return day - timedelta(days=days + 30), day - timedelta(days=days)


def daily_consolidated(rows: DataFrame, calendar: DataFrame, day: date, days: int = 45, chained: bool = True, exact: bool = False) -> DataFrame:
    """The whole table of the ``days`` up to ``day`` and the days carried on, from rows of 30 days more."""
    read_from, write_from = consolidated_window(day, days)
    base = rows.filter(F.col("date").between(F.lit(read_from), F.lit(day)))
    if not chained:
        base = base.unionByName(copy_non_business(base, calendar, read_from, day)).unionByName(project_forward(base, calendar, day))
        base = base.groupBy("date", *LONG).agg(*[F.sum(m).cast(MONEY).alias(m) for m in MEASURES])
        figures = averages(monthly_change(fill_all(base, calendar, day, chained=False)), exact=exact)
        written = materialize(figures.filter(F.col("date") >= F.lit(write_from)), "consolidated")
        return written.unionByName(copy_non_business(written, calendar, write_from, day, LONG))
    written = averages(changes(complete(base, calendar, read_from, day)), exact=exact).filter(F.col("date") >= F.lit(write_from))
    # copies of computed rows, where the long key has none that day
    copied = _spread(written, business_day_asof(calendar, inclusive=False).filter((F.col("is_business") == "N") & F.col("day").between(F.lit(write_from), F.lit(day))).select("origin", "day"))
    return _own_first(copied, LONG)


def _spread(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows on their own date (``_own``) and on every ``day`` whose ``origin`` it is; a row a day, so the map may be broadcast."""
    extra = days.filter(F.col("origin").isNotNull()).groupBy(F.col("origin").alias("date")).agg(F.collect_list("day").alias("_days"))
    joined = rows.join(F.broadcast(extra), "date", "left")
    all_days = F.concat(F.array(F.struct(F.col("date").alias("day"), F.lit(True).alias("own"))), F.transform(F.coalesce("_days", F.array().cast("array<date>")), lambda d: F.struct(d.alias("day"), F.lit(False).alias("own"))))
    grown = joined.select(*[c for c in rows.columns if c != "date"], F.explode(all_days).alias("_d"))
    return grown.select(F.col("_d.day").alias("date"), *[c for c in rows.columns if c != "date"], F.col("_d.own").alias("_own"))


def _own_first(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key and day that are its own; copies only where there is none."""
    own = F.max("_own").over(Window.partitionBy(*keys, "date"))
    return rows.withColumn("_any", own).filter("_own or not _any").drop("_own", "_any")


def complete(base: DataFrame, calendar: DataFrame, read_from: date, day: date) -> DataFrame:
    """The base with copies, projection and the three chained fills, after one shuffle by short key.

    A long key has rows in the months of its base rows, and in the business days of the month after one that it ended with a
    balance. In a month of its own it has its base days and all business days; the representative of a short key's last
    day goes on to the month's end. So the days of a long key's month are one set, told by the short key's last day.
    """
    upcoming = next_business_day(calendar).filter(F.col("day") == F.lit(day)).select("next_business")
    ahead = calendar.crossJoin(F.broadcast(upcoming)).filter((F.col("day") > F.lit(day)) & (F.col("day") < F.col("next_business"))).select(F.lit(day).alias("origin"), "day")  # one row
    holidays = business_day_asof(calendar, inclusive=False).filter((F.col("is_business") == "N") & F.col("day").between(F.lit(read_from), F.lit(day))).select("origin", "day")
    spread = _spread(base.select("date", *LONG, *MEASURES), holidays.unionByName(ahead)).repartition(*SHORT)
    # days ahead of the processing day take copies whatever there is; before it, own rows of the short key come first
    own = F.max("_own").over(Window.partitionBy(*SHORT, "date"))
    daily = spread.withColumn("_any", own).filter((F.col("date") > F.lit(day)) | F.col("_own") | ~F.col("_any"))
    daily = daily.groupBy(*LONG, "date").agg(*[F.sum(m).cast(MONEY).alias(m) for m in MEASURES]).withColumn("_month", _month())
    of_short = Window.partitionBy(*SHORT, "_month")
    attributes = F.struct(*ATTRIBUTES)
    daily = daily.withColumn("_last", F.max(F.when(F.col("rubro") != "0", F.col("date"))).over(of_short))
    daily = daily.withColumn("_chosen", F.min(F.when(F.col("date") == F.col("_last"), attributes)).over(of_short))
    ended = F.max(F.when((F.col("date") == F.last_day("date")) & (F.col("mo") != 0), F.lit(True)))
    months = daily.groupBy(*LONG, "_month").agg(F.map_from_entries(F.collect_list(F.struct("date", F.struct(*MEASURES)))).alias("_there"), F.max("_last").alias("_last"),
                                                F.max(F.col("_chosen") == attributes).alias("_chosen"), ended.alias("_ended"))
    following = F.lead("_month").over(Window.partitionBy(*LONG).orderBy("_month"))
    carried = F.coalesce(F.col("_ended"), F.lit(False)) & ~F.coalesce(following == F.add_months("_month", 1), F.lit(False))
    business = calendar.filter((F.col("is_business") == "S") & (F.col("day") <= F.lit(day))).groupBy(_month("day").alias("_month")).agg(F.collect_list("day").alias("_business"))
    last = business.select(F.add_months("_month", -1).alias("_month"), F.col("_business").alias("_coming"))
    months = months.withColumn("_carried", carried).join(F.broadcast(business), "_month", "left").join(F.broadcast(last), "_month", "left")  # a row a month
    none = F.array().cast("array<date>")
    end = F.least(F.last_day("_month"), F.lit(day))
    tail = F.when(F.col("_chosen") & (F.col("_last") < end), F.sequence(F.date_add("_last", 1), end))
    days = F.array_union(F.array_union(F.map_keys("_there"), F.coalesce("_business", none)), F.coalesce(tail, none))
    days = F.concat(days, F.when(F.col("_carried"), F.coalesce("_coming", none)).otherwise(none))
    grown = months.select(*LONG, "_there", F.explode(days).alias("date"))
    found = F.element_at("_there", F.col("date"))
    return grown.select("date", *LONG, *[F.coalesce(found[m], F.lit(0)).cast(MONEY).alias(m) for m in MEASURES])
