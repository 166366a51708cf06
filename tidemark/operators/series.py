"""Daily balance series: completion over the calendar, deduplication, gap fills, running averages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.classify import classify_universe, credit_buckets
from tidemark.functions.keys import operation_keys
from tidemark.operators.calendar import business_day_asof, next_business_day
from tidemark.operators.master import account_executive

ORIGINAL, COPY = "ORIGINAL", "COPIA_HABIL"
MONEY, AVERAGE = "decimal(18,2)", "decimal(18,4)"


def _month(day: str = "date") -> Column:
    return F.trunc(day, "MM")


def propagate_business_days(balances: DataFrame, calendar: DataFrame, lo: date, hi: date) -> DataFrame:
    """Every calendar day of the range gets the rows of the last business day up to it; ``origin_kind`` tells copies."""
    days = business_day_asof(calendar).filter(F.col("day").between(F.lit(lo), F.lit(hi)) & F.col("origin").isNotNull()).select("day", "origin")
    rows = balances.join(F.broadcast(days), F.col("date") == F.col("origin"))
    kind = F.when(F.col("day") == F.col("origin"), ORIGINAL).otherwise(COPY)
    return rows.withColumn("origin_kind", kind).drop("date", "origin").withColumnRenamed("day", "date")


def dedup_day(df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: Sequence[str], mode: str = "sum") -> DataFrame:
    """One row per key: attributes of the first row in ``order``, measures summed or of that row (``best``).

    Of rows that ``order`` leaves equal the one with the largest measures is first, compared in turn.
    """
    if mode not in ("sum", "best"):
        raise ValueError("mode must be sum or best")
    rank = Window.partitionBy(*keys).orderBy(*order, *[F.col(m).desc() for m in measures])
    rows = df.withColumn("_rank", F.row_number().over(rank))
    if mode == "sum":
        rows = rows.withColumns({m: F.sum(m).over(Window.partitionBy(*keys)).cast(MONEY) for m in measures})
    return rows.filter("_rank = 1").drop("_rank")


def fill_month(df: DataFrame, calendar: DataFrame, keys: Sequence[str], end: date, measures: Sequence[str], strict_anchor: bool = False) -> DataFrame:
    """Complete every month in which a key appears, up to ``end``: measures 0, other columns from the anchor row.

    The anchor is the last row up to the day, else the first ORIGINAL one after it; days without an anchor get no row.
    ``strict_anchor`` takes ORIGINAL rows alone on either side. ``origin_kind`` of an added row is RELLENO. Keys and days
    must be unique. Every row brings the days up to the next one, and the first row of a month those before it, so
    one sort within (keys, month) does it and there is no spine to join; the calendar is only looked up. A column
    ``_month`` (first day of the date's month) is made use of and kept, so that rows dealt by it need not be dealt again.
    """
    others = [c for c in df.columns if c not in (*keys, "date", "_month", *measures)]
    kept = ["_month"] if "_month" in df.columns else []
    span = Window.partitionBy(*keys, "_month").orderBy("date")
    row = F.struct(*[F.col(c) for c in others])
    original = F.when(F.col("origin_kind") == ORIGINAL, row)
    rows = df.filter(F.col("date") <= F.lit(end))
    rows = rows if kept else rows.withColumn("_month", _month())
    rows = rows.withColumns({
        "_row": row, "_next": F.lead("date").over(span), "_first": F.row_number().over(span) == 1,
        "_before": F.last(original, ignorenulls=True).over(span.rowsBetween(Window.unboundedPreceding, 0)) if strict_anchor else row,
        "_after": F.first(original, ignorenulls=True).over(span.rowsBetween(1, Window.unboundedFollowing)),
    })
    last = F.least(F.coalesce(F.date_sub("_next", 1), F.last_day("date")), F.lit(end))
    days = F.sequence(F.when(F.col("_first"), F.col("_month")).otherwise(F.col("date")), last)
    grown = rows.withColumn("_day", F.explode(days))
    there = F.col("_day") == F.col("date")
    ahead = F.coalesce(F.when(F.col("origin_kind") == ORIGINAL, F.col("_row")), F.col("_after"))  # for days before the first row
    anchor = F.when(there, F.col("_row")).when(F.col("_day") < F.col("date"), ahead).otherwise(F.coalesce("_before", "_after"))
    grown = grown.withColumn("_anchor", anchor).filter("_anchor is not null")
    known = F.broadcast(calendar.filter(F.col("day") <= F.lit(end)).select(F.col("day").alias("_day")))  # one row a day
    filled = [F.when(there, F.col(m)).otherwise(F.lit(0)).cast(MONEY).alias(m) for m in measures]
    kind = F.when(there, F.col("origin_kind")).otherwise("RELLENO").alias("origin_kind")
    return grown.join(known, "_day", "left_semi").select(*keys, *kept, F.col("_day").alias("date"), *[F.col(f"_anchor.{c}").alias(c) for c in others if c != "origin_kind"], kind, *filled)


def daily_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Measures summed per key and day, with the day's number and the days of its month."""
    sums = df.groupBy(*keys, "date").agg(*[F.sum(m).cast(MONEY).alias(m) for m in measures])
    return sums.withColumns({"day_number": F.dayofmonth("date"), "month_days": F.dayofmonth(F.last_day("date"))})


def running_month_average(df: DataFrame, keys: Sequence[str], measures: Sequence[str], zero_override: bool = False, business_only: bool = False, exact: bool = False, month: Column | None = None) -> DataFrame:
    """Add avg_<measure>: the running sum of the month over the day's number.

    ``zero_override`` divides by the rows so far instead, and gives 0 where today's value is 0. ``business_only``
    counts days with is_business = 'S' alone. ``exact`` gives doubles, otherwise decimals with four places.
    ``month`` is a column with the date's month, if there is one.
    """
    span = Window.partitionBy(*keys, _month() if month is None else month).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    business = F.col("is_business") == "S" if business_only else F.lit(True)
    added = {}
    for m in measures:
        total = F.sum(F.when(business, F.col(m))).over(span)
        days = F.sum(business.cast("int")).over(span) if business_only else F.count("*").over(span) if zero_override else F.dayofmonth("date")
        average = F.try_divide(total.cast("double"), days.cast("double"))
        if zero_override:
            average = F.when(F.col(m) == 0, 0.0).otherwise(average)
        added[f"avg_{m}"] = average if exact else average.cast(AVERAGE)
    return df.withColumns(added)


def operating_balances(balances: DataFrame, calendar: DataFrame, lo: date, hi: date, write_from: date, measures: Sequence[str] = ("amount_mo", "amount_mn"), mode: str = "sum", exact: bool = False, accounts: DataFrame | None = None) -> DataFrame:
    """Dense daily balances per operation with credit states and month averages, from sparse closing balances.

    Reads days from ``lo``, completes up to ``hi``, returns days from ``write_from`` on. Attributes of an operation and day are
    those of its latest load, then lowest account code; ``best`` takes the largest measures of several rows of that load. With ``accounts`` (account, executive) each row gets its executive.
    """
    if mode not in ("sum", "best"):
        raise ValueError("mode must be sum or best")
    keys = ["id_operation", "rubro"]
    best = [c for c in balances.columns if c not in (*keys, "date") and (mode == "best" or c not in measures)]
    sums = [F.sum(m).cast(MONEY).alias(m) for m in measures if mode == "sum"]
    # rows of a key and day become one before they are shuffled, and before days are copied
    single = balances.groupBy(*keys, "date").agg(*sums, F.max_by(F.struct(*best), F.struct("load_seq", *(measures if mode == "best" else ()))).alias("_best")).select(*keys, "date", "_best.*", *(measures if sums else ()))
    # every step below works within an operation's month, so the copies are dealt once
    daily = propagate_business_days(single, calendar, lo, hi).withColumn("_month", _month()).repartition("id_operation", "_month")
    full = fill_month(daily, calendar, keys, hi, measures)
    split = credit_buckets(classify_universe(full), amounts=tuple(measures))
    columns = [*measures, *[c for c in split.columns if any(c.endswith(f"_{m}") for m in measures) and c not in full.columns]]
    picked = F.struct("rubro", "module", "currency", "account", "load_seq", "origin_kind")
    attributes = F.min_by(picked, F.struct(F.negative("load_seq"), "rubro")).alias("_picked")
    totals = split.groupBy("id_operation", "_month", "date").agg(*[F.sum(m).cast(MONEY).alias(m) for m in columns], attributes)
    averaged = running_month_average(totals, ["id_operation"], columns, exact=exact, month=F.col("_month")).drop("_month")
    averaged = averaged.withColumns({"day_number": F.dayofmonth("date"), "month_days": F.dayofmonth(F.last_day("date"))})
    out = averaged.select("*", "_picked.*").drop("_picked").filter(F.col("date") >= F.lit(write_from))
    return out if accounts is None else out.join(account_executive(accounts), "account", "left")


def balance_grid(balances: DataFrame, calendar: DataFrame, key: str, lo: date, hi: date, measures: Sequence[str]) -> DataFrame:
    """Every key on every day of the range: sums of its rows or 0, attributes of its latest row.

    The calendar must have each day of the range once (a check of one row); then a key has each day once, since keys are grouped and sums are one a key and day.
    """
    assert_days(calendar, lo, hi)
    days = calendar.filter(F.col("day").between(F.lit(lo), F.lit(hi))).select(F.col("day").alias("date"))
    # one pass over the balances; the attributes come from what is left of them
    sums = balances.groupBy(key, "date").agg(*[F.sum(m).alias(m) for m in measures], F.max(F.struct("load_seq", "account", "currency", "module")).alias("_row"))
    latest = sums.groupBy(key).agg(F.max_by("_row", "date").alias("_last")).select(key, F.struct("_last.account", "_last.currency", "_last.module").alias("_last"))
    grid = latest.crossJoin(F.broadcast(days))  # the range bounds the days
    sums = sums.drop("_row")
    return grid.join(sums, [key, "date"], "left").select(key, "date", "_last.*", *[F.coalesce(F.col(m), F.lit(0)).cast(MONEY).alias(m) for m in measures])


def assert_days(calendar: DataFrame, lo: date, hi: date) -> DataFrame:
    """Refuse a calendar that lacks a day of the range or has one twice."""
    there = calendar.filter(F.col("day").between(F.lit(lo), F.lit(hi))).agg(F.count("*").alias("rows"), F.count_distinct("day").alias("days")).first()
    if there["rows"] != there["days"]:
        raise ValueError("the calendar has a day twice")
    if there["days"] != (hi - lo).days + 1:
        raise ValueError("the calendar lacks days of the range")
    return calendar


def assert_grid(grid: DataFrame, key: str, lo: date, hi: date) -> DataFrame:
    """Refuse a (materialized) grid in which a key has two rows on a day or lacks a day of the range."""
    wrong = grid.filter(F.col("date").between(F.lit(lo), F.lit(hi))).groupBy(key).agg(F.count("*").alias("rows"), F.count_distinct("date").alias("days"))
    wrong = wrong.agg(F.count_if(F.col("rows") > F.col("days")).alias("repeated"), F.count_if(F.col("days") != (hi - lo).days + 1).alias("incomplete")).first()
    if wrong["repeated"]:
        raise ValueError("a key has more than one row on a day")
    if wrong["incomplete"]:
        raise ValueError("a key lacks days of the range")
    return grid


def running_profile(df: DataFrame, keys: Sequence[str], measure: str, exact: bool = False) -> DataFrame:
    """Add running_sum, running_days and running_avg of the measure inside each month of a key."""
    span = Window.partitionBy(*keys, _month()).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    total, days = F.sum(measure).over(span), F.count("*").over(span)
    average = total.cast("double") / days
    return df.withColumns({"running_sum": total.cast(MONEY), "running_days": days, "running_avg": average if exact else average.cast(AVERAGE)})


def rubro_average(df: DataFrame, keys: Sequence[str], measure: str, exact: bool = False) -> DataFrame:
    """Daily balance per key with its running month figures; rows of a key and day are summed first."""
    return running_profile(df.groupBy(*keys, "date").agg(F.sum(measure).cast(MONEY).alias(measure)), keys, measure, exact)


def account_average(df: DataFrame, account: Sequence[str], code: str, measure: str, exact: bool = False) -> DataFrame:
    """The same per account, over all its codes of a day; amounts are summed, averages are worked out anew."""
    daily = df.groupBy(*account, "date").agg(F.sum(measure).cast(MONEY).alias(measure), F.count_distinct(code).alias("codes"))
    return running_profile(daily, account, measure, exact)


def closed_month(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of every month of a key: it carries the month's average."""
    last = Window.partitionBy(*keys, _month()).orderBy(F.col("date").desc())
    return df.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank")


def closing_days(calendar: DataFrame, lo: date, close: date) -> DataFrame:
    """(origin, day, origin_kind): every day of the window takes its own rows; a day that is no business day takes those of
    the business day before too; days after ``close`` up to the next business day take those of ``close``."""
    own = calendar.filter(F.col("day").between(F.lit(lo), F.lit(close))).select(F.col("day").alias("origin"), "day", F.lit(ORIGINAL).alias("origin_kind"))
    copies = business_day_asof(calendar, inclusive=False).filter((F.col("is_business") == "N") & F.col("day").between(F.lit(lo), F.lit(close)) & F.col("origin").isNotNull())
    upcoming = next_business_day(calendar).filter(F.col("day") == F.lit(close)).select("next_business")
    ahead = calendar.crossJoin(F.broadcast(upcoming)).filter((F.col("day") > F.lit(close)) & (F.col("day") < F.col("next_business")))  # one row
    return own.unionByName(copies.select("origin", "day", F.lit(COPY).alias("origin_kind"))).unionByName(ahead.select(F.lit(close).alias("origin"), "day", F.lit("PROYECTADO").alias("origin_kind")))


def closing_balances(ods: DataFrame, calendar: DataFrame, lo: date, close: date) -> DataFrame:
    """Closing table: rows of the window, copies on days that are not business days, and the closing day carried to the next one.

    Columns: those of ``ods`` (date and key parts), keys, module_product (the module until it is resolved), origin_kind.
    One pass: the days that a row goes to are looked up in a small map.
    """
    days = F.broadcast(closing_days(calendar, lo, close))  # a row or two a day
    rows = ods.join(days, F.col("date") == F.col("origin")).drop("date", "origin").withColumnRenamed("day", "date")
    return operation_keys(rows).withColumn("module_product", F.col("module"))
