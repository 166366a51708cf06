"""Checks and comparisons; every check returns its violations, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.tables import materialize

MONEY = "decimal(18,2)"


def check_weekend_copy(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sundays that differ from their Saturday; keys and days must be unique. One pass over the weekends, no self join."""
    ordered = Window.partitionBy(*keys).orderBy("date")
    days = df.filter(F.dayofweek("date").isin(1, 7)).select("date", *keys, *measures)
    days = days.withColumns({"_before": F.lag("date").over(ordered), **{f"saturday_{m}": F.lag(m).over(ordered) for m in measures}})
    differs = reduce(lambda a, b: a | b, [~F.col(m).eqNullSafe(F.col(f"saturday_{m}")) for m in measures])
    return days.filter((F.dayofweek("date") == 1) & (F.col("_before") == F.date_sub("date", 1)) & differs).drop("_before")


def worst_first(violations: DataFrame, measure: Column, ties: Sequence[str], top: int) -> DataFrame:
    """The ``top`` violations by a measure, worst first, equal ones by the columns ``ties``."""
    return violations.orderBy(measure.desc(), *ties).limit(top)


def check_month_complete(df: DataFrame, keys: Sequence[str], last: date) -> DataFrame:
    """Key-months whose rows are not as many as the month's days; the month of ``last`` counts up to that day."""
    months = df.groupBy(*keys, F.trunc("date", "MM").alias("month")).agg(F.count("*").alias("n_rows"))
    due = F.when(F.trunc(F.lit(last), "MM") == F.col("month"), F.dayofmonth(F.lit(last))).otherwise(F.dayofmonth(F.last_day("month")))
    return months.withColumn("due", due).filter("n_rows <> due")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def range_covered(df: DataFrame, column: str = "date") -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count("*").alias("n_rows"))


def check_lost_keys(detail: DataFrame, output: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the detail that the output lacks."""
    return detail.select(*keys).distinct().join(output.select(*keys).distinct(), list(keys), "left_anti")


def days_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct("date").alias("days"), F.min("date").alias("first"), F.max("date").alias("last")).orderBy("days", *keys)


def check_average(df: DataFrame, keys: Sequence[str], measure: str, average: str) -> DataFrame:
    """Month ends whose stored average is not the sum of the month over its days, to three decimals."""
    sums = df.groupBy(*keys, F.trunc("date", "MM").alias("month")).agg(F.sum(measure).cast("double").alias("_sum"))
    ends = df.filter(F.col("date") == F.last_day("date")).select(*keys, F.trunc("date", "MM").alias("month"), "date", average)
    again = ends.join(sums, [*keys, "month"]).withColumn("recomputed", F.col("_sum") / F.dayofmonth("date")).drop("_sum")
    return again.filter(F.round(F.col(average).cast("double"), 3) != F.round("recomputed", 3))


def check_ratio(df: DataFrame, average: str = "running_avg", total: str = "running_sum", days: str = "running_days", tolerance: float = 1e-6) -> DataFrame:
    return df.filter(F.abs(F.col(average).cast("double") - F.col(total).cast("double") / F.col(days)) > tolerance)


def check_rollup(detail: DataFrame, total: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.01) -> DataFrame:
    """Totals that are not the sum of their detail."""
    sums = detail.groupBy(*keys).agg(F.sum(measure).alias("detail_sum"))
    joined = total.join(sums, list(keys))
    return joined.filter(F.abs(F.col(measure) - F.col("detail_sum")) > tolerance).select(*keys, F.col(measure).cast("double").alias(measure), F.col("detail_sum").cast("double").alias("detail_sum"))


def check_grid(df: DataFrame, key: str, lo: date, hi: date) -> DataFrame:
    """Keys without a row on every day of the range."""
    due = (hi - lo).days + 1
    return df.filter(F.col("date").between(F.lit(lo), F.lit(hi))).groupBy(key).agg(F.count_distinct("date").alias("days")).filter(F.col("days") != due)


def compare_daily(before: DataFrame, after: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Days whose rows or sums differ, days on one side included; strictly."""
    def daily(df: DataFrame, mark: str) -> DataFrame:
        return df.groupBy("date").agg(F.count("*").alias(f"{mark}_rows"), *[F.sum(m).cast(MONEY).alias(f"{mark}_{m}") for m in measures])

    joined = daily(before, "before").join(daily(after, "after"), "date", "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"before_{m}").eqNullSafe(F.col(f"after_{m}")) for m in ("rows", *measures)])
    return joined.filter(differs)


#: Ranges of key hashes whose digests are compared, coarse ones first. A digest is a row a range: these numbers bound what is broadcast.
LEVELS = (256, 65_536)


def range_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = (), levels: Sequence[int] = LEVELS) -> DataFrame:
    """Per finest range of the keys' hashes: rows, and two 64-bit digests of keys and columns that do not depend on the order of rows.

    Combined within tasks, so at most a row a range and task is shuffled.
    """
    words = [F.col(c) for c in (*keys, *columns)]
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in (*keys, *columns)])  # the hash passes over nulls
    one, two = F.xxhash64(nulls, *words), F.xxhash64(F.lit("second"), *words, nulls)
    return df.groupBy(_key_range(keys, levels[-1]).alias("range")).agg(F.count("*").alias("n"), F.bit_xor(one).alias("one"), F.sum(two.cast("decimal(20,0)")).alias("two"))


def _key_range(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def differing_ranges(a: DataFrame, b: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """The finest ranges whose digests differ, found level by level: ranges of the next level are compared only below those that differ.

    Two ranges of other rows look equal with a chance of about 2^-128.
    """
    left, right = materialize(a, "digests"), materialize(b, "digests")  # a row a range; else every level would read the tables again
    figures = lambda df, n: df.groupBy(F.pmod("range", F.lit(n)).alias("at")).agg(F.sum("n").alias("n"), F.bit_xor("one").alias("one"), F.sum("two").alias("two"))
    differing, before = None, 0
    for n in levels:  # each number divides the next one
        if differing is not None:
            left, right = (df.join(F.broadcast(differing), F.pmod("range", F.lit(before)) == F.col("at"), "left_semi") for df in (left, right))  # at most a row a range of the level before
        x, y = figures(left, n), figures(right, n).select("at", *[F.col(c).alias(f"_{c}") for c in ("n", "one", "two")])
        joined = x.join(y, "at", "full_outer")
        differing, before = joined.filter(~(F.col("n").eqNullSafe(F.col("_n")) & F.col("one").eqNullSafe(F.col("_one")) & F.col("two").eqNullSafe(F.col("_two")))).select("at"), n
    return materialize(differing, "differing")


def within_ranges(df: DataFrame, keys: Sequence[str], ranges: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """The rows whose keys fall in the finest ranges ``ranges``; nothing is shuffled."""
    return df.join(F.broadcast(ranges), _key_range(keys, levels[-1]) == F.col("at"), "left_semi")


def compare_keys(before: DataFrame, after: DataFrame, keys: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Keys that one side lacks: MISSING in the new version, or EXTRA. Only ranges of keys whose digests differ are joined."""
    ranges = differing_ranges(range_digests(before, keys, levels=levels), range_digests(after, keys, levels=levels), levels)
    a, b = (within_ranges(df.select(*keys), keys, ranges, levels).distinct() for df in (before, after))
    return a.join(b, list(keys), "left_anti").withColumn("status", F.lit("MISSING")).unionByName(b.join(a, list(keys), "left_anti").withColumn("status", F.lit("EXTRA")))


def compare_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Rows of both sides that differ, with the names of the differing columns; nulls are equal to each other. Keys are unique on each side.

    Only ranges of keys whose digests differ are joined, so equal versions cost two scans and no shuffle of rows.
    """
    ranges = differing_ranges(range_digests(before, keys, columns, levels), range_digests(after, keys, columns, levels), levels)
    before, after = (within_ranges(df, keys, ranges, levels) for df in (before, after))
    b = after.select(*keys, *[F.col(c).alias(f"after_{c}") for c in columns])
    joined = before.select(*keys, *columns).join(b, list(keys))
    names = F.concat_ws(",", *[F.when(~F.col(c).eqNullSafe(F.col(f"after_{c}")), c) for c in columns])
    return joined.withColumn("differing", names).filter("differing <> ''").select(*keys, "differing")


def classify_differences(differences: DataFrame, money: Sequence[str]) -> DataFrame:
    """Counts of differing rows by kind: money or attributes only."""
    listed = F.split("differing", ",")
    kind = F.when(F.arrays_overlap(listed, F.array(*map(F.lit, money))), "MONEY").otherwise("ATTRIBUTES")
    return differences.groupBy(kind.alias("kind")).agg(F.count("*").alias("n_rows"))


def quality_summary(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: violations and verdict."""
    counts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations") for name, df in checks.items()]
    return reduce(DataFrame.unionByName, counts).withColumn("verdict", F.when(F.col("violations") == 0, "OK").otherwise("FAIL"))


def month_breakdown(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per month: days present, keys, rows, and the rows that complete keys would have."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    day = F.expr("shiftleft(1, dayofmonth(date) - 1)")  # the days of a month are the bits of an integer
    of_key = df.groupBy(F.trunc("date", "MM").alias("month"), *keys).agg(F.bit_or(day).alias("_days"), F.count("*").alias("_n"))
    months = of_key.groupBy("month").agg(F.coalesce(F.bit_count(F.bit_or("_days")), F.lit(0)).cast("long").alias("days"), F.count_if(whole).alias("n_keys"), F.sum("_n").alias("n_rows"))
    return months.withColumn("expected_rows", F.col("n_keys") * F.dayofmonth(F.last_day("month")))


def expectation_counts(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """Rows that break each rule (condition, severity), all in one pass; a null condition breaks it."""
    broken = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, (rule, _) in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"), F.col(n).alias("broken")) for n, (_, s) in rules.items()]))
    return broken.select(pairs.alias("r")).select("r.*")


def observe_expectations(df: DataFrame, rules: dict[str, tuple[Column, str]], **figures: Column) -> tuple[DataFrame, Observation]:
    """``df`` with the counts of rows (``n_rows``) and of rows that break each rule told by whatever action reads it, and the observation that
    holds them after that action. Further ``figures`` are aggregates of the same pass."""
    told = Observation()
    counts = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule_{name}") for name, (rule, _) in rules.items()]
    return df.observe(told, F.count(F.lit(1)).alias("n_rows"), *counts, *[c.alias(n) for n, c in figures.items()]), told


def apply_expectations(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """Rows that pass: ``drop`` rules remove rows, ``fail`` rules stop the job, ``warn`` rules change nothing."""
    out = df
    for name, (rule, severity) in rules.items():
        holds = F.coalesce(rule, F.lit(False))
        if severity == "drop":
            out = out.filter(holds)
        elif severity == "fail":
            out = out.filter(F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(f"rule {name} is broken")).cast("boolean")))
        elif severity != "warn":
            raise ValueError("severity must be warn, drop or fail")
    return out


def reconcile_totals(a: DataFrame, b: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.01) -> DataFrame:
    """Keys whose totals differ by more than the tolerance; a side without rows counts as 0."""
    total = lambda df, name: df.groupBy(*keys).agg(F.sum(measure).alias(name))
    joined = total(a, "left_total").join(total(b, "right_total"), list(keys), "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    return joined.select(*keys, zero("left_total").alias("left_total"), zero("right_total").alias("right_total")).filter(F.abs(F.col("left_total") - F.col("right_total")) > tolerance)


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that the contract or the table lacks, or whose types differ."""
    declared, real = {f.name: f.dataType.simpleString() for f in contract}, {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [(c, declared.get(c), real.get(c), "MISSING" if c not in real else "UNDECLARED" if c not in declared else "TYPE") for c in sorted(declared | real) if declared.get(c) != real.get(c)]
    return df.sparkSession.createDataFrame(rows, "column_name string, declared string, actual string, status string")
