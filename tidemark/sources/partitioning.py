"""Splitting a source: equal ranges, cuts of like weight, user predicates, and skew reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.tables import materialize


def select_source(df: DataFrame, columns: Sequence[str] = (), predicate: str | None = None) -> DataFrame:
    """Columns (all if none are named) and rows of a source; both reach the scan."""
    rows = df.where(predicate) if predicate else df
    return rows.select(*columns) if columns else rows


def range_bounds(df: DataFrame, column: str) -> tuple | None:
    """(minimum, maximum + 1), or None for a table without values: then there is nothing to split."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    return None if lo is None else (lo, hi + 1)


def range_number(column: str, lo, hi, n: int) -> Column:
    """Equal-width range of a value, clamped: nulls and what is below go first, what is above goes last."""
    width = F.floor((F.col(column).cast("double") - lo) * n / (hi - lo))
    return F.when(F.col(column).isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(n - 1), width))).cast("int")


def assign_range_partition(df: DataFrame, column: str, lo, hi, n: int) -> DataFrame:
    return df.withColumn("part", range_number(column, lo, hi, n))


def bucket_histogram(df: DataFrame, bucket: Column) -> DataFrame:
    """(bucket, n) over the rows whose bucket is not null."""
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).filter(F.col("bucket").isNotNull())


def cuts_by_count(histogram: DataFrame, n: int) -> list:
    """Upper ends of the first groups when ordered buckets are packed into n groups of like weight.

    Group k is closed by the bucket with which the rows so far reach k even shares, if enough buckets are left for the
    groups still to come; one bucket closes one group at most. Running sums are worked out by ranges of buckets, so a
    fine histogram needs no single task; the driver gets a position a group.
    """
    ranged = materialize(histogram.select("bucket", "n").repartitionByRange("bucket").sortWithinPartitions("bucket").withColumn("_part", F.spark_partition_id()), "histogram")
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_rows"), F.sum("n").alias("_n"))  # one row a partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_rows", "_n")])
    inside = Window.partitionBy("_part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(F.broadcast(parts), "_part").select("bucket", (F.count("*").over(inside) + F.col("_rows_before")).alias("place"), (F.sum("n").over(inside) + F.col("_n_before")).alias("upto"))
    buckets, total = placed.agg(F.count("*"), F.max("upto")).first()
    n = min(n, buckets)
    if n <= 1 or not total:
        return []
    reached = placed.agg(*[F.min(F.when(F.col("upto") * n >= F.lit(total) * k, F.col("place"))).alias(f"k{k}") for k in range(1, n)]).first()
    places: list[int] = []
    for k in range(1, n):
        place = max(reached[k - 1], places[-1] + 1 if places else 1)
        if buckets - place < n - k:
            break
        places.append(place)
    return [r["bucket"] for r in placed.filter(F.col("place").isin(places)).orderBy("bucket").select("bucket").collect()]


def assign_cut_partition(df: DataFrame, bucket: Column, cuts: Sequence) -> DataFrame:
    """Number of the group (first bounds included) of each row; nulls have a group of their own after the last."""
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(bucket > F.lit(cut), 1).otherwise(0)
    return df.withColumn("part", F.when(bucket.isNull(), len(cuts) + 1).otherwise(number))


def skew_report(df: DataFrame, bucket: Column, part: str = "part", factor: float = 1.5) -> DataFrame:
    """Rows per partition, its share of the even share, whether it is above ``factor``, and whether a single value of
    ``bucket`` alone exceeds the even share: then no cut can help, only another column."""
    every = Window.partitionBy(F.lit(1))  # one row a partition
    values = df.groupBy(part, bucket.alias("_value")).agg(F.count("*").alias("_n"))
    sizes = values.groupBy(part).agg(F.sum("_n").alias("n"), F.max("_n").alias("_top"))
    even = F.sum("n").over(every) / F.count("*").over(every)
    return sizes.select(part, "n", (F.col("n") / even).alias("ratio"), (F.col("n") / even > factor).alias("skewed"), (F.col("_top") > even).alias("single_value"))


def predicate_partitions(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Number of the first predicate that a row meets, and how many it meets: anything but 1 is a gap or an overlap."""
    met = [F.coalesce(F.expr(p), F.lit(False)) for p in predicates]
    first = reduce(lambda out, x: F.when(x[1], x[0]).otherwise(out), reversed(list(enumerate(met))), F.lit(None).cast("int"))
    return df.withColumns({"part": first, "matches": sum(m.cast("int") for m in met)})


def range_profile(df: DataFrame, column: str, lo, hi, n: int) -> DataFrame:
    """Per equal-width range: rows, nulls, smallest and largest value."""
    return assign_range_partition(df, column, lo, hi, n).groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"), F.min(column).alias("low"), F.max(column).alias("high"))


def _checked(part: str, n: int) -> Column:
    """The number in the column ``part``; one that is missing or not from 0 to n - 1 fails the job."""
    return F.when(F.col(part).between(0, n - 1), F.col(part).cast("int")).otherwise(F.raise_error(F.concat(F.lit("no task for part "), F.coalesce(F.col(part).cast("string"), F.lit("null")))).cast("int"))


def deal_parts(df: DataFrame, part: str, n: int) -> DataFrame:
    """Rows dealt to ``n`` tasks by the numbers 0 to n - 1 in the column ``part``: a number is one task, and one file when written.

    A missing number (a row that no predicate takes) would vanish in the first task unseen, and one outside of the range would share
    another's: both fail the job. The task of a number grows with its rows; :func:`extract_parts` has no such task.
    """
    return df.repartitionById(n, _checked(part, n))


def extract_parts(df: DataFrame, part: str, n: int, path: str) -> DataFrame:
    """Write the rows of each number to a folder of its own and read them back with that folder's name and the file's.

    Files of a number are of about spark.sql.adaptive.advisoryPartitionSizeInBytes, each written by one task: numbers of many rows are
    split between tasks. Numbers that are missing or out of range fail the job, as in :func:`deal_parts`.
    """
    name = "_number"
    while name in df.columns:
        name += "_"
    df.withColumn(name, _checked(part, n)).hint("rebalance", F.col(name)).write.mode("overwrite").partitionBy(name).parquet(path)
    steps = F.split("_metadata.file_path", "/")
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return out.select(*df.columns, F.element_at(steps, -2).alias("folder"), F.concat_ws("/", F.element_at(steps, -2), F.element_at(steps, -1)).alias("file"))


def predicate_number(predicates: Sequence[str]) -> Column:
    """Number of the predicate that a row meets; rows that meet none get the number after the last, so that nothing is lost."""
    return F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(predicates)], F.lit(len(predicates)))
