"""Load modes as functions from tables to the next version of a table, and their form on Parquet paths.

A path is never overwritten while it is read: a new version is written beside it and returned. Tables of dated files, of which a load rewrites only
some, are in ``tidemark.sources.dated``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.dated import Conflict, names, put_if_absent, read_text


def guard_non_empty(df: DataFrame) -> DataFrame:
    """An empty source must not empty its target."""
    if df.isEmpty():
        raise ValueError("the source is empty")
    return df


def load_replace(target: DataFrame, staged: DataFrame) -> DataFrame:
    """The staged rows in the target's columns and types."""
    return guard_non_empty(staged).select(*[F.col(f.name).cast(f.dataType) for f in target.schema])


def high_water_mark(log: DataFrame, table: str | None = None, column: str = "mark_to") -> DataFrame:
    """One row ``mark``: the largest mark of finished runs, null before the first."""
    rows = log.filter("state = 'TERMINADO'")
    return (rows.filter(F.col("table_name") == table) if table else rows).agg(F.max(column).alias("mark"))


def load_incremental(source: DataFrame, column: str, mark) -> DataFrame:
    """Rows beyond the mark; all rows without one."""
    return source if mark is None else source.filter(F.col(column) > F.lit(mark))


def merge_guard(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys, rows, repeated keys, and the verdict on a merge: KEYS_ONLY (nothing to update), REPEATED or OK."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("_n") > 1).alias("repeated"))
    verdict = F.lit("KEYS_ONLY") if not set(df.columns) - set(keys) else F.when(F.col("repeated") > 0, "REPEATED").otherwise("OK")
    return counts.select(F.lit(",".join(keys)).alias("keys"), "n_rows", "repeated", verdict.alias("verdict"))


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Refuse tables of keys alone and duplicated keys, before a target is touched."""
    if not set(df.columns) - set(keys):
        raise ValueError("there is nothing to update but keys")
    if merge_guard(df, keys).first()["verdict"] != "OK":
        raise ValueError("the source repeats a key")
    return df


def load_merge(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matching rows updated, new ones added, the others as they are."""
    return target.join(staged.select(*keys), list(keys), "left_anti").unionByName(assert_unique_keys(staged, keys))


def merge_counts(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: staged rows that update and rows that insert."""
    known = staged.join(target.select(*keys, F.lit(True).alias("_known")), list(keys), "left")
    return known.agg(F.count_if(F.col("_known")).alias("updated"), F.count_if(F.col("_known").isNull()).alias("inserted"))


def rewrite_range(target: DataFrame, fresh: DataFrame, column: str, lo: date, hi: date) -> DataFrame:
    """Dates of the range replaced by those of ``fresh``; running it again changes nothing."""
    inside = F.col(column).between(F.lit(lo), F.lit(hi))
    return target.filter(~inside | F.col(column).isNull()).unionByName(fresh.filter(inside))


def rewrite_days(target: DataFrame, fresh: DataFrame, column: str) -> DataFrame:
    """Only the days that ``fresh`` has are replaced."""
    return target.join(fresh.select(column).distinct(), column, "left_anti").select(*target.columns).unionByName(fresh)


def retain(df: DataFrame, column: str, today: date, days: int) -> DataFrame:
    """Rows of the last ``days`` days; 0 or less keeps all, today and unknown dates always stay."""
    return df if days <= 0 else df.filter((F.col(column) >= F.date_sub(F.lit(today), days)) | F.col(column).isNull())


def write_batch(df: DataFrame, path: str, files: int) -> str:
    """Write ``files`` Parquet files; without rows nothing is written. Returns TERMINADO or SIN_DATOS."""
    if df.isEmpty():
        return "SIN_DATOS"
    df.repartition(files).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return "TERMINADO"


def write_even(df: DataFrame, path: str) -> str:
    """Write Parquet files of about spark.sql.adaptive.advisoryPartitionSizeInBytes each, as many as the rows need: small partitions are
    joined and large ones split when their sizes are known. Without rows nothing is written. Returns TERMINADO or SIN_DATOS."""
    if df.isEmpty():
        return "SIN_DATOS"
    df.hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(path)
    return "TERMINADO"


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str] = ("anio", "mes")) -> None:
    """Overwrite only the partitions that ``df`` has. One shuffle by partition keeps files few; a partition of many rows is split between tasks, and so has several files."""
    df.hint("rebalance", *[F.col(c) for c in columns]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def read_batch(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the committed versions of a table below ``base``, oldest first."""
    return [int(name[2:]) for name in names(spark, base) if name.startswith("v-")]


def version_path(spark: SparkSession, base: str, number: int) -> str:
    """The folder of a version, which its file names."""
    return f"{base.rstrip('/')}/{read_text(spark, f'{base}/v-{number:012d}')}"


def commit_version(df: DataFrame, base: str, number: int | None = None, after: int | None = None) -> int:
    """Write the next version of a table below ``base`` (or the one of this number) and return its number.

    Rows go to a folder of their own; the version is there once a small file names that folder, which is put in place whole and only if no
    other has that number. So readers see the old version or the new one, and no writer's rows are lost unseen: a
    number that was there before is left as it is (a batch that comes again), but one that another writer takes meanwhile fails
    with :class:`Conflict`. With ``after`` it fails if the latest version is another one, by then or at the commit; without number and ``after`` the next
    free number is taken.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    there = versions(spark, base)
    latest = there[-1] if there else -1
    if number is not None and number in there:
        return number
    if after is not None and latest != after:
        raise Conflict(f"version {latest} has come after version {after}")
    folder = f"rows-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{folder}")
    place = latest + 1 if number is None else number
    while not put_if_absent(spark, f"{base}/v-{place:012d}", folder):
        if number is not None or after is not None:
            raise Conflict(f"another writer has committed version {place}")
        place += 1
    return place


def read_version(spark: SparkSession, base: str, number: int | None = None, schema=None) -> DataFrame:
    """A version of the table below ``base``, by default the latest."""
    return read_batch(spark, version_path(spark, base, versions(spark, base)[-1] if number is None else number), schema)


def generate_rows(ids: DataFrame, today: date) -> DataFrame:
    """Load-test rows for the column ``n`` of ``ids``, from its number alone."""
    n = F.col("n")
    return ids.select(
        n.alias("id"), (1 + n % 9).alias("pgcod"), F.date_format(F.date_sub(F.lit(today), (n % 730).cast("int")), "yyyyMMdd").cast("int").alias("fecha_mov"),
        F.when(n % 3 == 0, 1).when(n % 3 == 1, 2).otherwise(840).alias("moneda"), (n % 9973 + (n % 97) / F.lit(100)).cast("decimal(17,2)").alias("importe"),
        (F.lit(3.5) + (n % 1000) / F.lit(10000)).cast("decimal(17,8)").alias("tasa"), F.concat(F.lit("CTA"), F.lpad(n.cast("string"), 11, "0")).alias("cuenta"), F.concat(F.lit("MOV "), n.cast("string")).alias("glosa"),
    )


def generate_sales(ids: DataFrame, day: date, seed: str = "sales") -> DataFrame:
    """One sale per number ``n``: five branches, an amount below 10000 that depends on number and seed."""
    cents = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("n").cast("string"))), 1, 12), 16, 10).cast("long"), F.lit(1_000_000))
    return ids.select(F.lit(day).alias("date"), F.concat(F.lit("SUC-"), F.lpad((F.col("n") % 5 + 1).cast("string"), 2, "0")).alias("branch"), (cents / F.lit(100)).cast("decimal(17,2)").alias("amount"))


def generate_clients(ids: DataFrame, day: date) -> DataFrame:
    """One client per number ``n``: an eight-digit document and a name."""
    document = F.lpad((F.col("n") + 10_000_000).cast("string"), 8, "0")
    return ids.select(F.lit(day).alias("date"), document.alias("document"), F.concat(F.lit("Cliente de prueba "), F.col("n").cast("string")).alias("name"))


def replace_day(table: DataFrame, fresh: DataFrame, column: str, day: date) -> DataFrame:
    """The table with the rows of one day replaced by those of ``fresh``; running it again changes nothing."""
    return rewrite_range(table, fresh, column, day, day)
