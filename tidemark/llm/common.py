"""Helpers that the corpus operators share: shared tables, positions in a global order, checked broadcasts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.tables import bucketed, drop_bucketed, drop_shared, materialize, shared_dir  # noqa: F401

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows up to which a table of per-source or per-partition figures is broadcast.
BROADCAST_ROWS = 20_000
#: Texts that a Python worker gets at once.
TEXTS = 1000
#: Characters between words, as a Java/DuckDB/Python class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package even if the driver was started in another folder, and keep batches of whole texts small."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > TEXTS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS))


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """What is planned within knows the order of a table that :func:`bucketed` wrote, whose buckets are one file each."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_carried(df: DataFrame, carry: Sequence[str], inputs: Sequence[str], work: Callable, result: str) -> DataFrame:
    """The columns ``carry`` and those that Python works out from the columns ``inputs``.

    ``work()`` is called once a task and gives a function from lists of values (one list an input) to (rows,
    columns): ``rows`` says from which row of the batch each result comes (None: one each, in order) and ``columns`` are sequences
    in the order of ``result``. Carried columns stay in Arrow, so ids of any type and size pass unchanged, nulls too.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    kept = [df.schema[c] for c in carry]
    made = StructType.fromDDL(result)
    schema, names = StructType([*kept, *made.fields]), [f"_c{i}" for i in range(len(carry))] + [f"_i{i}" for i in range(len(inputs))]
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = work()
        for batch in batches:
            rows, columns = each(*[batch.column(len(kept) + i).to_pylist() for i in range(len(inputs))])
            at = None if rows is None else pa.array(np.asarray(rows, dtype=np.int64))
            ids = [batch.column(i) if at is None else batch.column(i).take(at) for i in range(len(kept))]
            arrays = [*(x.cast(f.type) for x, f in zip(ids, out, strict=False)), *(pa.array(x, type=f.type) for x, f in zip(columns, list(out)[len(kept) :], strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*carry, *inputs).toDF(*names).mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keyed(docs: DataFrame, name: str, key: str = "_row", columns: Sequence[str] | None = None) -> DataFrame:
    """The ``columns`` of ``docs`` (all by default) and a column ``key``, a number of its own for each row, whatever the columns hold, and the same at every read.

    It is the place of the row in its Parquet file below the file's number. Anything but a plain scan is written first, and so is a table with a
    column called _metadata, which would hide that place.
    """
    columns = list(docs.columns if columns is None else columns)
    hidden = [c for c in docs.columns if c.lower() == "_metadata"]
    if hidden:
        other = {c: fresh(docs, "_meta") for c in hidden}
        named = docs.select(*[docs[f"`{c}`"].alias(other.get(c, c)) for c in columns])
        return row_keyed(named, name, key).select(*[F.col(other.get(c, c)).alias(c) for c in columns], key)
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = materialize(docs.select(*columns), name)
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    path, number, place = (fresh(docs, c) for c in ("_path", "_file", "_place"))
    numbers = docs.sparkSession.createDataFrame([(f, i) for i, f in enumerate(files)], f"{path} string, {number} long")
    placed = docs.select(*columns, F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    return placed.join(F.broadcast(numbers), path).select(*columns, F.shiftleft(number, 40).bitwiseOR(F.col(place)).alias(key))


def order_keyed(docs: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """The ``columns`` and a long ``_key`` of its own for each row, in the order of doc_id, rows of one id by their place in the files, those without one last.

    Where ids are integers, present and unique, they are the key; else rows are numbered in that order and written.
    """
    whole = docs.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    if whole and docs.groupBy("doc_id").count().filter("`count` > 1 or doc_id is null").isEmpty():
        return docs.select(*columns, F.col("doc_id").cast("long").alias("_key"))
    keyed = row_keyed(docs, name, columns=list(dict.fromkeys([*columns, "doc_id"])))
    placed = positioned(keyed.select("doc_id", "_row"), [F.col("doc_id").asc_nulls_last(), F.col("_row")], "_key", name)
    return materialize(keyed.join(placed.select("_row", "_key"), "_row").select(*columns, "_key"), name)


def join_small(df: DataFrame, small: DataFrame, on: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join on a nullable key; ``small`` (materialized, unique keys) is broadcast only if its count allows it."""
    if small.count() <= rows:
        small = F.broadcast(small)
    right = small.withColumnRenamed(on, "_small_key")
    return df.join(right, F.col(on).eqNullSafe(F.col("_small_key")), "left").drop("_small_key")


def positioned(df: DataFrame, order: Sequence[str | Column], pos: str, name: str) -> DataFrame:
    """Add the row's 0-based place in the global order of the columns ``order``.

    Rows are dealt by range and sorted within partitions, so no key's rows have to fit in one task;
    only one row count per partition is summed up, and that table (bounded by the partition count) is broadcast.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), name)
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.withColumn(pos, F.col("_before") + local).drop("_part", "_before", "_place")


def hashed_unit(column: str, seed: str) -> Column:
    """A number in (0, 1) that depends on the column's text and the seed alone (52 bits of MD5)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(column).cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


#: The same in DuckDB, for the column {column} and the seed {seed}.
HASHED_UNIT_SQL = "((('0x' || substr(md5(concat_ws(':', '{seed}', CAST({column} AS VARCHAR))), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def checked(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Fail the job at the first row that breaks ``condition``."""
    return df.filter(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
