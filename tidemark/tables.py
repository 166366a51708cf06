"""Tables in the folder that driver and executors share: cut lineages that outlive executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only a local master may do without that setting: it then gets a temporary folder, as tests do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark's switch for deleting an execution's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; the shuffle files of the write go when it has ended."""
    spark = df.sparkSession
    path, before = shared_dir(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` in the shared folder, one file a bucket of ``key``, sorted within: joins and aggregations by the key need no shuffle.

    The table is known to the session's catalog until :func:`drop_bucketed` is called.
    """
    spark = df.sparkSession
    parts, table, before = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}", spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.repartition(parts, key).write.bucketBy(parts, key).sortBy(*order).option("path", shared_dir(spark, name)).format("parquet").saveAsTable(table)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.table(table)


def drop_bucketed(df: DataFrame) -> None:
    """Forget and delete a table that :func:`bucketed` wrote, once nothing reads it any more."""
    name = df._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().table()
    drop_shared(df)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def drop_shared(df: DataFrame) -> None:
    """Delete a table that :func:`materialize` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def observed(told: Observation) -> dict:
    """The figures of an observation after its action; none at all if the optimizer found the rows to be empty and left the observation out."""
    try:
        return told.get
    except Py4JJavaError as error:
        if "AssertionError" in error.java_exception.getClass().getName():
            return {}
        raise
