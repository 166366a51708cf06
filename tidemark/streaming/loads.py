"""Loads as streams over files: every micro-batch goes through the same load functions as a batch does."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.sources.loads import commit_version, load_merge, read_version, versions
from tidemark.tables import drop_shared, materialize

#: Parts of a table that increments are merged into.
PARTS = 16


def read_increments(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 8) -> DataFrame:
    """New Parquet files below a path, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_increments(stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> None:
    """Append whatever is new, exactly once, and stop."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.partitionBy(*partitions) if partitions else writer).start().awaitTermination()


def merge_increments(stream: DataFrame, target: DataFrame, keys: Sequence[str], order: str, base: str, checkpoint: str) -> DataFrame:
    """The target after all increments: each micro-batch is reduced to the newest row of a key and merged.

    State is in the shared folder alone. Below ``base`` every micro-batch commits the version of its number plus one
    (version 0 is the target before the first), from the version before it; a batch that comes again after a
    failure finds its version there and changes nothing, and a restart goes on from the latest. Rows are kept by hash of
    their key in ``PARTS`` parts, and a batch rewrites only the parts its keys fall in: the others are carried on by reference.
    """
    spark = stream.sparkSession
    columns = target.columns
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int").alias("_part")
    if not versions(spark, f"{base}/manifest"):
        first = spark.createDataFrame([(p, "first") for p in range(PARTS)], "_part int, _batch string")
        target.select("*", part).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{base}/rows/first")
        commit_version(first, f"{base}/manifest", 0)

    def current(manifest: DataFrame, parts: Sequence[int] | None = None) -> DataFrame:
        """Rows of the table at a version: for each part those of the batch that wrote it last."""
        wanted = [r for r in manifest.collect() if parts is None or r["_part"] in parts]  # a row a part
        schema = StructType([*target.schema.fields, StructField("_part", IntegerType())])
        out = spark.createDataFrame([], schema)
        for batch in sorted({r["_batch"] for r in wanted}):
            mine = [r["_part"] for r in wanted if r["_batch"] == batch]
            out = out.unionByName(spark.read.schema(schema).parquet(f"{base}/rows/{batch}").filter(F.col("_part").isin(mine)))
        return out

    def merge(batch: DataFrame, number: int) -> None:
        if number + 1 in versions(spark, f"{base}/manifest"):
            return
        newest = F.max_by(F.struct(*columns), F.struct(order, *[c for c in columns if c != order])).alias("_row")
        staged = materialize(batch.groupBy(*keys).agg(newest).select("_row.*", part), "merge-staged")
        touched = sorted(r[0] for r in staged.select("_part").distinct().collect())
        manifest = read_version(spark, f"{base}/manifest", number)
        name = f"{number}-{uuid.uuid4().hex}"
        if touched:
            merged = load_merge(current(manifest, touched), staged, keys)
            merged.repartition("_part").write.partitionBy("_part").parquet(f"{base}/rows/{name}")
        after = manifest.withColumn("_batch", F.when(F.col("_part").isin(touched), name).otherwise(F.col("_batch")))
        commit_version(after, f"{base}/manifest", number + 1)
        drop_shared(staged)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return current(read_version(spark, f"{base}/manifest")).select(*columns)


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Rows per key and time window. The watermark closes windows, so in append mode each comes out once and leaves the state."""
    spans = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n"))
    return spans.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")
