"""Streaming queries: the same results as their batch forms, from the tables written as increments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bed import Bed
from tidemark.plans.registry import add
from tidemark.streaming import loads
from tidemark.tables import shared_dir


def _increments(b: Bed, rows: DataFrame, files: int, key: str) -> tuple[DataFrame, str]:
    path, checkpoint = shared_dir(b.spark, "increments"), shared_dir(b.spark, "stream-state")
    rows.repartition(files, key).write.parquet(path)
    return loads.read_increments(b.spark, path, rows.schema, 2), checkpoint


def _appended(b: Bed) -> DataFrame:
    rows = b.run_log.select("event_id", "table_name", "state", "n_rows")
    stream, checkpoint = _increments(b, rows, 4, "event_id")
    path = shared_dir(b.spark, "appended")
    loads.append_increments(stream.filter("state = 'TERMINADO'"), path, checkpoint)
    return b.spark.read.schema(rows.schema).parquet(path).groupBy("table_name").agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"))


def _merged(b: Bed) -> DataFrame:
    stream, checkpoint = _increments(b, b.staged, 4, "c_custkey")
    return loads.merge_increments(stream, b.target, ["c_custkey"], "balance", shared_dir(b.spark, "merged"), checkpoint)


def _counted(b: Bed) -> DataFrame:
    """All days of the events: those that the watermark closed come from the stream, the days still open from a row each in its state."""
    rows = b.table("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    # in order of time, so that the watermark may close days; the last file ends the stream with a mark far behind all others
    last = rows.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"), F.lit("end of stream").alias("event_type"))
    path, checkpoint, out = shared_dir(b.spark, "increments"), shared_dir(b.spark, "stream-state"), shared_dir(b.spark, "counted")
    rows.repartitionByRange(4, "ts").write.parquet(path)
    for batch in (None, last):
        if batch is not None:
            batch.write.mode("append").parquet(path)
        counts = loads.windowed_counts(loads.read_increments(b.spark, path, rows.schema, 2), "ts", "event_type", "1 day", "60 days")
        writer = counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    written = b.spark.read.schema("start timestamp, end timestamp, event_type string, n long").parquet(out)
    return written.select(F.col("start").cast("date").alias("day"), "event_type", "n")


add("stream_append_increments", _appended, "SELECT table_name, count(*) AS n, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM run_log WHERE state = 'TERMINADO' GROUP BY 1")
add("stream_merge_increments", _merged, "SELECT * FROM staged UNION ALL SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM staged)")
add("stream_windowed_counts", _counted, "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
