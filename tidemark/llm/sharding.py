"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows are shuffled by a seeded hash and ranked within their source; sorted by fractional rank, every stretch of the
order holds all sources in their proportions, and equal cuts give shards whose row counts differ by one at most.
Both rankings are positions in a global order dealt by range (common.positioned), so a hot source spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import HASHED_UNIT_SQL, hashed_unit, join_small, materialize, positioned


def shard(docs: DataFrame, shards: int, seed: str = "shard", stratum: str = "source", id_col: str = "doc_id") -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (0-based place in it) to a narrow table of rows.

    Law: row counts of shards are at most one apart, and each holds its share of every stratum to within a row or
    two. Null is a stratum of its own. Rows with one id are ranked next to each other (tied rows in either order, but
    each keeps a slot of its own). With fewer rows than shards some shards are empty; an empty table gives none.
    Rows without an id are ranked by a hash of their other plain columns, so that many of them are dealt like others; equal ones are next to each other.
    Carry only the columns needed: all of them are shuffled twice. Columns of the table that are called shard or slot give way to the new ones.
    """
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    plain = [F.col(f.name) for f in docs.schema if f.name in names and f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    other = (F.pmod(F.xxhash64(*plain), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    unit = F.when(F.col(id_col).isNull(), other).otherwise(hashed_unit(id_col, seed))
    base = docs.select(F.struct(*names).alias("doc"), F.col(stratum).alias("stratum"), F.col(id_col).alias("id"), unit.alias("u"))
    first = positioned(base, ["stratum", "u", "id"], "at", "shard-ranks")
    sources = materialize(first.groupBy("stratum").agg(F.count("*").alias("rows"), F.min("at").alias("start")), "shard-sources")
    ranked = join_small(first, sources, "stratum")
    ranked = ranked.withColumn("rank", (F.col("at") - F.col("start") + 0.5) / F.col("rows")).drop("at", "start", "rows")
    placed = positioned(ranked, ["rank", "u", "id"], "at", "shard-order")
    total = int(sources.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
    number = F.expr(f"(at * {shards}) div {max(total, 1)}L")
    start = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.withColumn("shard", number.cast("int")).select("doc.*", "shard", (F.col("at") - start).alias("slot"))


def op3(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in 24 shards of near equal row counts; null texts count as empty, plus 8 bytes each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shard(materialize(narrow, "shard-rows"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# DuckDB has no CRC-32, so there is no SQL for the whole result; this gives all but text_crc32 and is used in tests.
OP3_SQL = f"""
WITH base AS (SELECT doc_id, source, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size, {HASHED_UNIT_SQL.format(column="doc_id", seed="shard")} AS u FROM documents),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY u, doc_id) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS rank FROM base),
placed AS (SELECT *, row_number() OVER (ORDER BY rank, u, doc_id) - 1 AS place, count(*) OVER () AS total FROM ranked),
cut AS (SELECT *, place * 24 // total AS shard FROM placed)
SELECT doc_id, size, 'rows' AS law, CAST(shard AS INTEGER) AS shard, place - (shard * total + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM cut
"""
