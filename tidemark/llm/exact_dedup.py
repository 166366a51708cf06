"""Exact deduplication on a log-structured merge index, with DataFrame functions only.

* Memtable: the rows of some input partitions, aggregated by digest before anything is shuffled.
* Run: a flushed memtable, one row per digest. All runs are cut into the same segments, ranges of digests, and stored
  together: bucketed by segment and sorted by digest, so that what follows merges them in place, without a shuffle or a sort.
* Filter: a bit map for every run and segment, sized by the keys of a segment, so filters grow with the runs.
* Hits: digests that a run holds more than once or that pass the filter of another run. All other digests are known
  to be single, and neither compaction nor the final join sees them.
* Compaction: merges the hits of all runs segment by segment; of each digest the best row stays, ties going to the smallest identifier.
* Verification: the normalised texts of the hits are compared byte for byte (smallest against largest per digest,
  combined before the shuffle, so a hot group ships one pair per task). Digests whose texts differ are grouped by
  the texts themselves instead.

Which texts verification has to look at is told by one more filter, a broadcast of at most ``FILTER_BITS`` bits (8 MB);
when that one fills up, more rows are compared, never fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, bucketed, drop_bucketed, materialize, sorted_scans

FILTER_BITS = 1 << 26
BUCKET_BITS = 32_768
#: Keys of a run in a segment, about: sixteen bits of a bitmap each.
SEGMENT_KEYS = BUCKET_BITS // 16


def normalised(text: Column) -> Column:
    """The text without the characters [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")


def best_row() -> Column:
    """The row that stays: most characters, the smallest id, of repeated rows the last."""
    return F.min(F.struct(F.negative("chars").alias("less"), F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("keep_id"), F.negative("entry").alias("later")))


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _slot(digest: Column, bits: int) -> Column:
    """The filter bit of a digest, from 1."""
    return F.pmod(F.xxhash64(digest), F.lit(bits)) + 1


def build_filter(digests: DataFrame, bits: int, *by: str) -> DataFrame:
    """Bitmaps (bucket, bitmap) over the column ``digest``, one set for each value of ``by``."""
    slots = digests.select(*by, _slot(F.col("digest"), bits).alias("_slot"))
    return slots.groupBy(*by, F.bitmap_bucket_number("_slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("bitmap"))


def bit_set(bitmap: Column, place: Column) -> Column:
    """Whether the bit at a place from 0 is set in the bitmap; false without one."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.get(F.array(*[F.shiftright(byte, i).bitwiseAND(F.lit(1)) for i in range(8)]), F.pmod(place, F.lit(8)).cast("int"))
    return F.coalesce(bit == 1, F.lit(False))


def passes(bitmap: Column, digest: Column, bits: int) -> Column:
    """Whether the digest's bit is set in the bitmap of its bucket; false without one."""
    return bit_set(bitmap, F.bitmap_bit_position(_slot(digest, bits)))


def filter_bits(rows: int) -> int:
    """16 bits a key in whole buckets, within the bound."""
    return min(FILTER_BITS, BUCKET_BITS * max(1, -(-rows * 16 // BUCKET_BITS)))


def probably_in(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column may be among ``keys`` (a materialized table of one column): a broadcast filter of bounded size, so nothing is shuffled."""
    bits = filter_bits(keys.count())
    maps = build_filter(keys.toDF("digest"), bits).select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    placed = df.withColumn("_bucket", F.bitmap_bucket_number(_slot(F.col(column), bits))).join(F.broadcast(maps), "_bucket")
    return placed.filter(passes(F.col("_bitmap"), F.col(column), bits)).drop("_bucket", "_bitmap")


def without(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` (read twice) whose column is not null and none of ``keys`` (a materialized table of this column).

    Rows that the filter tells apart from all keys stay where they are; only the others, as many as there are keys and few more, are
    shuffled for the comparison. Beyond some millions of keys the filter tells nothing, and all rows are.
    """
    bits = filter_bits(keys.count())
    maps = build_filter(keys.toDF("digest"), bits).select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap"))
    placed = df.withColumn("_bucket", F.bitmap_bucket_number(_slot(F.col(column), bits))).join(F.broadcast(maps), "_bucket", "left")
    flagged = placed.withColumn("_flag", passes(F.col("_bitmap"), F.col(column), bits)).drop("_bucket", "_bitmap")
    return flagged.filter("not _flag").drop("_flag").unionByName(flagged.filter("_flag").drop("_flag").join(keys, column, "left_anti"))


def among(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose column is one of ``keys`` (a materialized table of this column, each value once).

    The filter comes first, so few others are shuffled. This is no semi-join, which the optimizer would move before the filter.
    """
    return probably_in(df, column, keys).join(keys, column)


def compaction(flushed: DataFrame, runs: int) -> DataFrame:
    """(segment, digest, group_size, best) of the digests that runs hold more than once, merged in the order in which ``flushed`` is stored.

    Under :func:`sorted_scans` the scan gives its order away: the filters of a segment come from a hash table of their bucket (two bytes a
    key), which leaves the order of the runs as it is, and equal digests are neighbours.
    """
    # every segment's filters side by side, probed by the digests of that segment
    place = F.pmod(F.xxhash64("digest"), F.lit(BUCKET_BITS))
    wide = flushed.groupBy("segment").agg(*[F.bitmap_construct_agg(F.when(F.col("run") == r, place)).alias(f"_bitmap{r}") for r in range(runs)])
    hit = F.col("rows") > 1
    for r in range(runs):
        hit = hit | ((F.col("run") != r) & bit_set(F.col(f"_bitmap{r}"), place))
    hits = flushed.join(wide.hint("shuffle_hash"), "segment").filter(hit)
    return hits.groupBy("segment", "digest").agg(F.sum("rows").alias("group_size"), F.min("best").alias("best")).filter("group_size > 1")


def exact_dedup(docs: DataFrame, runs: int = 8, digest: Callable[[Column], Column] = sha256, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, and the columns ``carry``.

    Texts are equal if they are identical after :func:`normalised`; null, empty and blank texts are one group. Of a
    group, the row with most code points in the original text stays, of these the smallest doc_id. Repeated rows count
    one by one, and one of them is kept: exactly one row of a group stays. Null doc_ids only stay if the group has no
    other id. Any ``digest`` gives the same result, a weak one only slower. Further columns are ignored.
    """
    norm = normalised(F.col("text"))
    entries = docs.select("doc_id", *carry, F.monotonically_increasing_id().alias("entry"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), digest(norm).alias("digest"), F.sha2(norm, 256).alias("text_sha256"),
                          F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"))
    entries = materialize(entries, "lsm-entries")
    # segments: ranges of the digest's leading 28 bits that hold about SEGMENT_KEYS keys of a run
    segments = max(1, -(-entries.count() // (runs * SEGMENT_KEYS)))
    lead = F.coalesce(F.conv(F.substring(F.hex("digest"), 1, 7), 16, 10).cast("long"), F.lit(0))
    segment = F.floor(lead * segments / (1 << 28)).cast("long")

    memtables = entries.groupBy("run", "digest").agg(F.count("*").alias("rows"), best_row().alias("best"))
    flushed = bucketed(memtables.withColumn("segment", segment), "lsm_runs", "segment", ["segment", "digest"])
    try:
        with sorted_scans(docs.sparkSession):
            compacted = materialize(compaction(flushed, runs).drop("segment"), "lsm-compacted")
    finally:
        drop_bucketed(flushed)

    # byte verification of all texts whose digest passes the filter of the hits
    texts = probably_in(docs.select(norm.alias("norm")).withColumn("digest", digest(F.col("norm"))), "digest", compacted.select("digest"))
    ends = texts.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    false_hits = materialize(ends.filter(F.col("low") != F.col("high")).select("digest"), "lsm-false")

    groups = compacted.join(false_hits, "digest", "left_anti").select("digest", "group_size", F.col("best.keep_id").alias("keep_id"), F.negative(F.col("best.later")).alias("keep_entry"))
    out = entries.join(groups, "digest", "left")
    if false_hits.isEmpty():
        return _result(out, carry)
    apart = docs.withColumn("norm", norm).withColumn("digest", digest(F.col("norm"))).join(false_hits, "digest", "left_semi")
    apart = apart.select("doc_id", *carry, F.monotonically_increasing_id().alias("entry"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), "norm", F.sha2("norm", 256).alias("text_sha256"))
    apart = materialize(apart, "lsm-apart")
    by_text = apart.groupBy("norm").agg(F.count("*").alias("group_size"), best_row().alias("best")).select("norm", "group_size", F.col("best.keep_id").alias("keep_id"), F.negative(F.col("best.later")).alias("keep_entry"))
    return _result(out.join(false_hits, "digest", "left_anti"), carry).unionByName(_result(apart.join(by_text, "norm"), carry))


def _result(rows: DataFrame, carry: Sequence[str]) -> DataFrame:
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    kept = (single | (F.col("entry") == F.col("keep_entry"))).alias("kept")
    return rows.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), kept, "text_sha256", *carry)


def op7(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = f"""
WITH base AS (SELECT doc_id, coalesce(length(text), 0) AS chars, sha256(regexp_replace(coalesce(text, ''), '[{SPACE}]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) = 1 AS kept, text_sha256
FROM base
"""
