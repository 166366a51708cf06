"""Mixing sources to target weights by Pareto order sampling.

A source's target is a number of words. Every document gets ``floor(target / size of its source)`` certain
copies; the words still missing are filled by one more copy of documents in the order of their Pareto key, random
odds divided by inclusion odds, as long as the next one fits. A document that does not fit ends a round; the following
round goes on behind it with those that are no longer than what is missing, and after ``ROUNDS`` of them the one
document whose size comes nearest to the rest is taken if that brings the source nearer to its target.

All ranking is by running sums over buckets of the key: per source and level there are at most ``BUCKETS`` rows, and only
the documents of one bucket of the last level (about one in a million of a source) are sorted together, so a hot source
needs no task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import HASHED_UNIT_SQL, WORD, fresh, hashed_unit, join_small, materialize

BUCKETS = 1024
#: Times that documents are taken in the order of their keys.
ROUNDS = 2
#: Words at which a document has half of the odds that a very long one of its source has.
HALF = 100.0


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float = 1.0, cap: int = 3) -> DataFrame:
    """Targets for a table (source, source_size) of unique sources.

    Weights are dealt to the sources in code point order, null last, and repeat. A target stops at ``cap`` times its
    source's size and the excess goes to the others by weight, until none is above: sources are filled in the
    order of capacity per weight, those of equal capacity per weight together, and those that the water level reaches
    are capped. Without any words, targets are 0.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("_w", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("_full", F.col("source_size") * cap).withColumn("_need", F.col("_full") / F.col("_w"))
    order, ties, whole = Window.orderBy("_need"), Window.partitionBy("_need"), Window.partitionBy(F.lit(0))
    # frames by range hold all ties, so sources of equal need have one level
    upto, onward = order.rangeBetween(Window.unboundedPreceding, Window.currentRow), order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    before = F.sum("_full").over(upto) - F.sum("_full").over(ties)
    level = (F.sum("source_size").over(whole) * F.lit(share) - before) / F.sum("_w").over(onward)
    levels = weighed.withColumn("_level", level).withColumn("_capped", F.col("_need") <= F.col("_level"))
    # the level that counts is that of the first sources which it does not fill
    water = F.min(F.when(~F.col("_capped"), F.struct("_need", "_level"))).over(whole)
    return levels.select("source", "source_size", F.when(F.col("_capped"), F.col("_full").cast("double")).otherwise(F.col("_w") * water["_level"]).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, cap: int = 3, seed: str = "mix", chance: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, copies, taken, and the columns ``carry``.

    The inclusion odds of a document are those of its source times a factor: the column that ``chance`` names, or by default
    size / (size + ``HALF``), so that of two documents the longer one is likelier to be drawn and scraps seldom are.
    Size is the number of words; null text has size 0 and, like documents without odds, is never
    drawn. Null is a source of its own. Repeated rows are drawn together, tied keys by doc_id and ``carry``. An empty table gives an empty result; further columns are ignored.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    factor = F.col("size") / (F.col("size") + F.lit(HALF)) if chance is None else F.col("_factor")
    base = docs.select("doc_id", *carry, "source", size.alias("size"), hashed_unit("doc_id", seed).alias("_u"), (F.lit(1.0) if chance is None else F.col(chance).cast("double")).alias("_factor"))
    base = materialize(base.withColumn("_factor", factor).withColumn("_tie", F.monotonically_increasing_id()), "mix-base")
    targets = materialize(source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "mix-targets")
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    fraction = F.coalesce(rest / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0))
    odds = F.col("_fraction") / (1 - F.col("_fraction")) * F.col("_factor")
    keyed = join_small(base, targets, "source")
    keyed = keyed.withColumn("_whole", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0))), F.lit(0)))
    # whole words; the thousandth keeps a sum that is whole but for its last digit
    keyed = keyed.withColumn("_rest", F.floor(rest + 0.001)).withColumn("_fraction", fraction)
    keyed = keyed.withColumn("_key", F.when(odds > 0, F.col("_u") / (1 - F.col("_u")) / odds))
    fine = F.floor(F.col("_key") / (1 + F.col("_key")) * (BUCKETS * BUCKETS))  # grows with the key
    keyed = keyed.withColumn("_fine", F.least(fine, F.lit(BUCKETS * BUCKETS - 1))).withColumn("_coarse", F.floor(F.col("_fine") / BUCKETS))
    keyed = keyed.withColumn("_extra", F.lit(0)).drop("_u", "_factor", "_fraction")
    order = ["_key", "doc_id", *carry, "_tie"]
    for _ in range(ROUNDS):
        keyed = _fill(keyed, order)
    keyed = _nearest(keyed, order)
    copies = (F.col("_whole") + F.col("_extra")).cast("int")
    return keyed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), *carry)


def _missing(keyed: DataFrame) -> DataFrame:
    """Add _room, the words that the source still lacks."""
    room = keyed.groupBy("source").agg((F.first("_rest") - F.sum(F.col("size") * F.col("_extra"))).alias("_room"))
    return join_small(keyed, materialize(room, "mix-room"), "source")


def _fill(keyed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Take one more copy (``_extra``) of the documents that are no longer than what their source lacks, by ``order``, as long as the next one fits."""
    keyed = _missing(keyed)
    able = keyed.filter("_extra = 0 and _key is not null and size <= _room")
    first = materialize(_border(able.withColumn("_start", F.lit(0)), "_coarse"), "mix-border")
    near = join_small(able, first.select("source", F.col("_at").alias("_at1"), F.col("_start").alias("_start")), "source").filter("_coarse = _at1")
    second = materialize(_border(near, "_fine"), "mix-border")
    at = join_small(keyed, second.select("source", F.col("_at").alias("_at2"), F.col("_start").alias("_start2")), "source")
    fits = F.coalesce((F.col("_extra") == 0) & F.col("_key").isNotNull() & (F.col("size") <= F.col("_room")), F.lit(False))
    close = fits & F.coalesce(F.col("_fine") == F.col("_at2"), F.lit(False))
    clear = at.filter(~close).withColumn("_extra", F.when(fits & (F.col("_at2").isNull() | (F.col("_fine") < F.col("_at2"))), 1).otherwise(F.col("_extra")))
    running = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    border = at.filter(close).withColumn("_extra", (F.col("_start2") + F.sum("size").over(running) <= F.col("_room")).cast("int"))
    return materialize(clear.unionByName(border).drop("_room", "_at2", "_start2"), "mix-filled")


def _nearest(keyed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Take of each source the one document whose size is nearest to what it lacks, the first by ``order`` of several, if it then is nearer to its target."""
    keyed = _missing(keyed)
    off = F.abs(F.col("size") - F.col("_room"))
    able = keyed.filter((F.col("_extra") == 0) & F.col("_key").isNotNull() & (off < F.col("_room")))
    best = materialize(able.groupBy("source").agg(F.min(F.struct(off.alias("off"), *order))["_tie"].alias("_best")), "mix-nearest")
    return join_small(keyed, best, "source").withColumn("_extra", F.when(F.col("_tie") == F.col("_best"), 1).otherwise(F.col("_extra")))


def _border(keyed: DataFrame, bucket: str) -> DataFrame:
    """Per source the bucket in which the running size passes ``_room``, if any, and the size before it."""
    sums = keyed.groupBy("source", bucket).agg(F.sum("size").alias("_sum"), F.first("_room").alias("_room"), F.first("_start").alias("_start"))
    running = Window.partitionBy("source").orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.col("_start") + F.sum("_sum").over(running)
    sums = sums.withColumn("_after", after).withColumn("_before", F.col("_after") - F.col("_sum"))
    return sums.filter((F.col("_before") <= F.col("_room")) & (F.col("_room") < F.col("_after"))).select("source", F.col(bucket).alias("_at"), F.col("_before").alias("_start"))


def repeated(docs: DataFrame, mixed: DataFrame, by: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` as often as ``mixed`` takes them; columns stay as they are.

    Rows are matched by the column ``by``, nulls too. Where it repeats, all its rows come as often as the one taken most.
    """
    key, times = fresh(docs, "_by"), fresh(docs, "_copies")
    copies = mixed.filter("copies > 0").groupBy(F.col(by).alias(key)).agg(F.max("copies").alias(times))
    joined = docs.join(copies, F.col(by).eqNullSafe(F.col(key)))
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).drop(times)


def op10(spark, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 over all of ``documents``, at most 3 copies."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = f"""
WITH base AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                     {HASHED_UNIT_SQL.format(column="doc_id", seed="mix")} AS u FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM base GROUP BY source),
weighed AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sizes),
-- a level is right if the targets it gives add up to all words: tried at every source's own breaking point
levels AS (SELECT max(t.level) AS level FROM (
    SELECT (all_words - coalesce(sum(CASE WHEN 3 * b.source_size / b.w < a.need THEN 3 * b.source_size END), 0)) / sum(CASE WHEN 3 * b.source_size / b.w >= a.need THEN b.w END) AS level, a.need
    FROM (SELECT DISTINCT 3 * source_size / w AS need FROM weighed) a, weighed b, (SELECT CAST(sum(source_size) AS DOUBLE) AS all_words FROM weighed) c
    GROUP BY a.need, all_words) t WHERE t.level < t.need),
targets AS (SELECT source, source_size, CASE WHEN (SELECT level FROM levels) < 3 * source_size / w THEN w * (SELECT level FROM levels) ELSE CAST(3 * source_size AS DOUBLE) END AS target FROM weighed),
keyed AS (SELECT b.doc_id, b.size, t.source, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS whole, b.u FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT *, (target - whole * source_size) / nullif(source_size, 0) AS fraction, CAST(floor(target - whole * source_size + 0.001) AS BIGINT) AS rest, size / (size + {HALF}) AS factor FROM keyed),
ranked AS (SELECT *, CASE WHEN fraction > 0 AND factor > 0 THEN u / (1 - u) / (fraction / (1 - fraction) * factor) END AS key, row_number() OVER () AS tie FROM drawn),
first AS (SELECT *, key IS NOT NULL AND size <= rest AS fits, sum(size) FILTER (key IS NOT NULL AND size <= rest) OVER (PARTITION BY source ORDER BY key NULLS LAST, doc_id, tie ROWS UNBOUNDED PRECEDING) AS run FROM ranked),
first_room AS (SELECT *, fits AND run <= rest AS took, rest - coalesce(sum(size) FILTER (fits AND run <= rest) OVER (PARTITION BY source), 0) AS room FROM first),
second AS (SELECT *, key IS NOT NULL AND NOT took AND size <= room AS fits2, sum(size) FILTER (key IS NOT NULL AND NOT took AND size <= room) OVER (PARTITION BY source ORDER BY key NULLS LAST, doc_id, tie ROWS UNBOUNDED PRECEDING) AS run2 FROM first_room),
second_room AS (SELECT *, took OR (fits2 AND run2 <= room) AS took2, room - coalesce(sum(size) FILTER (fits2 AND run2 <= room) OVER (PARTITION BY source), 0) AS room2 FROM second),
last AS (SELECT *, NOT took2 AND key IS NOT NULL AND abs(size - room2) < room2 AS able,
           row_number() OVER (PARTITION BY source, NOT took2 AND key IS NOT NULL AND abs(size - room2) < room2 ORDER BY abs(size - room2), key, doc_id, tie) AS place FROM second_room)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN took2 OR (able AND place = 1) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM last
"""
