"""Importance resampling of documents towards the n-grams of a target table.

Features are hashed n-grams. A first pass sums them up per bucket, for the documents and for the target; a bucket's gain is
the logarithm of how much likelier the target is to use it. A second pass gives each document the mean gain of its
features as its weight, adds Gumbel noise that depends on the id and the seed alone, and the highest scores are drawn: without
replacement, with odds in proportion to exp(weight).

Both passes intern the n-grams of a block of texts in an open-addressed table of NumPy arrays (:class:`Grams`): keys are 64-bit
xxHash values, a slot belongs to one n-gram, told by its bytes and not by its key alone, and holds its bucket and its count. Occurrences
keep the number of their slot, so counts and gains are gathered by slot, and a bucket is worked out once for each n-gram of a block.

Blocks have ``BLOCK`` bytes of text or one text. Shuffled are at most ``buckets`` sums from a task, and four numbers a document
for the ranking; the gains (``buckets`` numbers) are all that the driver holds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_carried, materialize, positioned, ship

BLOCK = 1 << 20
#: Lower case of A-Z, and which bytes of UTF-8 are part of words: digits, letters and all of what is not ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: Fixed values of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def short_xxh64(rows: np.ndarray) -> np.ndarray:
    """64-bit xxHash (seed 0) of each row of a matrix of bytes with fewer than 32 columns."""
    n, width = rows.shape
    h, at = np.full(n, _P5 + np.uint64(width)), 0
    for at in range(0, width - 7, 8):
        lane = np.ascontiguousarray(rows[:, at : at + 8]).view("<u8")[:, 0]
        h = _turned(h ^ (_turned(lane * _P2, 31) * _P1), 27) * _P1 + _P4
    at = width // 8 * 8
    if width - at >= 4:
        lane = np.ascontiguousarray(rows[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64)
        h, at = _turned(h ^ (lane * _P1), 23) * _P2 + _P3, at + 4
    for column in range(at, width):
        h = _turned(h ^ (rows[:, column].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Keys of the stretches of ``data``: those of one length together, long ones by the library."""
    keys = np.empty(len(starts), dtype=np.uint64)
    order = np.argsort(lengths, kind="stable")
    widths, first = np.unique(lengths[order], return_index=True)
    for width, mine in zip(widths.tolist(), np.split(order, first[1:]), strict=True):
        if width < 32:
            keys[mine] = short_xxh64(data[starts[mine][:, None] + np.arange(width)])
        else:
            keys[mine] = [xxhash.xxh64_intdigest(data[a : a + width].tobytes()) for a in starts[mine].tolist()]
    return keys


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all bytes of the stretches, one stretch after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Grams:
    """The distinct stretches of a block in an open-addressed table, and the slot of each occurrence."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray | None = None):
        keys = xxh64(data, starts, lengths) if keys is None else keys
        size = 1 << max(4, (2 * len(starts)).bit_length())
        first = np.full(size, -1, dtype=np.int64)  # the occurrence that owns the slot
        self.slot = np.empty(len(starts), dtype=np.int64)
        place, todo = (keys & np.uint64(size - 1)).astype(np.int64), np.arange(len(starts))
        while len(todo):  # equal stretches walk together: they start at one slot and meet the same owners
            here = place[todo]
            free = first[here] < 0
            first[here[free]] = todo[free]
            owner = first[here]
            same = (keys[owner] == keys[todo]) & (lengths[owner] == lengths[todo])
            verify = np.flatnonzero(same & (owner != todo))
            if len(verify):
                a, b = todo[verify], owner[verify]
                differ = data[_flat(starts[a], lengths[a])] != data[_flat(starts[b], lengths[b])]
                same[verify] = ~np.logical_or.reduceat(differ, np.cumsum(lengths[a]) - lengths[a])
            self.slot[todo[same]] = here[same]
            todo = todo[~same]
            place[todo] = (place[todo] + 1) & (size - 1)
        self.used = np.flatnonzero(first >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self._bytes = data.tobytes()
        self._ends = [(a, a + n) for a, n in zip(starts[first[self.used]].tolist(), lengths[first[self.used]].tolist(), strict=True)]
        self.size = size

    def buckets(self, n: int) -> np.ndarray:
        """The bucket of each slot: CRC-32 of its bytes modulo ``n``."""
        out = np.zeros(self.size, dtype=np.int64)
        out[self.used] = [zlib.crc32(self._bytes[a:b]) % n for a, b in self._ends]
        return out


def features(texts: list[bytes], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths, texts' numbers) of all runs of ``low`` to ``high`` words, and the words of each text.

    Words are joined by one space in the returned bytes, so that every run is a stretch of them.
    """
    raw = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
    inside = _IN_WORD[raw]
    after = np.concatenate([[False], inside[:-1]])
    keep = inside | after  # words, and the first byte behind each
    text_of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[keep]
    data, inside = np.where(inside, raw, 32).astype(np.uint8)[keep], inside[keep]
    ends = np.flatnonzero(~inside)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    owner = text_of[starts]
    parts = []
    for n in range(low, high + 1):
        i = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.empty(0, dtype=np.int64)
        parts.append((starts[i], ends[i + n - 1] - starts[i], owner[i]))
    first, length, text = (np.concatenate(x) for x in zip(*parts, strict=True))
    return data, first, length, text, np.bincount(owner, minlength=len(texts))


def blocks(texts: list) -> Iterator[list[bytes]]:
    """Texts in UTF-8 in their order, null as empty, about ``BLOCK`` bytes at once."""
    block, size = [], 0
    for text in texts:
        block.append((text or "").encode())
        size += len(block[-1])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def bucket_counts(df: DataFrame, low: int, high: int, buckets: int, column: str = "text") -> np.ndarray:
    """Occurrences of the features of all rows per bucket; a task sums up its own before anything is shuffled."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist()):
                data, starts, lengths, _, _ = features(block, low, high)
                grams = Grams(data, starts, lengths)
                np.add.at(total, grams.buckets(buckets)[grams.used], grams.count[grams.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counts = df.select(df[column].alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counts.collect():  # a row a bucket at most
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over its share in the source, both with one added to each bucket, rounded down."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, low: int, high: int) -> DataFrame:
    """Per row: doc_id, n_features, n_words, and weight, the mean gain of its features rounded down (0 without any)."""
    buckets = len(gains)

    def work():
        def each(texts: list) -> tuple:
            out = []
            for block in blocks(texts):
                data, starts, lengths, text, words = features(block, low, high)
                grams = Grams(data, starts, lengths)
                gain = gains[grams.buckets(buckets)][grams.slot]
                upto = np.concatenate([[0], np.cumsum(gain[order := np.argsort(text, kind="stable")])])
                n = np.bincount(text[order], minlength=len(block))
                ends = np.cumsum(n)
                out.append((n, words, (upto[ends] - upto[ends - n]) // np.maximum(n, 1)))
            return None, [np.concatenate(x) for x in zip(*out, strict=True)] or [[]] * 3

        return each

    return map_carried(docs, ["doc_id"], ["text"], work, "n_features long, n_words long, weight long")


def gumbel(column: str, seed: str) -> Column:
    """Thousandths of Gumbel noise that depends on the column's text and the seed alone, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000, seed: str = "2024", min_words: int = 20, percent: int = 10) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_features, n_words, weight, score and rank among the drawn ones.

    Drawn are ``percent`` of a hundred of the rows with ``min_words`` words or more, rounded down, by score, ties to the smaller doc_id, a missing one last;
    the others have no rank. Null and empty texts have no features and weight 0. Rows without an id share one noise; repeated rows
    are ranked one after the other. An empty target makes rare features likely; an empty table gives no rows. Further columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, low, high, buckets), bucket_counts(target, low, high, buckets))
    scored = materialize(weigh(docs, gains, low, high).withColumn("score", F.col("weight") + gumbel("doc_id", seed)).withColumn("_tie", F.monotonically_increasing_id()), "resample-scored")
    able = F.col("n_words") >= min_words
    drawn = scored.filter(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("_tie")]
    ranked = positioned(scored.filter(able), order, "_pos", "resample-ranked").withColumn("rank", F.when(F.col("_pos") < drawn, F.col("_pos") + 1))
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    return ranked.select(*columns).unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def op11(spark, sf_dir: str) -> DataFrame:
    """A tenth of all ``documents`` of 20 words or more, drawn towards the single words of all ``benchmark`` texts."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: CRC-32 of distinct words by a table of 256 values, which SQL works out itself.
OP11_SQL = r"""
WITH bits AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)
),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bits),
doc_words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)
),
doc_counts AS (SELECT rid, word, count(*) AS n FROM doc_words GROUP BY ALL),
goal_words AS (
  SELECT word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY word
),
vocabulary AS (SELECT DISTINCT word FROM (SELECT word FROM doc_counts UNION ALL SELECT word FROM goal_words)),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(word)) + 1), lambda j: ('0x' || substr(hex(encode(word)), 2 * j - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc_table
),
source AS (SELECT bucket, sum(n) AS s FROM doc_counts JOIN buckets USING (word) GROUP BY bucket),
goal AS (SELECT bucket, sum(n) AS t FROM goal_words JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM source) AS s_all, (SELECT coalesce(sum(t), 0) FROM goal) AS t_all),
gains AS (
  SELECT source.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
  FROM source LEFT JOIN goal USING (bucket), totals
),
weights AS (SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gain FROM doc_counts JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features,
    CASE WHEN n_features IS NULL THEN 0 ELSE (gain - ((gain % n_features) + n_features) % n_features) // n_features END::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS noise
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN weights USING (rid)
),
placed AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST, weight DESC) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END::BIGINT AS rank, n_features AS n_words FROM placed
"""
