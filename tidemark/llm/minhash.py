"""Near-duplicate groups: MinHash bands propose, signatures screen, full shingle sets confirm, stars connect.

Documents with equal shingle sets form a class with one representative, so copies of a text cost one row each
from there on. Representatives meet in the buckets of their bands. First all members of a bucket are tried against
one centre, its first row; what is confirmed is connected. Buckets that still hold several
components get the full sets of their members: all pairs are compared inside the task, by
matrix products over the shingles shared, and only a spanning star of each component found leaves it. Large buckets are
dealt as pairs of blocks of at most ``BLOCK`` members, and small ones that touch are taken together. So no pairs are listed, and no link that shares a band is given up.
Bands are chosen such that a pair at the threshold misses all of them with a chance of at most ``MISS``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_shared, join_small, map_carried, materialize, row_keyed
from tidemark.llm.components import connected_components
from tidemark.llm.exact_dedup import among, probably_in

MISS, MOST_HASHES, BLOCK, BIN_ROWS = 1e-7, 160, 2048, 2048
_MASK = (1 << 64) - 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_WORDS = _WordHashes()


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``width``-grams of the text, A-Z lower-cased; short texts are one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter((_WORDS[w] for w in words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    acc = np.full(len(words) - span + 1, np.uint64(span), dtype=np.uint64)
    for i in range(span):
        acc = (acc ^ (acc >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : len(words) - span + 1 + i]
    acc = (acc ^ (acc >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return np.unique(acc ^ (acc >> np.uint64(31)))


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): as many rows as the hash budget allows at the chance ``MISS``."""
    best = None
    for rows in range(1, 9):
        bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows))) if percent < 100 else 1
        if bands * rows <= MOST_HASHES or best is None:
            best = (bands, rows)
    return best


def minima(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash (odd factor times x plus shift, mod 2**64, upper bits) over the set."""
    low = np.full(len(factors), _MASK, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(low, (factors[:, None] * shingles[None, at : at + 1024] + shifts[:, None]).min(axis=1), out=low)
    return low >> np.uint64(16)


def signatures(keyed: DataFrame, width: int, bands: int, rows: int, seed: int = 1) -> DataFrame:
    """_row, doc_id, n_shingles, set_digest (of the sorted set), bands (hashes of rows of minima), signature (a byte per minimum)."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, size=bands * rows, dtype=np.uint64)
    mix = rng.integers(0, 1 << 63, size=(bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(text: str | None) -> tuple:
        s = shingle_set(text, width)
        if not len(s):
            return 0, b"", [], b""
        low = minima(s, factors, shifts)
        keys = (low.reshape(bands, rows) * mix).sum(axis=1, dtype=np.uint64)
        keys ^= keys >> np.uint64(31)
        return len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), keys.astype(np.int64), low.astype(np.uint8).tobytes()

    result = "n_shingles long, set_digest binary, bands array<long>, signature binary"
    return map_carried(keyed, ["_row", "doc_id"], ["text"], lambda: lambda texts: (None, list(zip(*map(sign, texts), strict=True)) or [[]] * 4), result)


def screen(pairs: DataFrame, signed: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the similarity; five standard deviations are left to chance."""
    t = percent / 100
    least = math.floor(hashes * t - 5 * math.sqrt(hashes * t * (1 - t)))
    a = signed.select(F.col("_row").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    b = signed.select(F.col("_row").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    sized = pairs.join(b, "b").join(a, "a").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left = np.frombuffer(b"".join(batch["sa"]), dtype=np.uint8).reshape(len(batch), -1)
            right = np.frombuffer(b"".join(batch["sb"]), dtype=np.uint8).reshape(len(batch), -1)
            yield batch.loc[(left == right).sum(axis=1) >= least, ["a", "b"]]

    return sized.select("a", "b", "sa", "sb").mapInPandas(close, "a long, b long")


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    ends = materialize(pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct(), "minhash-ends")
    texts = probably_in(texts.select("_row", "text"), "_row", ends)
    left = texts.select(F.col("_row").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("_row").alias("b"), F.col("text").alias("tb"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, base = None, None
        for batch in batches:
            good = np.zeros(len(batch), dtype=bool)
            for i, (a, ta, tb) in enumerate(zip(batch["a"], batch["ta"], batch["tb"], strict=True)):
                if a != last:
                    last, base = a, shingle_set(ta, width)
                other = shingle_set(tb, width)
                both = len(np.intersect1d(base, other, assume_unique=True))
                good[i] = 100 * both >= percent * (len(base) + len(other) - both)
            yield batch.loc[good, ["a", "b"]]

    return full.mapInPandas(similar, "a long, b long")


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first one that is reachable by links of the similarity asked for, all pairs compared exactly."""
    n, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    both = np.zeros((n, n), dtype=np.float32)  # exact: counts stay below 2**24
    row = np.repeat(np.arange(n), sizes)
    tokens, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1  # other shingles are in no intersection
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, min(int(shared.sum()), max(256, (1 << 23) // max(n, 1))))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part @ part.T
    near = 100 * both.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - both.astype(np.int64))
    np.fill_diagonal(near, True)
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def _units(open_: DataFrame, block: int) -> DataFrame:
    """(unit, _row): the members of buckets that touch are one unit if they are few, so each set travels once; else buckets, dealt as pairs of blocks."""
    spread = connected_components(open_.select(F.col("centre").alias("u"), F.col("_row").alias("v")))
    sizes = spread.groupBy("root").agg(F.count("*").alias("n"))
    placed = materialize(spread.join(sizes, "root").select(F.col("node").alias("_row"), "root", (F.col("n") <= block).alias("few")), "minhash-clusters")
    few = placed.filter("few").select(F.xxhash64("root").alias("unit"), "_row")
    many = open_.select("bucket", "_row").join(placed.filter("not few").select("_row"), "_row")
    # buckets with the same members are one
    kinds = many.groupBy("bucket").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(_row))").alias("x"), F.expr("bit_xor(xxhash64(_row, 1))").alias("y"))
    kinds = kinds.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = many.join(kinds, "bucket").withColumn("mine", F.pmod(F.xxhash64("_row"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = rows.select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "_row")
    units = materialize(few.unionByName(blocks), "minhash-units")
    drop_shared(placed)
    return units


def compare_buckets(open_: DataFrame, texts: DataFrame, width: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the members (bucket, _row) of each bucket, whose ``centre`` is one of them, as all their pairs would."""
    units = _units(open_, block)
    wanted = materialize(units.select("_row").distinct(), "minhash-wanted")
    sets = map_carried(among(texts, "_row", wanted), ["_row"], ["text"], lambda: lambda batch: (None, [[shingle_set(t, width).tobytes() for t in batch]]), "shingles binary")
    bins = max(1, -(-units.count() // BIN_ROWS))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby("unit", sort=False):
            part = part.sort_values("_row")
            ids = part["_row"].to_numpy(dtype=np.int64)
            label = linked([np.frombuffer(x, dtype=np.uint64) for x in part["shingles"]], percent)
            some = label != np.arange(len(ids))
            out.append(pd.DataFrame({"a": ids[label[some]], "b": ids[some]}))
        return pd.concat(out, ignore_index=True)

    joined = units.join(sets, "_row").withColumn("_bin", F.pmod(F.xxhash64("unit"), F.lit(bins)))
    found = materialize(joined.groupBy("_bin").applyInPandas(compare, "a long, b long").distinct(), "minhash-links")
    for spent in (units, wanted):
        drop_shared(spent)
    return found


def near_rows(keyed: DataFrame, width: int = 5, percent: int = 80, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """One row per row of ``keyed`` (_row, doc_id, text): _row, doc_id, n_shingles, class_row (least ``_row`` with the same
    set), group_row (least ``_row`` linked directly or through others) and shared (whether the group has other rows).

    ``_row`` is a number of its own for every row; everything is decided by it, so ids may repeat or be missing.
    """
    bands, rows = bands_for(percent)
    signed = materialize(signatures(keyed, width, bands, rows, seed), "minhash-signed")
    # one row per set, chosen before the shuffle where a task holds several
    first = F.min_by(F.struct("n_shingles", "bands", "signature"), "_row").alias("first")
    classes = signed.filter("n_shingles > 0").groupBy("set_digest").agg(F.min("_row").alias("class_row"), F.count("*").alias("copies"), first)
    classes = materialize(classes.select("set_digest", "class_row", "copies", "first.*"), "minhash-classes")
    names = classes.select("set_digest", "class_row", "copies")
    members = materialize(signed.select("_row", "doc_id", "n_shingles", "set_digest").join(names, "set_digest", "left").drop("set_digest"), "minhash-members")
    drop_shared(signed)
    heads = classes.withColumnRenamed("class_row", "_row")
    keyed_bands = heads.select("_row", F.posexplode("bands").alias("band", "hash")).select("_row", F.xxhash64("band", "hash").alias("bucket"))
    shared = keyed_bands.groupBy("bucket").agg(F.count("*").alias("rows"), F.min("_row").alias("centre")).filter("rows > 1")
    shared = materialize(shared.select("bucket", "centre"), "minhash-shared")
    # filters keep what shares no bucket out of the shuffles, texts above all
    buckets = materialize(probably_in(keyed_bands, "bucket", shared.select("bucket")).join(shared, "bucket"), "minhash-buckets")
    open_rows = materialize(buckets.select("_row").distinct(), "minhash-open-rows")
    heads = materialize(among(heads.select("_row", "n_shingles", "signature"), "_row", open_rows), "minhash-heads")
    texts = materialize(among(keyed.select("_row", "text"), "_row", open_rows), "minhash-texts", "zstd")
    for table in (classes, shared):
        drop_shared(table)

    pairs = buckets.filter("centre <> _row").select(F.col("centre").alias("a"), F.col("_row").alias("b")).distinct()
    close = materialize(screen(pairs, heads, percent, bands * rows), "minhash-close")
    links = materialize(confirm(close, texts, width, percent), "minhash-links")
    roots = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    spent = [buckets, open_rows, heads, texts, close, links]
    # buckets that still hold several components: a bucket of two was settled against its centre
    at = buckets.join(roots.select(F.col("node").alias("_row"), "root"), "_row", "left").withColumn("root", F.coalesce("root", "_row"))
    split = at.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).filter("low <> high and n > 2")
    open_ = materialize(at.join(split.select("bucket"), "bucket").select("bucket", "_row", "centre"), "minhash-open")
    spent.append(open_)
    if not open_.isEmpty():
        more = compare_buckets(open_, texts, width, percent, block)
        spent.append(more)
        if not more.isEmpty():
            roots = connected_components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more.toDF("u", "v")))

    for table in spent:  # nothing reads them any more
        drop_shared(table)
    placed = members.join(roots.select(F.col("node").alias("class_row"), "root"), "class_row", "left")
    is_shared = F.col("root").isNotNull() | F.coalesce(F.col("copies") > 1, F.lit(False))
    return placed.select("_row", "doc_id", "n_shingles", F.coalesce("class_row", "_row").alias("class_row"), F.coalesce("root", "class_row", "_row").alias("group_row"), is_shared.alias("shared"))


def near_dups(docs: DataFrame, width: int = 5, percent: int = 80, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id, kept.

    Null, empty and blank texts have no shingles and are linked with nothing, not even each other. Of rows linked
    directly or through others the smallest doc_id names the component, and its rows are kept. class_id is the smallest doc_id
    with the same shingle set. Rows that repeat a doc_id are rows of their own, with equal texts or others. Rows without
    a doc_id are judged like the others; they name a component only if no other id is in it, and are kept then.
    Texts of any length are shingled whole. An empty table gives an empty result; further columns are ignored.
    """
    rows = materialize(near_rows(row_keyed(docs, "minhash-docs", columns=["doc_id", "text"]), width, percent, seed, block), "minhash-rows")
    found = rows.filter("shared")
    classes = materialize(found.groupBy("class_row").agg(F.min("doc_id").alias("class_id")), "minhash-names")
    groups = materialize(found.groupBy("group_row").agg(F.min("doc_id").alias("component_id")), "minhash-names")
    named = join_small(join_small(rows, classes, "class_row"), groups, "group_row")  # else Spark splits what a large group holds
    own = lambda c: F.when(F.col("shared"), F.col(c)).otherwise(F.col("doc_id")).alias(c)
    named = named.select("doc_id", "n_shingles", own("class_id"), own("component_id"))
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles and 85 percent over all of ``documents``."""
    found = near_dups(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
