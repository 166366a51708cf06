"""Removal of repeated byte strings across a corpus by bucketed, hash-compared suffix sorting.

Every window of ``width`` bytes starts a suffix. Windows are bucketed by their anchor, the leftmost smallest hash of
the ``GRAM``-byte strings within, so equal windows meet, wherever they stand. Runs of windows with one anchor travel as a
single row (anchor hash, 128-bit digest of the bytes they cover). Runs that cover the same bytes, which the digest
verifies, need no sorting: all but the first are repeats. Where one anchor stands in different surroundings, suffixes are
sorted: their bytes are fetched, a mergesort compares them in logarithmic time through prefix hashes, neighbours that agree
for ``width`` bytes are verified byte by byte, and all but the earliest of a class are repeats.

Common strings do not gather in one task: grams that a sample of the texts shows to be common are anchors only of
windows that hold no others, and those are combined within tasks before the shuffle. Anchors with more than ``HOT``
different surroundings have their windows dealt by content, to be sorted in as many tasks as it takes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop_shared, map_carried, materialize, order_keyed, ship
from tidemark.llm.polyhash import Common, Suffixes, anchors, mixed, prefix_hashes, window_hashes

GRAM, HOT, BUCKET_ROWS = 40, 8192, 4096
#: Windows of a text hashed at a time.
STRETCH = 1 << 22
#: Texts, about, that the search for common anchors looks at, and the share of all runs from which one is common; it bounds their number.
#: They decide where windows meet, never what is removed.
SAMPLE_TEXTS, COMMON_SHARE, COMMON_LEAST = 10_000, 1 / 20_000, 16


def runs_of(raw: bytes, width: int, gram: int, common: Common | None = None, digests: bool = True) -> tuple[np.ndarray, ...]:
    """Per run of windows with one anchor: anchor hash, digest (two numbers) of the anchor's offset and the covered bytes, and the run (first window, windows, offset) in one number."""
    data, out = np.frombuffer(raw, dtype=np.uint8), []
    for at in range(0, max(len(data) - width + 1, 0), STRETCH):
        part = data[at : at + STRETCH + width - 1]
        grams = window_hashes(prefix_hashes(part), gram)
        place, first, last = anchors(grams, width - gram + 1, common)
        offset = place - first
        cover = np.zeros((len(first), 2), dtype=np.int64)
        if digests:
            ends = zip((first + at).tolist(), (last + at + width).tolist(), offset.tolist(), strict=True)
            cover = np.frombuffer(b"".join([hashlib.blake2b(raw[a:b], digest_size=16, salt=o.to_bytes(2, "little")).digest() for a, b, o in ends]), dtype=np.int64).reshape(-1, 2)
        out.append((grams[place].view(np.int64), cover[:, 0], cover[:, 1], (first + at) << 16 | (last - first + 1) << 8 | offset))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, dtype=np.int64),) * 4


def common_anchors(keyed: DataFrame, width: int, gram: int, sample_texts: int = SAMPLE_TEXTS) -> np.ndarray:
    """Anchors that hold more than ``COMMON_SHARE`` of the runs of a hashed sample; there are fewer than its inverse."""
    one_in = max(1, keyed.count() // sample_texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs_of((t or "").encode("utf-8", "surrogatepass"), width, gram, digests=False)[0] for t in batch.column(0).to_pylist()]
            anchor, n = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], names=["anchor", "n"])

    sample = keyed.filter(F.pmod(F.xxhash64("_key"), F.lit(one_in)) == 0).select("text").mapInArrow(count, "anchor long, n long")
    counts = materialize(sample.groupBy("anchor").agg(F.sum("n").alias("n")), "suffix-sample")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = [r[0] for r in counts.filter(F.col("n") > max(COMMON_LEAST, total * COMMON_SHARE)).select("anchor").collect()]
    drop_shared(counts)
    return np.sort(np.array(found, dtype=np.int64).view(np.uint64))


def all_runs(keyed: DataFrame, width: int, gram: int, hot_anchors: np.ndarray) -> DataFrame:
    """Rows (anchor, c1, c2, _key, run, again). Runs that repeat an earlier one of the same batch, or of the task under a
    common anchor, are known repeats (``again``) and get a scattered anchor."""
    schema = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("_key", pa.int64()), ("run", pa.int64()), ("again", pa.bool_())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, earliest = Common(hot_anchors), {}
        for batch in batches:
            found, keys = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.append(runs_of((text or "").encode("utf-8", "surrogatepass"), width, gram, common))
                keys.append(np.full(len(found[-1][0]), key, dtype=np.int64))
            if not found:
                continue
            key, (h, c1, c2, run) = np.concatenate(keys), (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((run, key, c2, c1, h))
            h, c1, c2, key, run = h[order], c1[order], c2[order], key[order], run[order]
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (c1[1:] == c1[:-1]) & (c2[1:] == c2[:-1])])[: len(h)]
            if len(common.hashes):
                for i in np.flatnonzero(common.has(h.view(np.uint64)) & ~again).tolist():
                    name, place = (h[i], c1[i], c2[i]), (key[i], run[i])
                    again[i] = earliest.setdefault(name, place) < place
                    earliest[name] = min(earliest[name], place)
            scattered = mixed(run.view(np.uint64) + key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.where(again, scattered, h), c1, c2, key, run, again)], schema=schema)

    return keyed.select("_key", "text").mapInArrow(find, "anchor long, c1 long, c2 long, _key long, run long, again boolean")


def surroundings(keyed: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """Rows (anchor, _key, first, offset, bytes): the bytes that each run of (anchor, _key, run) covers."""
    lists = runs.groupBy("_key").agg(F.collect_list(F.struct("anchor", "run")).alias("runs"))  # of one document

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, wanted in zip(batch["_key"], batch["text"], batch["runs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for x in wanted:
                    run = x["run"]
                    first, windows = run >> 16, run >> 8 & 255
                    out.append((x["anchor"], key, first, run & 255, raw[first : first + windows + width - 1]))
            yield pd.DataFrame(out, columns=["anchor", "_key", "first", "offset", "bytes"])

    joined = keyed.select("_key", "text").join(lists, "_key")
    return joined.mapInPandas(cut, "anchor long, _key long, first long, offset int, bytes binary")


def _windows(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes end to end, and for each window its place there, its row and its number in the document."""
    lengths = rows["bytes"].map(len).to_numpy(dtype=np.int64)
    data = np.frombuffer(b"".join(rows["bytes"]), dtype=np.uint8)
    per_row = lengths - width + 1
    row = np.repeat(np.arange(len(rows)), per_row)
    step = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    return data, (np.cumsum(lengths) - lengths)[row] + step, row, rows["first"].to_numpy(dtype=np.int64)[row] + step


def _spans(doc: np.ndarray, window: np.ndarray, width: int) -> pd.DataFrame:
    """Spans (_key, low, high) that the windows cover, neighbours joined."""
    order = np.lexsort((window, doc))
    doc, window = doc[order], window[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (window[1:] != window[:-1] + 1)])[: len(doc)]
    last = np.append(np.flatnonzero(new)[1:], len(doc)) - 1 if len(doc) else np.empty(0, dtype=np.int64)
    return pd.DataFrame({"_key": doc[new], "low": window[new], "high": window[last] + width})


def repeats_by_sorting(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """Spans of windows that repeat an earlier one, among the surroundings given (whole anchors only)."""
    rows = rows.sort_values(["_key", "first"], kind="stable").reset_index(drop=True)
    data, place, row, window = _windows(rows, width)
    anchor = rows["anchor"].to_numpy(dtype=np.int64)[row]
    within = rows["offset"].to_numpy(dtype=np.int64)[row] - (window - rows["first"].to_numpy(dtype=np.int64)[row])  # anchor's place in the window
    doc = rows["_key"].to_numpy(dtype=np.int64)[row]
    order = np.lexsort((window, doc, within, anchor))
    place, anchor, within, doc, window = place[order], anchor[order], within[order], doc[order], window[order]
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (within[1:] != within[:-1])])[: len(place)]
    segment = np.cumsum(fresh)
    some = np.flatnonzero(np.bincount(segment)[segment] > 1) if len(segment) else np.empty(0, dtype=np.int64)
    place, segment, doc, window = place[some], segment[some], doc[some], window[some]
    suffixes = Suffixes(data, width)
    sorted_ = suffixes.sort(place, segment)  # stable: the earliest of equal suffixes comes first
    a, b = sorted_[:-1], sorted_[1:]
    same = np.flatnonzero(segment[a] == segment[b]) if len(sorted_) else np.empty(0, dtype=np.int64)
    same = same[suffixes.common(place[a[same]], place[b[same]]) >= width]
    same = same[suffixes.verified(place[a[same]], place[b[same]])]
    return _spans(doc[b[same]], window[b[same]], width)


def dealt_by_content(rows: DataFrame, width: int) -> DataFrame:
    """Rows (anchor, _key, first, offset, bytes, again) of one window each, whose anchor follows from the window's bytes and its place
    about the old anchor. Windows with the bytes of an earlier one of the batch are known repeats (``again``) and come without bytes."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024].sort_values(["_key", "first"], kind="stable").reset_index(drop=True)
                data, place, row, window = _windows(part, width)
                raw, seen, again = data.tobytes(), {}, np.zeros(len(place), dtype=bool)
                within = part["offset"].to_numpy(dtype=np.int64)[row] - (window - part["first"].to_numpy(dtype=np.int64)[row])
                content = [raw[p : p + width] for p in place]
                key = part["_key"].to_numpy(dtype=np.int64)[row]
                for i in np.lexsort((window, key)).tolist():
                    again[i] = seen.setdefault((content[i], within[i]), i) != i
                dealt = [int.from_bytes(hashlib.blake2b(c, digest_size=8, salt=int(w).to_bytes(8, "little", signed=True)).digest(), "little", signed=True) for c, w in zip(content, within, strict=True)]
                yield pd.DataFrame({"anchor": dealt, "_key": key, "first": window, "offset": within.astype(np.int32), "bytes": [b"" if x else c for c, x in zip(content, again, strict=True)], "again": again})

    return rows.mapInPandas(explode, "anchor long, _key long, first long, offset int, bytes binary, again boolean")


def repeated_spans(keyed: DataFrame, width: int = 100, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Spans (_key, low, high) whose union is every byte covered by a ``width``-byte string that also starts earlier, in the order of ``_key``."""
    ship(keyed.sparkSession)
    runs = all_runs(keyed, width, gram, common_anchors(keyed, width, gram))
    by_anchor = Window.partitionBy("anchor")
    before = F.lag(F.struct("c1", "c2")).over(by_anchor.orderBy("c1", "c2", "_key", "run"))
    seen = runs.withColumn("_again", F.col("again") | F.coalesce(before == F.struct("c1", "c2"), F.lit(False)))
    differ = [F.min(c).over(by_anchor) != F.max(c).over(by_anchor) for c in ("c1", "c2")]
    seen = seen.withColumn("_mixed", differ[0] | differ[1]).filter("_again or _mixed")
    found = materialize(seen.select("_key", "run", F.when(~F.col("_again"), F.col("anchor")).alias("anchor")), "suffix-runs", "zstd")

    low = F.shiftright("run", 16)
    whole = found.filter("anchor is null").select("_key", low.alias("low"), (low + F.shiftright("run", 8).bitwiseAND(F.lit(255)) + (width - 1)).alias("high"))
    open_ = found.filter("anchor is not null")
    crowded = materialize(open_.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "suffix-crowded")
    around = materialize(surroundings(keyed, open_, width), "suffix-bytes", "zstd")
    spans, spent, rows = [whole], [found, crowded, around], around
    if not crowded.isEmpty():
        apart = materialize(dealt_by_content(around.join(crowded, "anchor", "left_semi"), width), "suffix-windows", "zstd")
        spans.append(apart.filter("again").select("_key", F.col("first").alias("low"), (F.col("first") + width).alias("high")))
        rows = around.join(crowded, "anchor", "left_anti").unionByName(apart.filter("not again").drop("again"))
        spent.append(apart)
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("_bucket")
    spans.append(dealt.applyInPandas(lambda x: repeats_by_sorting(x, width), "_key long, low long, high long"))
    union = spans[0]
    for more in spans[1:]:
        union = union.unionByName(more)
    out = materialize(union, "suffix-spans", "zstd")
    for table in spent:  # nothing reads them any more
        drop_shared(table)
    return out


def remove_repeats(docs: DataFrame, width: int = 100, gram: int = GRAM, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, ``kept`` (bytes).

    Texts are judged as UTF-8 bytes, null as empty; of equal strings the one with the smallest doc_id, then the
    earliest start stays. Texts shorter than ``width`` lose nothing. Rows that repeat an id are texts of their own, in
    the order of their places in the table; rows without an id come after all others. An empty table gives an empty
    result; further columns are ignored.
    """
    if not 0 < gram < width or width - gram > 254:
        raise ValueError("the gram must be shorter than the width, and runs of windows must stay below 256")
    keyed = order_keyed(docs, "suffix-docs", ["doc_id", "text"])
    lists = repeated_spans(keyed, width, gram, hot).groupBy("_key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # of one document

    def remove(text: str | None, spans: list | None) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass")
        merged: list[list[int]] = []
        for low, high in sorted((x["low"], x["high"]) for x in spans or []):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        edges = [0, *(x for span in merged for x in span), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        return (len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept)[: 5 if with_text else 4]

    result = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    columns = 5 if with_text else 4
    joined = keyed.join(lists, "_key", "left")
    return map_carried(joined, ["doc_id"], ["text", "spans"], lambda: lambda texts, spans: (None, list(zip(*map(remove, texts, spans), strict=True)) or [[]] * columns), result)


def op4(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
