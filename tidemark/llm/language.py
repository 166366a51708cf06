"""Language identification by error-correcting output codes over hashed byte trigrams.

Every language has a codeword; each bit is predicted by a linear classifier of its own, the log-odds of the
trigram distributions of the languages with that bit against those without. Training is one distributed count over
all labelled rows, summed up to one row a bucket with a column a bit (``BUCKETS`` rows and a row a language are all that reaches the driver). Decoding takes the codeword with
the least logistic loss over the bits, weighted by how far apart a bit's two sides are; near ties are flagged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_shared, map_carried, materialize, ship

BUCKETS = 1 << 13
#: A trigram counts for a tenth of its log-odds, since neighbours overlap; score margin below which a row is ambiguous.
DAMPING, MARGIN = 0.1, 0.2
#: Languages whose counts a task holds before it hands them on.
HELD = 200
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def trigram_counts(text: str) -> np.ndarray | None:
    """Counts of hashed trigrams over lower-cased letters and single blanks; None without a letter."""
    import regex

    if not text or not regex.search(r"\p{L}", text):
        return None
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return None
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(32 - 13), minlength=BUCKETS)


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """n x bits of +1/-1: all splits of up to seven languages, else the best of some random codes by least distance."""
    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= 7:
        columns = [[1 if l == 0 or not (k >> (l - 1)) & 1 else -1 for l in range(n)] for k in range(1, 1 << max(n - 1, 0))]
        return np.array(columns, dtype=np.int8).reshape(-1, n).T
    bits, rng = 15 * int(np.ceil(np.log2(n))), np.random.default_rng(seed)
    if n > 512:  # so many random words of so many bits are far apart as they come
        return rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits))
    tries = [rng.choice(np.array([-1, 1], dtype=np.int8), size=(n, bits)) for _ in range(32)]
    apart = lambda c: ((bits - c.astype(int) @ c.T.astype(int)) // 2 + bits * np.eye(n, dtype=int)).min()
    best = max(tries, key=apart)
    return best[:, np.abs(best.sum(axis=0)) < n]  # a bit that all share says nothing


def fit(labelled: DataFrame, held: int = HELD) -> dict:
    """Train on all rows of (text, lang) with a language and a letter; no rows give a model that predicts ``und`` only.

    Every language is learned, however many there are: tasks hand on their counts before they hold more than ``held`` of them, and the shares of
    the languages of either side of a bit are summed up in Spark. Nulls in either column are left out, repeated rows count one by one, further columns are ignored.
    """
    ship(labelled.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for lang, c in sums.items():
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": c[at].astype(np.int64)})
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if (c := trigram_counts(text)) is not None:
                    if lang in sums:
                        sums[lang] += c
                        continue
                    if len(sums) >= held:
                        yield from flush()
                    sums[lang] = c
        yield from flush()

    counted = labelled.select("text", "lang").filter("text is not null and lang is not null").mapInPandas(count, "lang string, bucket int, n long")
    table = materialize(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    totals = {r["lang"]: r["n"] + 0.5 * BUCKETS for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row a language
    langs = sorted(totals)
    code = codewords(len(langs))
    n_bits = code.shape[1] if langs else 0
    whole = np.array([totals[lang] for lang in langs])
    on = np.full((BUCKETS, n_bits), 0.5) * ((code > 0) / whole[:, None]).sum(axis=0) if n_bits else np.zeros((BUCKETS, 0))
    off = np.full((BUCKETS, n_bits), 0.5) * ((code < 0) / whole[:, None]).sum(axis=0) if n_bits else np.zeros((BUCKETS, 0))
    if n_bits:
        words = table.sparkSession.createDataFrame([(lang, float(totals[lang]), word.tolist()) for lang, word in zip(langs, code, strict=True)], "lang string, _all double, _word array<int>")
        share = F.col("n") / F.col("_all")
        sides = [F.sum(F.when(F.col("_word")[bit] > 0, share).otherwise(0.0)).alias(f"b{bit}") for bit in range(n_bits)]
        for row in table.join(words, "lang").groupBy("bucket").agg(F.sum(share).alias("every"), *sides).toLocalIterator():  # a row a bucket
            plus = np.array(row[2:])
            on[row["bucket"]] += plus
            off[row["bucket"]] += row["every"] - plus
    drop_shared(table)
    on, off = on / np.maximum((code > 0).sum(axis=0), 1), off / np.maximum((code < 0).sum(axis=0), 1)
    weights = np.round(np.log(on / off), 9)  # sums may differ in their last digits from run to run
    reliability = ((on - off) * weights).sum(axis=0)  # symmetric divergence of the two sides
    if len(reliability):
        reliability = reliability / reliability.sum() if reliability.sum() > 0 else np.full(len(reliability), 1 / len(reliability))
    return {"langs": langs, "code": code.astype(np.float64), "weights": weights, "reliability": reliability}


def decide(text: str | None, model: dict) -> tuple[str, float, bool]:
    """(language, score, ambiguous) of a text."""
    code = model["code"]
    c = trigram_counts(text) if model["langs"] else None
    if c is None:
        return "und", 0.0, True
    margins = np.clip(DAMPING * (c @ model["weights"]), -50, 50)
    losses = np.logaddexp(0, -code * margins) @ model["reliability"] * code.shape[1]
    p = np.exp(losses.min() - losses)
    p /= p.sum()
    first = int(np.argmax(p))
    second = np.partition(p, -2)[-2] if len(p) > 1 else 0.0
    return model["langs"][first], float(p[first]), bool(p[first] - second < MARGIN)


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, whatever its columns, whose text has a language that is not ambiguous."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not decide(x.as_py(), shared.value)[2] for x in batch.column(at)], type=pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every row of (doc_id, text).

    Null texts and texts without a letter are ``und`` with score 0, as is everything if the model knows no language;
    a model of one language predicts it with score 1. Score is the share of the winner in a softmax of the losses.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages and buckets bound its size

    def decode(texts: list) -> tuple:
        return None, list(zip(*(decide(text, shared.value) for text in texts), strict=True)) or [[]] * 3

    return map_carried(docs, ["doc_id"], ["text"], lambda: decode, "lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    predicted = predict(docs, fit(training_rows(docs)))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
