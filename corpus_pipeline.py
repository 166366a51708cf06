"""Five stages from raw documents to packed sequences; each works on what its predecessor kept, and as a table of its own.

A stage gets (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``; the last one returns pieces.
Stages decide row by row: a doc_id may be null or repeat, with one text or several. Further columns, whatever their
names, are passed on as they are; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, language, minhash, mixing, packing
from tidemark.llm.common import fresh, join_small, materialize, row_keyed


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter (null and empty texts too), and near ties between languages, go.

    Rows are judged one by one, so repeated rows stay or go together.
    """
    model = language.fit(language.training_rows(docs))
    return language.accepted(docs, model)


def _keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, in a column whose name the documents do not have."""
    key = fresh(docs, "_row")
    return row_keyed(docs, name, key), key


def _without(keyed: DataFrame, key: str, dropped: DataFrame, name: str) -> DataFrame:
    return exact_dedup.without(keyed, key, materialize(dropped.select(key), name)).drop(key)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (null, empty and blank ones are equal): the longest original, then the smallest doc_id, a missing one last."""
    keyed, key = _keyed(docs, "exact-rows")
    return _without(keyed, key, exact_dedup.exact_dedup(keyed, carry=[key]).filter(~F.col("kept")), "exact-dropped")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by a similarity of 0.8 or more on five-word shingles, that of the smallest doc_id, a missing one last; wordless texts stay."""
    keyed, key = _keyed(docs, "near-rows")
    found = minhash.near_rows(keyed.select(F.col(key).alias("_row"), "doc_id", "text"), width=5, percent=80)
    linked = materialize(found.filter("shared").select(F.col("group_row").alias("_group"), "_row", "doc_id"), "near-linked")
    best = linked.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "_row")).alias("best"))
    return _without(keyed, key, join_small(linked, materialize(best, "near-best"), "_group").filter("_row <> best._row").select(F.col("_row").alias(key)), "near-dropped")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, those without an id too; rows without words are only part of whole copies of their source."""
    keyed, key = _keyed(docs, "mix-rows")
    return mixing.repeated(keyed, mixing.mix(keyed, carry=[key]), by=key).drop(key)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, *packing.vocabulary())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("mixing", source_mix),
    ("best_fit_packing", sequences),
]

#: No SQL: language models, signatures and token ids are out of its reach. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
