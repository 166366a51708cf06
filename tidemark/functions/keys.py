"""Composite keys and row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPERATION = ["company", "module", "branch", "currency", "paper", "account", "operation", "sub_operation", "operation_type"]
BALANCE = [c for c in OPERATION if c != "module"]
CROSS = [c for c in BALANCE if c != "operation_type"]


def operation_keys(df: DataFrame) -> DataFrame:
    """Add id_operation (nine parts), id_balance (no module) and id_cross (no operation type), joined by a bar. Parts must not be null."""
    joined = lambda parts: F.concat_ws("|", *[F.col(c).cast("string") for c in parts])
    return df.withColumns({"id_operation": joined(OPERATION), "id_balance": joined(BALANCE), "id_cross": joined(CROSS)})


def row_hash(df: DataFrame, columns: Sequence[str], name: str = "row_hash") -> DataFrame:
    """SHA-256 over the columns as text, null as empty, joined by a bar."""
    return df.withColumn(name, F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256))
