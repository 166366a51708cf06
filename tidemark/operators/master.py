"""Operation master: operations, liabilities without one, one row per operation with a content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.classify import account_type
from tidemark.functions.keys import row_hash

# Modules that are no operations, modules left out of the liabilities, modules always taken as liabilities.
NOT_OPERATIONS = (20, 21, 403, 419, 426, 431, 451, 455, 456, 468, 469, 471, 486)
NOT_LIABILITIES = (403, 419, 426, 431, 451, 455, 456, 468, 469, 471, 486)
ALWAYS_LIABILITIES = (20, 21, 27, 63, 65, 45, 162, 321)
NO_ACCOUNT = 999999999


def base_operations(operations: DataFrame) -> DataFrame:
    """Operations of company 1 outside the excluded modules; account_type 1."""
    return operations.filter((F.col("company") == 1) & ~F.col("module").isin(*NOT_OPERATIONS)).withColumn("account_type", F.lit(1))


def balances_without_operation(balances: DataFrame, operations: DataFrame, base: DataFrame) -> DataFrame:
    """Balances of company 1 whose module is known or always taken, without an operation of the same module and cross key, or id."""
    rows = balances.filter((F.col("company") == 1) & ~F.col("module").isin(*NOT_LIABILITIES))
    rows = rows.join(base.select("module", "id_cross").distinct(), ["module", "id_cross"], "left_anti")
    modules = F.broadcast(operations.select("module").distinct().withColumn("_known", F.lit(True)))  # module codes
    rows = rows.join(modules, "module", "left").filter(F.col("_known") | F.col("module").isin(*ALWAYS_LIABILITIES)).drop("_known")
    return rows.join(base.select("id_operation").distinct(), "id_operation", "left_anti")


def base_liabilities(balances: DataFrame, operations: DataFrame, base: DataFrame) -> DataFrame:
    """The same in the columns of the operations: the amount as disbursed, what is missing as null."""
    rows = balances_without_operation(balances, operations, base).withColumns({"account_type": account_type(F.col("module"), F.col("rubro")), "disbursed": F.col("amount_mn").cast("decimal(18,2)")})
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns])


def account_executive(accounts: DataFrame) -> DataFrame:
    """(account, executive): the largest code of each account."""
    return accounts.groupBy("account").agg(F.max("executive").alias("executive"))


def operation_master(operations: DataFrame, balances: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row per operation: account type 2 first, then the newest date, then the content hash; with executive and hash."""
    base = base_operations(operations)
    rows = base.unionByName(base_liabilities(balances, operations, base)).join(account_executive(accounts), "account", "left")
    hashed = row_hash(rows, ["id_operation", "id_balance", "id_cross", "account_type", "module", "account", "date"])
    first = Window.partitionBy("id_operation").orderBy(F.when(F.col("account_type") == 2, 1).otherwise(2), F.col("date").desc(), F.col("disbursed").desc_nulls_last(), "row_hash")
    return hashed.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank").withColumn("is_active", F.lit(1))


def activate_snapshot(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored rows become inactive, those of the new snapshot are active."""
    return stored.withColumn("is_active", F.lit(0)).unionByName(fresh.withColumn("is_active", F.lit(1)))


def modules_of_cross_keys(operations: DataFrame) -> DataFrame:
    """Distinct (id_cross, module) of real accounts."""
    return operations.filter(F.col("account") != NO_ACCOUNT).select("id_cross", "module").distinct()


def resolve_product_module(balances: DataFrame, operations: DataFrame) -> DataFrame:
    """Set module_product to the operation's module where the cross key has exactly one; otherwise it stays the balance's."""
    single = modules_of_cross_keys(operations).groupBy("id_cross").agg(F.max("module").alias("_one"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return balances.join(single, "id_cross", "left").withColumn("module_product", F.coalesce("_one", "module")).drop("_one")
