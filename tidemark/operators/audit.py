"""Audit and operations reports over log tables: table_name, batch_id, run_date, state, n_rows, seconds."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.calendar import latest_before
from tidemark.operators.quality import apply_expectations, observe_expectations
from tidemark.sources.dated import Conflict, DatedTable
from tidemark.tables import observed

LOG = "table_name string, batch_id string, state string, n_rows long, seconds double, message string, broken map<string, long>"


def audit_rows(df: DataFrame, table: str, batch: str, seconds: int, error: str | None = None) -> DataFrame:
    """One log row for a load of ``df``: state by its rows or error, the error cut to 4000 characters."""
    state = F.lit("ERROR") if error else F.when(F.col("n_rows") == 0, "SIN_DATOS").otherwise("TERMINADO")
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(table).alias("table_name"), F.lit(batch).alias("batch_id"), state.alias("state"), "n_rows", F.lit(seconds).alias("seconds"), F.lit((error or "")[:4000] or None).cast("string").alias("message"))


def load_audited(store: DatedTable, rows: DataFrame, table: str, batch: str, rules: dict[str, tuple[Column, str]] | None = None) -> DataFrame:
    """Replace the content of ``store`` by ``rows`` and return the log row of this load, all figures from the pass that writes.

    Rules (condition, severity) are counted on the rows as they come; ``drop`` rules remove rows and ``fail`` rules stop the load. Without rows nothing is committed and the state is SIN_DATOS;
    an error or another writer leaves the store as it was, and its text is cut to 4000 characters.
    """
    rules, began = rules or {}, time.monotonic()
    seen = store.version()
    watched, told = observe_expectations(rows, rules)
    written, kept = observe_expectations(apply_expectations(watched, rules), {})
    state, error, figures, n = "TERMINADO", None, {}, 0
    try:
        added = store.write(written)
        figures, n = observed(told), observed(kept).get("n_rows", 0)
        if n:
            store.commit(seen, lambda listed: listed, added, f"load {batch}")
        else:
            state = "SIN_DATOS"
    except (PySparkException, Conflict) as problem:
        state, error, figures, n = "ERROR", str(problem)[:4000], {}, 0
    broken = {name: int(figures.get(f"rule_{name}") or 0) for name in rules} if state != "ERROR" else None
    return rows.sparkSession.createDataFrame([(table, batch, state, int(n), time.monotonic() - began, error, broken)], LOG)


def latest_batch(extracted: DataFrame, loaded: DataFrame) -> DataFrame:
    """Tables of the latest batch extracted, with rows extracted and loaded (null where nothing was loaded)."""
    last = extracted.agg(F.max("batch_id").alias("batch_id"))
    ext = extracted.join(F.broadcast(last), "batch_id").groupBy("batch_id", "table_name").agg(F.sum("n_rows").alias("extracted_rows"))  # one row
    load = loaded.groupBy("batch_id", "table_name").agg(F.sum("n_rows").alias("loaded_rows"))
    return ext.join(load, ["batch_id", "table_name"], "left")


def recent_errors(extracted: DataFrame, loaded: DataFrame, today: date, days: int = 7) -> DataFrame:
    rows = extracted.withColumn("log", F.lit("EXTRACT")).unionByName(loaded.select(*extracted.columns).withColumn("log", F.lit("LOAD")))
    return rows.filter((F.col("state") == "ERROR") & (F.col("run_date") >= F.date_sub(F.lit(today), days)))


def unregistered(extracted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tables that were extracted but are not in the catalog."""
    return extracted.select("table_name").distinct().join(catalog.select("table_name"), "table_name", "left_anti")


def repeated_empty(extracted: DataFrame, today: date, days: int = 15, times: int = 3) -> DataFrame:
    recent = extracted.filter((F.col("state") == "SIN_DATOS") & (F.col("run_date") >= F.date_sub(F.lit(today), days)))
    return recent.groupBy("table_name").agg(F.count("*").alias("empty_runs"), F.max("run_date").alias("last_run")).filter(F.col("empty_runs") >= times)


def procedure_stats(log: DataFrame, today: date, days: int = 30) -> DataFrame:
    recent = log.filter(F.col("run_date") >= F.date_sub(F.lit(today), days))
    return recent.groupBy("table_name").agg(F.count("*").alias("runs"), F.count_if(F.col("state") == "ERROR").alias("failures"), (F.sum("seconds").cast("double") / F.count("*")).alias("mean_seconds"), F.max("seconds").alias("worst_seconds"), F.max("run_date").alias("last_run"))


def last_load(log: DataFrame) -> DataFrame:
    """Per table: last run, and last run that had rows."""
    return log.groupBy("table_name").agg(F.max("run_date").alias("last_run"), F.max(F.when(F.col("n_rows") > 0, F.col("run_date"))).alias("last_data"))


def never_loaded(catalog: DataFrame, log: DataFrame) -> DataFrame:
    return catalog.filter("active").join(log.select("table_name").distinct(), "table_name", "left_anti")


def close_batch(log: DataFrame, batch: str) -> DataFrame:
    """Per state of a batch: runs and rows; ``batch_failed`` if any run of the batch failed."""
    rows = log.filter(F.col("batch_id") == batch).groupBy("state").agg(F.count("*").alias("runs"), F.sum("n_rows").alias("n_rows"))
    return rows.withColumn("batch_failed", F.max(F.col("state") == "ERROR").over(Window.partitionBy(F.lit(1))))  # one row a state


def last_finished(log: DataFrame) -> DataFrame:
    """The last finished run of each table."""
    done = log.filter("state = 'TERMINADO'")
    return done.groupBy("table_name").agg(F.max_by(F.struct("batch_id", "event_id", "n_rows"), F.struct("batch_id", "event_id")).alias("r")).select("table_name", "r.*")


def batch_lots(lots: DataFrame, declared: DataFrame, strict: bool = True) -> DataFrame:
    """Lots of a batch with their destination.

    A lot without one would leave its target as it was the day before, unseen: it fails the job, whose message names the
    tables. ``strict=False`` only marks such lots in a column ``undeclared``.
    """
    marked = lots.join(declared, "table_name", "left").withColumn("undeclared", F.col("destination").isNull())
    if not strict:
        return marked
    missing = [r[0] for r in marked.filter("undeclared").select("table_name").distinct().orderBy("table_name").limit(100).collect()]
    if missing:
        raise ValueError(f"no destination is declared for: {', '.join(missing)}")
    return marked.drop("undeclared")


def retry_list(log: DataFrame, batch: str) -> DataFrame:
    """One row: the tables of a batch that failed, each once, sorted and joined by commas; empty if none did."""
    failed = log.filter((F.col("batch_id") == batch) & (F.col("state") == "ERROR"))
    return failed.agg(F.array_join(F.array_sort(F.collect_set("table_name")), ",").alias("only_tables"))


def reconcile_catalog(a: DataFrame, b: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys of two catalogs: on one side only, with another attribute, or equal."""
    joined = a.select(key, F.col(attribute).alias("left_value"), F.lit(True).alias("_a")).join(b.select(key, F.col(attribute).alias("right_value"), F.lit(True).alias("_b")), key, "full_outer")
    status = F.when(F.col("_b").isNull(), "ONLY_LEFT").when(F.col("_a").isNull(), "ONLY_RIGHT").when(F.col("left_value").eqNullSafe(F.col("right_value")), "SAME").otherwise("DIFFERENT")
    return joined.withColumn("status", status).drop("_a", "_b")


def scaling_curve(runs: DataFrame, marks: DataFrame, group: Sequence[str] = ("table_name",)) -> DataFrame:
    """Rows per second of each run (run, n_rows, seconds, at), the cores of the latest mark (at, cores) up to it, and efficiency.

    Efficiency is the speed against that of the group's first run with known cores, scaled by cores.
    """
    held = latest_before(runs, marks, group, "at", "cores")
    speed = held.withColumn("speed", F.try_divide(F.col("n_rows").cast("double"), F.col("seconds").cast("double")))
    per_core = F.col("speed") / F.col("cores")
    first = speed.filter(per_core.isNotNull()).groupBy(*group).agg(F.min_by(per_core, F.struct("at", "run")).alias("_first"))  # a row a group, combined before the shuffle
    return speed.join(first, list(group), "left").withColumn("efficiency", F.try_divide(F.col("speed"), F.col("_first") * F.col("cores"))).drop("_first")
