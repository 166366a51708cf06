"""Queries that write tables and read them back: stored versions, range rewrites, marks, merges, retention, audited loads, splits as tasks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import audit as au
from tidemark.operators import calendar as cal
from tidemark.operators import consolidated as con
from tidemark.operators import reports as re
from tidemark.plans import table_queries as tq
from tidemark.plans.bed import Bed
from tidemark.plans.registry import SELECTS, add
from tidemark.plans.series_queries import _base, _source
from tidemark.sources import loads as ld
from tidemark.sources import partitioning as pt
from tidemark.sources.dated import Conflict, DatedTable
from tidemark.tables import shared_dir


def _store(rows: DataFrame, name: str, **how) -> DatedTable:
    """A stored table of the columns of ``rows`` with these rows as its version 0."""
    store = DatedTable(rows.sparkSession, shared_dir(rows.sparkSession, name), rows.schema, **how)
    store.append(rows)
    return store


# Splits whose numbers are written apart
def _files_of(b: Bed, parted: DataFrame, n: int) -> DataFrame:
    """Per number: its rows and the places (folders) that hold them; a place has as many files, each of a task, as its size needs."""
    out = pt.extract_parts(parted, "part", n, shared_dir(b.spark, "extract"))
    return out.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("nulls"), F.count_distinct("folder").alias("files"))


_PER_PART = "SELECT part, count(*) AS n, count(*) - count(v) AS nulls, 1 AS files FROM {} GROUP BY part"
add("s2_range_tasks", lambda b: _files_of(b, pt.assign_range_partition(tq._nullable(b), "v", 100, 1700, 8), 8), f"{tq._NULLABLE}, parted AS (SELECT *, {tq._RANGE} AS part FROM src) {_PER_PART.format('parted')}")


def _cut_tasks(b: Bed) -> DataFrame:
    cuts = pt.cuts_by_count(pt.bucket_histogram(tq._nullable(b), tq._bucket()), 5)
    return _files_of(b, pt.assign_cut_partition(tq._nullable(b), tq._bucket(), cuts), len(cuts) + 2)


add("s6_cut_tasks", _cut_tasks, f"{tq._CUT_PARTS} {_PER_PART.format('parted')}")
_EXCLUSIVE = ["v < 500", "v >= 500 AND v < 1000", "v >= 1000"]
add("s8_predicate_tasks", lambda b: _files_of(b, tq._nullable(b).withColumn("part", pt.predicate_number(_EXCLUSIVE)), 4),
    f"{tq._NULLABLE}, parted AS (SELECT *, CASE WHEN v IS NULL THEN 3 WHEN v < 500 THEN 0 WHEN v < 1000 THEN 1 ELSE 2 END AS part FROM src) {_PER_PART.format('parted')}")


def _even(b: Bed) -> DataFrame:
    path = shared_dir(b.spark, "even")
    rows = b.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    ld.write_even(rows, path)
    return ld.read_batch(b.spark, path, rows.schema)


add("s10_write_even", _even, "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")


# Loads
def _refused(b: Bed) -> DataFrame:
    """Two writers replace version 0; the first has committed when the second comes, which is refused."""
    base = shared_dir(b.spark, "refused")
    first = ld.commit_version(b.target, base)
    ld.commit_version(ld.load_replace(b.target, b.staged), base, after=first)
    refused = 0
    try:
        ld.commit_version(b.target.limit(1), base, after=first)
    except Conflict:
        refused = 1
    return ld.read_version(b.spark, base).withColumns({"version": F.lit(ld.versions(b.spark, base)[-1]), "refused": F.lit(refused)})


add("s13_refused_replacement", _refused, "SELECT *, 1 AS version, 1 AS refused FROM staged")


def _increments(b: Bed) -> DataFrame:
    """The run log up to a day, then all of it: rows beyond the mark are added, and the mark with them."""
    rows = b.run_log.select("event_id", "table_name", "state", "run_date")
    store = DatedTable(b.spark, shared_dir(b.spark, "increments"), rows.schema, day="run_date")
    store.append_new(rows.filter("run_date < DATE '2024-01-15'"), "event_id")
    store.append_new(rows, "event_id")
    store.append_new(rows, "event_id")  # nothing new
    return store.read().withColumn("mark", F.lit(store.mark()).cast("long"))


add("s14_s15_stored_increments", _increments, """, first AS (SELECT max(event_id) AS mark FROM run_log WHERE run_date < DATE '2024-01-15')
SELECT event_id, table_name, state, run_date, (SELECT max(event_id) FROM run_log) AS mark FROM run_log, first WHERE run_date < DATE '2024-01-15' OR event_id > first.mark""")  # fmt: skip


def _stored_merge(b: Bed) -> DataFrame:
    """The target merged with all staged rows, then with new keys alone: the second merge leaves every file of the first in place."""
    store = _store(b.target, "merged", key="c_custkey", files=8)
    store.merge(b.staged, ["c_custkey"])
    before = store.list_files()
    added = b.staged.filter("c_nationkey = 7").withColumn("c_custkey", -F.col("c_custkey"))
    store.merge(added, ["c_custkey"])
    lost = before.join(store.list_files(), "file", "left_anti").count()
    return store.read().withColumn("lost_files", F.lit(lost))


add("s16_stored_merge", _stored_merge, """SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, coalesce(s.balance, t.balance) AS balance, coalesce(s.segment, t.segment) AS segment, 0 AS lost_files
FROM target t FULL JOIN staged s ON s.c_custkey = t.c_custkey UNION ALL SELECT -c_custkey, c_name, c_nationkey, balance, segment, 0 FROM staged WHERE c_nationkey = 7 AND c_custkey <> 0""")  # fmt: skip


def _stored_range(b: Bed) -> DataFrame:
    """All balances by month, of which the days of a range are rewritten twice; ``lost_files`` counts files of other months that are gone."""
    store = _store(tq._small(b), "range", day="date", unit="month")
    others = store.list_files().filter("part <> '1998-02-01'")
    for _ in range(2):
        store.rewrite_range(tq._fresh(b), date(1998, 2, 1), date(1998, 2, 15))
    return store.read().withColumn("lost_files", F.lit(others.join(store.list_files(), "file", "left_anti").count()))


add("s20_stored_range", _stored_range, "SELECT date, load_seq, CASE WHEN date BETWEEN DATE '1998-02-01' AND DATE '1998-02-15' THEN CAST(amount_mn * 2 AS DOUBLE) ELSE CAST(amount_mn AS DOUBLE) END AS amount_mn, 0 AS lost_files FROM closing WHERE NOT (date BETWEEN DATE '1998-02-01' AND DATE '1998-02-15' AND load_seq % 2 = 1)")


def _stored_days(b: Bed) -> DataFrame:
    store = _store(tq._small(b), "days", day="date", unit="month")
    store.rewrite_days(tq._fresh(b).filter("load_seq % 7 = 0"))
    return store.read()


add("s21_stored_days", _stored_days, "SELECT date, load_seq, CAST(amount_mn AS DOUBLE) AS amount_mn FROM closing WHERE date NOT IN (SELECT date FROM closing WHERE load_seq % 14 = 0) UNION ALL SELECT date, load_seq, CAST(amount_mn * 2 AS DOUBLE) FROM closing WHERE load_seq % 14 = 0")


def _stored_retention(b: Bed) -> DataFrame:
    """Balances of the last 400 days of the data, after the files of older ones are deleted; a reader of the version before had them all."""
    store = _store(tq._small(b), "retention", day="date", unit="month")
    last = tq._small(b).agg(F.max("date")).first()[0]
    store.retain(last, 400)
    store.vacuum()
    return store.read()


add("s22_stored_retention", _stored_retention, "SELECT date, load_seq, CAST(amount_mn AS DOUBLE) AS amount_mn FROM closing WHERE date >= (SELECT max(date) FROM closing) - INTERVAL 400 DAY")


def _stored_report(b: Bed) -> DataFrame:
    """The product report, kept as a table: its horizon is rewritten by what the months of the horizon give, older rows stay.

    The table starts as the report from 150 days before the end on, with balances of zero; only the horizon is worked out anew.
    """
    last = con.project_forward(_source(b), b.calendar, tq.DAY).select("date").unionByName(_source(b).select("date"))
    ends = cal.report_start(last).withColumn("older", F.trunc(F.date_sub("start", 90), "MM")).first()
    older = tq._report_since(b, ends["older"]).withColumns({a: F.lit(0).cast("decimal(18,2)") for a in re.AMOUNTS})
    store = _store(older, "report", day="date", unit="month")
    fresh = tq._report_since(b, ends["start"])
    store.rewrite_range(fresh, ends["start"], date(9999, 12, 31))
    return store.read()


_ALL = "(SELECT * FROM loans UNION ALL SELECT * FROM deposits UNION ALL SELECT * FROM borrowings UNION ALL SELECT * FROM repos)"
_ZERO = ", ".join(f"CASE WHEN date >= horizon.start THEN CAST({a} AS DOUBLE) ELSE 0.0 END AS {a}" for a in re.AMOUNTS)
add("r5_stored_report", _stored_report, f"""{tq.REPORT_SQL}, horizon AS (SELECT CAST(date_trunc('month', max(date) - INTERVAL 60 DAY) AS DATE) AS start FROM base)
SELECT date, level_1, level_2, level_3, rubro, currency, account_currency, {_ZERO} FROM {_ALL}, horizon WHERE date >= date_trunc('month', horizon.start - INTERVAL 90 DAY)""")  # fmt: skip


# Figures of a load from the pass that writes it
def _audited(b: Bed) -> DataFrame:
    """Log rows of four loads of one table: whole, without rows, stopped by a rule, and with rows dropped; and what the table holds in the end."""
    store = DatedTable(b.spark, shared_dir(b.spark, "audited"), b.target.schema)
    none = {"far": (F.when(F.col("c_custkey") >= 0, F.lit(True)).otherwise(F.raise_error(F.lit("x")).cast("boolean")), "warn")}
    stopped = {"long": (F.when(F.col("c_custkey") < 0, F.lit(True)).otherwise(F.raise_error(F.lit("a negative key was due")).cast("boolean")), "fail")}
    out = au.load_audited(store, b.target, "whole", "1", none)
    out = out.unionByName(au.load_audited(store, b.target.filter("c_custkey < 0"), "none", "2"))
    out = out.unionByName(au.load_audited(store, b.target, "stopped", "3", stopped))
    out = out.unionByName(au.load_audited(store, tq._changed(b), "rules", "4", {k: r for k, r in tq._rules().items() if r[1] != "fail"}))
    return out.select("table_name", "batch_id", "state", "n_rows", F.col("message").contains("a negative key was due").alias("told"), (F.col("seconds") >= 0).alias("timed"), F.lit(store.read().count()).alias("held"), F.lit(store.version()).alias("version"))


_KEPT = "SELECT count(*) FROM target WHERE balance + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END > 0"
add("a1_audited_load", _audited, f"""SELECT t.*, true AS timed, ({_KEPT}) AS held, 1 AS version FROM (
SELECT 'whole' AS table_name, '1' AS batch_id, 'TERMINADO' AS state, count(*) AS n_rows, CAST(NULL AS BOOLEAN) AS told FROM target UNION ALL SELECT 'none', '2', 'SIN_DATOS', 0, NULL
UNION ALL SELECT 'stopped', '3', 'ERROR', 0, true UNION ALL SELECT 'rules', '4', 'TERMINADO', ({_KEPT}), NULL) t""")  # fmt: skip


def _observed_rules(b: Bed) -> DataFrame:
    """Broken rules as the load's own log row tells them."""
    store = DatedTable(b.spark, shared_dir(b.spark, "observed"), b.target.schema)
    rules = tq._rules()
    row = au.load_audited(store, tq._changed(b), "target", "1", rules)
    severity = F.create_map(*[F.lit(x) for name, (_, s) in rules.items() for x in (name, s)])
    return row.select(F.explode("broken").alias("rule", "broken")).select("rule", severity[F.col("rule")].alias("severity"), "broken")


add("q17_observed_rules", _observed_rules, SELECTS["q17_expectation_counts"])
