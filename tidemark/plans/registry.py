"""Registry of named queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.bed import BED_SQL, Bed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The part of a query's SQL that follows the views.
SELECTS: dict[str, str] = {}
#: All years of the tables, and the day from which results are written.
LO, HI, START = date(1995, 1, 1), date(2001, 12, 31), date(1995, 2, 1)
D_LO, D_HI, D_START = (f"DATE '{d}'" for d in (LO, HI, START))

# Attributes that a balance row carries through the series.
CARRIED = ("company", "module", "branch", "currency", "paper", "account", "operation", "load_seq")
# Asset prefixes and credit states once more, so that the twins do not rest on the library's own lists.
_ASSETS = "('1401','1403','1404','1405','1406','1411','1413','1414','1415','1416','1421','1423','1424','1425','1426')"
_STATES = {"current": "14_1", "restructured": "14_3", "refinanced": "14_4", "overdue": "14_5", "judicial": "14_6"}
_BUCKETS = ", ".join(f"CASE WHEN left(rubro, 4) IN {_ASSETS} AND left(rubro, 4) LIKE '{p}' THEN {a} ELSE 0 END AS {s}_{a}" for a in ("amount_mo", "amount_mn") for s, p in _STATES.items())
MEASURES = ["amount_mo", "amount_mn", *[f"{s}_{a}" for a in ("amount_mo", "amount_mn") for s in _STATES]]

#: Steps of the balance series in SQL, by correlated subqueries instead of windows and spines.
SERIES_SQL = f""",
days AS (SELECT day, is_business, (SELECT max(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day <= c.day) AS origin FROM calendar c WHERE day BETWEEN {D_LO} AND {D_HI}),
daily AS (SELECT d.day AS date, CASE WHEN d.day = d.origin THEN 'ORIGINAL' ELSE 'COPIA_HABIL' END AS origin_kind, b.* EXCLUDE (date) FROM days d JOIN closing b ON b.date = d.origin),
single AS (SELECT id_operation, rubro, date, {", ".join(f"arg_max({c}, load_seq) AS {c}" for c in (*CARRIED[:-1], "origin_kind"))}, max(load_seq) AS load_seq,
    CAST(sum(amount_mo) AS DECIMAL(18,2)) AS amount_mo, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS amount_mn FROM daily GROUP BY id_operation, rubro, date),
spine AS (SELECT k.id_operation, k.rubro, c.day AS date FROM (SELECT DISTINCT id_operation, rubro, date_trunc('month', date) AS m FROM single) k JOIN calendar c ON date_trunc('month', c.day) = k.m AND c.day <= {D_HI}),
anchored AS (SELECT p.*, coalesce((SELECT max(s.date) FROM single s WHERE s.id_operation = p.id_operation AND s.rubro = p.rubro AND s.date <= p.date AND date_trunc('month', s.date) = date_trunc('month', p.date)),
    (SELECT min(s.date) FROM single s WHERE s.id_operation = p.id_operation AND s.rubro = p.rubro AND s.date >= p.date AND s.origin_kind = 'ORIGINAL' AND date_trunc('month', s.date) = date_trunc('month', p.date))) AS anchor FROM spine p),
filled AS (SELECT a.id_operation, a.rubro, a.date, {", ".join(f"s.{c}" for c in CARRIED)}, CASE WHEN a.date = a.anchor THEN s.origin_kind ELSE 'RELLENO' END AS origin_kind,
    CASE WHEN a.date = a.anchor THEN s.amount_mo ELSE 0 END AS amount_mo, CASE WHEN a.date = a.anchor THEN s.amount_mn ELSE 0 END AS amount_mn
    FROM anchored a JOIN single s ON s.id_operation = a.id_operation AND s.rubro = a.rubro AND s.date = a.anchor),
bucketed AS (SELECT *, {_BUCKETS} FROM filled WHERE left(rubro, 4) IN {_ASSETS} OR module IN (20, 21, 22, 120, 155, 162, 184, 185, 321)),
totals AS (SELECT id_operation, date, {", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in MEASURES)} FROM bucketed GROUP BY id_operation, date),
averaged AS (SELECT t.id_operation, t.date, {", ".join(f"any_value(t.{m}) AS {m}, CAST(sum(u.{m}::DECIMAL(18,2)) AS DOUBLE) / day(t.date) AS avg_{m}" for m in MEASURES)} FROM totals t
    JOIN totals u ON u.id_operation = t.id_operation AND u.date <= t.date AND date_trunc('month', u.date) = date_trunc('month', t.date) GROUP BY t.id_operation, t.date)
"""


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines give the same values."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema])


def add(name: str, build: Callable[[Bed], DataFrame], sql: str | None, series: bool = False) -> None:
    """Register a query. ``sql`` is a SELECT, or further CTEs (starting with a comma) and a SELECT."""
    QUERIES[name] = lambda spark, sf_dir: doubles(build(Bed(spark, sf_dir)))
    if sql:
        SELECTS[name] = sql
        ORACLES[name] = BED_SQL + (SERIES_SQL if series else "") + sql
