"""Calendar, series, consolidated and variation queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.classify import classify_universe, credit_buckets
from tidemark.operators import calendar as cal
from tidemark.operators import consolidated as con
from tidemark.operators import series as ser
from tidemark.operators import variation as var
from tidemark.plans.bed import Bed
from tidemark.plans.registry import CARRIED, D_HI, D_LO, D_START, HI, LO, MEASURES, START, add
from tidemark.tables import materialize

KEYS = ["id_operation", "rubro"]
AMOUNTS = ("amount_mo", "amount_mn")


def daily(b: Bed) -> DataFrame:
    return ser.propagate_business_days(b.closing, b.calendar, LO, HI)


def single(b: Bed, mode: str = "sum") -> DataFrame:
    narrow = daily(b).select(*KEYS, "date", *CARRIED, "origin_kind", *AMOUNTS)
    return ser.dedup_day(narrow, [*KEYS, "date"], [F.col("load_seq").desc()], AMOUNTS, mode)


def filled(b: Bed) -> DataFrame:
    return ser.fill_month(single(b), b.calendar, KEYS, HI, AMOUNTS)


def totals(b: Bed) -> DataFrame:
    return ser.daily_totals(credit_buckets(classify_universe(filled(b))), ["id_operation"], MEASURES)


# Calendar
add("j1_business_day_asof", lambda b: cal.business_day_asof(b.calendar), "SELECT c.*, (SELECT max(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day <= c.day) AS origin FROM calendar c")
add("j2_business_day_strict", lambda b: cal.business_day_asof(b.calendar, inclusive=False).filter("is_business = 'N'"), "SELECT c.*, (SELECT max(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day < c.day) AS origin FROM calendar c WHERE is_business = 'N'")
add("j3_next_business_day", lambda b: cal.next_business_day(b.calendar), "SELECT c.*, (SELECT min(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day > c.day) AS next_business FROM calendar c")
for option in (2, 3, 4):
    test = "" if option == 3 else "AND x.date = last_day(x.date)"
    add(f"j4_pair_dates_{option}", lambda b, o=option: cal.pair_dates(b.snapshots.select("date").distinct(), o), f"SELECT DISTINCT s.date, (SELECT max(x.date) FROM snapshots x WHERE x.date < s.date {test}) AS previous FROM snapshots s")
add("p24_report_start", lambda b: cal.report_start(b.closing), "SELECT CAST(date_trunc('month', max(date) - INTERVAL 60 DAY) AS DATE) AS start FROM closing")
add("b5w_operating_window", lambda b: cal.operating_window(b.calendar, HI, 1500, b.closing), f"SELECT {D_HI} AS \"end\", max(day) AS read_from, CAST(date_trunc('month', max(day)) AS DATE) AS write_from FROM calendar WHERE is_business = 'S' AND day <= {D_HI} - INTERVAL 1500 DAY")


def _range(b: Bed) -> DataFrame:
    lo, hi = cal.resolve_range(b.closing, "date", "MES", START)
    day, _ = cal.resolve_range(b.closing, "date", "DIARIO")
    return b.closing.filter(F.col("date").between(F.lit(lo), F.lit(hi)) | (F.col("date") == F.lit(day))).select("load_seq", "date")


add("p23_resolve_range", _range, "SELECT load_seq, date FROM closing WHERE strftime(date, '%Y-%m') = '1995-02' OR date = (SELECT max(date) FROM closing)")

# Series
add("b1_propagate_business_days", lambda b: daily(b).select("date", "load_seq", "origin_kind", "amount_mn"), "SELECT date, load_seq, origin_kind, CAST(amount_mn AS DOUBLE) AS amount_mn FROM daily", series=True)
add("b1d_dedup_day_sum", single, f"SELECT id_operation, rubro, date, {', '.join(CARRIED)}, origin_kind, CAST(amount_mo AS DOUBLE) AS amount_mo, CAST(amount_mn AS DOUBLE) AS amount_mn FROM single", series=True)
add("b1d_dedup_day_best", lambda b: single(b, "best").select(*KEYS, "date", "load_seq", *AMOUNTS), "SELECT id_operation, rubro, date, max(load_seq) AS load_seq, CAST(arg_max(amount_mo, (load_seq, amount_mo, amount_mn)) AS DOUBLE) AS amount_mo, CAST(arg_max(amount_mn, (load_seq, amount_mo, amount_mn)) AS DOUBLE) AS amount_mn FROM daily GROUP BY id_operation, rubro, date", series=True)
_FILLED = f"SELECT id_operation, rubro, date, {', '.join(CARRIED)}, origin_kind, CAST(amount_mo AS DOUBLE) AS amount_mo, CAST(amount_mn AS DOUBLE) AS amount_mn FROM filled"
add("b2_fill_month", filled, _FILLED, series=True)
add("b2a_fill_month_strict", lambda b: ser.fill_month(single(b), b.calendar, KEYS, HI, AMOUNTS, strict_anchor=True).select(*KEYS, "date", "load_seq", "origin_kind"), """,
strict AS (SELECT p.*, coalesce((SELECT max(s.date) FROM single s WHERE s.id_operation = p.id_operation AND s.rubro = p.rubro AND s.date = p.date),
    (SELECT max(s.date) FROM single s WHERE s.id_operation = p.id_operation AND s.rubro = p.rubro AND s.date <= p.date AND s.origin_kind = 'ORIGINAL' AND date_trunc('month', s.date) = date_trunc('month', p.date)),
    (SELECT min(s.date) FROM single s WHERE s.id_operation = p.id_operation AND s.rubro = p.rubro AND s.date >= p.date AND s.origin_kind = 'ORIGINAL' AND date_trunc('month', s.date) = date_trunc('month', p.date))) AS anchor FROM spine p)
SELECT a.id_operation, a.rubro, a.date, s.load_seq, CASE WHEN a.date = a.anchor THEN s.origin_kind ELSE 'RELLENO' END AS origin_kind FROM strict a JOIN single s ON s.id_operation = a.id_operation AND s.rubro = a.rubro AND s.date = a.anchor""", series=True)  # fmt: skip
# The same completion by recursion over days, as an independent count of rows per key and month.
add("b2r_month_days", lambda b: filled(b).groupBy(*KEYS, F.trunc("date", "MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(F.col("origin_kind") == "RELLENO").alias("added")), f""",
first_days AS (SELECT id_operation, rubro, CAST(date_trunc('month', date) AS DATE) AS month, min(CASE WHEN origin_kind = 'ORIGINAL' THEN date END) AS original, min(date) AS any_day, count(*) AS n FROM single GROUP BY 1, 2, 3),
walk AS (SELECT id_operation, rubro, month, CASE WHEN original IS NOT NULL THEN month ELSE any_day END AS d FROM first_days UNION ALL
    SELECT id_operation, rubro, month, CAST(d + INTERVAL 1 DAY AS DATE) FROM walk WHERE d < least(last_day(month), {D_HI}))
SELECT w.id_operation, w.rubro, w.month, count(*) AS n, count(*) - any_value(f.n) AS added FROM walk w JOIN first_days f USING (id_operation, rubro, month) GROUP BY 1, 2, 3""", series=True)  # fmt: skip
add("b3_daily_totals", totals, f"SELECT *, CAST(day(date) AS INTEGER) AS day_number, CAST(day(last_day(date)) AS INTEGER) AS month_days FROM totals", series=True)
add("b4_running_month_average", lambda b: ser.running_month_average(totals(b), ["id_operation"], MEASURES, exact=True).drop("day_number", "month_days"), "SELECT * FROM averaged", series=True)
_B5 = ["id_operation", "date", "rubro", "module", "account", "load_seq", "origin_kind", "amount_mo", "amount_mn", "overdue_amount_mn", "avg_amount_mo", "avg_amount_mn", "avg_overdue_amount_mn"]


def operating(b: Bed) -> DataFrame:
    narrow = b.closing.select(*KEYS, "date", *CARRIED, *AMOUNTS)
    return ser.operating_balances(narrow, b.calendar, LO, HI, START, exact=True, accounts=b.accounts).select(*_B5, "executive")


add("b5_operating_balances", operating, f""", pick AS (SELECT id_operation, date, {', '.join(f'arg_max({c}, (load_seq, 1e9 - CAST(rubro AS BIGINT))) AS {c}' for c in ('rubro', 'module', 'account', 'load_seq', 'origin_kind'))} FROM bucketed GROUP BY id_operation, date)
SELECT {', '.join(_B5)}, (SELECT max(executive) FROM accounts a WHERE a.account = pick.account) AS executive FROM averaged JOIN pick USING (id_operation, date) WHERE date >= {D_START}""", series=True)  # fmt: skip
add("b6_balance_grid", lambda b: ser.balance_grid(b.closing, b.calendar, "id_operation", START, HI, AMOUNTS), f"""
SELECT k.id_operation, c.day AS date, k.account, k.currency, k.module, coalesce((SELECT CAST(sum(amount_mo) AS DOUBLE) FROM closing x WHERE x.id_operation = k.id_operation AND x.date = c.day), 0) AS amount_mo,
    coalesce((SELECT CAST(sum(amount_mn) AS DOUBLE) FROM closing x WHERE x.id_operation = k.id_operation AND x.date = c.day), 0) AS amount_mn
FROM (SELECT id_operation, arg_max(account, (date, load_seq)) AS account, arg_max(currency, (date, load_seq)) AS currency, arg_max(module, (date, load_seq)) AS module FROM closing GROUP BY id_operation) k CROSS JOIN (SELECT day FROM calendar WHERE day BETWEEN {D_START} AND {D_HI}) c""")  # fmt: skip
_ACC = ["company", "module", "account", "operation", "currency"]
_RUN = """, base AS ({base}), shown AS (SELECT a.*, CAST((SELECT sum(x.amount_mn) FROM base x WHERE {match} AND x.date <= a.date AND date_trunc('month', x.date) = date_trunc('month', a.date)) AS DOUBLE) AS running_sum,
    (SELECT count(*) FROM base x WHERE {match} AND x.date <= a.date AND date_trunc('month', x.date) = date_trunc('month', a.date)) AS running_days FROM base a)
SELECT * REPLACE (CAST(amount_mn AS DOUBLE) AS amount_mn), running_sum / running_days AS running_avg FROM shown"""


def _running(base: str, keys: list[str]) -> str:
    return _RUN.format(base=base, match=" AND ".join(f"x.{k} = a.{k}" for k in keys))


add("b7_rubro_average", lambda b: ser.rubro_average(b.closing, [*_ACC, "rubro"], "amount_mn", exact=True), _running(f"SELECT {', '.join(_ACC)}, rubro, date, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS amount_mn FROM closing GROUP BY ALL", [*_ACC, "rubro"]))
_B8 = f"SELECT {', '.join(_ACC)}, date, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS amount_mn, count(DISTINCT rubro) AS codes FROM closing GROUP BY ALL"
add("b8_account_average", lambda b: ser.account_average(b.closing, _ACC, "rubro", "amount_mn", exact=True), _running(_B8, _ACC))
# The same by a key that grows with the tables.
_CUSTOMER = ["company", "customer", "currency"]
add("b8_customer_average", lambda b: ser.account_average(b.closing, _CUSTOMER, "rubro", "amount_mn", exact=True), _running(f"SELECT {', '.join(_CUSTOMER)}, date, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS amount_mn, count(DISTINCT rubro) AS codes FROM closing GROUP BY ALL", _CUSTOMER))
add("b9_closed_month", lambda b: ser.closed_month(ser.account_average(b.closing, _ACC, "rubro", "amount_mn", exact=True), _ACC), _running(_B8, _ACC) + f" s WHERE date = (SELECT max(x.date) FROM base x WHERE {' AND '.join(f'x.{k} = s.{k}' for k in _ACC)} AND date_trunc('month', x.date) = date_trunc('month', s.date))")


def _business_average(b: Bed) -> DataFrame:
    rows = filled(b).groupBy("id_operation", "date").agg(F.sum("amount_mn").cast("decimal(18,2)").alias("amount_mn"))
    rows = rows.join(F.broadcast(b.calendar.select(F.col("day").alias("date"), "is_business")), "date")  # one row a day
    return ser.running_month_average(rows, ["id_operation"], ["amount_mn"], business_only=True, exact=True)


add("b10_business_day_average", _business_average, """, t AS (SELECT f.id_operation, f.date, c.is_business, CAST(sum(f.amount_mn) AS DECIMAL(18,2)) AS amount_mn FROM filled f JOIN calendar c ON c.day = f.date GROUP BY ALL)
SELECT a.id_operation, a.date, a.is_business, CAST(any_value(a.amount_mn) AS DOUBLE) AS amount_mn, CAST(sum(CASE WHEN x.is_business = 'S' THEN x.amount_mn END) AS DOUBLE) / nullif(count(CASE WHEN x.is_business = 'S' THEN 1 END), 0) AS avg_amount_mn
FROM t a JOIN t x ON x.id_operation = a.id_operation AND x.date <= a.date AND date_trunc('month', x.date) = date_trunc('month', a.date) GROUP BY a.id_operation, a.date, a.is_business""", series=True)  # fmt: skip

# Consolidated
#: The processing day, a Friday after which the tables have next to nothing.
DAY = date(2001, 11, 2)
DAYS = (DAY - START).days
READ = con.consolidated_window(DAY, DAYS)[0]
D_DAY, D_READ = f"DATE '{DAY}'", f"DATE '{READ}'"
_SHORT, _LONG = ", ".join(con.SHORT), ", ".join(con.LONG)
_same = lambda keys, a="x", b="s": " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)
CON_SQL = f""",
src AS (SELECT date, {_LONG}, mo, mn FROM sdc WHERE date BETWEEN {D_READ} AND {D_DAY}),
holidays AS (SELECT day, (SELECT max(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day < c.day) AS origin FROM calendar c WHERE is_business = 'N' AND day BETWEEN {D_READ} AND {D_DAY}),
copies AS (SELECT h.day AS date, s.* EXCLUDE (date) FROM src s JOIN holidays h ON h.origin = s.date WHERE NOT EXISTS (SELECT 1 FROM src x WHERE x.date = h.day AND {_same(con.SHORT)})),
ahead AS (SELECT c.day AS date, s.* EXCLUDE (date) FROM src s JOIN calendar c ON c.day > {D_DAY} AND c.day < (SELECT min(day) FROM calendar WHERE is_business = 'S' AND day > {D_DAY}) WHERE s.date = {D_DAY}),
base AS (SELECT date, {_LONG}, CAST(sum(mo) AS DECIMAL(18,2)) AS mo, CAST(sum(mn) AS DECIMAL(18,2)) AS mn FROM (SELECT * FROM src UNION ALL SELECT * FROM copies UNION ALL SELECT * FROM ahead) GROUP BY ALL),
lasts AS (SELECT {_SHORT}, date_trunc('month', date) AS m, max(date) AS last FROM base WHERE rubro <> '0' GROUP BY ALL),
chosen AS (SELECT DISTINCT ON ({', '.join('b.' + k for k in con.SHORT)}, l.m) b.*, l.m, l.last FROM base b JOIN lasts l ON {_same(con.SHORT, 'l', 'b')} AND b.date = l.last WHERE l.last < last_day(l.last) ORDER BY title, b.branch, chapter, term, grp),
fill_a AS (SELECT c.day AS date, {', '.join('s.' + k for k in con.LONG)}, CAST(0 AS DECIMAL(18,2)) AS mo, CAST(0 AS DECIMAL(18,2)) AS mn FROM chosen s JOIN calendar c ON date_trunc('month', c.day) = s.m AND c.day > s.last AND c.day <= {D_DAY}),
with_a AS (SELECT * FROM base UNION ALL SELECT * FROM fill_a),
fill_b AS (SELECT DISTINCT c.day AS date, {', '.join('s.' + k for k in con.LONG)}, CAST(0 AS DECIMAL(18,2)) AS mo, CAST(0 AS DECIMAL(18,2)) AS mn FROM with_a s JOIN calendar c ON date_trunc('month', c.day) = s.date + INTERVAL 1 DAY AND c.is_business = 'S' AND c.day <= {D_DAY}
    WHERE s.date = last_day(s.date) AND s.mo <> 0 AND NOT EXISTS (SELECT 1 FROM with_a x WHERE {_same(con.LONG)} AND date_trunc('month', x.date) = s.date + INTERVAL 1 DAY)),
with_b AS (SELECT * FROM with_a UNION ALL SELECT * FROM fill_b),
fill_c AS (SELECT c.day AS date, {', '.join('s.' + k for k in con.LONG)}, CAST(0 AS DECIMAL(18,2)) AS mo, CAST(0 AS DECIMAL(18,2)) AS mn FROM (SELECT DISTINCT {_LONG}, date_trunc('month', date) AS m FROM with_b) s
    JOIN calendar c ON date_trunc('month', c.day) = s.m AND c.is_business = 'S' AND c.day <= {D_DAY} WHERE NOT EXISTS (SELECT 1 FROM with_b x WHERE x.date = c.day AND {_same(con.LONG)})),
complete AS (SELECT * FROM with_b UNION ALL SELECT * FROM fill_c),
changed AS (SELECT s.*, {', '.join(f"CAST(s.{m} - CASE WHEN month(s.date) = 1 THEN 0 ELSE coalesce((SELECT sum(x.{m}) FROM complete x WHERE {_same(con.LONG)} AND x.date = date_trunc('month', s.date) - INTERVAL 1 DAY), 0) END AS DECIMAL(18,2)) AS change_{m}" for m in con.MEASURES)} FROM complete s),
figures AS (SELECT s.*, {', '.join(f"CASE WHEN s.{m} = 0 THEN 0.0::DOUBLE ELSE CAST((SELECT sum(x.{m}) FROM complete x WHERE {_same(con.LONG)} AND x.date <= s.date AND date_trunc('month', x.date) = date_trunc('month', s.date)) AS DOUBLE) / (SELECT count(*) FROM complete x WHERE {_same(con.LONG)} AND x.date <= s.date AND date_trunc('month', x.date) = date_trunc('month', s.date)) END AS avg_{m}" for m in con.MEASURES)} FROM changed s),
written AS (SELECT * FROM figures WHERE date >= {D_START}),
again AS (SELECT h.day AS date, s.* EXCLUDE (date) FROM written s JOIN holidays h ON h.origin = s.date AND h.day >= {D_START} WHERE NOT EXISTS (SELECT 1 FROM written x WHERE x.date = h.day AND {_same(con.LONG)}))
"""  # fmt: skip
_two = f"SELECT date, {_LONG}, CAST(mo AS DOUBLE) AS mo, CAST(mn AS DOUBLE) AS mn FROM "


def _source(b: Bed) -> DataFrame:
    return b.sdc.filter(F.col("date").between(F.lit(READ), F.lit(DAY))).select("date", *con.LONG, "mo", "mn")


def _base(b: Bed, lo: date = READ) -> DataFrame:
    """The consolidated rows from ``lo`` on; ten days before are read, of which days without business are copies."""
    rows = _source(b).filter(F.col("date") >= F.date_sub(F.lit(lo), 10))
    rows = rows.unionByName(con.copy_non_business(rows, b.calendar, READ, DAY)).unionByName(con.project_forward(rows, b.calendar, DAY))
    sums = rows.groupBy("date", *con.LONG).agg(F.sum("mo").cast("decimal(18,2)").alias("mo"), F.sum("mn").cast("decimal(18,2)").alias("mn"))
    return materialize(sums.filter(F.col("date") >= F.lit(lo)), "consolidated-base")


def _with_a(b: Bed) -> DataFrame:
    base = _base(b)
    return base.unionByName(materialize(con.fill_to_month_end(base, b.calendar, DAY), "consolidated-a"))


def _with_b(b: Bed) -> DataFrame:
    rows = _with_a(b)
    return rows.unionByName(materialize(con.fill_next_month(rows, b.calendar, DAY), "consolidated-b"))


add("c1_copy_non_business", lambda b: con.copy_non_business(_source(b), b.calendar, READ, DAY), CON_SQL + _two + "copies")
add("c3_project_forward", lambda b: con.project_forward(_source(b), b.calendar, DAY), CON_SQL + _two + "ahead")
add("c4_fill_to_month_end", lambda b: con.fill_to_month_end(_base(b), b.calendar, DAY), CON_SQL + _two + "fill_a")
add("c5_fill_next_month", lambda b: con.fill_next_month(_with_a(b), b.calendar, DAY), CON_SQL + _two + "fill_b")
add("c6_fill_intra_month", lambda b: con.fill_intra_month(_with_b(b), b.calendar, DAY), CON_SQL + _two + "fill_c")
add("c7_representative", lambda b: con.representative(_base(b)), CON_SQL + f"SELECT DISTINCT ON (date, {_SHORT}) date, {_LONG}, CAST(mo AS DOUBLE) AS mo, CAST(mn AS DOUBLE) AS mn FROM base ORDER BY date, {_SHORT}, title, branch, chapter, term, grp")
_figures = f"SELECT date, {_LONG}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ('mo', 'mn', 'change_mo', 'change_mn'))}"
add("c8_monthly_change", lambda b: con.changes(con.complete(_source(b), b.calendar, READ, DAY)), CON_SQL + _figures + " FROM changed")
add("c9_zero_override_average", lambda b: con.averages(con.complete(_source(b), b.calendar, READ, DAY), exact=True), CON_SQL + f"SELECT date, {_LONG}, CAST(mo AS DOUBLE) AS mo, CAST(mn AS DOUBLE) AS mn, avg_mo, avg_mn FROM figures")
add("c10_copy_computed", lambda b: con.daily_consolidated(_source(b), b.calendar, DAY, DAYS, exact=True).join(F.broadcast(b.calendar.filter("is_business = 'N'").select(F.col("day").alias("date"))), "date").select("date", *con.LONG, "mo", "mn"),
    CON_SQL + f"SELECT s.* FROM ({_two} written UNION ALL {_two} again) s JOIN calendar c ON c.day = s.date AND c.is_business = 'N'")
add("c11_daily_consolidated", lambda b: con.daily_consolidated(_source(b), b.calendar, DAY, DAYS, exact=True), CON_SQL + f"{_figures}, avg_mo, avg_mn FROM (SELECT * FROM written UNION ALL SELECT * FROM again)")
_PARTS = ["company", "module", "branch", "currency", "paper", "account", "operation", "sub_operation", "operation_type", "rubro", "load_seq", "amount_mn"]
add("k1_closing_balances", lambda b: ser.closing_balances(b.closing.select("date", *_PARTS), b.calendar, START, DAY).select("date", "id_operation", "id_balance", "id_cross", "rubro", "load_seq", "module_product", "origin_kind", "amount_mn"), f"""
SELECT date, id_operation, id_balance, id_cross, rubro, load_seq, module AS module_product, origin_kind, CAST(amount_mn AS DOUBLE) AS amount_mn FROM (
SELECT *, 'ORIGINAL' AS origin_kind FROM closing WHERE date BETWEEN {D_START} AND {D_DAY}
UNION ALL BY NAME SELECT * REPLACE (c.day AS date), 'COPIA_HABIL' AS origin_kind FROM (SELECT b.*, c.day FROM closing b JOIN calendar c ON c.is_business = 'N' AND c.day BETWEEN {D_START} AND {D_DAY} AND b.date = (SELECT max(x.day) FROM calendar x WHERE x.is_business = 'S' AND x.day < c.day)) c
UNION ALL BY NAME SELECT * REPLACE (c.day AS date), 'PROYECTADO' AS origin_kind FROM (SELECT b.*, c.day FROM closing b JOIN calendar c ON b.date = {D_DAY} AND c.day > {D_DAY} AND c.day < (SELECT min(day) FROM calendar WHERE is_business = 'S' AND day > {D_DAY})) c)""")  # fmt: skip

# Variation
_VK = ", ".join(var.KEYS)
_flag = """CASE WHEN module = 20 THEN CASE WHEN origin_type = 8 THEN 10 ELSE 7 END WHEN module = 21 THEN 8 WHEN module = 22 THEN CASE WHEN origin_type = 10 THEN 11 ELSE 9 END WHEN module = 120 THEN CASE WHEN origin_type = 30 THEN 4 ELSE 3 END
    WHEN module = 155 THEN 10 WHEN module = 185 THEN CASE origin_type WHEN 0 THEN 5 WHEN 15 THEN 3 WHEN 3 THEN 10 ELSE 2 END WHEN module = 321 THEN 6 ELSE 0 END"""  # fmt: skip
VAR_SQL = """, pairs AS ({pairs}),
three AS (
SELECT c.date, p.previous, {ck}, c.amount_mn, p0.amount_mn AS previous_amount_mn, c.amount_mo, p0.amount_mo AS previous_amount_mo, 'BOTH' AS "case", c.origin_type FROM pairs p JOIN snapshots c ON c.date = p.date JOIN snapshots p0 ON p0.date = p.previous AND {same}
UNION ALL SELECT p.date, p.previous, {pk}, 0, p0.amount_mn, 0, p0.amount_mo, 'GONE', p0.origin_type FROM pairs p JOIN snapshots p0 ON p0.date = p.previous WHERE NOT EXISTS (SELECT 1 FROM snapshots c WHERE c.date = p.date AND {same})
UNION ALL SELECT c.date, NULL, {ck}, c.amount_mn, 0, c.amount_mo, 0, 'NEW', c.origin_type FROM pairs p JOIN snapshots c ON c.date = p.date WHERE NOT EXISTS (SELECT 1 FROM snapshots p0 WHERE p0.date = p.previous AND {same}))
SELECT date, previous, {k}, CAST(amount_mn AS DOUBLE) AS amount_mn, CAST(previous_amount_mn AS DOUBLE) AS previous_amount_mn, CAST(amount_mn - previous_amount_mn AS DOUBLE) AS variation_amount_mn, CAST(amount_mo AS DOUBLE) AS amount_mo,
    CAST(previous_amount_mo AS DOUBLE) AS previous_amount_mo, CAST(amount_mo - previous_amount_mo AS DOUBLE) AS variation_amount_mo, "case", origin_type, {flag} AS expense_flag FROM three"""


def _variation_sql(pairs: str) -> str:
    return VAR_SQL.format(pairs=pairs, k=_VK, ck=", ".join(f"c.{k}" for k in var.KEYS), pk=", ".join(f"p0.{k}" for k in var.KEYS), same=_same(var.KEYS, "c", "p0"), flag=_flag)


add("v1_variation", lambda b: var.variation(b.snapshots, b.spark.sql("SELECT DATE '1998-02-28' AS date, DATE '1998-01-31' AS previous")), _variation_sql("SELECT DATE '1998-02-28' AS date, DATE '1998-01-31' AS previous"))
for option in (2, 3, 4):
    test = "" if option == 3 else "AND x.date = last_day(x.date)"
    pairs = f"SELECT DISTINCT s.date, (SELECT max(x.date) FROM snapshots x WHERE x.date < s.date {test}) AS previous FROM snapshots s WHERE s.date BETWEEN DATE '1995-02-02' AND {D_HI}"
    add(f"v2_variation_range_{option}", lambda b, o=option: var.variation_range(b.snapshots, date(1995, 2, 2), HI, o), _variation_sql(pairs))
add("j10_pair_snapshots", lambda b: var.pair_snapshots(b.snapshots, b.spark.sql("SELECT DATE '1998-02-28' AS date, DATE '1998-01-31' AS previous")).groupBy("module", "now", "before").agg(F.count("*").alias("n")), f""",
a AS (SELECT {_VK} FROM snapshots WHERE date = DATE '1998-02-28'), z AS (SELECT {_VK} FROM snapshots WHERE date = DATE '1998-01-31')
SELECT module, now, before, count(*) AS n FROM (SELECT {_VK}, true AS now, EXISTS (SELECT 1 FROM z WHERE {_same(var.KEYS, 'z', 'a')}) AS before FROM a UNION ALL SELECT {_VK}, false, true FROM z WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_same(var.KEYS, 'a', 'z')})) GROUP BY ALL""")  # fmt: skip
_R = ["income", "expense"]


def _results(b: Bed) -> DataFrame:
    rows = b.closing.select("id_operation", "date", F.when(F.col("code").startswith("51"), F.col("amount_mn")).alias("income"), F.when(F.col("code").startswith("41"), F.col("amount_mn")).alias("expense"))
    return var.daily_results(rows, ["id_operation"], _R)


_RES = ", res AS (SELECT id_operation, date, CAST(sum(CASE WHEN code LIKE '51%' THEN amount_mn END) AS DECIMAL(18,2)) AS income, CAST(sum(CASE WHEN code LIKE '41%' THEN amount_mn END) AS DECIMAL(18,2)) AS expense FROM closing GROUP BY 1, 2)"
add("v4_daily_results", _results, _RES + " SELECT id_operation, date, CAST(income AS DOUBLE) AS income, CAST(expense AS DOUBLE) AS expense FROM res")
_before = lambda c: f"(SELECT max(x.{c}) FROM res x WHERE x.id_operation = r.id_operation AND x.date = date_trunc('month', r.date) - INTERVAL 1 DAY)"
add("j15_month_end_self_join", lambda b: var.month_end_self_join(_results(b), ["id_operation"], _R), _RES + f" SELECT id_operation, date, CAST(income AS DOUBLE) AS income, CAST(expense AS DOUBLE) AS expense, CAST({_before('income')} AS DOUBLE) AS previous_income, CAST({_before('expense')} AS DOUBLE) AS previous_expense FROM res r")
add("v3_month_result", lambda b: var.month_result(_results(b), ["id_operation"], _R), _RES + f" SELECT id_operation, date, CAST(income AS DOUBLE) AS income, CAST(expense AS DOUBLE) AS expense, CAST(coalesce(income, 0) - coalesce({_before('income')}, 0) AS DOUBLE) AS month_income, CAST(coalesce(expense, 0) - coalesce({_before('expense')}, 0) AS DOUBLE) AS month_expense FROM res r")
