"""Sources, loads, typing, keys, joins, master, reports, checks and audit queries."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import classify as cl
from tidemark.functions import keys as ky
from tidemark.functions import typing_ as ty
from tidemark.operators import audit as au
from tidemark.operators import calendar as cal
from tidemark.operators import consolidated as con
from tidemark.operators import joins as jo
from tidemark.operators import master as ma
from tidemark.operators import quality as qu
from tidemark.operators import reports as re
from tidemark.operators import series as ser
from tidemark.plans.bed import Bed
from tidemark.plans.registry import D_HI, D_START, HI, START, add
from tidemark.plans.series_queries import _ACC, CON_SQL, DAY, READ, _base, _source, filled, totals
from tidemark.sources import loads as ld
from tidemark.sources import partitioning as pt
from tidemark.tables import materialize, shared_dir

TODAY = date(2024, 1, 20)
D_TODAY = f"DATE '{TODAY}'"
RANGE = ("l_partkey", 100, 1700, 8)

# Sources and partitions
add("s1_select_source", lambda b: pt.select_source(b.table("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"], "l_quantity >= 45 AND l_discount < 0.03"), "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_discount < 0.03")
_RANGE = "CASE WHEN v IS NULL THEN 0 ELSE CAST(greatest(0, least(7, floor((CAST(v AS DOUBLE) - 100) * 8 / 1600))) AS INTEGER) END"


def _nullable(b: Bed) -> DataFrame:
    return b.table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey")).alias("v"))


_NULLABLE = ", src AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS v FROM lineitem)"
add("s2_range_partition", lambda b: pt.assign_range_partition(_nullable(b), "v", 100, 1700, 8), f"{_NULLABLE} SELECT *, {_RANGE} AS part FROM src")
add("s3_range_bounds", lambda b: b.table("lineitem").agg(F.count("*").alias("n_rows")).withColumns(dict(zip(("low", "high"), map(F.lit, pt.range_bounds(b.table("lineitem"), "l_partkey")), strict=True))), "SELECT count(*) AS n_rows, min(l_partkey) AS low, max(l_partkey) + 1 AS high FROM lineitem")
_bucket = lambda: F.floor(F.sqrt(F.col("v").cast("double")))
add("s4_bucket_histogram", lambda b: pt.bucket_histogram(_nullable(b), _bucket()), f"{_NULLABLE} SELECT CAST(floor(sqrt(v)) AS BIGINT) AS bucket, count(*) AS n FROM src WHERE v IS NOT NULL GROUP BY 1")


def _cuts(b: Bed) -> DataFrame:
    hist = materialize(pt.bucket_histogram(_nullable(b), _bucket()), "histogram")
    cuts = pt.cuts_by_count(hist, 5)
    return pt.assign_cut_partition(hist, F.col("bucket"), cuts).groupBy("part").agg(F.max("bucket").alias("cut"), F.sum("n").alias("n"))


_WALK = f"""{_NULLABLE}, hist AS (SELECT CAST(floor(sqrt(v)) AS BIGINT) AS bucket, count(*) AS n, row_number() OVER (ORDER BY floor(sqrt(v))) AS at FROM src WHERE v IS NOT NULL GROUP BY floor(sqrt(v))),
size AS (SELECT count(*) AS buckets, sum(n) AS total, least(5, count(*)) AS parts FROM hist),
walk AS (SELECT CAST(0 AS BIGINT) AS at, 0 AS part, 0 AS cuts, CAST(0 AS HUGEINT) AS upto UNION ALL
    SELECT h.at, w.cuts, w.cuts + CASE WHEN s.parts - 1 - w.cuts > 0 AND w.upto + h.n >= s.total / s.parts * (w.cuts + 1) AND s.buckets - h.at >= s.parts - 1 - w.cuts THEN 1 ELSE 0 END, w.upto + h.n
    FROM walk w JOIN hist h ON h.at = w.at + 1 CROSS JOIN size s)"""  # fmt: skip
add("s5_cuts_by_count", _cuts, f"{_WALK} SELECT w.part, max(h.bucket) AS cut, CAST(sum(h.n) AS BIGINT) AS n FROM walk w JOIN hist h ON h.at = w.at GROUP BY w.part")


def _cut_parts(b: Bed) -> DataFrame:
    cuts = pt.cuts_by_count(pt.bucket_histogram(_nullable(b), _bucket()), 5)
    return pt.assign_cut_partition(_nullable(b), _bucket(), cuts)


_CUT_PARTS = f"{_WALK}, parted AS (SELECT s.*, CASE WHEN s.v IS NULL THEN (SELECT max(part) + 1 FROM walk) ELSE w.part END AS part FROM src s LEFT JOIN hist h ON h.bucket = floor(sqrt(s.v)) LEFT JOIN walk w ON w.at = h.at)"
add("s6_cut_partition", _cut_parts, f"{_CUT_PARTS} SELECT * FROM parted")
add("s7_skew_report", lambda b: pt.skew_report(_cut_parts(b), _bucket()), f"""{_CUT_PARTS}, c AS (SELECT part, count(*) AS n FROM parted GROUP BY part), even AS (SELECT CAST(sum(n) AS DOUBLE) / count(*) AS share FROM c)
SELECT part, n, n / share AS ratio, n / share > 1.5 AS skewed, (SELECT max(k) FROM (SELECT count(*) AS k FROM parted p WHERE p.part = c.part GROUP BY floor(sqrt(v)))) > share AS single_value FROM c CROSS JOIN even""")
_PREDICATES = ["v < 500", "v >= 500 AND v < 1000", "v >= 900"]
add("s8_predicate_partitions", lambda b: pt.predicate_partitions(_nullable(b), _PREDICATES).groupBy("part", "matches").agg(F.count("*").alias("n")),
    f"{_NULLABLE}, m AS (SELECT CASE WHEN v < 500 THEN 0 WHEN v >= 500 AND v < 1000 THEN 1 WHEN v >= 900 THEN 2 END AS part, coalesce(CAST(v < 500 AS INTEGER), 0) + coalesce(CAST(v >= 500 AND v < 1000 AS INTEGER), 0) + coalesce(CAST(v >= 900 AS INTEGER), 0) AS matches FROM src) SELECT part, matches, count(*) AS n FROM m GROUP BY ALL")
add("s9_range_profile", lambda b: pt.range_profile(_nullable(b), "v", 100, 1700, 8), f"{_NULLABLE} SELECT {_RANGE} AS part, count(*) AS n, count(*) - count(v) AS nulls, min(v) AS low, max(v) AS high FROM src GROUP BY 1")


def _written(b: Bed) -> DataFrame:
    path = shared_dir(b.spark, "batch")
    rows = b.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    assert ld.write_batch(rows.filter("o_orderkey < 0"), path, 2) == "SIN_DATOS"
    ld.write_batch(rows, path, 4)
    return ld.read_batch(b.spark, path, rows.schema)


add("s10_s12_write_and_read_batch", _written, "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")


def _partitioned(b: Bed) -> DataFrame:
    path = shared_dir(b.spark, "hive")
    rows = b.table("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes"))
    ld.write_partitioned(rows, path)
    ld.write_partitioned(rows.filter("anio = 1996 AND mes <= 6").withColumn("o_totalprice", F.lit(0.0)), path)  # those months alone are replaced
    return b.spark.read.parquet(path)


add("s11_write_partitioned", _partitioned, "SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 AND month(o_orderdate) <= 6 THEN 0.0 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders")


def _replaced(b: Bed) -> DataFrame:
    """The target as version 0, replaced by the staged rows as version 1; rows tell which version they were read from."""
    base = shared_dir(b.spark, "replaced")
    before = ld.read_version(b.spark, base, ld.commit_version(b.target, base))
    ld.commit_version(ld.load_replace(before, b.staged), base)
    return ld.read_version(b.spark, base).withColumn("version", F.lit(1)).unionByName(before.withColumn("version", F.lit(0)))


add("s13_load_replace", _replaced, "SELECT *, 1 AS version FROM staged UNION ALL SELECT *, 0 FROM target")
_marks = lambda b: ld.high_water_mark(b.load_log.filter("run_date < DATE '2024-01-15'"), None)
add("s14_load_incremental", lambda b: ld.load_incremental(b.run_log.select("event_id", "table_name", "state"), "event_id", _marks(b).first()["mark"]), "SELECT event_id, table_name, state FROM run_log WHERE event_id > (SELECT max(mark_to) FROM load_log WHERE state = 'TERMINADO' AND run_date < DATE '2024-01-15')")
add("s15_high_water_mark", lambda b: b.load_log.filter("state = 'TERMINADO'").groupBy("table_name").agg(F.max("mark_to").alias("mark")).unionByName(ld.high_water_mark(b.load_log).select(F.lit("(all)").alias("table_name"), "mark")),
    "SELECT table_name, max(mark_to) AS mark FROM load_log WHERE state NOT IN ('ERROR', 'SIN_DATOS') GROUP BY 1 UNION ALL SELECT '(all)', max(mark_to) FROM load_log WHERE state NOT IN ('ERROR', 'SIN_DATOS')")
add("s16_load_merge", lambda b: ld.load_merge(b.target, b.staged, ["c_custkey"]), "SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name, coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, coalesce(s.balance, t.balance) AS balance, coalesce(s.segment, t.segment) AS segment FROM target t FULL JOIN staged s ON s.c_custkey = t.c_custkey")
add("s17_duplicated_keys", lambda b: qu.check_unique(b.target, ["c_nationkey", "segment"]), "SELECT c_nationkey, segment, count(*) AS n_rows FROM target GROUP BY ALL HAVING count(*) > 1")
_GUARDED = (["c_custkey"], ["c_nationkey", "segment"], ["c_custkey", "c_name", "c_nationkey", "balance", "segment"])
add("s17_merge_guard", lambda b: reduce(DataFrame.unionByName, [ld.merge_guard(b.target, keys) for keys in _GUARDED]), " UNION ALL ".join(
    f"SELECT '{','.join(k)}' AS keys, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS repeated, {verdict} AS verdict FROM (SELECT count(*) AS n FROM target GROUP BY {', '.join(k)})"
    for k, verdict in zip(_GUARDED, ("CASE WHEN max(n) > 1 THEN 'REPEATED' ELSE 'OK' END", "CASE WHEN max(n) > 1 THEN 'REPEATED' ELSE 'OK' END", "'KEYS_ONLY'"), strict=True)))
add("s18_merge_counts", lambda b: ld.merge_counts(b.target, b.staged, ["c_custkey"]), "SELECT (SELECT count(*) FROM staged WHERE c_custkey IN (SELECT c_custkey FROM target)) AS updated, (SELECT count(*) FROM staged WHERE c_custkey NOT IN (SELECT c_custkey FROM target)) AS inserted")
add("s19_guard_non_empty", lambda b: ld.guard_non_empty(b.staged), "SELECT * FROM staged")
_small = lambda b: b.closing.select("date", "load_seq", "amount_mn")
_fresh = lambda b: _small(b).filter("load_seq % 2 = 0").withColumn("amount_mn", (F.col("amount_mn") * 2).cast("decimal(17,2)"))
_FRESH = "CASE WHEN load_seq % 2 = 0 THEN CAST(amount_mn * 2 AS DOUBLE) END"
add("s20_rewrite_range", lambda b: ld.rewrite_range(_small(b), _fresh(b), "date", date(1998, 2, 1), date(1998, 2, 15)), "SELECT date, load_seq, CASE WHEN date BETWEEN DATE '1998-02-01' AND DATE '1998-02-15' THEN CAST(amount_mn * 2 AS DOUBLE) ELSE CAST(amount_mn AS DOUBLE) END AS amount_mn FROM closing WHERE NOT (date BETWEEN DATE '1998-02-01' AND DATE '1998-02-15' AND load_seq % 2 = 1)")
add("s21_rewrite_days", lambda b: ld.rewrite_days(_small(b), _fresh(b).filter("load_seq % 7 = 0"), "date"), "SELECT date, load_seq, CAST(amount_mn AS DOUBLE) AS amount_mn FROM closing WHERE date NOT IN (SELECT date FROM closing WHERE load_seq % 14 = 0) UNION ALL SELECT date, load_seq, CAST(amount_mn * 2 AS DOUBLE) FROM closing WHERE load_seq % 14 = 0")
add("s22_retain", lambda b: ld.retain(_small(b), "date", date(1998, 3, 31), 30), "SELECT date, load_seq, CAST(amount_mn AS DOUBLE) AS amount_mn FROM closing WHERE date >= DATE '1998-03-31' - INTERVAL 30 DAY")
add("s23_generate_rows", lambda b: ld.generate_rows(b.table("orders").select((F.col("o_orderkey") + 1).alias("n")), TODAY), f"""
SELECT n AS id, 1 + n % 9 AS pgcod, CAST(strftime({D_TODAY} - to_days(CAST(n % 730 AS INTEGER)), '%Y%m%d') AS INTEGER) AS fecha_mov, CASE n % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 840 END AS moneda, CAST(n % 9973 AS DOUBLE) + (n % 97) / 100.0 AS importe,
    (35000 + n % 1000) / 10000.0 AS tasa, 'CTA' || lpad(CAST(n AS VARCHAR), 11, '0') AS cuenta, 'MOV ' || n AS glosa FROM (SELECT o_orderkey + 1 AS n FROM orders)""")  # fmt: skip
add("s24_generate_sales", lambda b: ld.generate_sales(b.table("orders").select(F.col("o_orderkey").alias("n")), START), f"SELECT {D_START} AS date, 'SUC-' || lpad(CAST(o_orderkey % 5 + 1 AS VARCHAR), 2, '0') AS branch, (('0x' || substr(md5('sales:' || o_orderkey), 1, 12))::BIGINT % 1000000) / 100.0 AS amount FROM orders")
_SALE = "'SUC-' || lpad(CAST(o_orderkey % 5 + 1 AS VARCHAR), 2, '0') AS branch, (('0x' || substr(md5('{seed}:' || o_orderkey), 1, 12))::BIGINT % 1000000) / 100.0 AS amount FROM orders"
add("s24_generate_clients", lambda b: ld.generate_clients(b.table("customer").select(F.col("c_custkey").alias("n")), START), f"SELECT {D_START} AS date, lpad(CAST(10000000 + c_custkey AS VARCHAR), 8, '0') AS document, 'Cliente de prueba ' || c_custkey AS name FROM customer")


def _resold(b: Bed) -> DataFrame:
    """Sales of two days, of which the second is generated anew."""
    ids = b.table("orders").select(F.col("o_orderkey").alias("n"))
    both = ld.generate_sales(ids, START).unionByName(ld.generate_sales(ids, HI))
    return ld.replace_day(both, ld.generate_sales(ids, HI, "again"), "date", HI)


add("s24_replace_sales", _resold, f"SELECT {D_START} AS date, {_SALE.format(seed='sales')} UNION ALL SELECT {D_HI} AS date, {_SALE.format(seed='again')}")
add("s25_stamp_load", lambda b: ty.stamp_load(b.closing.select("load_seq", "date"), "date").withColumn("stamped", F.col("load_ts").isNotNull()).drop("load_ts"), "SELECT load_seq, date, CAST(year(date) AS INTEGER) AS anio, CAST(month(date) AS INTEGER) AS mes, true AS stamped FROM closing")

# Types and projections
_SPEC = "o_orderkey:bigint|price:decimal(17,2)|note:int|missing:varchar(5)|day:date"


def _texts(b: Bed) -> DataFrame:
    blank = F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), (F.col("o_orderkey") % 100).cast("string")))
    return b.table("orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.round("o_totalprice").cast("long").cast("string").alias("price"), blank.alias("note"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")


_TYPED = "SELECT o_orderkey, CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE) AS price, {note} AS note, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders"
add("p1_p2_apply_types", lambda b: ty.apply_types(_texts(b), ty.parse_types(_SPEC)), _TYPED.format(note="CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 100 AS INTEGER) END"))
add("p3_coerce_types", lambda b: ty.apply_types(_texts(b).withColumn("note", F.when(F.col("o_orderkey").cast("long") % 3 == 0, "n/a").otherwise(F.col("note"))), ty.parse_types(_SPEC), mode="coerce"), _TYPED.format(note="CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 100 AS INTEGER) END"))
_TARGET = T.StructType([T.StructField("FECHA_PROCESO", T.DateType()), T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("day", T.DateType())])
add("p4_conform_to", lambda b: ty.conform_to(_texts(b).drop("note"), _TARGET), "SELECT o_orderkey, CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders")
add("p5_stamp_batch", lambda b: ty.stamp_batch(b.target.select("c_custkey", "segment"), START, "20240120000000"), f"SELECT {D_START} AS FECHA_PROCESO, c_custkey, segment, '20240120000000' AS BATCH_ID FROM target")
add("p6_operation_keys", lambda b: b.closing.select("load_seq", "id_operation", "id_balance", "id_cross"), """SELECT load_seq, company || '|' || module || '|' || branch || '|' || currency || '|' || paper || '|' || account || '|' || operation || '|' || sub_operation || '|' || operation_type AS id_operation,
    company || '|' || branch || '|' || currency || '|' || paper || '|' || account || '|' || operation || '|' || sub_operation || '|' || operation_type AS id_balance, company || '|' || branch || '|' || currency || '|' || paper || '|' || account || '|' || operation || '|' || sub_operation AS id_cross FROM closing""")  # fmt: skip
_fx = lambda b: b.fx.withColumn("day", ty.yyyymmdd_to_date(F.col("day_number")))
_VALID = "try_strptime(CAST(day_number AS VARCHAR), '%Y%m%d')"
add("p7_safe_dates", lambda b: _fx(b).filter("day is not null").select("o_orderkey", "day"), f"SELECT o_orderkey, CAST({_VALID} AS DATE) AS day FROM fx WHERE {_VALID} IS NOT NULL")
add("p7_discarded_dates", lambda b: _fx(b).groupBy("currency").agg(F.count_if(F.col("day").isNull()).alias("discarded"), F.count("*").alias("n")), f"SELECT currency, count(*) - count({_VALID}) AS discarded, count(*) AS n FROM fx GROUP BY 1")
add("p8_checked_dates", lambda b: b.parameters.select("id2", ty.checked_yyyymmdd(F.col("id1")).alias("day")), "SELECT id2, CAST(CASE WHEN length(id1) = 8 AND substr(id1, 5, 2) BETWEEN '01' AND '12' AND substr(id1, 7, 2) BETWEEN '01' AND '31' THEN try_strptime(id1, '%Y%m%d') END AS DATE) AS day FROM parameters")
add("p9_derive_fx", lambda b: ty.derive_fx(b.fx).select("o_orderkey", F.round(F.col("inverse_rate") * 10**8).cast("long").alias("inverse_e8"), "is_local"), "SELECT o_orderkey, CASE WHEN rate <> 0 THEN (20000000000000000 + CAST(rate * 100000000 AS BIGINT)) // (2 * CAST(rate * 100000000 AS BIGINT)) END AS inverse_e8, CASE currency WHEN 1 THEN 'S' ELSE 'N' END AS is_local FROM fx")
for kind, (code, names, keyed) in ty.PARAMETERS.items():
    extra = "CAST(CASE WHEN length(id1) = 8 AND substr(id1, 5, 2) BETWEEN '01' AND '12' AND substr(id1, 7, 2) BETWEEN '01' AND '31' THEN try_strptime(id1, '%Y%m%d') END AS DATE) AS date, " if kind == "executives" else ""
    add(f"p10_{kind}", lambda b, k=kind: ty.split_parameters(b.parameters, k), f"SELECT {extra}company, code, {', '.join(f'{c} AS {n}' for c, n in names.items())} FROM parameters WHERE code = {code}" + (" AND NOT id1 = '99999999'" if keyed else ""))
add("p11_account_currency", lambda b: b.chart.select("code", cl.account_currency(F.col("code")).alias("currency")), "SELECT code, CASE WHEN code LIKE '__1%' THEN 1 WHEN code LIKE '__2%' THEN 2 END AS currency FROM chart")
_A = "regexp_matches(rubro, '^14([012][13456])') AND left(rubro, 4) <> '1402'"
_STATES = ", ".join(f"CASE WHEN {_A} AND rubro LIKE '{p}%' THEN CAST({a} AS DOUBLE) ELSE 0 END AS {s}_{a}" for a in ("amount_mo", "amount_mn") for s, p in cl.CREDIT_STATES.items())
add("p12_credit_buckets", lambda b: cl.credit_buckets(b.closing.select("load_seq", "rubro", "amount_mo", "amount_mn")), f"SELECT load_seq, rubro, CAST(amount_mo AS DOUBLE) AS amount_mo, CAST(amount_mn AS DOUBLE) AS amount_mn, {_STATES} FROM closing")
add("p13_is_asset", lambda b: b.chart.select("code", cl.is_asset(F.col("code")).alias("asset")), "SELECT code, regexp_matches(code, '^14[012][13456]') AS asset FROM chart")
add("p14_classify_universe", lambda b: cl.classify_universe(b.closing, "code").select("load_seq", "is_asset"), "SELECT load_seq, 1 AS is_asset FROM closing WHERE regexp_matches(code, '^14[012][13456]') UNION ALL SELECT load_seq, 0 FROM closing WHERE module IN (20, 21, 22, 120, 155, 162, 184, 185, 321) AND NOT regexp_matches(code, '^14[012][13456]')")
# The prefixes of the wide universe once more, so that the twin does not rest on the library's own list.
_WIDE = """(
    left(code, 2) IN ('41', '46', '49', '56', '57', '68')
    OR left(code, 4) IN ('4111', '4112', '4113', '4115', '4116', '4117', '4118', '4121', '4122', '4123', '4125', '4126', '4127', '4128', '4211', '4212', '4221', '4222', '4312', '4313', '4322', '4323', '4411', '4413', '4421', '4423', '4511', '4512', '4513', '4514', '4521', '4522', '4523', '4524', '5111', '5112', '5114', '5117', '5118', '5121', '5124', '5127', '5128', '5211', '5212', '5213', '5214', '5221', '5222', '5223', '5224', '5415', '5416', '5425', '5426')
    OR left(code, 6) IN ('411401', '411402', '411403', '411404', '411405', '411406', '411407', '411408', '411901', '411903', '411904', '411905', '411907', '411908', '411909', '411910', '411911', '411912', '411913', '411914', '411915', '411916', '411917', '411918', '411919', '411920', '411922', '411923', '411925', '411926', '412401', '412402', '412403', '412404', '412405', '412406', '412407', '412408', '412901', '412903', '412904', '412905', '412907', '412908', '412909', '412910', '412911', '412912', '412913', '412914', '412915', '412916', '412917', '412918', '412919', '412920', '412922', '412923', '412925', '412926', '421204', '421205', '422204', '422205', '431401', '431402', '431501', '431502', '431503', '431504', '431506', '431508', '431509', '432401', '432402', '432501', '432502', '432503', '432504', '432506', '432508', '432509', '511301', '511302', '511303', '511304', '511305', '511306', '511504', '511507', '511901', '511903', '511904', '511910', '511911', '511912', '511913', '511914', '511915', '511916', '511917', '511918', '511919', '511925', '511926', '511927', '511928', '512301', '512302', '512303', '512304', '512305', '512306', '512504', '512507', '512901', '512903', '512904', '512910', '512911', '512912', '512913', '512914', '512915', '512916', '512917', '512918', '512919', '512925', '512926', '512927', '512928', '521204', '521205', '522204', '522205')
    OR left(code, 8) IN ('41191703', '41192403', '41291703', '41292403', '43150501', '43150505', '43150506', '43250501', '43250505', '43250506', '51191703', '51192403', '51291703', '51292403', '54140103', '54240103')
    OR left(code, 10) IN ('4119170102', '4119170202', '4119240101', '4119240102', '4129170102', '4129170202', '4129240101', '4129240102', '4315050401', '4315050402', '4325050401', '4325050402', '5119170102', '5119170202', '5119240101', '5119240102', '5129170102', '5129170202', '5129240101', '5129240102')
    OR left(code, 16) IN ('4312030106030101', '4312030106030501', '4312030201060101', '4312030201060501', '4312030701000103', '4312030702000103'))"""
add("p15_classify_universe_full", lambda b: cl.classify_universe(b.closing, "code", rules="full").select("load_seq", "code", "is_asset"),
    f"SELECT load_seq, code, CASE WHEN regexp_matches(code, '^14[012][13456]') THEN 1 ELSE 0 END AS is_asset FROM closing WHERE regexp_matches(code, '^14[012][13456]') OR module IN (20, 21, 22, 120, 155, 162, 184, 185, 321) OR (module = 183 AND regexp_matches(code, '^12[012]1')) OR {_WIDE}")
add("p16_result_lines", lambda b: cl.result_lines(b.closing.select("load_seq", "code", "amount_mn")).drop("amount_mn"), """
SELECT load_seq, code, CASE WHEN code LIKE '51_4%' AND substr(code, 3, 1) IN ('1', '2') THEN CAST(amount_mn AS DOUBLE) END AS income, CASE WHEN regexp_matches(code, '^51[12]7') THEN CAST(amount_mn AS DOUBLE) END AS commission, CASE WHEN code LIKE '41%' THEN CAST(amount_mn AS DOUBLE) END AS expense,
    CASE WHEN regexp_matches(code, '^54[12]40103') THEN CAST(amount_mn AS DOUBLE) END AS reversal, CASE WHEN regexp_matches(code, '^43[12]2030(106030501|201060101|201060501|701000103|702000103)') THEN CAST(amount_mn AS DOUBLE) END AS provision FROM closing""")  # fmt: skip
add("p17_product_expense_flag", lambda b: b.closing.select("load_seq", cl.product_expense_flag(F.col("module"), F.col("origin_type")).alias("flag")), "SELECT load_seq, CASE WHEN module = 20 AND origin_type = 8 THEN 10 WHEN module = 20 THEN 7 WHEN module = 21 THEN 8 WHEN module = 120 AND origin_type = 30 THEN 4 WHEN module = 120 THEN 3 ELSE 0 END AS flag FROM closing")
add("p18_account_type", lambda b: b.closing.select("load_seq", cl.account_type(F.col("module"), F.col("code")).alias("kind")), "SELECT load_seq, CASE WHEN module = 65 AND left(code, 1) = '1' THEN 1 ELSE 2 END AS kind FROM closing")
add("p19_row_hash", lambda b: ky.row_hash(b.table("customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("n"), "c_mktsegment"), ["c_custkey", "c_name", "n", "c_mktsegment"]).select("c_custkey", "row_hash"),
    "SELECT c_custkey, sha256(c_custkey || '|' || c_name || '|' || coalesce(CAST(CASE WHEN c_nationkey > 3 THEN c_nationkey END AS VARCHAR), '') || '|' || c_mktsegment) AS row_hash FROM customer")
add("p20_activate_snapshot", lambda b: ma.activate_snapshot(b.target, b.staged), "SELECT *, 0 AS is_active FROM target UNION ALL SELECT *, 1 FROM staged")
add("p22_where_template", lambda b: ty.where_template(b.run_log.select("event_id", "batch_id", "run_date"), "batch_id = '{FECHA_AAAAMMDD-5}' OR (run_date >= DATE '{FECHA_ISO+3}' AND batch_id LIKE '{FECHA_AAAAMM}%')", TODAY), "SELECT event_id, batch_id, run_date FROM run_log WHERE run_date = DATE '2024-01-15' OR (run_date >= DATE '2024-01-23' AND run_date < DATE '2024-02-01')")

# Joins
add("j6_anti_join", lambda b: jo.without_own_row(b.target.select("c_custkey", "segment"), b.staged, ["c_custkey"]), "SELECT c_custkey, segment FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM staged)")
_base_ops = lambda b: ma.base_operations(b.operations)
_BASE_OPS = ", base_ops AS (SELECT *, 1 AS account_type FROM operations WHERE company = 1 AND module NOT IN (20, 21, 403, 419, 426, 431, 451, 455, 456, 468, 469, 471, 486))"
_LOOSE = f"""{_BASE_OPS}, loose AS (SELECT * FROM closing c WHERE company = 1 AND module NOT IN (403, 419, 426, 431, 451, 455, 456, 468, 469, 471, 486) AND NOT EXISTS (SELECT 1 FROM base_ops o WHERE o.module = c.module AND o.id_cross = c.id_cross)
    AND (module IN (SELECT module FROM operations) OR module IN (20, 21, 27, 63, 65, 45, 162, 321)) AND NOT EXISTS (SELECT 1 FROM base_ops o WHERE o.id_operation = c.id_operation))"""  # fmt: skip
add("j7_balances_without_operation", lambda b: ma.balances_without_operation(b.closing, b.operations, _base_ops(b)).select("load_seq", "id_operation"), f"{_LOOSE} SELECT load_seq, id_operation FROM loose")
add("j11_account_executive", lambda b: b.operations.join(ma.account_executive(b.accounts), "account", "left").select("id_operation", "executive"), "SELECT id_operation, (SELECT max(executive) FROM accounts a WHERE a.account = o.account) AS executive FROM operations o")
add("j12_attribute_lookup", lambda b: jo.attribute_by_day(totals(b).select("id_operation", "date"), b.closing, ["id_operation", "date"], ["origin_type"]), "SELECT id_operation, date, (SELECT arg_max(origin_type, (load_seq, origin_type)) FROM closing c WHERE c.id_operation = t.id_operation AND c.date = t.date) AS origin_type FROM totals t", series=True)
add("j14_resolve_product_module", lambda b: ma.resolve_product_module(b.closing, b.operations.filter("module > 20")).select("load_seq", "module_product"), ", ones AS (SELECT id_cross, max(module) AS m FROM operations WHERE module > 20 AND account <> 999999999 GROUP BY 1 HAVING count(DISTINCT module) = 1) SELECT load_seq, coalesce(m, module) AS module_product FROM closing LEFT JOIN ones USING (id_cross)")
add("j17_reconcile_catalog", lambda b: au.reconcile_catalog(b.target, b.staged, "c_custkey", "segment"), "SELECT c_custkey, t.segment AS left_value, s.segment AS right_value, CASE WHEN s.c_custkey IS NULL THEN 'ONLY_LEFT' WHEN t.c_custkey IS NULL THEN 'ONLY_RIGHT' WHEN s.segment = t.segment THEN 'SAME' ELSE 'DIFFERENT' END AS status FROM target t FULL JOIN staged s USING (c_custkey)")
add("j8_key_by_day", lambda b: jo.key_by_day(b.operations.select("id_operation"), b.calendar), "SELECT id_operation, day FROM operations, calendar")
_month_ends = lambda b: b.closing.groupBy("id_operation", F.trunc("date", "MM").alias("m")).agg(F.max("date").alias("date")).drop("m")
add("j9_month_range_join", lambda b: jo.days_to_month_end(_month_ends(b), b.calendar), "SELECT id_operation, date, day FROM (SELECT id_operation, max(date) AS date FROM closing GROUP BY id_operation, date_trunc('month', date)) JOIN calendar ON day >= date AND day <= last_day(date)")
add("j13_dimension_lookup", lambda b: jo.with_dimension(b.closing.select("load_seq", "code"), b.chart, "code", ["dig4", "dig10"]).drop("code"), "SELECT load_seq, (SELECT dig4 FROM chart c WHERE c.code = x.code) AS dig4, (SELECT dig10 FROM chart c WHERE c.code = x.code) AS dig10 FROM closing x")

# Operation master and reports
_OPS = ["id_operation", "id_cross", "module", "account", "date", "account_type", "disbursed"]
add("o1_base_operations", lambda b: _base_ops(b).select(*_OPS), f"{_BASE_OPS} SELECT id_operation, id_cross, module, account, date, account_type, CAST(disbursed AS DOUBLE) AS disbursed FROM base_ops")
add("o2_base_liabilities", lambda b: ma.base_liabilities(b.closing, b.operations, _base_ops(b)).select(*_OPS), f"{_LOOSE} SELECT id_operation, id_cross, module, account, date, CASE WHEN module = 65 AND rubro LIKE '1%' THEN 1 ELSE 2 END AS account_type, CAST(amount_mn AS DOUBLE) AS disbursed FROM loose")
add("o3_operation_master", lambda b: ma.operation_master(b.operations, b.closing, b.accounts).select(*_OPS, "executive", "row_hash", "is_active"), f"""{_LOOSE}, every AS (SELECT id_operation, id_balance, id_cross, module, account, date, account_type, disbursed FROM base_ops UNION ALL
    SELECT id_operation, id_balance, id_cross, module, account, date, CASE WHEN module = 65 AND rubro LIKE '1%' THEN 1 ELSE 2 END, CAST(amount_mn AS DECIMAL(18,2)) FROM loose),
best AS (SELECT DISTINCT ON (id_operation) * FROM every ORDER BY id_operation, account_type DESC, date DESC, disbursed DESC)
SELECT id_operation, id_cross, module, account, date, account_type, CAST(disbursed AS DOUBLE) AS disbursed, (SELECT max(executive) FROM accounts a WHERE a.account = best.account) AS executive,
    sha256(concat_ws('|', id_operation, id_balance, id_cross, account_type, module, account, date)) AS row_hash, 1 AS is_active FROM best""")  # fmt: skip
add("o4_modules_of_cross_keys", lambda b: ma.modules_of_cross_keys(b.operations), "SELECT DISTINCT id_cross, module FROM operations WHERE account <> 999999999")


def _report_rows(b: Bed, base: DataFrame | None = None) -> DataFrame:
    """Consolidated rows whose accounts are spread over the report families, with their monthly changes."""
    rows = con.monthly_change(_base(b) if base is None else base)
    code = F.when(F.col("rubro").startswith("14"), F.col("rubro"))
    for group, c in {0: "2111010101", 1: "2512020101", 2: "2512020101"}.items():
        code = code.when(F.col("grp") == group, F.when(F.col("title") == 1, F.col("rubro")).otherwise(_family(c)))
    return rows.withColumn("rubro", code).filter(F.col("rubro").isNotNull())


_FAMILY = ("2111010101010101", "2128010101010101", "2112010101010101", "2316010101010101", "2318010101010101", "2612020101010101", "2618020101010101", "2622020101010101", "2514110101001001", "2514110101001003", "2524110101001009", "2317010101010101")


def _family(_: str):
    return F.element_at(F.array(*map(F.lit, _FAMILY)), (F.col("branch") % len(_FAMILY) + 1).cast("int"))


_FAM = "CASE branch % 12 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_FAMILY)) + " END"
REPORT_SQL = CON_SQL + f""", based AS (SELECT s.*, s.mo - CASE WHEN month(s.date) = 1 THEN 0 ELSE coalesce((SELECT sum(x.mo) FROM base x WHERE {" AND ".join(f"x.{k} = s.{k}" for k in con.LONG)} AND x.date = date_trunc('month', s.date) - INTERVAL 1 DAY), 0) END AS change_mo,
    s.mn - CASE WHEN month(s.date) = 1 THEN 0 ELSE coalesce((SELECT sum(x.mn) FROM base x WHERE {" AND ".join(f"x.{k} = s.{k}" for k in con.LONG)} AND x.date = date_trunc('month', s.date) - INTERVAL 1 DAY), 0) END AS change_mn FROM base s),
rep AS (SELECT * REPLACE (CASE WHEN rubro LIKE '14%' OR title = 1 THEN rubro ELSE {_FAM} END AS rubro) FROM based),
mods AS (SELECT DISTINCT rubro, CASE CAST(right(rubro, 1) AS INTEGER) WHEN 1 THEN 65 WHEN 3 THEN 111 WHEN 4 THEN 102 WHEN 5 THEN 115 ELSE 999 END AS module FROM rep WHERE rubro LIKE '14%'),
loans AS (SELECT date, 'CARTERA' AS level_1, 'CARTERA' AS level_2, CASE m.module WHEN 65 THEN 'Tarjeta' WHEN 102 THEN 'Hipotecario' WHEN 111 THEN CASE WHEN grp = 9 THEN 'IFIS' ELSE 'Capital de Trabajo' END ELSE 'Mediano Plazo' END AS level_3, r.rubro, currency, substr(r.rubro, 3, 1) AS account_currency,
    -mo AS mo, -mn AS mn, -change_mo AS change_mo, -change_mn AS change_mn FROM (SELECT * REPLACE (grp + 9 AS grp) FROM rep) r JOIN mods m ON m.rubro = r.rubro WHERE m.module IN (65, 102) OR (m.module = 111 AND grp IN (9, 10, 11, 12, 13)) OR (m.module = 115 AND grp IN (10, 11, 12, 13))),
named AS (SELECT *, CASE WHEN regexp_matches(rubro, '^21.(1|801)') THEN 'Obligaciones a la Vista' WHEN regexp_matches(rubro, '^21.(3|803)') THEN 'Obligaciones por Cuentas a Plazo' WHEN regexp_matches(rubro, '^21.(2|802)') THEN 'Obligaciones por Cuentas de Ahorro'
    WHEN regexp_matches(rubro, '^21.(6|7|807)') THEN 'Obligaciones Restringidas (DPF, Cta Cte, Ahorro) y CTS Propios' WHEN regexp_matches(rubro, '^23.(1|801)') THEN 'Cuenta Corriente' WHEN regexp_matches(rubro, '^23.(2|802)') THEN 'Cuenta Ahorro' WHEN regexp_matches(rubro, '^23.(3|803)') THEN 'Depósitos a Plazo' END AS name FROM rep),
deposits AS (SELECT date, 'PRODUCTOS PASIVOS' AS level_1, CASE WHEN rubro LIKE '21%' THEN 'OBLIGACIONES CON EL PUBLICO' ELSE 'DEPOSITOS DE EMPRESAS DEL SIST FINANCIERO Y ORG FINANC' END AS level_2, name AS level_3, rubro, currency, substr(rubro, 3, 1) AS account_currency, mo, mn, change_mo, change_mn FROM named WHERE name IS NOT NULL),
borrowings AS (SELECT date, 'ADEUDADOS' AS level_1, 'ADEUDADOS' AS level_2, CASE WHEN rubro LIKE '2612020101%' THEN 'MiVivienda' WHEN rubro LIKE '26_8020101%' THEN 'BANCOLDEX' ELSE 'COFIDE' END AS level_3, rubro, currency, substr(rubro, 3, 1) AS account_currency, mo, mn, change_mo, change_mn FROM rep WHERE rubro LIKE '2612020101%' OR rubro LIKE '26_8020101%' OR rubro LIKE '262202%'),
repos AS (SELECT date, 'REPOS' AS level_1, 'REPOS' AS level_2, CASE WHEN rubro IN ('2514110101001001', '2514110101001002') THEN 'Repos de Valores' WHEN rubro = '2514110101001003' THEN 'Repos de Divisas' END AS level_3, rubro, currency, substr(rubro, 3, 1) AS account_currency, mo, mn, change_mo, change_mn FROM rep WHERE rubro LIKE '25_4110101%')
"""  # fmt: skip


def _chart_of(rows: DataFrame) -> DataFrame:
    codes = rows.select(F.col("rubro").alias("code")).distinct()
    return codes.select("code", *[F.substring("code", 1, n).alias(f"dig{n}") for n in (2, 4, 6, 10)])


def _modules_of(rows: DataFrame) -> DataFrame:
    last = F.substring("rubro", -1, 1)
    module = F.when(last == "1", 65).when(last == "3", 111).when(last == "4", 102).when(last == "5", 115).otherwise(999)
    return rows.filter(F.col("rubro").startswith("14")).select("rubro", module.alias("module")).distinct()


def _report(b: Bed, part) -> DataFrame:
    rows = materialize(_report_rows(b), "report-rows")
    return part(rows, _chart_of(rows))


def _regrouped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("grp", F.col("grp") + 9)


_AMOUNTS = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in re.AMOUNTS)
_show = lambda name: f"{REPORT_SQL} SELECT date, level_1, level_2, level_3, rubro, currency, account_currency, {_AMOUNTS} FROM {name}"
add("r1_report_loans", lambda b: _report(b, lambda r, c: re.report_loans(_regrouped(r), c, _modules_of(r))), _show("loans"))
add("r2_report_deposits", lambda b: _report(b, re.report_deposits), _show("deposits"))
add("r3_report_borrowings", lambda b: _report(b, re.report_borrowings), _show("borrowings"))
add("r4_report_repos", lambda b: _report(b, re.report_repos), _show("repos"))


def _report_since(b: Bed, start: date) -> DataFrame:
    """The product report from ``start`` on: only its months and the one before, which changes need, are read and built."""
    base = _base(b, (start.replace(day=1) - timedelta(days=1)).replace(day=1))
    rows = materialize(_report_rows(b, base), "report-rows")
    return re.report_product_detail(_regrouped(rows), _chart_of(rows), _modules_of(rows), F.lit(start))


def _recent_report(b: Bed) -> DataFrame:
    tail = _source(b).agg(F.date_sub(F.max("date"), 10)).first()[0]
    return _report_since(b, cal.report_start(_base(b, tail)).first()["start"])


add("r5_report_product_detail", _recent_report, _show("(SELECT * FROM loans UNION ALL SELECT * FROM deposits UNION ALL SELECT * FROM borrowings UNION ALL SELECT * FROM repos) WHERE date >= (SELECT date_trunc('month', max(date) - INTERVAL 60 DAY) FROM base)"))


def _fx_position(b: Bed) -> DataFrame:
    rows = b.sdc.withColumns({"account_kind": F.when(F.col("module") == 20, "POSICION ME").otherwise("OTROS"), "group_kind": F.when(F.col("title") == 1, "POSICION NETA DE FORWARDS").otherwise("OTROS"),
                              "line": F.when(F.col("module") == 65, "Derivados de Negociación").when(F.col("module") == 120, "Utilidad-Pérdida en Diferencia de Cambio"), "change_mo": (-F.col("mo")).cast("decimal(18,2)"), "change_mn": F.col("mn")})
    return re.report_fx_position(rows, rows)


add("r6_report_fx_position", _fx_position, """SELECT date, level_1, level_2, rubro, currency, CAST(mo AS DOUBLE) AS mo, CAST(mn AS DOUBLE) AS mn, CAST(CASE WHEN level_1 = 'UTILIDAD' THEN -mo END AS DOUBLE) AS change_mo, CAST(CASE WHEN level_1 = 'UTILIDAD' THEN mn END AS DOUBLE) AS change_mn
FROM sdc CROSS JOIN (VALUES ('POSICION ME', 'CONTABLE'), ('POSICION ME', 'DERIVADOS'), ('UTILIDAD', 'DERIVADOS'), ('UTILIDAD', 'CONTABLE')) AS l(level_1, level_2)
WHERE CASE WHEN level_1 = 'POSICION ME' AND level_2 = 'CONTABLE' THEN module = 20 WHEN level_1 = 'POSICION ME' THEN title = 1 WHEN level_2 = 'DERIVADOS' THEN module = 65 ELSE module = 120 END""")  # fmt: skip
add("r7_daily_summary", lambda b: re.daily_summary(b.closing.filter("module = 65").select("date", F.col("amount_mn").alias("amount")), b.closing.filter("module = 21").select("date", "account").distinct(), b.calendar.filter(F.col("day").between(F.lit(START), F.lit(HI))).select(F.col("day").alias("date"))),
    f"SELECT day AS date, coalesce((SELECT CAST(sum(amount_mn) AS DOUBLE) FROM closing x WHERE module = 65 AND x.date = c.day), 0) AS total_sales, (SELECT count(DISTINCT account) FROM closing x WHERE module = 21 AND x.date = c.day) AS clients FROM calendar c WHERE day BETWEEN {D_START} AND {D_HI}")

# Checks: on rows that are complete they find nothing, so most run on rows with faults made by rule
_sparse = lambda b: b.raw.groupBy("id_operation", F.col("ship").alias("date")).agg(F.sum("amount_mn").cast("decimal(18,2)").alias("amount_mn"))
_SPARSE = ", sparse AS (SELECT id_operation, ship AS date, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS amount_mn FROM raw GROUP BY 1, 2)"


def _dense(b: Bed) -> DataFrame:
    """Daily totals per operation; every 37th day of the year is off by one, every 23rd operation lacks the second."""
    rows = filled(b).groupBy("id_operation", "date").agg(F.sum("amount_mn").cast("decimal(18,2)").alias("amount_mn"))
    rows = rows.filter(~((F.dayofmonth("date") == 2) & (F.substring("id_operation", -5, 1) == "1")))
    return rows.withColumn("amount_mn", (F.col("amount_mn") + F.when(F.dayofyear("date") % 37 == 0, 1).otherwise(0)).cast("decimal(18,2)"))


_DENSE = """, dense AS (SELECT id_operation, date, CAST(sum(amount_mn) + CASE WHEN dayofyear(date) % 37 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS amount_mn FROM filled WHERE NOT (day(date) = 2 AND substr(id_operation, length(id_operation) - 4, 1) = '1') GROUP BY id_operation, date)"""
add("q1_weekend_copy", lambda b: qu.check_weekend_copy(_dense(b), ["id_operation"], ["amount_mn"]), f"""{_DENSE}, stepped AS (SELECT *, lag(date) OVER w AS before, lag(amount_mn) OVER w AS saturday FROM dense WINDOW w AS (PARTITION BY id_operation ORDER BY date))
SELECT date, id_operation, CAST(amount_mn AS DOUBLE) AS amount_mn, CAST(saturday AS DOUBLE) AS saturday_amount_mn FROM stepped WHERE dayofweek(date) = 0 AND before + INTERVAL 1 DAY = date AND amount_mn <> saturday""", series=True)  # fmt: skip
add("q2_month_complete", lambda b: qu.check_month_complete(_dense(b), ["id_operation"], HI), f"{_DENSE} SELECT id_operation, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_rows, CAST(day(last_day(max(date))) AS INTEGER) AS due FROM dense GROUP BY 1, 2 HAVING count(*) <> day(last_day(max(date)))", series=True)
add("q3_worst_repeats", lambda b: qu.worst_first(qu.check_unique(b.closing, ["id_operation", "rubro", "date"]), F.col("n_rows"), ["id_operation", "rubro", "date"], 50), "SELECT id_operation, rubro, date, count(*) AS n_rows FROM closing GROUP BY 1, 2, 3 HAVING count(*) > 1 ORDER BY n_rows DESC, id_operation, rubro, date LIMIT 50")
add("q3_unique", lambda b: qu.check_unique(b.closing, ["id_operation", "rubro", "date"]), "SELECT id_operation, rubro, date, count(*) AS n_rows FROM closing GROUP BY 1, 2, 3 HAVING count(*) <> 1")
add("q4_range_covered", lambda b: qu.range_covered(b.closing), "SELECT min(date) AS first, max(date) AS last, count(*) AS n_rows FROM closing")
add("q5_lost_keys", lambda b: qu.check_lost_keys(b.closing, b.operations, ["id_operation"]), "SELECT id_operation FROM closing EXCEPT SELECT id_operation FROM operations")
add("q6_days_per_key", lambda b: qu.days_per_key(b.closing, ["id_operation"]), "SELECT id_operation, count(DISTINCT date) AS days, min(date) AS first, max(date) AS last FROM closing GROUP BY 1")
_stored = lambda b: ser.running_month_average(_dense(b), ["id_operation"], ["amount_mn"], exact=True).withColumn("avg_amount_mn", F.col("avg_amount_mn") + F.when(F.month("date") == 2, 0.25).otherwise(0.0))
add("q7_check_average", lambda b: qu.check_average(_stored(b), ["id_operation"], "amount_mn", "avg_amount_mn").select("id_operation", "month", "date", "recomputed"),
    f"{_DENSE} SELECT id_operation, CAST(date_trunc('month', date) AS DATE) AS month, max(date) AS date, CAST(sum(amount_mn) AS DOUBLE) / day(last_day(max(date))) AS recomputed FROM dense WHERE month(date) = 2 GROUP BY 1, 2", series=True)
_profile = lambda b: ser.account_average(b.closing, _ACC, "rubro", "amount_mn", exact=True).withColumn("running_avg", F.col("running_avg") + F.when(F.dayofmonth("date") == 3, 0.1).otherwise(0.0))
add("q8_check_ratio", lambda b: qu.check_ratio(_profile(b)).select(*_ACC, "date"), f"SELECT DISTINCT {', '.join(_ACC)}, date FROM closing WHERE day(date) = 3")
_totals = lambda b: b.closing.groupBy("account", "date").agg((F.sum("amount_mn") + F.when(F.col("account") % 5 == 0, 1).otherwise(0)).cast("decimal(18,2)").alias("amount_mn"))
add("q9_check_rollup", lambda b: qu.check_rollup(b.closing, _totals(b), ["account", "date"], "amount_mn"), "SELECT account, date, CAST(sum(amount_mn) + 1 AS DOUBLE) AS amount_mn, CAST(sum(amount_mn) AS DOUBLE) AS detail_sum FROM closing WHERE account % 5 = 0 GROUP BY 1, 2")
add("q10_check_grid", lambda b: qu.check_grid(_dense(b), "id_operation", START, HI), f"{_DENSE} SELECT id_operation, count(DISTINCT date) AS days FROM dense WHERE date BETWEEN {D_START} AND {D_HI} GROUP BY 1 HAVING count(DISTINCT date) <> {D_HI} - {D_START} + 1", series=True)
_other = lambda b: _sparse(b).filter(F.dayofmonth("date") != 9).withColumn("amount_mn", (F.col("amount_mn") + F.when(F.dayofmonth("date") == 5, 1).otherwise(0)).cast("decimal(18,2)"))
add("q11_compare_daily", lambda b: qu.compare_daily(_sparse(b), _other(b), ["amount_mn"]), f"{_SPARSE} SELECT date, count(*) AS before_rows, CAST(sum(amount_mn) AS DOUBLE) AS before_amount_mn, CASE WHEN day(date) = 5 THEN count(*) END AS after_rows, CASE WHEN day(date) = 5 THEN CAST(sum(amount_mn + 1) AS DOUBLE) END AS after_amount_mn FROM sparse WHERE day(date) IN (5, 9) GROUP BY date")
add("q12_compare_keys", lambda b: qu.compare_keys(b.target, b.staged, ["c_custkey"]), "SELECT c_custkey, 'MISSING' AS status FROM (SELECT c_custkey FROM target EXCEPT SELECT c_custkey FROM staged) UNION ALL SELECT c_custkey, 'EXTRA' FROM (SELECT c_custkey FROM staged EXCEPT SELECT c_custkey FROM target)")
_COLUMNS = ["c_name", "c_nationkey", "balance", "segment"]
_changed = lambda b: b.target.withColumns({"balance": F.col("balance") + F.when(F.col("c_custkey") % 4 == 0, 1).otherwise(0), "segment": F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("segment"))})
_DIFFERING = ", d AS (SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 4 = 0 THEN 'balance' END, CASE WHEN c_custkey % 10 = 0 THEN 'segment' END) AS differing FROM target WHERE c_custkey % 4 = 0 OR c_custkey % 10 = 0)"
add("q13_compare_rows", lambda b: qu.compare_rows(b.target, _changed(b), ["c_custkey"], _COLUMNS), f"{_DIFFERING} SELECT * FROM d")
add("q14_classify_differences", lambda b: qu.classify_differences(qu.compare_rows(b.target, _changed(b), ["c_custkey"], _COLUMNS), ["balance"]), f"{_DIFFERING} SELECT CASE WHEN differing LIKE '%balance%' THEN 'MONEY' ELSE 'ATTRIBUTES' END AS kind, count(*) AS n_rows FROM d GROUP BY 1")


def _summary(b: Bed) -> DataFrame:
    return qu.quality_summary({"unique": qu.check_unique(b.closing, ["id_operation", "rubro", "date"]), "lost": qu.check_lost_keys(b.closing, b.operations, ["id_operation"]), "load_seq": qu.check_unique(b.closing, ["load_seq"])})


add("q15_quality_summary", _summary, """, v AS (SELECT 'unique' AS check_name, count(*) AS violations FROM (SELECT 1 FROM closing GROUP BY id_operation, rubro, date HAVING count(*) > 1) UNION ALL SELECT 'lost', count(DISTINCT id_operation) FROM closing WHERE id_operation NOT IN (SELECT id_operation FROM operations)
UNION ALL SELECT 'load_seq', count(*) FROM (SELECT 1 FROM closing GROUP BY load_seq HAVING count(*) > 1)) SELECT *, CASE WHEN violations = 0 THEN 'OK' ELSE 'FAIL' END AS verdict FROM v""")  # fmt: skip
add("q16_month_breakdown", lambda b: qu.month_breakdown(b.closing, ["id_operation", "rubro"]), "SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(DISTINCT date) AS days, count(DISTINCT (id_operation, rubro)) AS n_keys, count(*) AS n_rows, count(DISTINCT (id_operation, rubro)) * day(last_day(min(date))) AS expected_rows FROM closing GROUP BY date_trunc('month', date)")
_rules = lambda: {"positive": (F.col("balance") > 0, "drop"), "named": (F.col("segment").isNotNull(), "warn"), "keyed": (F.col("c_custkey") >= 0, "fail")}
add("q17_expectation_counts", lambda b: qu.expectation_counts(_changed(b), _rules()), "SELECT 'positive' AS rule, 'drop' AS severity, count(*) FILTER (WHERE balance + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END <= 0) AS broken FROM target UNION ALL SELECT 'named', 'warn', count(*) FILTER (WHERE c_custkey % 10 = 0) FROM target UNION ALL SELECT 'keyed', 'fail', 0 FROM (SELECT 1)")
add("q17_apply_expectations", lambda b: qu.apply_expectations(_changed(b), _rules()).select("c_custkey"), "SELECT c_custkey FROM target WHERE balance + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END > 0")
add("q18_reconcile_totals", lambda b: qu.reconcile_totals(b.closing.filter("account <> 3"), b.closing.filter("load_seq % 11 <> 0"), ["account"], "amount_mn"), ", t AS (SELECT account, coalesce(sum(amount_mn) FILTER (WHERE account <> 3), 0) AS l, coalesce(sum(amount_mn) FILTER (WHERE load_seq % 11 <> 0), 0) AS r FROM closing GROUP BY 1) SELECT account, CAST(l AS DOUBLE) AS left_total, CAST(r AS DOUBLE) AS right_total FROM t WHERE abs(l - r) > 0.01")
_CONTRACT = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.IntegerType()), T.StructField("region", T.StringType())])
add("q19_check_contract", lambda b: qu.check_contract(b.table("customer").select("c_custkey", "c_name", "c_acctbal"), _CONTRACT), """,
real AS (SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS actual FROM (DESCRIBE customer) WHERE column_name IN ('c_custkey', 'c_name', 'c_acctbal')),
wanted AS (SELECT * FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'int'), ('region', 'string')) AS w(column_name, declared))
SELECT column_name, declared, actual, CASE WHEN actual IS NULL THEN 'MISSING' WHEN declared IS NULL THEN 'UNDECLARED' ELSE 'TYPE' END AS status FROM wanted FULL JOIN real USING (column_name) WHERE declared IS DISTINCT FROM actual""")  # fmt: skip

# Audit
_COLS = ["table_name", "batch_id", "run_date", "state", "n_rows", "seconds", "event_id"]
add("a1_audit_rows", lambda b: au.audit_rows(b.target, "target", "20240120", 7).unionByName(au.audit_rows(b.target.filter("c_custkey < 0"), "none", "20240120", 0)).unionByName(au.audit_rows(b.staged, "staged", "20240120", 1, "e" * 5000)).withColumn("message", F.length("message")),
    "SELECT 'target' AS table_name, '20240120' AS batch_id, 'TERMINADO' AS state, count(*) AS n_rows, 7 AS seconds, CAST(NULL AS INTEGER) AS message FROM target UNION ALL SELECT 'none', '20240120', 'SIN_DATOS', 0, 0, NULL FROM (SELECT 1) UNION ALL SELECT 'staged', '20240120', 'ERROR', count(*), 1, 4000 FROM staged")
add("a2_latest_batch", lambda b: au.latest_batch(b.run_log, b.load_log.filter("table_name <> 'view'")), "SELECT batch_id, table_name, CAST(sum(n_rows) AS BIGINT) AS extracted_rows, (SELECT CAST(sum(n_rows) AS BIGINT) FROM load_log l WHERE l.batch_id = r.batch_id AND l.table_name = r.table_name AND table_name <> 'view') AS loaded_rows FROM run_log r WHERE batch_id = (SELECT max(batch_id) FROM run_log) GROUP BY 1, 2")
add("a3_recent_errors", lambda b: au.recent_errors(b.run_log.select(_COLS), b.load_log.select(_COLS), TODAY), f"SELECT {', '.join(_COLS)}, 'EXTRACT' AS log FROM run_log WHERE state = 'ERROR' AND run_date >= {D_TODAY} - INTERVAL 7 DAY UNION ALL SELECT {', '.join(_COLS)}, 'LOAD' FROM load_log WHERE state = 'ERROR' AND run_date >= {D_TODAY} - INTERVAL 7 DAY")
_catalog = lambda b: b.run_log.filter("table_name in ('view', 'click', 'error')").select("table_name").distinct().withColumns({"active": F.lit(True), "destination": F.concat(F.lit("stg_"), F.col("table_name"))})
add("a4_unregistered", lambda b: au.unregistered(b.run_log, _catalog(b)), "SELECT DISTINCT table_name FROM run_log WHERE table_name NOT IN ('view', 'click', 'error')")
add("a5_repeated_empty", lambda b: au.repeated_empty(b.run_log, TODAY), f"SELECT table_name, count(*) AS empty_runs, max(run_date) AS last_run FROM run_log WHERE state = 'SIN_DATOS' AND run_date >= {D_TODAY} - INTERVAL 15 DAY GROUP BY 1 HAVING count(*) >= 3")
add("a6_procedure_stats", lambda b: au.procedure_stats(b.run_log, date(2024, 1, 31), 20), "SELECT table_name, count(*) AS runs, count(*) FILTER (WHERE state = 'ERROR') AS failures, CAST(sum(seconds) AS DOUBLE) / count(*) AS mean_seconds, max(seconds) AS worst_seconds, max(run_date) AS last_run FROM run_log WHERE run_date >= DATE '2024-01-11' GROUP BY 1")
add("a7_last_load", lambda b: au.last_load(b.load_log), "SELECT table_name, max(run_date) AS last_run, max(run_date) FILTER (WHERE n_rows > 0) AS last_data FROM load_log GROUP BY 1")
add("a8_never_loaded", lambda b: au.never_loaded(b.run_log.select("table_name").distinct().withColumn("active", F.col("table_name") != "error"), b.load_log.filter("table_name <> 'signup' and table_name <> 'error'")),
    "SELECT DISTINCT table_name, table_name <> 'error' AS active FROM run_log r WHERE table_name <> 'error' AND NOT EXISTS (SELECT 1 FROM load_log l WHERE l.table_name = r.table_name AND l.table_name NOT IN ('signup', 'error'))")
add("a9_close_batch", lambda b: au.close_batch(b.load_log, "20240110"), "SELECT state, count(*) AS runs, CAST(sum(n_rows) AS BIGINT) AS n_rows, (SELECT bool_or(state = 'ERROR') FROM load_log WHERE batch_id = '20240110') AS batch_failed FROM load_log WHERE batch_id = '20240110' GROUP BY 1")
add("a10_last_finished", lambda b: au.last_finished(b.load_log), "SELECT DISTINCT ON (table_name) table_name, batch_id, event_id, n_rows FROM load_log WHERE state = 'TERMINADO' ORDER BY table_name, batch_id DESC, event_id DESC")
add("a11_batch_lots", lambda b: au.batch_lots(b.run_log.filter("batch_id = '20240105'").select("event_id", "table_name"), _catalog(b).drop("active"), strict=False), "SELECT event_id, table_name, CASE WHEN table_name IN ('view', 'click', 'error') THEN 'stg_' || table_name END AS destination, table_name NOT IN ('view', 'click', 'error') AS undeclared FROM run_log WHERE batch_id = '20240105'")
add("a11_declared_lots", lambda b: au.batch_lots(b.run_log.filter("table_name in ('view', 'click', 'error')").select("event_id", "table_name"), _catalog(b).drop("active")), "SELECT event_id, table_name, 'stg_' || table_name AS destination FROM run_log WHERE table_name IN ('view', 'click', 'error')")
add("a9_retry_list", lambda b: reduce(DataFrame.unionByName, [au.retry_list(b.load_log.withColumn("table_name", F.concat_ws("_", "table_name", F.col("event_id") % 40)), x).withColumn("batch_id", F.lit(x)) for x in ("20240110", "20240111", "19000101")]),
    " UNION ALL ".join(f"SELECT coalesce(string_agg(DISTINCT table_name || '_' || event_id % 40, ',' ORDER BY table_name || '_' || event_id % 40), '') AS only_tables, '{x}' AS batch_id FROM load_log WHERE batch_id = '{x}' AND state = 'ERROR'" for x in ("20240110", "20240111", "19000101")))


def _curve(b: Bed) -> DataFrame:
    runs = b.run_log.filter("event_id % 10 <> 0 and n_rows > 0 and seconds > 0").select("table_name", F.col("event_id").alias("run"), "n_rows", "seconds", F.col("event_id").alias("at"))
    marks = b.run_log.select("table_name", F.col("event_id").alias("at"), (F.col("event_id") % 4 + 1).cast("int").alias("cores")).filter("at % 10 = 0")
    return au.scaling_curve(runs, marks)


add("a12_scaling_curve", _curve, """, marks AS (SELECT table_name, event_id AS at, CAST(event_id % 4 + 1 AS INTEGER) AS cores FROM run_log WHERE event_id % 10 = 0),
runs AS (SELECT table_name, event_id AS run, n_rows, seconds, event_id AS at FROM run_log WHERE event_id % 10 <> 0 AND n_rows > 0 AND seconds > 0),
held AS (SELECT r.*, (SELECT arg_max(cores, m.at) FROM marks m WHERE m.table_name = r.table_name AND m.at <= r.at) AS cores, CAST(n_rows AS DOUBLE) / seconds AS speed FROM runs r)
SELECT *, speed / ((SELECT arg_min(x.speed / x.cores, x.at) FROM held x WHERE x.table_name = held.table_name AND x.cores IS NOT NULL) * cores) AS efficiency FROM held""")  # fmt: skip
