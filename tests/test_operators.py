"""Scenarios of the balance series, guards, types, marks and cuts on small literal tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import classify as cl
from tidemark.functions import typing_ as ty
from tidemark.operators import audit as au
from tidemark.operators import calendar as cal
from tidemark.operators import consolidated as con
from tidemark.operators import joins as jo
from tidemark.operators import quality as qu
from tidemark.operators import series as ser
from tidemark.operators import variation as var
from tidemark.sources import loads as ld
from tidemark.sources import partitioning as pt
from tidemark.tables import shared_dir

D = date


def days(lo, hi):
    return [lo + timedelta(days=i) for i in range((hi - lo).days + 1)]


@pytest.fixture(scope="module")
def calendar(spark):
    rows = [(1, d, "N" if d.weekday() > 4 or (d.month, d.day) in ((6, 1), (6, 30)) else "S") for d in days(D(2026, 4, 1), D(2026, 8, 31))]
    return spark.createDataFrame(rows, "cod_calendar int, day date, is_business string")


def balances(spark, rows):
    return spark.createDataFrame([(k, r, d, kind, n, 10.0) for n, (k, r, d, kind) in enumerate(rows)], "key string, rubro string, date date, origin_kind string, load_seq int, amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def june(spark, calendar, rows, **kw):
    out = ser.fill_month(balances(spark, rows), calendar, ["key", "rubro"], D(2026, 6, 30), ["amount"], **kw)
    return {(r.key, r.rubro, r.date): r for r in out.collect()}


def test_fill_month_scenarios(spark, calendar):
    month = days(D(2026, 6, 1), D(2026, 6, 30))
    rows = [("A", "1", d, "ORIGINAL") for d in month]
    rows += [("B", "1", d, "ORIGINAL") for d in month[14:]] + [("C", "1", d, "ORIGINAL") for d in month[:10]]
    rows += [("D", "1", d, "ORIGINAL") for d in month if d.day not in (12, 13, 14)] + [("E", "1", month[0], "COPIA_HABIL")]
    rows += [("F", "1", month[4], "ORIGINAL"), ("F", "2", month[20], "ORIGINAL")]
    got = june(spark, calendar, rows)
    for key, rubro in (("A", "1"), ("B", "1"), ("C", "1"), ("D", "1"), ("E", "1"), ("F", "1"), ("F", "2")):
        assert [d for d in month if (key, rubro, d) in got] == month
    assert got["B", "1", month[0]].amount == 0 and got["B", "1", month[0]].load_seq == 30  # from the first row after
    assert got["C", "1", month[29]].load_seq == 55 and got["C", "1", month[29]].origin_kind == "RELLENO"
    assert got["D", "1", D(2026, 6, 13)].load_seq == got["D", "1", D(2026, 6, 11)].load_seq
    strict = june(spark, calendar, [("E", "1", month[0], "COPIA_HABIL"), ("G", "1", month[9], "COPIA_HABIL")], strict_anchor=True)
    assert set(strict) == {("E", "1", month[0]), ("G", "1", month[9])}
    late = june(spark, calendar, [("H", "1", month[9], "COPIA_HABIL")])
    assert min(d for _, _, d in late) == month[9]  # a copy anchors what comes after it alone


def test_fill_month_of_nothing_and_of_31_days(spark, calendar):
    assert june(spark, calendar, []) == {}
    out = ser.fill_month(balances(spark, [("A", "1", D(2026, 5, 20), "ORIGINAL")]), calendar, ["key", "rubro"], D(2026, 6, 30), ["amount"])
    assert out.count() == 31


def test_dedup_modes(spark):
    rows = balances(spark, [("A", "1", D(2026, 6, 3), "ORIGINAL")] * 3)
    summed = ser.dedup_day(rows, ["key", "date"], [F.col("load_seq").desc()], ["amount"]).first()
    best = ser.dedup_day(rows, ["key", "date"], [F.col("load_seq").desc()], ["amount"], "best").first()
    assert (summed.amount, summed.load_seq, best.amount) == (30, 2, 10)
    with pytest.raises(ValueError):
        ser.dedup_day(rows, ["key"], [], [], "any")


@pytest.mark.parametrize("turn", [1, -1])
def test_rows_of_one_load_have_an_order(spark, calendar, turn):
    """Of rows of the same load those with the largest measures or attributes are taken, in whatever order they come."""
    rows = [("A", "1", D(2026, 6, 3), 7, a, b) for a, b in ((10, 2), (30, 1), (30, 4), (20, 9))] + [("A", "1", D(2026, 6, 3), 6, 99, 99)]
    df = spark.createDataFrame(rows[::turn], "id_operation string, rubro string, date date, load_seq int, mo int, mn int").coalesce(1)
    best = ser.dedup_day(df, ["id_operation", "date"], [F.col("load_seq").desc()], ["mo", "mn"], "best").first()
    found = jo.attribute_by_day(df.select("id_operation", "date").distinct(), df, ["id_operation", "date"], ["mo", "mn"]).first()
    assert (best.load_seq, best.mo, best.mn) == (7, 30, 4) and (found.mo, found.mn) == (30, 4)
    attributes = {"module": 20, "currency": 1, "account": 1}
    whole = df.withColumns({k: F.lit(v) for k, v in attributes.items()}).withColumns({m: F.col(m).cast("decimal(18,2)") for m in ("mo", "mn")})
    day = ser.operating_balances(whole, calendar, D(2026, 6, 3), D(2026, 6, 3), D(2026, 6, 3), measures=("mo", "mn"), mode="best").first()
    assert (day.load_seq, day.mo, day.mn) == (7, 30, 4)


def test_consolidated_keys_stay_unique_when_fills_are_chained(spark, calendar):
    key = dict.fromkeys(("company", "branch", "module", "currency", "paper"), 1)
    rows = [(d, *key.values(), "2111", 1, 1, 0, g, 5.0, 5.0) for g, span in ((0, days(D(2026, 5, 4), D(2026, 5, 15))), (1, [D(2026, 5, 29), D(2026, 5, 31), D(2026, 6, 3)])) for d in span]
    schema = "date date, company int, branch int, module int, currency int, paper int, rubro string, title int, chapter int, term int, grp int, mo double, mn double"
    base = spark.createDataFrame(rows, schema).withColumns({m: F.col(m).cast("decimal(18,2)") for m in con.MEASURES})
    chained = con.fill_all(base, calendar, D(2026, 6, 30))
    assert qu.check_unique(chained, ["date", *con.LONG]).isEmpty()
    apart = con.fill_all(base, calendar, D(2026, 6, 30), chained=False)
    assert apart.count() > chained.count() and not qu.check_unique(apart, ["date", *con.LONG]).isEmpty()


def test_variation_keeps_nulls_and_tells_absence(spark):
    rows = [
        (D(2026, 5, 31), 1, "a", 10.0), (D(2026, 6, 30), 1, "a", 10.0), (D(2026, 5, 31), 2, "a", 7.0), (D(2026, 6, 30), 3, "a", 4.0), (D(2026, 5, 31), 4, "a", None), (D(2026, 6, 30), 4, "a", 9.0),
        (D(2026, 5, 31), 5, "a", 0.0), (D(2026, 6, 30), 5, "a", 3.0), (D(2026, 5, 31), 6, "x", 2.0), (D(2026, 6, 30), 6, "y", 2.0), (D(2026, 6, 30), 7, "a", None),
    ]
    df = spark.createDataFrame(rows, "date date, op int, rubro string, amount double").withColumns({"module": F.lit(20), "origin_type": F.lit(8), "amount": F.col("amount").cast("decimal(18,2)")})
    pairs = spark.createDataFrame([(D(2026, 6, 30), D(2026, 5, 31))], "date date, previous date")
    got = {(r.op, r.rubro): r for r in var.variation(df, pairs, ["module", "op", "rubro"], ["amount"]).collect()}
    assert got[1, "a"].variation_amount == 0 and got[1, "a"].case == "BOTH" and got[1, "a"].expense_flag == 10
    assert got[2, "a"].variation_amount == -7 and got[2, "a"].case == "GONE"
    assert got[3, "a"].variation_amount == 4 and got[3, "a"].previous is None
    assert got[4, "a"].variation_amount is None and got[7, "a"].variation_amount is None and got[5, "a"].variation_amount == 3
    assert got[6, "x"].case == "GONE" and got[6, "y"].case == "NEW"
    with pytest.raises(Exception, match="no earlier one"):
        var.variation_range(df, D(2026, 5, 1), D(2026, 6, 30), 3, ["module", "op", "rubro"], ["amount"]).count()
    with pytest.raises(ValueError):
        cal.pair_dates(df, 1)


def test_month_result_is_not_multiplied(spark):
    rows = [("a", D(2026, 5, 31), 100.0), ("a", D(2026, 6, 10), 130.0), ("b", D(2026, 6, 10), None)]
    df = spark.createDataFrame(rows, "op string, date date, income double")
    got = {(r.op, r.date): r.month_income for r in var.month_result(df, ["op"], ["income"]).collect()}
    assert got["a", D(2026, 6, 10)] == 30 and got["b", D(2026, 6, 10)] == 0 and got["a", D(2026, 5, 31)] == 100


def test_anti_join_keeps_rows_when_the_list_has_a_null(spark):
    ops = spark.createDataFrame([("x", 1), (None, 1)], "id string, n int")
    rows = spark.createDataFrame([("x",), ("y",)], "id string")
    assert [r.id for r in rows.join(ops.select("id"), "id", "left_anti").collect()] == ["y"]


def test_load_guards(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    with pytest.raises(ValueError):
        ld.load_replace(target, target.limit(0))
    with pytest.raises(ValueError):
        ld.load_merge(target, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])
    with pytest.raises(ValueError):
        ld.load_merge(target.select("k"), target.select("k"), ["k"])
    merged = {r.k: r.v for r in ld.load_merge(target, spark.createDataFrame([(2, "z"), (3, "c")], "k int, v string"), ["k"]).collect()}
    assert merged == {1: "a", 2: "z", 3: "c"}
    assert ld.load_incremental(target, "k", None).count() == 2 and ld.load_incremental(target, "k", 1).count() == 1
    log = spark.createDataFrame([("t", "TERMINADO", 5), ("t", "ERROR", 9)], "table_name string, state string, mark_to int")
    assert ld.high_water_mark(log, "t").first().mark == 5 and ld.high_water_mark(log, "u").first().mark is None
    dated = spark.createDataFrame([(D(2026, 6, 1),), (D(2026, 6, 30),), (None,)], "date date")
    assert ld.retain(dated, "date", D(2026, 6, 30), 0).count() == 3 and ld.retain(dated, "date", D(2026, 6, 30), 5).count() == 2
    once = ld.rewrite_range(dated, dated, "date", D(2026, 6, 1), D(2026, 6, 15))
    assert sorted(map(str, once.collect())) == sorted(map(str, ld.rewrite_range(once, dated, "date", D(2026, 6, 1), D(2026, 6, 15)).collect()))


def test_versions_do_not_disturb_readers(spark):
    base = shared_dir(spark, "versions")
    first = ld.commit_version(spark.range(3).toDF("id"), base)
    second = ld.commit_version(ld.read_version(spark, base, first).filter("id > 0"), base)
    assert (first, second) == (0, 1) and ld.versions(spark, base) == [0, 1]
    assert ld.read_version(spark, base, first).count() == 3 and ld.read_version(spark, base).count() == 2
    assert ld.commit_version(spark.range(9).toDF("id"), base, 1) == 1 and ld.read_version(spark, base).count() == 2  # a batch that comes again


def test_streamed_merge_goes_on_after_a_restart(spark):
    """Stopped after the first increments and started anew with the same folders, a stream gives what one batch merge gives."""
    from tidemark.streaming import loads as st

    schema = "k int, v string, n int"
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "null", 0)], schema)
    path, base, checkpoint = (shared_dir(spark, x) for x in ("in", "table", "state"))
    merge = lambda: {(r.k, r.v) for r in st.merge_increments(st.read_increments(spark, path, target.schema, 1), target, ["k"], "n", base, checkpoint).collect()}
    spark.createDataFrame([(2, "B", 1), (3, "c", 1), (3, "C", 2)], schema).coalesce(1).write.parquet(path)
    assert merge() == {(1, "a"), (2, "B"), (3, "C"), (None, "null")}
    assert merge() == {(1, "a"), (2, "B"), (3, "C"), (None, "null")}  # nothing new
    spark.createDataFrame([(1, "A", 3), (4, "d", 3)], schema).coalesce(1).write.mode("append").parquet(path)
    assert merge() == {(1, "A"), (2, "B"), (3, "C"), (4, "d"), (None, "null")}


@pytest.mark.parametrize(("text", "kind"), [("varchar(10)", T.StringType()), ("decimal(17,2)", T.DecimalType(17, 2)), ("numeric(9)", T.DecimalType(9, 0)), ("bit", T.IntegerType()), ("bigint", T.LongType()),
                                            ("real", T.DoubleType()), ("date", T.DateType()), ("datetime2(7)", T.TimestampType()), ("smalldatetime", T.TimestampType()), ("geography", T.StringType())])
def test_declared_types(text, kind):
    assert ty.parse_type(text) == kind


@pytest.mark.parametrize("spec", ["A", "A:", ":int", "A:decimal", "A:int(", "A:numeric()"])
def test_malformed_types(spec):
    with pytest.raises(ValueError):
        ty.parse_types(spec)


def test_blank_is_null_never_zero(spark):
    df = spark.createDataFrame([("  ", "x"), ("7", " y")], "n string, s string")
    got = ty.apply_types(df, ty.parse_types("n:int|s:varchar(3)|absent:int")).collect()
    assert [(r.n, r.s) for r in got] == [(None, "x"), (7, " y")]
    bad = spark.createDataFrame([("q",)], "n string")
    assert ty.apply_types(bad, ty.parse_types("n:int"), "coerce").first().n is None
    for mode, spec in (("strict", "n:int"), ("coerce", "n:decimal(5,2)")):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            ty.apply_types(bad, ty.parse_types(spec), mode).collect()


DAY = D(2026, 3, 1)


@pytest.mark.parametrize(("template", "text"), [("F = {FECHA_AAAAMMDD}", "F = 20260301"), ("F = {FECHA_AAAAMMDD-1}", "F = 20260228"), ("F >= '{FECHA_ISO+31}'", "F >= '2026-04-01'"), ("P = {FECHA_AAAAMM}", "P = 202603"),
                                                 ("A = {FECHA_AAAA}", "A = 2026"), ("B = '{BATCH_ID}'", "B = 'b_1'")])
def test_marks(template, text):
    assert ty.resolve_template(template, DAY, "b_1") == text


@pytest.mark.parametrize(("template", "day", "batch"), [("{OTRA}", DAY, "b"), ("{FECHA_AAAA+1}", DAY, "b"), ("{FECHA_ISO}", None, "b"), ("{BATCH_ID}", DAY, "x' OR 1=1"), ("{BATCH_ID}", DAY, None), ("{FECHA_ISO", DAY, "b"), ("{FECHA_ISO}}", DAY, "b")])
def test_bad_marks(template, day, batch):
    with pytest.raises(ValueError):
        ty.resolve_template(template, day, batch)


@pytest.mark.parametrize(("weights", "n"), [([1] * 10, 4), ([1000, 1, 1, 1, 1], 3), ([5], 3), ([1, 2, 3], 9), ([1, 1, 1, 1, 1000], 3), ([], 2)])
def test_cuts_leave_no_group_empty(spark, weights, n):
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "bucket int, n int")
    cuts = pt.cuts_by_count(rows, n)
    want, upto, groups = [], 0, min(n, len(weights))
    for at, weight in enumerate(weights):
        upto += weight
        if groups - 1 - len(want) > 0 and upto * groups >= sum(weights) * (len(want) + 1) and len(weights) - at - 1 >= groups - 1 - len(want):
            want.append(at)
    assert cuts == want == sorted(set(cuts)) and (not cuts or cuts[-1] < len(weights) - 1)
    values = spark.createDataFrame([(i,) for i in range(len(weights))] + [(None,)], "v int")
    parts = [r.part for r in pt.assign_cut_partition(values, F.col("v"), cuts).collect()]
    assert len(set(parts)) == len(cuts) + 2 - (not weights) and parts.count(len(cuts) + 1) == 1


def test_single_values_above_the_even_share_are_reported(spark):
    rows = spark.createDataFrame([(1,)] * 30 + [(i,) for i in range(2, 13)], "v int")
    cuts = pt.cuts_by_count(pt.bucket_histogram(rows, F.col("v")), 4)
    got = {r.part: r for r in pt.skew_report(pt.assign_cut_partition(rows, F.col("v"), cuts), F.col("v")).collect()}
    assert got[0].single_value and got[0].skewed and not any(got[i].single_value for i in got if i)


def test_windows_fail_before_anything_is_written(spark, calendar):
    dates = lambda *d: spark.createDataFrame([(x,) for x in d], "date date")
    ok = cal.operating_window(calendar, D(2026, 6, 30), 45, dates(D(2026, 6, 1))).first()
    assert ok.read_from == D(2026, 5, 15) and ok.write_from == D(2026, 5, 1)
    for end, span, rows, text in ((D(2026, 4, 20), 45, dates(D(2026, 4, 10)), "no business day"), (D(2026, 9, 30), 45, dates(D(2026, 9, 1)), "ends before"), (D(2026, 6, 30), 45, dates(D(2026, 5, 1), D(2026, 7, 9)), "no balances")):
        with pytest.raises(Exception, match=text):
            cal.operating_window(calendar, end, span, rows).collect()
    assert con.consolidated_window(D(2026, 6, 30), 45) == (D(2026, 4, 16), D(2026, 5, 16))
    with pytest.raises(ValueError, match="positive"):
        con.consolidated_window(D(2026, 6, 30), 0)


def test_grids_and_lots_are_checked(spark):
    grid = spark.createDataFrame([("a", D(2026, 6, d)) for d in (1, 2, 3)] + [("b", D(2026, 6, d)) for d in (1, 2, 3)], "key string, date date")
    assert ser.assert_grid(grid, "key", D(2026, 6, 1), D(2026, 6, 3)) is grid
    for wrong, text in ((grid.unionByName(grid.limit(1)), "more than one"), (grid.filter("key = 'a' or day(date) > 1"), "lacks")):
        with pytest.raises(ValueError, match=text):
            ser.assert_grid(wrong, "key", D(2026, 6, 1), D(2026, 6, 3))
    lots, declared = spark.createDataFrame([(1, "x"), (2, "y")], "lot int, table_name string"), spark.createDataFrame([("x", "stg_x")], "table_name string, destination string")
    with pytest.raises(ValueError, match="y"):
        au.batch_lots(lots, declared)
    assert au.batch_lots(lots, declared, strict=False).filter("undeclared").count() == 1


def test_range_partition_clamps(spark):
    rows = spark.createDataFrame([(None,), (-5,), (0,), (99,), (100,), (500,)], "v int")
    assert [r.part for r in pt.assign_range_partition(rows, "v", 0, 100, 4).collect()] == [0, 0, 0, 3, 3, 3]
    assert pt.range_bounds(rows.limit(0), "v") is None


def test_universe_has_no_row_twice(spark):
    rows = spark.createDataFrame([("1411", 20), ("2111", 20), ("2111", 7), ("1411", 7)], "rubro string, module int")
    assert [(r.rubro, r.module, r.is_asset) for r in cl.classify_universe(rows).collect()] == [("1411", 20, 1), ("2111", 20, 0), ("1411", 7, 1)]


@pytest.mark.parametrize(("mode", "lo", "hi"), [("RANGO", DAY, DAY - timedelta(days=1)), ("RANGO", DAY, DAY + timedelta(days=400)), ("RANGO", None, DAY), ("MES", None, None), ("OTRO", DAY, DAY)])
def test_bad_ranges(spark, mode, lo, hi):
    with pytest.raises(ValueError):
        cal.resolve_range(spark.createDataFrame([(DAY,)], "date date"), "date", mode, lo, hi)


def test_fx_bench_rejects_impossible_days(spark):
    rows = spark.createDataFrame([(20260227, 3.754), (20260230, 3.7), (20260228, 0.0)], "day_number int, rate double").withColumns({"rate": F.col("rate").cast("decimal(17,8)"), "currency": F.lit(1)})
    good = rows.withColumn("day", ty.yyyymmdd_to_date(F.col("day_number"))).filter("day is not null")
    got = ty.derive_fx(good).orderBy("day").collect()
    assert [str(r.inverse_rate) for r in got] == ["0.26638253", "None"] and got[0].is_local == "S"


def test_expectations_stop_the_job(spark):
    rows = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    assert qu.apply_expectations(rows, {"pos": (F.col("v") > 0, "drop")}).count() == 1
    with pytest.raises(Exception, match="rule pos"):
        qu.apply_expectations(rows, {"pos": (F.col("v") > 0, "fail")}).collect()


def test_streamed_merge_equals_batch(spark, sf_dir):
    from __spark_entry__ import registry

    a, b = registry.QUERIES["stream_merge_increments"](spark, sf_dir).toPandas(), registry.QUERIES["s16_load_merge"](spark, sf_dir).toPandas()
    key = ["c_custkey"]
    assert a.sort_values(key).reset_index(drop=True).equals(b[a.columns].sort_values(key).reset_index(drop=True))
