"""Audited loads, comparisons by digest, as-of marks by ranges, even writes, splits as tasks, distinct counts in stages."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit as au
from tidemark.operators import calendar as cal
from tidemark.operators import quality as qu
from tidemark.operators import series as ser
from tidemark.sources import dated
from tidemark.sources import loads as ld
from tidemark.sources import partitioning as pt
from tidemark.tables import shared_dir

D = date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, rows, schema):
    """A table that counts how often its rows are read."""
    reads = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    return spark.createDataFrame(rows, schema).repartition(2).mapInPandas(pass_on, schema), reads


def test_a_load_is_audited_by_the_pass_that_writes(spark):
    rows, reads = counted(spark, [(k, k - 3) for k in range(10)], "k long, v long")
    store = dated.DatedTable(spark, shared_dir(spark, "audit"), rows.schema)
    rules = {"positive": (F.col("v") > 0, "drop"), "even": (F.col("k") % 2 == 0, "warn"), "there": (F.col("k").isNotNull(), "fail")}
    row = au.load_audited(store, rows, "t", "b", rules).first()
    assert reads.value == 10  # one scan for the rows, the log and all rules
    assert (row.state, row.n_rows, row.message, row.broken) == ("TERMINADO", 6, None, {"positive": 4, "even": 5, "there": 0}) and row.seconds > 0
    assert sorted(r.k for r in store.read().collect()) == [4, 5, 6, 7, 8, 9]
    row = au.load_audited(store, rows.filter("k > 99"), "t", "c").first()
    assert (row.state, row.n_rows) == ("SIN_DATOS", 0) and store.version() == 0
    text = "e" * 5000
    row = au.load_audited(store, rows, "t", "d", {"never": (F.col("k") < F.when(F.col("k") < 0, 1).otherwise(F.raise_error(F.lit(text)).cast("int")), "fail")}).first()
    assert row.state == "ERROR" and len(row.message) == 4000 and row.broken is None and row.n_rows == 0 and store.read().count() == 6
    row = au.load_audited(store, rows.filter("k is null"), "t", "e", {"any": (F.col("k") > 0, "drop")}).first()
    assert row.state == "SIN_DATOS" and row.broken == {"any": 0}


def test_another_writer_makes_a_load_fail(spark, monkeypatch):
    rows = spark.range(3).withColumnRenamed("id", "k")
    store = dated.DatedTable(spark, shared_dir(spark, "audit"), rows.schema)
    write = store.write

    def meanwhile(fresh):
        monkeypatch.setattr(store, "write", write)
        store.append(rows.limit(1))
        return write(fresh)

    monkeypatch.setattr(store, "write", meanwhile)
    row = au.load_audited(store, rows, "t", "b").first()
    assert row.state == "ERROR" and "has changed" in row.message and store.read().count() == 1


def test_a_second_writer_of_a_version_is_refused(spark, monkeypatch):
    base = shared_dir(spark, "versions")
    assert ld.commit_version(spark.range(3), base) == 0
    put = ld.put_if_absent

    def meanwhile(session, path, text):
        monkeypatch.setattr(ld, "put_if_absent", put)
        assert ld.commit_version(spark.range(7), base) == 1
        return put(session, path, text)

    for how in ({"number": 1}, {"after": 0}):
        monkeypatch.setattr(ld, "put_if_absent", meanwhile)
        if ld.versions(spark, base) == [0]:
            with pytest.raises(dated.Conflict):
                ld.commit_version(spark.range(9), base, **how)
        monkeypatch.setattr(ld, "put_if_absent", put)
    assert ld.read_version(spark, base).count() == 7 and ld.versions(spark, base) == [0, 1]
    with pytest.raises(dated.Conflict):
        ld.commit_version(spark.range(9), base, after=0)
    lost = iter([False, True])
    monkeypatch.setattr(ld, "put_if_absent", lambda *a: put(*a) if next(lost) else put(a[0], a[1], ld.read_text(spark, f"{base}/v-{0:012d}")) and False)
    assert ld.commit_version(spark.range(5), base) == 3 and ld.read_version(spark, base, 3).count() == 5  # the next free number


SMALL = (4, 64)


def versions_of(spark, n=3000):
    before = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("v"), (F.col("id") / 2).alias("w"))
    changed = before.withColumn("v", F.when(F.col("k") == 14, "new").when(F.col("k") == 15, F.lit(None)).otherwise(F.col("v"))).withColumn("w", F.when(F.col("k") == 16, -1.0).otherwise(F.col("w")))
    return before, changed.filter("k <> 20").unionByName(spark.createDataFrame([(n + 5, "extra", 0.0), (None, "null", 0.0)], "k long, v string, w double"))


@pytest.mark.parametrize("levels", [SMALL, qu.LEVELS, (1,), (2, 4, 8)])
def test_only_differing_ranges_are_joined(spark, levels):
    before, after = versions_of(spark)
    got = {r.k: r.differing for r in qu.compare_rows(before, after, ["k"], ["v", "w"], levels).collect()}
    assert got == {14: "v", 15: "v", 16: "w"}
    assert {(r.k, r.status) for r in qu.compare_keys(before, after, ["k"], levels).collect()} == {(20, "MISSING"), (3005, "EXTRA"), (None, "EXTRA")}
    ranges = qu.differing_ranges(*(qu.range_digests(x, ["k"], ["v", "w"], levels) for x in (before, after)), levels)
    assert ranges.count() <= 6
    assert qu.compare_rows(before, before.repartition(5), ["k"], ["v", "w"], levels).count() == 0
    equal = qu.differing_ranges(*(qu.range_digests(x, ["k"], ["v", "w"], levels) for x in (before, before.repartition(5))), levels)
    assert equal.count() == 0 and qu.within_ranges(before, ["k"], equal, levels).count() == 0


def test_digests_tell_nulls_and_repeated_rows(spark):
    schema = "k long, a string, b string"
    one = spark.createDataFrame([(1, None, "x"), (2, "y", "y")], schema)
    two = spark.createDataFrame([(1, "x", None), (2, "y", "y")], schema)
    assert {r.k for r in qu.compare_rows(one, two, ["k"], ["a", "b"], SMALL).collect()} == {1}
    digest = lambda df: sorted(map(tuple, qu.range_digests(df, ["k"], ["a", "b"], SMALL).collect()))
    assert digest(one) != digest(one.unionByName(one)) and digest(one) != digest(one.unionByName(one).unionByName(one))
    assert digest(one.limit(0)) == [] and qu.compare_keys(one.limit(0), one, ["k"], SMALL).count() == 2


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_latest_marks_by_ranges(spark, parts, monkeypatch):
    runs = [("a" if k % 3 else "b", k, k * 10, 2 + k % 5, k) for k in range(1, 400)] + [("c", 900, 5, 1, 900), (None, 901, 5, 1, 901)]
    marks = [("a", k, k % 4 + 1) for k in (0, 7, 7, 100, 399)] + [("b", 50, 2), ("b", 51, None), (None, 3, 9), ("z", 1, 1)]
    r = spark.createDataFrame(runs, "table_name string, run long, n_rows long, seconds long, at long")
    m = spark.createDataFrame(marks, "table_name string, at long, cores int")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x.run: x.cores for x in cal.latest_before(r, m, ["table_name"], "at", "cores").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {}
    for group, run, _, _, at in runs:
        before = [(t, c) for g, t, c in marks if g == group and t <= at and c is not None]
        want[run] = max(before)[1] if before else None
    assert got == want


def test_a_skewed_month_has_several_files(spark):
    rows = spark.range(60_000).select(F.md5(F.col("id").cast("string")).alias("v"), F.lit(2026).alias("anio"), F.when(F.col("id") < 100, 1).otherwise(2).alias("mes")).repartition(8)
    path, size = shared_dir(spark, "skewed"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        ld.write_partitioned(rows, path)
        assert ld.write_even(rows, path + "-even") == "TERMINADO" and ld.write_even(rows.limit(0), path + "-none") == "SIN_DATOS"
    finally:
        spark.conf.unset(size)
    files = {r.mes: r.n for r in spark.read.parquet(path).groupBy("mes").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files[1] == 1 and files[2] > 4
    sizes = [r.n for r in spark.read.parquet(path + "-even").groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 4 and max(sizes) < 3 * 60_000 / len(sizes)


def test_a_number_is_a_task_and_a_file(spark):
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else i) for i in range(100)], "k int, v int")
    parted = rows.withColumn("part", pt.predicate_number(["v < 30", "v >= 30 AND v < 31", "v > 500", "v >= 31"]))
    dealt = pt.deal_parts(parted, "part", 5)
    tasks = dealt.withColumn("at", F.spark_partition_id()).groupBy("part").agg(F.count_distinct("at").alias("tasks"), F.min("at").alias("task")).collect()
    assert {(r.part, r.tasks, r.task) for r in tasks} == {(0, 1, 0), (3, 1, 3), (4, 1, 4)}  # 30 is missing (null), nothing is above 500; nulls have the last task
    assert dealt.rdd.getNumPartitions() == 5 and plan(pt.deal_parts(parted, "part", 5)).count("Exchange") == 1
    out = pt.extract_parts(parted, "part", 5, shared_dir(spark, "extract"))
    assert out.count() == 100 and out.groupBy("file").agg(F.count_distinct("part").alias("n")).filter("n > 1").isEmpty() and out.select("file").distinct().count() == 3
    for bad in (None, 5, -1):
        with pytest.raises(Exception, match="no task for part"):
            pt.deal_parts(rows.withColumn("part", F.lit(bad).cast("int")), "part", 5).count()


def test_a_large_number_is_split_between_tasks(spark):
    """A number with nearly all rows has a folder of its own with several files, and no file has a large share; small ones have one file."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    parted = spark.range(0, 60_000, 1, 8).select("id", F.hash("id").alias("v"), F.when(F.col("id") < 10, F.col("id").cast("int") % 2).otherwise(2).alias("part"))
    spark.conf.set(size, "64k")
    try:
        out = pt.extract_parts(parted, "part", 4, shared_dir(spark, "extract")).cache()
    finally:
        spark.conf.unset(size)
    held = {r.part: (r.n, r.folders, r.files) for r in out.groupBy("part").agg(F.count("*").alias("n"), F.count_distinct("folder").alias("folders"), F.count_distinct("file").alias("files")).collect()}
    assert held[0] == held[1] == (5, 1, 1) and held[2][:2] == (59_990, 1) and held[2][2] > 3
    assert max(r["count"] for r in out.groupBy("file").count().collect()) < 59_990 / 3 and out.select("id").distinct().count() == 60_000
    assert out.groupBy("folder").agg(F.count_distinct("part").alias("n")).filter("n > 1").isEmpty()
    with pytest.raises(Exception, match="no task for part"):
        pt.extract_parts(parted.withColumn("part", F.col("part") + 2), "part", 4, shared_dir(spark, "extract"))


def test_distinct_counts_in_stages(spark):
    rows = [(D(2026, 1, 1), "a", 1), (D(2026, 1, 31), "a", 1), (D(2026, 1, 31), "b", 1), (D(2026, 1, 2), None, 1), (D(2026, 2, 3), "a", 2), (None, "a", 3)]
    df = spark.createDataFrame(rows, "date date, x string, y int")
    got = qu.month_breakdown(df, ["x", "y"])
    assert "Expand" not in plan(got)
    assert {(r.month, r.days, r.n_keys, r.n_rows, r.expected_rows) for r in got.collect()} == {(D(2026, 1, 1), 3, 2, 4, 62), (D(2026, 2, 1), 1, 1, 1, 28), (None, 0, 1, 1, None)}


def test_grids_need_a_whole_calendar(spark):
    days = spark.createDataFrame([(D(2026, 6, d),) for d in (1, 2, 3)], "day date")
    assert ser.assert_days(days, D(2026, 6, 1), D(2026, 6, 3)) is days
    for wrong, text in ((days.unionByName(days), "twice"), (days.filter("day(day) <> 2"), "lacks")):
        with pytest.raises(ValueError, match=text):
            ser.assert_days(wrong, D(2026, 6, 1), D(2026, 6, 3))


def test_units_above_a_day_keep_the_other_days(spark):
    schema = "date date, v int"
    rows = lambda *days: spark.createDataFrame([(d, n) for n, d in enumerate(days)], schema)
    store = dated.DatedTable(spark, shared_dir(spark, "months"), rows().schema, day="date", unit="month")
    all_days = [D(2026, m, d) for m in (1, 2, 3, 4) for d in (1, 15, 28)]
    store.append(rows(*all_days))
    first = {r.file for r in store.list_files().collect()}
    assert len(first) == 4
    store.rewrite_range(rows(D(2026, 2, 20), D(2026, 3, 2), D(2026, 3, 20)), D(2026, 2, 15), D(2026, 3, 15))
    kept = sorted(r.date for r in store.read().collect())
    assert kept == [D(2026, 1, 1), D(2026, 1, 15), D(2026, 1, 28), D(2026, 2, 1), D(2026, 2, 20), D(2026, 3, 2), D(2026, 3, 28), D(2026, 4, 1), D(2026, 4, 15), D(2026, 4, 28)]
    assert len(first & {r.file for r in store.list_files().collect()}) == 2
    store.rewrite_days(rows(D(2026, 4, 15), D(2026, 5, 1)))
    assert sorted(r.date for r in store.read().collect()) == [*kept, D(2026, 5, 1)]
    store.retain(D(2026, 5, 1), 40)
    assert sorted(r.date for r in store.read().collect()) == [D(2026, 3, 28), D(2026, 4, 1), D(2026, 4, 15), D(2026, 4, 28), D(2026, 5, 1)]
    assert [r.date for r in store.read(lo=D(2026, 4, 2), hi=D(2026, 4, 20)).collect()] == [D(2026, 4, 15)]
