"""Versions of stored tables: races, rebases, range rewrites, marks, merges, retention."""

import concurrent.futures
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.sources import dated
from tidemark.sources import loads as ld
from tidemark.tables import shared_dir

D = date
SCHEMA = "date date, k long, v string, part string, file string, low int"


def rows(spark, *items):
    return spark.createDataFrame([(D(2026, 6, d) if d else None, k, v, "p", "f", 1) for d, k, v in items], SCHEMA)


@pytest.fixture
def table(spark):
    out = dated.DatedTable(spark, shared_dir(spark, "dated"), spark.createDataFrame([], SCHEMA).schema, day="date")
    assert out.version() == -1 and out.read().count() == 0 and out.mark() is None
    assert out.append(rows(spark, (1, 1, "a"), (1, 2, "b"), (2, 3, "c"), (3, 4, "d"), (None, 5, "e"))) == 0
    return out


def content(table, number=None):
    return sorted(r.v for r in table.read(number).collect())


def files(table, number=None):
    return {r.file: r.part for r in table.list_files(number).collect()}


@pytest.mark.parametrize("local", [True, False])
def test_one_of_many_writers_puts_the_file(spark, local):
    path = shared_dir(spark, "put") + "/000"
    with concurrent.futures.ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: dated.put_if_absent(spark, path, f"writer {i} é", local), range(16)))
    assert sum(won) == 1 and dated.read_text(spark, path) == f"writer {won.index(True)} é"
    assert dated.names(spark, path.rsplit("/", 1)[0]) == ["000"] and dated.names(spark, path + "-none") == []


def test_a_range_is_rewritten_and_other_files_stay(spark, table):
    before = files(table)
    assert table.rewrite_range(rows(spark, (1, 1, "x"), (2, 9, "y"), (3, 9, "outside"), (None, 9, "outside")), D(2026, 6, 1), D(2026, 6, 2)) == 1
    assert content(table) == ["d", "e", "x", "y"] and content(table, 0) == ["a", "b", "c", "d", "e"]
    kept = {f for f, p in before.items() if p in (None, "2026-06-03")}
    assert len(kept) == 2 and kept == set(before) & set(files(table))
    table.rewrite_range(rows(spark, (1, 1, "x"), (2, 9, "y")), D(2026, 6, 1), D(2026, 6, 2))
    assert content(table) == ["d", "e", "x", "y"]  # again changes nothing
    table.rewrite_range(rows(spark), D(2026, 6, 2), D(2026, 6, 2))
    assert content(table) == ["d", "e", "x"] and [r.v for r in table.read(lo=D(2026, 6, 3), hi=D(2026, 6, 9)).collect()] == ["d"]
    assert len(table.read(lo=D(2026, 6, 3), hi=D(2026, 6, 9)).inputFiles()) == 1


def test_days_are_rewritten(spark, table):
    table.rewrite_days(rows(spark, (2, 1, "x"), (4, 1, "y"), (None, 1, "z")))
    assert content(table) == ["a", "b", "d", "e", "x", "y", "z"]


def test_the_loser_of_a_race_fails_or_goes_on_top(spark, table):
    """Two writers that read version 0: of one day the second fails and leaves nothing, of other days it commits after the first."""
    table.rewrite_range(rows(spark, (1, 1, "first")), D(2026, 6, 1), D(2026, 6, 1), seen=0)
    with pytest.raises(dated.Conflict):
        table.rewrite_range(rows(spark, (1, 1, "second")), D(2026, 6, 1), D(2026, 6, 2), seen=0)
    assert table.version() == 1 and content(table) == ["c", "d", "e", "first"]
    assert table.rewrite_range(rows(spark, (3, 1, "third")), D(2026, 6, 3), D(2026, 6, 3), seen=0) == 2
    assert content(table) == ["c", "e", "first", "third"]
    with pytest.raises(dated.Conflict):
        table.replace(rows(spark, (1, 1, "all")), seen=1)
    assert table.replace(rows(spark, (1, 1, "all")), seen=2) == 3 and content(table) == ["all"]


def test_writers_at_once_lose_nothing(spark, table):
    with concurrent.futures.ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda d: table.rewrite_range(rows(spark, (d, d, f"day {d}")), D(2026, 6, d), D(2026, 6, d)), range(10, 15)))
    assert table.version() == 5 and content(table) == ["a", "b", "c", "d", *(f"day {d}" for d in range(10, 15)), "e"]

    def attempt(i):
        try:
            return table.rewrite_range(rows(spark, (20, i, f"writer {i}")), D(2026, 6, 20), D(2026, 6, 20), seen=5)
        except dated.Conflict:
            return None

    with concurrent.futures.ThreadPoolExecutor(4) as pool:
        won = [i for i, n in enumerate(pool.map(attempt, range(4))) if n is not None]
    assert len(won) == 1 and [v for v in content(table) if v.startswith("writer")] == [f"writer {won[0]}"]


def test_mark_and_rows_are_committed_together(spark, table, monkeypatch):
    source = rows(spark, *[(5, k, f"k{k}") for k in range(10)])
    assert table.append_new(source.filter("k < 3"), "k") == 1 and table.mark() == "2"
    put = dated.put_if_absent
    monkeypatch.setattr(dated, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("the driver dies here")))
    with pytest.raises(OSError):
        table.append_new(source.filter("k < 6"), "k")  # rows are written, the commit is not
    monkeypatch.setattr(dated, "put_if_absent", put)
    assert table.mark() == "2" and len(content(table)) == 8
    assert table.append_new(source.filter("k < 6"), "k") == 2 and table.mark() == "5"
    table.rewrite_range(rows(spark), D(2026, 6, 1), D(2026, 6, 1))
    assert table.mark() == "5" and table.append_new(source.filter("k < 6"), "k") is None and table.append_new(source, "k") == 4
    assert [v for v in content(table) if v.startswith("k")] == [f"k{k}" for k in range(10)]


def test_two_incremental_runs_do_not_repeat_rows(spark, table, monkeypatch):
    source = rows(spark, *[(5, k, f"k{k}") for k in range(4)])
    write = table.write

    def meanwhile(fresh):
        monkeypatch.setattr(table, "write", write)
        table.append_new(source, "k")
        return write(fresh)

    monkeypatch.setattr(table, "write", meanwhile)
    with pytest.raises(dated.Conflict):
        table.append_new(source, "k")
    assert [v for v in content(table) if v.startswith("k")] == [f"k{k}" for k in range(4)]


def test_a_merge_rewrites_only_files_it_hits(spark):
    schema = "k long, v string"
    table = dated.DatedTable(spark, shared_dir(spark, "merged"), spark.createDataFrame([], schema).schema, key="k", files=8)
    table.append(spark.range(8000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = table.list_files().collect()
    assert len(before) == 8 and all(r.high - r.low + 1 == r.rows for r in before)
    staged = spark.createDataFrame([(k, "new") for k in (5, 700, 7999, 9000)], schema)
    want = {(r.k, r.v) for r in ld.load_merge(table.read(), staged, ["k"]).collect()}
    table.merge(staged, ["k"])
    hit = {r.file for r in before if any(r.low <= k <= r.high for k in (5, 700, 7999))}
    assert {(r.k, r.v) for r in table.read().collect()} == want
    assert {r.file for r in before} & set(files(table)) == {r.file for r in before} - hit and len(hit) < 4
    now = set(files(table))
    table.merge(spark.createDataFrame([(20_000, "far"), (None, "no key")], schema), ["k"])
    assert now < set(files(table)) and table.read().count() == 8003
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, "x"), (1, "y")], schema), ["k"])


def test_retention_drops_folders_and_leaves_readers_alone(spark, table):
    table.append(rows(spark, (9, 1, "today")))
    assert table.retain(D(2026, 6, 9), 0) == 1
    reader = table.read()
    assert table.retain(D(2026, 6, 9), 7) == 2 and content(table) == ["c", "d", "e", "today"]
    assert sorted(r.v for r in reader.collect()) == ["a", "b", "c", "d", "e", "today"]
    assert table.vacuum(keep=2) == 0 and table.versions() == [1, 2]
    latest = table.read()
    assert table.vacuum() == 1 and table.versions() == [2]
    assert content(table) == sorted(r.v for r in latest.collect()) == ["c", "d", "e", "today"]
    folders = {n for write in dated.names(spark, f"{table.base}/rows") for n in dated.names(spark, f"{table.base}/rows/{write}")}
    assert "_part=2026-06-01" not in folders and {"_part=2026-06-02", "_part=2026-06-03", "_part=2026-06-09"} <= folders
    assert len(dated.names(spark, f"{table.base}/files")) == 1
