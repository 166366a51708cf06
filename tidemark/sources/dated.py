"""Stored tables whose versions are lists of Parquet files, committed by compare-and-swap.

Below its folder a table has ``rows/<write>/_part=<day>/*.parquet`` (never changed once written), ``files/<commit>`` (the list of a
version: day, file, rows, lowest and highest key) and ``log/<number>``, one small file a version that names its list and carries a mark. A version
exists as soon as its log file does. That file is put in place whole and only if there is none (:func:`put_if_absent`), so of
two writers of one number exactly one succeeds. The other looks at what has changed since it read: if that does not touch the
days or files that it replaces, it commits on top of it, without writing its rows again; else it fails with :class:`Conflict` and nothing of it is seen.

Readers keep the version that they opened: files go only when :meth:`DatedTable.vacuum` removes versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.tables import materialize, observed


class Conflict(RuntimeError):
    """Another writer has changed what this one replaces."""


def _path(spark: SparkSession, text: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(text)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    store, place = _path(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _path(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str, local: bool | None = None) -> bool:
    """Create a small file with its whole content, unless there is one; of any number of writers one gets True.

    It is written aside and put in place by a hard link on local folders, and by a rename that does not replace elsewhere (as on HDFS; an
    object store whose rename replaces does not do). ``local`` says which; by default the scheme does.
    """
    jvm, (store, place) = spark._jvm, _path(spark, path)
    store.mkdirs(place.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
    stream = store.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if (place.toUri().getScheme() or store.getUri().getScheme()) == "file" if local is None else local:
            at = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(at(place), at(aside))
        else:
            rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            how = spark.sparkContext._gateway.new_array(rename, 1)
            how[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.makeQualified(place).toUri(), spark._jsc.hadoopConfiguration()).rename(aside, place, how)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        store.delete(aside, False)


class DatedTable:
    """A table of the columns ``schema`` below ``base``.

    ``day`` is the date column by which files are kept apart (None: they are not), by day or by the ``unit`` (week, month, quarter, year) that a date
    is in: few rows a day want larger units. ``key`` is a column by whose ranges the files of a write
    are cut, and whose lowest and highest value is known for each file. ``files`` is how many ranges a write cuts, by default as many as
    adaptive execution finds; tables without a key are dealt by day, and days that are too large for one file are split.
    """

    def __init__(self, spark: SparkSession, base: str, schema: StructType, day: str | None = None, key: str | None = None, files: int | None = None, unit: str = "day"):
        self.spark, self.base, self.day, self.key, self.files, self.unit = spark, base.rstrip("/"), day, key, files, unit
        self.schema = StructType([StructField(f.name, f.dataType) for f in schema])
        if "_metadata" in (n.lower() for n in self.schema.names):
            raise ValueError("a column called _metadata would hide the names of files")
        kind = self.schema[key].dataType if key else StringType()
        self.listed = StructType([*StructType.fromDDL("part string, file string, rows long").fields, StructField("low", kind), StructField("high", kind)])

    # Versions
    def versions(self) -> list[int]:
        return [int(n) for n in names(self.spark, f"{self.base}/log") if n.isdigit()]

    def version(self) -> int:
        """The latest version, -1 for a table without any."""
        return max(self.versions(), default=-1)

    def record(self, number: int) -> dict:
        """What the log says of a version: the folder of its list, the mark, and what was done."""
        return json.loads(read_text(self.spark, f"{self.base}/log/{number:012d}")) if number >= 0 else {"list": None, "mark": None, "did": None}

    def mark(self, number: int | None = None) -> str | None:
        return self.record(self.version() if number is None else number)["mark"]

    def list_files(self, number: int | None = None) -> DataFrame:
        """part, file, rows, low and high of the files of a version."""
        folder = self.record(self.version() if number is None else number)["list"]
        return self.spark.read.schema(self.listed).parquet(f"{self.base}/files/{folder}") if folder else self.spark.createDataFrame([], self.listed)

    # Reading
    def _rows(self, listed: DataFrame) -> DataFrame:
        paths = [f"{self.base}/rows/{r[0]}" for r in listed.select("file").toLocalIterator()]  # a path a file, as any scan needs on the driver
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _part(self, day: Column) -> Column:
        """The part that a day's files belong to: the first day of its unit."""
        return F.date_trunc(self.unit, day).cast("date").cast("string")

    def _inside(self, lo: date, hi: date) -> Column:
        return F.coalesce(F.col("part").between(self._part(F.lit(lo)), self._part(F.lit(hi))), F.lit(False))

    def read(self, number: int | None = None, lo: date | None = None, hi: date | None = None) -> DataFrame:
        """A version, by default the latest; with ``lo`` and ``hi`` the days between (both included), for which only their files are opened."""
        listed = self.list_files(number)
        return self._rows(listed) if lo is None else self._rows(listed.filter(self._inside(lo, hi))).filter(F.col(self.day).between(F.lit(lo), F.lit(hi)))

    # Writing
    def _of(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def write(self, rows: DataFrame) -> DataFrame:
        """Write rows to a folder of their own; the list of its files, counted from what was written. They are part of the table once :meth:`commit` gets the list."""
        folder = uuid.uuid4().hex
        name = "_part"
        while name in self.schema.names:
            name += "_"
        part = self._part(F.col(self.day)) if self.day else F.lit(None).cast("string")
        rows = self._of(rows).withColumn(name, part) if self.day else self._of(rows)
        if self.key:
            rows = rows.repartitionByRange(*([self.files] if self.files else []), *([name] if self.day else []), self.key)
        elif self.day:
            rows = rows.hint("rebalance", F.col(name))
        (rows.write.partitionBy(name) if self.day else rows.write).parquet(f"{self.base}/rows/{folder}")
        low, high = (F.min(self.key), F.max(self.key)) if self.key else (F.lit(None).cast("string"), F.lit(None).cast("string"))
        written = self.spark.read.schema(self.schema).parquet(f"{self.base}/rows/{folder}")
        file = F.concat(F.lit(f"{folder}/"), F.substring_index("_metadata.file_path", f"/{folder}/", -1))
        return written.groupBy(file.alias("file")).agg(F.max(part).alias("part"), F.count("*").alias("rows"), low.alias("low"), high.alias("high")).select(*self.listed.names)

    def commit(self, seen: int, gone: Callable[[DataFrame], DataFrame], added: DataFrame | None, did: str, mark: str | None = None, guard_mark: bool = False) -> int:
        """Put the version after ``seen`` in place: its files without those that ``gone`` picks, and the ``added`` ones.

        If others have committed since, what ``gone`` picks must be the same as before, and with ``guard_mark`` the mark too.
        """
        added = materialize(added, "dated-added") if added is not None else self.spark.createDataFrame([], self.listed)
        while True:
            latest = self.version()
            before = self.record(latest)
            if latest != seen:
                old, new = gone(self.list_files(seen)).select("file"), gone(self.list_files(latest)).select("file")
                if not old.exceptAll(new).isEmpty() or not new.exceptAll(old).isEmpty() or (guard_mark and before["mark"] != self.mark(seen)):
                    raise Conflict(f"version {latest} has changed what this writer read in version {seen}")
            listed = self.list_files(latest)
            folder = uuid.uuid4().hex
            kept = listed.join(gone(listed).select("file"), "file", "left_anti").select(*self.listed.names)
            kept.unionByName(added).write.parquet(f"{self.base}/files/{folder}")
            text = json.dumps({"list": folder, "mark": before["mark"] if mark is None else mark, "did": did})
            if put_if_absent(self.spark, f"{self.base}/log/{latest + 1:012d}", text):
                return latest + 1

    def append(self, rows: DataFrame) -> int:
        return self.commit(self.version(), lambda listed: listed.limit(0), self.write(rows), "append")

    def replace(self, rows: DataFrame, seen: int | None = None) -> int:
        """Other rows for all; fails if another version has come since ``seen`` (by default the latest at the call)."""
        seen = self.version() if seen is None else seen
        return self.commit(seen, lambda listed: listed, self.write(rows), "replace")

    def rewrite_range(self, rows: DataFrame, lo: date, hi: date, seen: int | None = None) -> int:
        """Days of the range (both ends included) replaced by those of ``rows``, in one step; files without a day of it stay. Running it again changes nothing that is read.

        With units above a day, the other days of the first and the last unit are carried over.
        """
        seen = self.version() if seen is None else seen
        within = F.col(self.day).between(F.lit(lo), F.lit(hi))
        inside = rows.filter(within)
        if self.unit != "day":
            inside = self._of(inside).unionByName(self._rows(self.list_files(seen).filter(self._inside(lo, hi))).filter(~within))
        return self.commit(seen, lambda listed: listed.filter(self._inside(lo, hi)), self.write(inside), "rewrite_range")

    def rewrite_days(self, rows: DataFrame, seen: int | None = None) -> int:
        """Only the days that ``rows`` has are replaced (missing dates are no day: they are added)."""
        seen = self.version() if seen is None else seen
        rows = self._of(rows)
        if self.unit != "day":
            days = materialize(rows.select(self.day).distinct(), "dated-days")  # a row a day
            touched = self.list_files(seen).join(days.select(self._part(F.col(self.day)).alias("part")).distinct(), "part", "left_semi")
            rows = rows.unionByName(self._rows(touched).join(F.broadcast(days), self.day, "left_anti").select(*self.schema.names))
        added = materialize(self.write(rows), "dated-parts")
        return self.commit(seen, lambda listed: listed.join(added.select("part").filter("part is not null").distinct(), "part", "left_semi").select(*self.listed.names), added, "rewrite_days")

    def append_new(self, source: DataFrame, column: str) -> int | None:
        """Rows of ``source`` whose ``column`` is beyond the table's mark, and the new mark with them in one commit; None without any.

        A run that dies before the commit leaves neither rows nor mark, so the next one takes the same rows; two runs at once
        cannot both commit them.
        """
        seen = self.version()
        mark = self.mark(seen)
        fresh = source if mark is None else source.filter(F.col(column) > F.lit(mark).cast(source.schema[column].dataType))
        told = Observation()
        added = self.write(fresh.observe(told, F.count(F.lit(1)).alias("n"), F.max(F.col(column)).cast("string").alias("mark")).select(*self.schema.names))
        figures = observed(told)
        if not figures.get("n"):
            return None
        return self.commit(seen, lambda listed: listed.limit(0), added, "append_new", figures["mark"], guard_mark=True)

    def hit_files(self, staged: DataFrame, keys: Sequence[str], seen: int) -> DataFrame:
        """The list of files that hold a key of ``staged``; files whose range lies outside of the staged keys are not opened."""
        listed = self.list_files(seen)
        lo, hi = staged.agg(F.min(self.key), F.max(self.key)).first()
        near = listed.filter((F.col("high") >= F.lit(lo)) & (F.col("low") <= F.lit(hi))) if lo is not None else listed.limit(0)
        file = F.element_at(F.split("_metadata.file_path", "/rows/"), -1)
        found = self._rows(near)
        if not found.inputFiles():
            return listed.limit(0)
        found = found.select(*keys, file.alias("file")).join(staged.select(*keys), list(keys), "left_semi").select("file").distinct()
        return listed.join(found, "file", "left_semi").select(*self.listed.names)

    def merge(self, staged: DataFrame, keys: Sequence[str]) -> int:
        """Rows of known keys updated, new ones added; only files that hold a staged key are written anew. Needs a ``key``, the first of ``keys``.

        Null keys match nothing. Repeated keys are refused.
        """
        from tidemark.sources.loads import assert_unique_keys, load_merge

        if not self.key or self.key != keys[0]:
            raise ValueError("the table's key must be the first key")
        seen = self.version()
        staged = assert_unique_keys(materialize(staged.select(*self.schema.names), "merge-staged"), keys)
        hit = materialize(self.hit_files(staged, keys, seen), "merge-hit")
        added = self.write(load_merge(self._rows(hit), staged, keys))
        return self.commit(seen, lambda listed: listed.join(hit.select("file"), "file", "left_semi").select(*self.listed.names), added, "merge")

    # Retention
    def retain(self, today: date, days: int) -> int:
        """A version without the days before the last ``days``; 0 or less drops nothing, today and unknown dates always stay. Files go with :meth:`vacuum`."""
        if days <= 0:
            return self.version()
        seen, first = self.version(), F.date_sub(F.lit(today), days)
        old, added = F.coalesce(F.col("part") < first.cast("string"), F.lit(False)), None
        if self.unit != "day":  # the unit of the first day is kept in part
            added = self.write(self._rows(self.list_files(seen).filter(F.col("part") == self._part(first))).filter(F.col(self.day) >= first))
        return self.commit(seen, lambda listed: listed.filter(old | F.coalesce(F.col("part") == self._part(first), F.lit(False)) if added is not None else old), added, "retain")

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions and delete the files that only those list; the number of deleted files.

        Folders of writes that are not committed are left alone: they may belong to writers at work.
        """
        numbers = self.versions()
        expired, kept = numbers[:-keep] if keep > 0 else [], numbers[-keep:]
        if not expired:
            return 0
        lists = lambda which: [f"{self.base}/files/{self.record(n)['list']}" for n in which]
        of = lambda which: self.spark.read.schema(self.listed).parquet(*lists(which)).select("file").distinct()
        folder = F.regexp_replace("file", "/[^/]*$", "")
        stay = of(kept)
        gone = of(expired).join(stay, "file", "left_anti").withColumn("folder", folder)
        gone = materialize(gone.join(stay.select(folder.alias("folder")).distinct().withColumn("_used", F.lit(True)), "folder", "left"), "vacuum")
        old = lists(expired)
        for number in expired:  # readers of the log no longer find them
            store, place = _path(self.spark, f"{self.base}/log/{number:012d}")
            store.delete(place, False)
        for path in [*(f"{self.base}/rows/{r[0]}" for r in gone.filter("_used is null").select("folder").distinct().toLocalIterator()), *(f"{self.base}/rows/{r[0]}" for r in gone.filter("_used").select("file").toLocalIterator()), *old]:
            store, place = _path(self.spark, path)
            store.delete(place, True)
        return gone.count()
