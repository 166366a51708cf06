"""Banking views of the TPC-H-like tables: the same definitions for Spark (class Bed) and for DuckDB (BED_SQL).

Balances are all lines of all orders. Keys are coarse (20 accounts, 3 operations), so that series have gaps instead of
single days; ``customer`` is the key that grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import operation_keys
from tidemark.operators.calendar import business_day_asof
from tidemark.tables import materialize

FEASTS = ("01-01", "05-01", "12-25")
# Account codes that the classification rules tell apart, dealt to rows by part key.
LEDGER = (
    "1411010101", "1424010101", "2111010101", "5114010101", "5127010101", "4111010101", "54140103010101", "4312030106030501",
    "4312030701000103", "5119170102", "511302010101", "1211010101", "5600010101", "7100010101", "2512020101", "43150501010101",
)


class Bed:
    """Views on the tables below ``sf_dir``; every view is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def calendar(self) -> DataFrame:
        first, last = self.table("lineitem").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()  # read once, not wherever the calendar is used
        days = self.spark.range(1).select(F.explode(F.sequence(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31)))).alias("day"))
        rest = F.dayofweek("day").isin(1, 7) | F.date_format("day", "MM-dd").isin(*FEASTS)
        return days.select(F.lit(1).alias("cod_calendar"), "day", F.when(rest, "N").otherwise("S").alias("is_business"))

    @cached_property
    def raw(self) -> DataFrame:
        lines = self.table("lineitem").withColumn("ship", F.col("l_shipdate").cast("date"))
        both = lines.join(self.table("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        pick = lambda column, *values: F.element_at(F.array(*map(F.lit, values)), (F.col(column) % len(values) + 1).cast("int"))
        currency = (F.col("l_orderkey") % 2 + 1).cast("int")
        both = both.withColumn("module", pick("l_linenumber", 20, 21, 120, 65)).withColumn("currency", currency)
        loan, deposit = pick("l_partkey", "1", "3", "4", "5", "6"), pick("l_partkey", "1", "2", "3")
        rubro = F.when(F.col("module") == 65, F.concat(F.lit("14"), F.col("currency").cast("string"), loan)).otherwise(F.concat(F.lit("21"), F.col("currency").cast("string"), deposit))
        rows = both.select(
            "ship", F.lit(1).alias("company"), "module", F.lit(1).alias("branch"), "currency", F.lit(0).alias("paper"),
            (F.col("o_custkey") % 20).cast("int").alias("account"), (F.col("l_suppkey") % 3).cast("int").alias("operation"), F.lit(0).alias("sub_operation"), F.lit(0).alias("operation_type"), F.col("o_custkey").alias("customer"),
            rubro.alias("rubro"), pick("l_partkey", *LEDGER).alias("code"), (F.col("l_partkey") % 31).cast("int").alias("origin_type"),
            F.col("l_extendedprice").cast("decimal(17,2)").alias("amount_mn"), (F.round("l_quantity").cast("int") * 10).cast("decimal(17,2)").alias("amount_mo"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("load_seq"),
            F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).alias("title"), F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("chapter"),
        )
        return operation_keys(rows)

    @cached_property
    def closing(self) -> DataFrame:
        """One row per line, moved to the last business day up to its ship date."""
        days = F.broadcast(business_day_asof(self.calendar).select(F.col("day").alias("ship"), F.col("origin").alias("date")))  # one row a day
        return self.raw.join(days, "ship").drop("ship")

    @cached_property
    def snapshots(self) -> DataFrame:
        keys = ["company", "module", "branch", "currency", "paper", "account", "operation", "rubro"]
        amount = F.when(~((F.col("account") == 7) & (F.col("operation") == 2)), F.sum("amount_mn")).cast("decimal(18,2)")
        return self.raw.groupBy(F.col("ship").alias("date"), *keys).agg(amount.alias("amount_mn"), F.sum("amount_mo").cast("decimal(18,2)").alias("amount_mo"), F.min("origin_type").alias("origin_type"))

    @cached_property
    def sdc(self) -> DataFrame:
        """Balances by day and long key: far fewer rows than lines. They are written once, since queries read them up to ten times."""
        keys = ["company", F.col("account").alias("branch"), "module", "currency", "paper", "rubro", "title", "chapter", F.lit(0).alias("term"), F.col("operation").alias("grp")]
        return materialize(self.closing.groupBy("date", *keys).agg(F.sum("amount_mo").cast("decimal(18,2)").alias("mo"), F.sum("amount_mn").cast("decimal(18,2)").alias("mn")), "sdc")

    @cached_property
    def operations(self) -> DataFrame:
        """One row per key that has a line of title 1, but for the accounts 3, 10 and 17: their balances have no operation."""
        return operation_keys(self.raw.filter("title = 1 and account % 7 <> 3").groupBy("company", "module", "branch", "currency", "paper", "account", "operation", "sub_operation", "operation_type").agg(
            F.max("ship").alias("date"), F.sum("amount_mn").cast("decimal(18,2)").alias("disbursed")))

    @cached_property
    def accounts(self) -> DataFrame:
        return self.table("customer").select((F.col("c_custkey") % 20).cast("int").alias("account"), F.col("c_nationkey").alias("executive"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))

    @cached_property
    def chart(self) -> DataFrame:
        codes = self.raw.select(F.col("rubro").alias("code")).unionByName(self.raw.select("code")).distinct()
        return codes.select("code", *[F.substring("code", 1, n).alias(f"dig{n}") for n in (1, 2, 4, 6, 8, 10)])

    @cached_property
    def run_log(self) -> DataFrame:
        e = self.table("events")
        state = F.when(F.col("event_type") == "error", "ERROR").when(F.col("value") < 5, "SIN_DATOS").otherwise("TERMINADO")
        return e.select(F.col("event_type").alias("table_name"), F.date_format("ts", "yyyyMMdd").alias("batch_id"), F.col("ts").cast("date").alias("run_date"), "event_id",
                        state.alias("state"), F.floor("value").cast("long").alias("n_rows"), (F.col("user_id") % 900).cast("int").alias("seconds"))

    @cached_property
    def load_log(self) -> DataFrame:
        """The load of every run; its mark is the run's id."""
        return self.run_log.withColumn("mark_to", F.col("event_id"))

    @cached_property
    def target(self) -> DataFrame:
        return self.table("customer").select("c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))

    @cached_property
    def staged(self) -> DataFrame:
        """All customers under doubled keys: about half of them match a key of the target."""
        return self.table("customer").select((F.col("c_custkey") * 2).alias("c_custkey"), "c_name", "c_nationkey", (F.col("c_acctbal") + 1).alias("balance"), F.lit("STAGED").alias("segment"))

    @cached_property
    def fx(self) -> DataFrame:
        """Exchange-rate staging rows: yyyymmdd integers, every seventh with an impossible day; some rates are zero."""
        o = self.table("orders")
        number = F.date_format("o_orderdate", "yyyyMMdd").cast("int") + F.when(F.col("o_orderkey") % 7 == 0, 40).otherwise(0)
        rate = F.when(F.col("o_orderkey") % 11 == 0, F.lit(0)).otherwise(F.lit(3) + (F.col("o_orderkey") % 1000) / F.lit(1000))
        return o.select("o_orderkey", F.lit(1).alias("company"), number.alias("day_number"), (F.col("o_custkey") % 3 + 1).cast("int").alias("currency"), rate.cast("decimal(17,8)").alias("rate"))

    @cached_property
    def parameters(self) -> DataFrame:
        """A table that holds several logical ones, told apart by its code."""
        p = self.table("part")
        code = F.element_at(F.array(*map(F.lit, (6007, 6006, 6008, 90009))), (F.col("p_partkey") % 4 + 1).cast("int"))
        first = F.when(F.col("p_partkey") % 13 == 0, "99999999").when(F.col("p_partkey") % 17 == 0, "20211399").otherwise(F.concat(F.lit("2021"), F.lpad((F.col("p_partkey") % 12 + 1).cast("string"), 2, "0"), F.lpad((F.col("p_partkey") % 28 + 1).cast("string"), 2, "0")))
        return p.select(F.lit(1).alias("company"), code.alias("code"), first.alias("id1"), F.col("p_partkey").cast("string").alias("id2"), F.lit("0").alias("id3"), F.lit("0").alias("id4"),
                        F.col("p_size").cast("string").alias("nro1"), F.lit("1").alias("nro2"), F.lit("2").alias("nro3"), F.col("p_brand").alias("chr1"), F.col("p_type").alias("chr2"), F.col("p_name").alias("chr3"))


def _pick(column: str, *values) -> str:
    cases = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values))
    return f"CASE {column} % {len(values)} {cases} END"


BED_SQL = f"""
WITH RECURSIVE calendar AS (SELECT 1 AS cod_calendar, CAST(d AS DATE) AS day,
    CASE WHEN dayofweek(d) IN (0, 6) OR strftime(d, '%m-%d') IN {FEASTS} THEN 'N' ELSE 'S' END AS is_business
    FROM (SELECT unnest(generate_series(date_trunc('year', (SELECT CAST(min(l_shipdate) AS TIMESTAMP) FROM lineitem)), CAST(make_date(CAST(year((SELECT max(l_shipdate) FROM lineitem)) AS INTEGER), 12, 31) AS TIMESTAMP), INTERVAL 1 DAY)) AS d)),
lines AS (SELECT CAST(l_shipdate AS DATE) AS ship, 1 AS company, {_pick("l_linenumber", 20, 21, 120, 65)} AS module, 1 AS branch, CAST(1 + l_orderkey % 2 AS INTEGER) AS currency, 0 AS paper,
    CAST(o_custkey % 20 AS INTEGER) AS account, CAST(l_suppkey % 3 AS INTEGER) AS operation, 0 AS sub_operation, 0 AS operation_type, o_custkey AS customer,
    {_pick("l_partkey", *LEDGER)} AS code, CAST(l_partkey % 31 AS INTEGER) AS origin_type, CAST(l_extendedprice AS DECIMAL(17,2)) AS amount_mn, CAST(CAST(round(l_quantity) AS INTEGER) * 10 AS DECIMAL(17,2)) AS amount_mo,
    l_orderkey * 8 + l_linenumber AS load_seq, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS title, CASE l_linestatus WHEN 'O' THEN 1 ELSE 2 END AS chapter, l_partkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw AS (SELECT *, CASE WHEN module = 65 THEN concat('14', currency, {_pick("l_partkey", "1", "3", "4", "5", "6")}) ELSE concat('21', currency, {_pick("l_partkey", "1", "2", "3")}) END AS rubro,
    concat_ws('|', company, module, branch, currency, paper, account, operation, sub_operation, operation_type) AS id_operation,
    concat_ws('|', company, branch, currency, paper, account, operation, sub_operation, operation_type) AS id_balance,
    concat_ws('|', company, branch, currency, paper, account, operation, sub_operation) AS id_cross FROM lines),
closing AS (SELECT * EXCLUDE (ship, l_partkey), (SELECT max(c.day) FROM calendar c WHERE c.is_business = 'S' AND c.day <= ship) AS date FROM raw),
snapshots AS (SELECT ship AS date, company, module, branch, currency, paper, account, operation, rubro, CASE WHEN account = 7 AND operation = 2 THEN NULL ELSE CAST(sum(amount_mn) AS DECIMAL(18,2)) END AS amount_mn,
    CAST(sum(amount_mo) AS DECIMAL(18,2)) AS amount_mo, min(origin_type) AS origin_type FROM raw GROUP BY ship, company, module, branch, currency, paper, account, operation, rubro),
sdc AS (SELECT date, company, account AS branch, module, currency, paper, rubro, title, chapter, 0 AS term, operation AS grp, CAST(sum(amount_mo) AS DECIMAL(18,2)) AS mo, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS mn FROM closing GROUP BY ALL),
operations AS (SELECT company, module, branch, currency, paper, account, operation, sub_operation, operation_type, id_operation, id_balance, id_cross, max(ship) AS date, CAST(sum(amount_mn) AS DECIMAL(18,2)) AS disbursed FROM raw WHERE title = 1 AND account % 7 <> 3 GROUP BY ALL),
accounts AS (SELECT CAST(c_custkey % 20 AS INTEGER) AS account, c_nationkey AS executive, c_name AS name, c_mktsegment AS segment FROM customer),
chart AS (SELECT code, {", ".join(f"left(code, {n}) AS dig{n}" for n in (1, 2, 4, 6, 8, 10))} FROM (SELECT rubro AS code FROM raw UNION SELECT code FROM raw)),
run_log AS (SELECT event_type AS table_name, strftime(ts, '%Y%m%d') AS batch_id, CAST(ts AS DATE) AS run_date, event_id, CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value < 5 THEN 'SIN_DATOS' ELSE 'TERMINADO' END AS state,
    CAST(floor(value) AS BIGINT) AS n_rows, CAST(user_id % 900 AS INTEGER) AS seconds FROM events),
load_log AS (SELECT *, event_id AS mark_to FROM run_log),
target AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer),
staged AS (SELECT c_custkey * 2 AS c_custkey, c_name, c_nationkey, c_acctbal + 1 AS balance, 'STAGED' AS segment FROM customer),
fx AS (SELECT o_orderkey, 1 AS company, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) + CASE WHEN o_orderkey % 7 = 0 THEN 40 ELSE 0 END AS day_number, CAST(o_custkey % 3 + 1 AS INTEGER) AS currency,
    CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(3 + (o_orderkey % 1000) / 1000.0 AS DECIMAL(17,8)) END AS rate FROM orders),
parameters AS (SELECT 1 AS company, {_pick("p_partkey", 6007, 6006, 6008, 90009)} AS code, CASE WHEN p_partkey % 13 = 0 THEN '99999999' WHEN p_partkey % 17 = 0 THEN '20211399'
    ELSE '2021' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') END AS id1, CAST(p_partkey AS VARCHAR) AS id2, '0' AS id3, '0' AS id4,
    CAST(p_size AS VARCHAR) AS nro1, '1' AS nro2, '2' AS nro3, p_brand AS chr1, p_type AS chr2, p_name AS chr3 FROM part)
"""
