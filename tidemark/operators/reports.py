"""Product detail and currency position reports: levelled rows from consolidated balances and the chart of accounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNTS = ("mo", "mn", "change_mo", "change_mn")
# Loan names by module; two modules depend on the account group.
LOANS = {
    239: "Convenios", 102: "Hipotecario", 101: "Mi Vivienda", 140: "Mi Vivienda", 36: "Leasing", 103: "Préstamo Personal", 112: "Comex", 113: "Comex", 114: "Comex", 65: "Tarjeta",
    139: "Confirming", 71: "Descuento de Letras", 117: "Créditos por Liquidar", 116: "Financiamiento Inmobiliario", 149: "Factoring", 142: "Activo Fijo Bien Mueble",
}
LOAN_GROUPS = {(111, (9,)): "IFIS", (111, (10, 11, 12, 13)): "Capital de Trabajo", (115, (10, 11, 12, 13)): "Mediano Plazo"}
LOAN_STATES = ("14_1", "14_3", "14_4", "14_5", "14_6")
# Deposit names by account pattern, in order; level 2 follows the first two digits.
DEPOSITS = {
    "Obligaciones a la Vista": ("21_1", "21_801"), "Obligaciones por Cuentas a Plazo": ("21_3", "21_803"), "Obligaciones por Cuentas de Ahorro": ("21_2", "21_802"),
    "Obligaciones Restringidas (DPF, Cta Cte, Ahorro) y CTS Propios": ("21_6", "21_7", "21_807"),
    "Cuenta Corriente": ("23_1", "23_801"), "Cuenta Ahorro": ("23_2", "23_802"), "Depósitos a Plazo": ("23_3", "23_803"),
}
PUBLIC, FINANCIAL = "OBLIGACIONES CON EL PUBLICO", "DEPOSITOS DE EMPRESAS DEL SIST FINANCIERO Y ORG FINANC"
BORROWINGS = {"MiVivienda": "2612020101", "BANCOLDEX": "26_8020101", "COFIDE": "262202"}
REPOS = {"Repos de Valores": ("2514110101001001", "2514110101001002"), "Repos de Divisas": ("2514110101001003",)}


def _matches(pattern: str) -> Column:
    return F.col(f"dig{len(pattern)}").like(pattern)


def _first(cases: dict[str, Column]) -> Column:
    return reduce(lambda out, case: F.when(case[1], case[0]).otherwise(out), reversed(cases.items()), F.lit(None).cast("string"))


def _detail(rows: DataFrame, chart: DataFrame) -> DataFrame:
    return rows.join(chart, rows.rubro == chart.code).drop("code").withColumn("account_currency", F.substring("rubro", 3, 1))


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _level(one: str, two: str | Column, three: Column, sign: int = 1) -> Column:
    """Levels and sign of a row, null where the third level has no name."""
    two = F.lit(two) if isinstance(two, str) else two
    return F.when(three.isNotNull(), F.struct(F.lit(one).alias("level_1"), two.alias("level_2"), three.alias("level_3"), F.lit(sign).alias("sign")))


def _loans() -> Column:
    """By the column loan_module and the group; asset balances change sign."""
    names = {name: (F.col("loan_module") == module) & F.col("grp").isin(*groups) for (module, groups), name in LOAN_GROUPS.items()}
    names |= {name: F.col("loan_module").isin(*[m for m, n in LOANS.items() if n == name]) for name in dict.fromkeys(LOANS.values())}
    return _level("CARTERA", "CARTERA", F.when(_any(_matches(p) for p in LOAN_STATES), _first(names)), sign=-1)


def _deposits() -> Column:
    names = _first({name: _any(_matches(p) for p in patterns) for name, patterns in DEPOSITS.items()})
    return _level("PRODUCTOS PASIVOS", F.when(F.col("dig2") == "21", PUBLIC).otherwise(FINANCIAL), names)


def _borrowings() -> Column:
    return _level("ADEUDADOS", "ADEUDADOS", _first({n: _matches(p) for n, p in BORROWINGS.items()}))


def _repos() -> Column:
    """By full code; other codes of the family have no name but stay."""
    names = _first({n: F.col("rubro").isin(*codes) for n, codes in REPOS.items()})
    named = F.struct(F.lit("REPOS").alias("level_1"), F.lit("REPOS").alias("level_2"), names.alias("level_3"), F.lit(1).alias("sign"))
    return F.when(_matches("25_4110101"), named)


def _with_modules(rows: DataFrame, modules: DataFrame) -> DataFrame:
    """Add loan_module: the modules of loan accounts (module, rubro) in the chart of products, a row for each."""
    return rows.join(modules.filter(F.col("rubro").startswith("14")).select(F.col("module").alias("loan_module"), "rubro").distinct(), "rubro", "left")


def _levelled(rows: DataFrame, levels: Column) -> DataFrame:
    amounts = [(F.col(a) * F.col("_level.sign")).cast("decimal(18,2)").alias(a) for a in AMOUNTS]
    return rows.withColumn("_level", levels).filter("_level is not null").select("date", "_level.level_1", "_level.level_2", "_level.level_3", "rubro", "currency", "account_currency", *amounts)


def report_loans(rows: DataFrame, chart: DataFrame, modules: DataFrame) -> DataFrame:
    """Loans by module (module, rubro) and group; asset balances change sign."""
    return _levelled(_with_modules(_detail(rows, chart), modules), _loans())


def report_deposits(rows: DataFrame, chart: DataFrame) -> DataFrame:
    return _levelled(_detail(rows, chart), _deposits())


def report_borrowings(rows: DataFrame, chart: DataFrame) -> DataFrame:
    return _levelled(_detail(rows, chart), _borrowings())


def report_repos(rows: DataFrame, chart: DataFrame) -> DataFrame:
    """Repos by full code; other codes of the family have no name but stay."""
    return _levelled(_detail(rows, chart), _repos())


def report_product_detail(rows: DataFrame, chart: DataFrame, modules: DataFrame, start) -> DataFrame:
    """Loans, deposits, borrowings and repos from ``start`` (a date) on, in one pass: their account patterns exclude each other."""
    recent = _with_modules(_detail(rows.filter(F.col("date") >= start), chart), modules)
    return _levelled(recent, F.coalesce(_loans(), _deposits(), _borrowings(), _repos()))


def report_fx_position(balance: DataFrame, results: DataFrame) -> DataFrame:
    """Position rows of the balance sheet (no monthly figures) and of the results, by their text labels."""
    def branch(rows: DataFrame, one: str, two: str, monthly: bool) -> DataFrame:
        months = [F.col(f"change_{a}") if monthly else F.lit(None).cast("decimal(18,2)").alias(f"change_{a}") for a in ("mo", "mn")]
        return rows.select("date", F.lit(one).alias("level_1"), F.lit(two).alias("level_2"), "rubro", "currency", "mo", "mn", *months)

    parts = [
        branch(balance.filter("account_kind = 'POSICION ME'"), "POSICION ME", "CONTABLE", False), branch(balance.filter("group_kind = 'POSICION NETA DE FORWARDS'"), "POSICION ME", "DERIVADOS", False),
        branch(results.filter("line = 'Derivados de Negociación'"), "UTILIDAD", "DERIVADOS", True), branch(results.filter("line = 'Utilidad-Pérdida en Diferencia de Cambio'"), "UTILIDAD", "CONTABLE", True),
    ]
    return reduce(DataFrame.unionByName, parts)


def daily_summary(sales: DataFrame, clients: DataFrame, days: DataFrame) -> DataFrame:
    """Total of sales and number of clients for every day of ``days``, absent ones as 0."""
    total = sales.groupBy("date").agg(F.sum("amount").alias("total_sales"))
    number = clients.groupBy("date").agg(F.count("*").alias("clients"))
    out = days.select("date").distinct().join(total, "date", "left").join(number, "date", "left")
    return out.select("date", F.coalesce("total_sales", F.lit(0)).cast("decimal(18,2)").alias("total_sales"), F.coalesce("clients", F.lit(0)).alias("clients"))
