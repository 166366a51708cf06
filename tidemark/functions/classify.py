"""Classification of account codes, modules and operation types: rules are data, expressions stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Four-digit prefixes of loan assets, and modules of the liability universe.
ASSET_PREFIXES = ("1401", "1403", "1404", "1405", "1406", "1411", "1413", "1414", "1415", "1416", "1421", "1423", "1424", "1425", "1426")
LIABILITY_MODULES = (20, 21, 22, 120, 155, 162, 184, 185, 321)
# Credit states by the last digit of the prefix 14_x.
CREDIT_STATES = {"current": "14_1", "restructured": "14_3", "refinanced": "14_4", "overdue": "14_5", "judicial": "14_6"}
# The wide universe of liabilities and results, as account prefixes by their length.
WIDE_2 = ("41", "46", "49", "56", "57", "68")
WIDE_4 = (
    "4111", "4112", "4113", "4115", "4116", "4117", "4118", "4121", "4122", "4123", "4125", "4126", "4127", "4128", "4211", "4212", "4221", "4222",
    "4312", "4313", "4322", "4323", "4411", "4413", "4421", "4423", "4511", "4512", "4513", "4514", "4521", "4522", "4523", "4524", "5111", "5112",
    "5114", "5117", "5118", "5121", "5124", "5127", "5128", "5211", "5212", "5213", "5214", "5221", "5222", "5223", "5224", "5415", "5416", "5425",
    "5426",
)
WIDE_6 = (
    "411401", "411402", "411403", "411404", "411405", "411406", "411407", "411408", "411901", "411903", "411904", "411905", "411907", "411908",
    "411909", "411910", "411911", "411912", "411913", "411914", "411915", "411916", "411917", "411918", "411919", "411920", "411922", "411923",
    "411925", "411926", "412401", "412402", "412403", "412404", "412405", "412406", "412407", "412408", "412901", "412903", "412904", "412905",
    "412907", "412908", "412909", "412910", "412911", "412912", "412913", "412914", "412915", "412916", "412917", "412918", "412919", "412920",
    "412922", "412923", "412925", "412926", "421204", "421205", "422204", "422205", "431401", "431402", "431501", "431502", "431503", "431504",
    "431506", "431508", "431509", "432401", "432402", "432501", "432502", "432503", "432504", "432506", "432508", "432509", "511301", "511302",
    "511303", "511304", "511305", "511306", "511504", "511507", "511901", "511903", "511904", "511910", "511911", "511912", "511913", "511914",
    "511915", "511916", "511917", "511918", "511919", "511925", "511926", "511927", "511928", "512301", "512302", "512303", "512304", "512305",
    "512306", "512504", "512507", "512901", "512903", "512904", "512910", "512911", "512912", "512913", "512914", "512915", "512916", "512917",
    "512918", "512919", "512925", "512926", "512927", "512928", "521204", "521205", "522204", "522205",
)
WIDE_8 = (
    "41191703", "41192403", "41291703", "41292403", "43150501", "43150505", "43150506", "43250501", "43250505", "43250506", "51191703",
    "51192403", "51291703", "51292403", "54140103", "54240103",
)
WIDE_10 = (
    "4119170102", "4119170202", "4119240101", "4119240102", "4129170102", "4129170202", "4129240101", "4129240102", "4315050401",
    "4315050402", "4325050401", "4325050402", "5119170102", "5119170202", "5119240101", "5119240102", "5129170102", "5129170202",
    "5129240101", "5129240102",
)
WIDE_16 = (
    "4312030106030101", "4312030106030501", "4312030201060101",
    "4312030201060501", "4312030701000103", "4312030702000103",
)
WIDE_PREFIXES = {2: WIDE_2, 4: WIDE_4, 6: WIDE_6, 8: WIDE_8, 10: WIDE_10, 16: WIDE_16}
CARD_MODULE, CARD_PREFIXES = 183, ("1201", "1211", "1221")
# Result lines by prefix; provisions by the prefixes of their full codes.
RESULT_LINES = {"income": ("5114", "5124"), "commission": ("5117", "5127"), "expense": ("41",), "reversal": ("54140103", "54240103")}
PROVISIONS = (
    "4312030106030501", "4322030106030501", "4312030201060101", "4322030201060101", "4312030201060501",
    "4322030201060501", "4312030701000103", "4322030701000103", "4312030702000103", "4322030702000103",
)
# Product-expense flags by module and operation type of origin (None: any other type).
EXPENSE_FLAGS = (
    (20, 8, 10), (20, None, 7),
    (21, None, 8),
    (22, 10, 11), (22, None, 9),
    (120, 30, 4), (120, None, 3),
    (155, None, 10),
    (185, 0, 5), (185, 15, 3), (185, 3, 10), (185, None, 2),
    (321, None, 6),
)


def account_currency(code: Column) -> Column:
    """1 or 2 by the third digit of the code, else null."""
    digit = F.substring(code, 3, 1)
    return F.when(digit.isin("1", "2"), digit.cast("int"))


def is_asset(code: Column) -> Column:
    return F.substring(code, 1, 4).isin(*ASSET_PREFIXES)


def credit_buckets(df: DataFrame, code: str = "rubro", amounts: tuple[str, ...] = ("amount_mo", "amount_mn")) -> DataFrame:
    """Add <state>_<amount> for the five credit states: the amount where code and asset class fit, else 0."""
    added = {}
    for amount in amounts:
        for state, pattern in CREDIT_STATES.items():
            fits = is_asset(F.col(code)) & F.substring(code, 1, 4).like(pattern)
            added[f"{state}_{amount}"] = F.when(fits, F.col(amount)).otherwise(F.lit(0).cast("decimal(18,2)"))
    return df.withColumns(added)


def classify_universe(df: DataFrame, code: str = "rubro", module: str = "module", rules: str = "narrow") -> DataFrame:
    """Rows of the balance universe with ``is_asset`` (1 or 0), assets taking precedence; one pass, no row twice.

    ``narrow``: loan assets or liability modules. ``full``: also results and liabilities by prefix, looked up by length.
    """
    asset = is_asset(F.col(code))
    inside = asset | F.col(module).isin(*LIABILITY_MODULES)
    if rules == "full":
        for digits, prefixes in WIDE_PREFIXES.items():
            inside = inside | F.substring(code, 1, digits).isin(*prefixes)
        inside = inside | ((F.col(module) == CARD_MODULE) & F.substring(code, 1, 4).isin(*CARD_PREFIXES))
    elif rules != "narrow":
        raise ValueError("rules must be narrow or full")
    return df.filter(inside).withColumn("is_asset", F.when(asset, 1).otherwise(0))


def result_lines(df: DataFrame, code: str = "code", amount: str = "amount_mn") -> DataFrame:
    """Add income, commission, expense, reversal and provision: the amount where the code belongs to the line, else null."""
    belongs = lambda prefixes: F.greatest(*[F.startswith(F.col(code), F.lit(p)) for p in (*prefixes, prefixes[0])])
    lines = RESULT_LINES | {"provision": PROVISIONS}
    return df.withColumns({name: F.when(belongs(prefixes), F.col(amount)) for name, prefixes in lines.items()})


def product_expense_flag(module: Column, origin_type: Column) -> Column:
    """0 to 11 by module and the operation type of origin."""
    out = F.lit(0)
    for wanted, kind, flag in reversed(EXPENSE_FLAGS):
        out = F.when((module == wanted) if kind is None else (module == wanted) & (origin_type == kind), flag).otherwise(out)
    return out


def account_type(module: Column, code: Column) -> Column:
    return F.when((module == 65) & code.startswith("1"), 1).otherwise(2)
