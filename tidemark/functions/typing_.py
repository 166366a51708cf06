"""Declared types, safe dates, stamps and templated filters."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = {
    **dict.fromkeys(("char", "varchar", "nchar", "nvarchar"), T.StringType()),
    **dict.fromkeys(("int", "integer", "smallint", "bit"), T.IntegerType()),
    "bigint": T.LongType(), **dict.fromkeys(("float", "double", "real"), T.DoubleType()), "date": T.DateType(),
}


def parse_type(text: str) -> T.DataType:
    """A declared type: decimals need a precision, bits stay integers, unknown names are strings."""
    found = re.fullmatch(r"\s*(\w+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", text)
    if not found:
        raise ValueError(f"not a type: {text!r}")
    name, precision, scale = found[1].lower(), found[2], found[3]
    if name in ("decimal", "numeric"):
        if precision is None:
            raise ValueError(f"{name} needs a precision")
        return T.DecimalType(int(precision), int(scale or 0))
    if name.startswith(("datetime", "timestamp")) or name == "smalldatetime":
        return T.TimestampType()
    return _PLAIN.get(name, T.StringType())


def parse_types(spec: str) -> T.StructType:
    """COLUMN:TYPE|COLUMN:TYPE as a schema; a malformed item is an error."""
    fields = []
    for item in filter(str.strip, spec.split("|")):
        name, colon, kind = item.partition(":")
        if not colon or not name.strip() or not kind.strip():
            raise ValueError(f"not COLUMN:TYPE: {item!r}")
        fields.append(T.StructField(name.strip(), parse_type(kind)))
    return T.StructType(fields)


def apply_types(df: DataFrame, types: T.StructType, mode: str = "strict") -> DataFrame:
    """Cast declared columns; blank text becomes null first, other columns stay, absent ones are passed over.

    ``strict``: what cannot be cast fails. ``coerce``: numbers that cannot be parsed become null, decimals still fail.
    """
    changed = {}
    for field in types:
        if field.name not in df.columns:
            continue
        column = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, T.StringType) and not isinstance(field.dataType, T.StringType):
            column = F.nullif(F.trim(column), F.lit(""))
        lenient = mode == "coerce" and not isinstance(field.dataType, T.DecimalType)
        changed[field.name] = column.try_cast(field.dataType) if lenient else column.cast(field.dataType)
    return df.withColumns(changed) if changed else df


def conform_to(df: DataFrame, target: T.StructType, injected: tuple[str, ...] = ("FECHA_PROCESO", "BATCH_ID")) -> DataFrame:
    """Take types from the target's columns of the same name, but for those that loads inject."""
    return apply_types(df, T.StructType([f for f in target if f.name not in injected]))


def stamp_batch(df: DataFrame, day: date, batch: str) -> DataFrame:
    """Business date first, batch id last."""
    return df.select(F.lit(day).alias("FECHA_PROCESO"), "*", F.lit(batch).alias("BATCH_ID"))


def stamp_load(df: DataFrame, column: str) -> DataFrame:
    """Year and month of a date column, for partitioned writes, and the load time."""
    return df.withColumns({"load_ts": F.current_timestamp(), "anio": F.year(column), "mes": F.month(column)})


def yyyymmdd_to_date(number: Column) -> Column:
    """A date from 20240131, null where there is none."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def checked_yyyymmdd(text: Column) -> Column:
    """The same after a test of form: eight characters, month 1 to 12, day 1 to 31."""
    month, day = F.substring(text, 5, 2).try_cast("int"), F.substring(text, 7, 2).try_cast("int")
    return F.when((F.length(text) == 8) & month.between(1, 12) & day.between(1, 31), F.try_to_date(text, "yyyyMMdd"))


def derive_fx(df: DataFrame, rate: str = "rate", currency: str = "currency") -> DataFrame:
    """Inverse rate with eight decimals (null for a rate of zero) and the local-currency flag."""
    inverse = F.try_divide(F.lit(1).cast("decimal(17,8)"), F.col(rate)).cast("decimal(17,8)")
    return df.withColumns({"inverse_rate": inverse, "is_local": F.when(F.col(currency) == 1, "S").otherwise("N")})


_MARK = re.compile(r"\{([^{}]*)\}")
_DATE_MARK = re.compile(r"(FECHA_AAAAMMDD|FECHA_ISO)([+-]\d+)?")


def resolve_template(template: str, day: date | None, batch: str | None = None) -> str:
    """Replace date and batch marks in a filter; unknown or unresolved marks, and odd batch ids, are errors."""

    def value(found: re.Match) -> str:
        mark = found[1]
        if mark == "BATCH_ID":
            if batch is None or not re.fullmatch(r"[A-Za-z0-9_]{1,32}", batch):
                raise ValueError("the batch id is missing or has characters that are not allowed")
            return batch
        if (m := _DATE_MARK.fullmatch(mark)) or mark in ("FECHA_AAAAMM", "FECHA_AAAA"):
            if day is None:
                raise ValueError(f"{mark} needs a date")
            if not m:
                return f"{day:%Y%m}" if mark == "FECHA_AAAAMM" else f"{day:%Y}"
            moved = day + timedelta(days=int(m[2] or 0))
            return f"{moved:%Y%m%d}" if m[1] == "FECHA_AAAAMMDD" else f"{moved:%Y-%m-%d}"
        raise ValueError(f"unknown mark {{{mark}}}")

    out = _MARK.sub(value, template)
    if "{" in out or "}" in out:
        raise ValueError("a mark is not closed")
    return out


def where_template(df: DataFrame, template: str, day: date | None, batch: str | None = None) -> DataFrame:
    return df.where(resolve_template(template, day, batch)) if template.strip() else df


#: Logical tables inside the parameter table: code, columns renamed, rows of the key 99999999 dropped.
PARAMETERS = {
    "module_product": (6007, {"id1": "module", "id2": "operation_type", "nro1": "record_kind", "nro2": "relation_kind", "nro3": "business_kind", "chr1": "balance_kind", "chr2": "module_name", "chr3": "operation_type_name"}, False),
    "segments": (6006, {"id1": "kind", "id2": "segment", "chr1": "short_name", "chr2": "name"}, False),
    "executives": (6008, {"id2": "executive", "nro1": "segment", "nro2": "bank", "chr1": "executive_name", "chr2": "team_lead"}, True),
    "equity": (90009, {"id1": "period", "chr1": "equity"}, True),
}


def split_parameters(df: DataFrame, kind: str) -> DataFrame:
    """One logical table of the parameter table; executives also get a date from their key, null if it is malformed."""
    code, names, keyed = PARAMETERS[kind]
    rows = df.filter(F.col("code") == code)
    if keyed:
        rows = rows.filter(F.col("id1") != "99999999")
    extra = [checked_yyyymmdd(F.col("id1")).alias("date")] if kind == "executives" else []
    return rows.select(*extra, "company", "code", *[F.col(c).alias(n) for c, n in names.items()])
