"""Value cleaning and guards."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfold.functions.named import time_to_sec

# Texts that stand for a zero date, and the date they are rounded to.
ZERO_DATES = ("0", "0000-00-00", "0000-00-00 00:00:00", "00000000000000")
ROUNDED_DATE = "0001-01-01"

# SQL type names and the type each converts to.
SQL_TYPES = {
    "BIGINT": "bigint",
    "BINARY": "binary",
    "BIT": "bigint",
    "CHAR": "string",
    "DATE": "date",
    "DECIMAL": "decimal(38,10)",
    "DOUBLE": "double",
    "FLOAT": "float",
    "INTEGER": "int",
    "LONGVARBINARY": "binary",
    "LONGVARCHAR": "string",
    "REAL": "double",
    "SMALLINT": "smallint",
    "TIMESTAMP": "timestamp_ntz",
    "TINYINT": "tinyint",
    "VARBINARY": "binary",
    "VARCHAR": "string",
}


def _fail(*parts: str | Column) -> Column:
    pieces = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.raise_error(F.concat(*pieces))


def wild_match(value: Column, pattern: str) -> Column:
    """Case-insensitive match of a whole value: ``%`` any text, ``_`` one character, ``\\`` escape."""
    def unescaped(found: re.Match[str]) -> str:
        return found[1] if found[1] and found[1] not in "%_\\" else "\\" + (found[1] or "\\")

    plain = re.sub(r"(?s)\\(.?)", unescaped, pattern)
    return F.coalesce(value.ilike(plain), F.lit(False))


def zero_date(value: Column, mode: str = "error", to: str = "date") -> Column:
    """Text to date; a zero date becomes null, an error, or the first day of year 1."""
    text = F.trim(value)
    replacement = {
        "null": F.lit(None).cast(to),
        "round": F.lit(ROUNDED_DATE).cast(to),
        "error": _fail("zero date: ", text).cast(to),
    }[mode]
    return F.when(text.isin(*ZERO_DATES), replacement).otherwise(text.cast(to))


def zero_dates(df: DataFrame, cols: Sequence[str], mode: str = "error", to: str = "date") -> DataFrame:
    return df.withColumns({c: zero_date(F.col(c), mode, to) for c in cols})


def tiny_to_bool(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-digit integers as booleans."""
    return df.withColumns({c: F.col(c) != 0 for c in cols})


def year_column(value: Column, as_date: bool = True, two_digit: bool = False) -> Column:
    """A year as 1 January of it, or as a number; two-digit years up to 69 are 20yy."""
    year = value.cast("int")
    if two_digit:
        year = year + F.when(year <= 69, 2000).otherwise(1900)
    return F.make_date(year, F.lit(1), F.lit(1)) if as_date else year.cast("smallint")


def to_number(value: Column, empty_as_zero: bool = True, to: str = "double") -> Column:
    """Text to number; what is no number or does not fit becomes null, empty text 0 or an error.

    A whole-number type takes ``12.7`` and ``1e3`` as well, cut to whole numbers.
    """
    text = F.trim(value)
    empty = F.lit(0).cast(to) if empty_as_zero else _fail("empty text is no number").cast(to)
    number = F.coalesce(text.try_cast(to), text.try_cast("double").try_cast(to))
    return F.when(text == "", empty).otherwise(number)


def checked_cast(value: Column, to: str, on_error: str = "fail") -> Column:
    """Narrowing that never wraps: what does not fit fails the job or becomes null."""
    fitted = value.try_cast(to)
    if on_error == "null":
        return fitted
    wrong = value.isNotNull() & fitted.isNull()
    return F.when(wrong, _fail("out of range for ", to, ": ", value).cast(to)).otherwise(fitted)


def cast_rejects(df: DataFrame, column: str, to: str) -> DataFrame:
    """The rows whose value does not fit."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(to).isNull())


def shift_tz(ts: Column, from_tz: str, to_tz: str) -> Column:
    """The wall-clock time in ``to_tz`` of a wall-clock time in ``from_tz``."""
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), ts)


def _forbidden(df: DataFrame, pattern: str, cols: Sequence[str] | None) -> dict[str, Column]:
    whole = rf"\A(?:{pattern})\z"
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return {n: F.coalesce(F.col(n).cast("string").rlike(whole), F.lit(False)) for n in cols}


def regex_guard(
    df: DataFrame, pattern: str, mode: str = "fail", flag: str = "disallowed",
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Watch columns for values that fully match a forbidden pattern.

    All text columns unless ``cols`` names them; others are matched as text. ``fail`` stops the
    job, ``drop`` leaves such rows out, ``flag`` adds the names of the columns.
    """
    hits = _forbidden(df, pattern, cols)
    if not hits:
        return df.withColumn(flag, F.array().cast("array<string>")) if mode == "flag" else df
    if mode == "flag":
        named = F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items()])
        return df.withColumn(flag, F.array_compact(named))
    if mode == "drop":
        return df.where(~reduce(Column.__or__, hits.values()))
    if mode != "fail":
        raise ValueError(f"unknown mode {mode}")
    checked = {
        name: F.when(hit, _fail("value disallowed in column ", name).cast(df.schema[name].dataType))
        .otherwise(F.col(name))
        for name, hit in hits.items()
    }
    return df.withColumns(checked)


def regex_report(
    df: DataFrame, pattern: str, keys: Sequence[str], cols: Sequence[str] | None = None
) -> DataFrame:
    """One row per disallowed value: the row's keys and the ``column``."""
    flagged = regex_guard(df, pattern, "flag", "__found", cols)
    return flagged.select(*keys, F.explode("__found").alias("column"))


def convert(value: Column, type_name: str, strict: bool = True) -> Column:
    """Conversion by SQL type name, with or without ``SQL_`` in front; TIME gives seconds.

    DECIMAL may be given its precision and scale, as in ``DECIMAL(38,18)``. Numbers become plain
    text, without an exponent where 20 digits before the point and 18 after it hold the same value.
    """
    name = type_name.strip().upper().removeprefix("SQL_")
    if re.fullmatch(r"DECIMAL\(\d+, *\d+\)", name):
        return value.cast(name) if strict else value.try_cast(name)
    if name == "TIME":
        return time_to_sec(value.cast("string"))
    if name not in SQL_TYPES:
        raise ValueError(f"unsupported conversion type {type_name!r}")
    if SQL_TYPES[name] == "string":
        return _plain_text(value)
    return value.cast(SQL_TYPES[name]) if strict else value.try_cast(SQL_TYPES[name])


def _plain_text(value: Column) -> Column:
    text = value.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    number = F.typeof(value).isin("double", "float") & text.contains("E")
    # Compared in the value's own type: a float's digits are those that give the float back.
    same = F.when(F.typeof(value) == "float", plain.try_cast("float") == text.try_cast("float")).otherwise(plain.try_cast("double") == text.try_cast("double"))
    return F.when(number & F.coalesce(same, F.lit(False)), plain).otherwise(text)
