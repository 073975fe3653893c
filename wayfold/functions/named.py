"""Functions by their SQL names that Spark lacks or defines otherwise.

Every other advertised numeric, string and date function is a Spark built-in of the same name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Day number of 1970-01-01 counted from year 0, and the pivot of two-digit years.
EPOCH_DAYS = 719528
YEAR_PIVOT = 70

# Percent codes of date and time formats and the Spark pattern of each.
FORMAT_CODES = {
    "a": "EEE", "b": "MMM", "c": "M", "d": "dd", "e": "d", "f": "SSSSSS", "H": "HH", "h": "hh",
    "I": "hh", "i": "mm", "j": "DDD", "k": "H", "l": "h", "M": "MMMM", "m": "MM", "p": "a",
    "r": "hh:mm:ss a", "S": "ss", "s": "ss", "T": "HH:mm:ss", "W": "EEEE", "Y": "yyyy", "y": "yy",
}


def truncate(x: Column, decimals: int) -> Column:
    """Cut, not rounded, to a number of decimals; negative counts cut whole digits."""
    # The digits of the number as it is written; a double of 0.29 is a little less than that.
    written = F.abs(x).try_cast("decimal(38,18)")
    cut = F.signum(x) * F.floor(written, F.lit(decimals)).cast("double")
    # Numbers of 1e20 and more have no decimals.
    return F.coalesce(cut, x.cast("double") if decimals >= 0 else x - x % F.lit(float(10**-decimals)))


def length(text: Column) -> Column:
    """Length in bytes; Spark's counts characters."""
    return F.octet_length(text)


def elt(n: Column, *options: Column) -> Column:
    """The n-th option; null outside them, where Spark's fails."""
    return F.when(n.between(1, len(options)), F.elt(n, *options))


def field(value: Column, *options: Column) -> Column:
    """Position of the value among the options from 1; 0 if absent or null."""
    return F.coalesce(F.array_position(F.array(*options), value), F.lit(0)).cast("int")


def make_set(bits: Column, *names: Column) -> Column:
    """The names whose bit is set, joined by commas; null names are skipped."""
    chosen = [F.when(F.getbit(bits.cast("bigint"), F.lit(i)) == 1, name) for i, name in enumerate(names)]
    return F.when(bits.isNotNull(), F.concat_ws(",", *chosen))


def export_set(bits: Column, on: str, off: str, sep: str = ",", count: int = 64) -> Column:
    """A text for every bit, lowest first."""
    each = [
        F.when(F.getbit(bits.cast("bigint"), F.lit(i)) == 1, F.lit(on)).otherwise(F.lit(off))
        for i in range(min(count, 64))
    ]
    return F.when(bits.isNotNull(), F.concat_ws(sep, *each))


def insert(text: Column, pos: int, length: int, new: Column) -> Column:
    """Replace ``length`` characters from ``pos``; a position outside the text changes nothing."""
    size = F.length(text)
    rest = F.when(F.lit(length) < 0, size).otherwise(F.lit(length))
    tail = F.substr(text, F.lit(pos) + rest, size)
    replaced = F.concat(F.substr(text, F.lit(1), F.lit(max(pos - 1, 0))), new, tail)
    return F.when(F.lit(pos).between(F.lit(1), size), replaced).otherwise(text)


def mid(text: Column, pos: int, length: int) -> Column:
    return F.substring(text, pos, length)


def oct(number: Column) -> Column:
    return F.conv(number.cast("string"), 10, 8)


def ord(text: Column) -> Column:
    """Number made of the bytes of the first character."""
    first = F.hex(F.encode(F.substring(text, 1, 1), "UTF-8"))
    return F.when(text == "", F.lit(0)).otherwise(F.conv(first, 16, 10).cast("bigint")).cast("bigint")


def strcmp(left: Column, right: Column) -> Column:
    """-1, 0 or 1, by bytes."""
    return F.when(left == right, 0).when(left < right, -1).when(left > right, 1)


def week(day: Column, mode: int = 0) -> Column:
    """Week of year. Weeks begin on Sunday (modes 0, 2, 4, 6) or Monday (1, 3, 5, 7; 3 is ISO). The first week is the one that begins
    in the year (0, 2, 5, 7), or the first with four days in it (1, 3, 4, 6). Days before it are in week 0 (0, 1, 4, 5), or in
    the last week of the year before, as may days at the end be in the first week of the next (2, 3, 6, 7)."""
    if mode not in range(8):
        raise ValueError("mode must be from 0 to 7")
    since_first = F.weekday(day) if mode % 2 else F.dayofweek(day) - F.lit(1)
    middle = mode in (1, 3, 4, 6)
    if mode in (2, 3, 6, 7):
        # The week is of the year that its first day, or its fourth, is in.
        decides = F.date_add(day, (F.lit(3 if middle else 0) - since_first).cast("int"))
        return (F.floor((F.dayofyear(decides) - F.lit(1)) / F.lit(7)) + F.lit(1)).cast("int")
    if not middle:
        return F.floor((F.dayofyear(day) - F.lit(1) + F.lit(7) - since_first) / F.lit(7)).cast("int")
    new_year = F.pmod(since_first - F.dayofyear(day) + F.lit(1), F.lit(7))
    return (F.floor((F.dayofyear(day) - F.lit(1) + new_year) / F.lit(7)) + F.when(new_year <= 3, 1).otherwise(0)).cast("int")


def _months(period: Column) -> Column:
    year = F.floor(period / F.lit(100))
    full = F.when(year < YEAR_PIVOT, year + 2000).when(year < 100, year + 1900).otherwise(year)
    return full * F.lit(12) + period % F.lit(100) - F.lit(1)


def period_add(period: Column, months: Column) -> Column:
    """YYYYMM or YYMM plus a number of months, as YYYYMM."""
    total = _months(period) + months
    return (F.floor(total / F.lit(12)) * F.lit(100) + total % F.lit(12) + F.lit(1)).cast("bigint")


def period_diff(left: Column, right: Column) -> Column:
    return (_months(left) - _months(right)).cast("bigint")


def to_days(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")) + F.lit(EPOCH_DAYS)


def from_days(number: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), (number - F.lit(EPOCH_DAYS)).cast("int"))


def unix_timestamp(ts: Column) -> Column:
    """Whole seconds since 1970, of a clock without zone: the session zone plays no part."""
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + seconds


def from_unixtime(seconds: Column) -> Column:
    """The inverse, as ``yyyy-MM-dd HH:mm:ss``."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")), "yyyy-MM-dd HH:mm:ss")


def dayname(day: Column) -> Column:
    """Full name of the weekday."""
    return F.date_format(day, "EEEE")


def monthname(day: Column) -> Column:
    """Full name of the month."""
    return F.date_format(day, "MMMM")


def sec_to_time(seconds: Column) -> Column:
    """``[-]HH:MM:SS``; hours may exceed 24."""
    size = F.abs(seconds.cast("bigint"))
    parts = (F.floor(size / 3600), F.floor(size % 3600 / 60), size % 60)
    texts = [F.format_string("%02d", p.cast("bigint")) for p in parts]
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.concat_ws(":", *texts))


def time_to_sec(text: Column) -> Column:
    """Seconds of ``[-]H:MM[:SS]``; null for any other text."""
    shaped = F.regexp_extract(text, r"\A-?(\d+):([0-5]?\d)(?::([0-5]?\d))?(?:\.\d*)?\z", 0) != ""

    def part(i: int) -> Column:
        found = F.regexp_extract(text, r"\A-?(\d+):(\d+)(?::(\d+))?", i)
        return F.coalesce(found.try_cast("bigint"), F.lit(0))

    size = part(1) * 3600 + part(2) * 60 + part(3)
    return F.when(shaped, F.when(text.startswith("-"), -size).otherwise(size))


def _pieces(codes: str) -> list[tuple[str, str]]:
    """(code, literal) pairs of a percent format."""
    return re.findall(r"%(.)|([^%]+)", codes)


def percent_format(ts: Column, codes: str) -> Column:
    """Format by percent codes, such as ``%Y-%m-%d %H:%i:%s``."""
    texts = [
        F.date_format(ts, FORMAT_CODES[code]) if code in FORMAT_CODES else F.lit(code or literal)
        for code, literal in _pieces(codes)
    ]
    return F.concat(*texts)


def time_format(seconds: Column, codes: str) -> Column:
    """A time of day, given in seconds, by percent codes; ``%H`` and ``%k`` may exceed 24."""
    size = F.abs(seconds.cast("bigint"))
    hours = F.floor(size / 3600)
    clock = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (size % 86400).cast("decimal(18,6)")
    )
    texts = []
    for code, literal in _pieces(codes):
        if code == "H":
            texts.append(F.format_string("%02d", hours.cast("bigint")))
        elif code == "k":
            texts.append(hours.cast("string"))
        elif code in FORMAT_CODES:
            texts.append(F.date_format(clock, FORMAT_CODES[code]))
        else:
            texts.append(F.lit(code or literal))
    return F.concat(*texts)


def sysdate() -> Column:
    return F.localtimestamp()


def curtime() -> Column:
    """Time of day as text."""
    return F.date_format(F.localtimestamp(), "HH:mm:ss")
