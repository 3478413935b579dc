"""Numbers, money, periods and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.canon import lookup


def number(c: Column) -> Column:
    """A number from text, with a decimal comma allowed; null where there is none, and for NaN."""
    x = F.regexp_replace(F.trim(c.cast("string")), ",", ".").try_cast("double")
    return F.when(F.isnan(x), None).otherwise(x)


def no_nan(c: Column) -> Column:
    return F.when(F.isnan(c), None).otherwise(c)


def ratio(a: Column, b: Column, zero: bool = True) -> Column:
    """a / b; where b is null or zero, or a is null: zero, or null if not ``zero``."""
    x = F.try_divide(a.cast("double"), b.cast("double"))
    return F.coalesce(x, F.lit(0.0)) if zero else x


# Euros for a unit of the currency.
EUROS = {"EUR": 1.0, "DKK": 0.134, "SEK": 0.088, "PLN": 0.23, "HUF": 0.0026}


def to_euros(amount: Column, currency: Column, rates: dict[str, float] | None = None) -> Column:
    """Amount in euros; a blank currency is the euro, an unknown one gives null."""
    code = F.coalesce(F.nullif(F.upper(F.trim(currency)), F.lit("")), F.lit("EUR"))
    return amount * lookup(code, rates or EUROS)


def add_months(period: Column, months: int) -> Column:
    """yyyymm shifted by months."""
    n = F.floor(period / 100) * 12 + period % 100 - 1 + months
    return (F.floor(n / 12) * 100 + F.pmod(n, F.lit(12)) + 1).cast("long")


def year_of(period: Column) -> Column:
    return F.floor(period / 100).cast("long")


def period_of(c: Column) -> Column:
    """yyyymm from text: six digits, or a date."""
    t = F.trim(c.cast("string"))
    digits = F.when(t.rlike("^\\d{6}$"), t)
    d = parse_date(c)
    return F.coalesce(digits, F.date_format(d, "yyyyMM")).try_cast("long")


def period_in_name(name: Column) -> Column:
    """The first six digits in a file name that are a month."""
    return F.nullif(F.regexp_extract(name, "((?:19|20)\\d{2}(?:0[1-9]|1[0-2]))", 1), F.lit("")).try_cast("long")


FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd", "d/M/yyyy", "dd-MM-yyyy", "yyyyMMdd")


def parse_date(c: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """A date by the first format that fits; a bare year is its first day; years up to 1900 are null."""
    t = F.trim(c.cast("string"))
    year = F.when(t.rlike("^\\d{4}$"), F.try_to_date(F.concat(t, F.lit("-01-01")), "yyyy-MM-dd"))
    found = F.coalesce(year, *(F.try_to_date(t, f) for f in formats), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    return F.when(F.year(found) > 1900, found)


def registration_year(*candidates: Column) -> Column:
    """The first candidate that is a year from 1901 to 2100."""
    whole = [c.try_cast("int") for c in candidates]
    return F.coalesce(*(F.when(c.between(1901, 2100), c) for c in whole))


def padded_code(c: Column, width: int) -> Column:
    """A numeric code as text with leading zeros; null if it isn't one."""
    digits = F.regexp_replace(F.trim(c.cast("string")), "\\.0$", "")
    return F.when(digits.rlike(f"^\\d{{1,{width}}}$"), F.lpad(digits, width, "0"))


def age_in(as_of: int, year: Column) -> Column:
    """Age in years at an explicit year; null for a future year."""
    return F.when(year <= as_of, F.lit(as_of) - year)
