"""Column expressions that turn codes, names and months into labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyport.config import (
    CONTINENTS,
    EXTRACT_LABEL,
    INSTRUMENT_CODES,
    MONTHS,
    PRICE_TABLES,
    REQUEST_LABELS,
    SEARCH_LABEL,
    SEARCH_PATTERN,
    SOURCE_RULES,
    UNKNOWN_INSTITUTION,
    UNKNOWN_USER,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_match(cases: Iterable[tuple[Column, Column]]) -> Column:
    """CASE WHEN over (condition, value) pairs, NULL when none holds."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain


def month_name(month: Column | str) -> Column:
    """English month name of a month number, whatever the locale."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), _col(month))


def request_label(code: Column | str) -> Column:
    code = _col(code)
    return _first_match((code == k, F.lit(v)) for k, v in REQUEST_LABELS.items())


def source_class(name: Column | str, rules: Iterable[tuple[str, str]] = SOURCE_RULES) -> Column:
    """Class of a raw source name. Labels are literals, so a backslash in one stays as it is."""
    name = _col(name)
    return _first_match((name.like(pattern), F.lit(label)) for pattern, label in rules)


def search_or_extract(name: Column | str) -> Column:
    return F.when(_col(name).like(SEARCH_PATTERN), F.lit(SEARCH_LABEL)).otherwise(F.lit(EXTRACT_LABEL))


def year_month_key(year: Column | str, month: Column | str) -> Column:
    """``YYYYMM``"""
    return F.concat(_col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def first_of_month(year_month: Column | str) -> Column:
    """``YYYYMM`` -> first day of that month"""
    return F.to_date(_col(year_month), "yyyyMM")


def short_month_label(year: Column | str, month: Column | str) -> Column:
    """``Jan23``"""
    two_digits = F.lpad((_col(year) % 100).cast("string"), 2, "0")
    return F.concat(F.substring(month_name(month), 1, 3), two_digits)


def numbered_month_label(month: Column | str) -> Column:
    """``01 - January``"""
    return F.concat(F.lpad(_col(month).cast("string"), 2, "0"), F.lit(" - "), month_name(month))


def period_label(year: Column | str, month_label: Column | str) -> Column:
    """``2023-January``"""
    return F.concat(_col(year).cast("string"), F.lit("-"), _col(month_label))


def month_institution_label(month_label: Column | str, institution: Column | str) -> Column:
    """``January - Institution``; NULL when either is."""
    return F.concat(_col(month_label), F.lit(" - "), _col(institution))


def user_institution_label(user: Column | str, institution: Column | str) -> Column:
    """``user - institution`` with stand-ins for what is missing"""
    return F.concat(
        F.coalesce(_col(user), F.lit(UNKNOWN_USER)),
        F.lit(" - "),
        F.coalesce(_col(institution), F.lit(UNKNOWN_INSTITUTION)),
    )


def continent_of(country: Column | str) -> Column:
    """Continent code of a country, NULL for a country on no list."""
    country = _col(country)
    return _first_match((country.isin(*names), F.lit(code)) for code, names in CONTINENTS.items())


def instrument_code(instrument: Column | str) -> Column:
    instrument = _col(instrument)
    return _first_match((instrument == k, F.lit(v)) for k, v in INSTRUMENT_CODES.items())


def price_table(instrument: Column | str) -> Column:
    instrument = _col(instrument)
    return _first_match((instrument == k, F.lit(v)) for k, v in PRICE_TABLES.items())
