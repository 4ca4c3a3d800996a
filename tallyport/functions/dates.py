"""Column expressions for dates and chart axes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_date(seconds: Column | str) -> Column:
    """UTC date of epoch seconds, whatever the session time zone."""
    days = F.floor(_col(seconds) / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def date_and_year(date: Column | str) -> tuple[Column, Column]:
    """Date of a ``YYYY-MM-DD`` text or date, and its year"""
    as_date = _col(date).cast("date")
    return as_date, F.year(as_date)


def relative_bounds(as_of: Column | str | dt.date) -> dict[str, Column]:
    """Start days of the 15- and 365-day windows that end at ``as_of``, and the year of the latter."""
    end = F.lit(as_of) if isinstance(as_of, dt.date) else _col(as_of)
    month_start = F.date_sub(end, 365)
    return {
        "date_start": F.date_sub(end, 15),
        "date_end": end,
        "month_start": month_start,
        "previous_year": F.year(month_start).cast("string"),
        "current_year": F.year(end).cast("string"),
    }


def axis_step(n: Column | str) -> Column:
    """Distance of axis ticks: 10 below 100, else the power of ten with as many digits as ``n``."""
    n = _col(n).cast("bigint")
    zeros = F.length(n.cast("string")) - 1
    power = F.rpad(F.lit("1"), zeros + 1, F.lit("0")).cast("bigint")
    return F.when(n < 100, F.lit(10).cast("bigint")).otherwise(power)


def axis_limit(top: Column | str) -> Column:
    """Upper end of an axis whose highest bar is ``top``."""
    top = _col(top).cast("double")
    return (
        F.when(top <= 100, top + 10)
        .when(top <= 50000, top + top * 0.5)
        .otherwise(top + top * 0.35)
    )
