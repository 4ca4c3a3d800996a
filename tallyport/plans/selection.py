"""Which years and institutions a run covers."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.operators import metrics


def parse_years(argument: str | None) -> tuple[int, ...] | None:
    """``"2021"`` or ``"2021,2022"`` -> years; nothing given -> None"""
    if not argument:
        return None
    try:
        return tuple(int(part) for part in argument.split(","))
    except ValueError:
        raise ValueError(f"years are whole numbers with commas between them, got {argument!r}") from None


def parse_institutions(argument: str | None) -> tuple[str, ...] | None:
    """``"A"`` or ``"A;B"`` -> names; nothing given -> None"""
    return tuple(argument.split(";")) if argument else None


def selected(
    metric: DataFrame, institutions: Sequence[str] | None, years: Sequence[int] | None
) -> DataFrame:
    """Rows of the chosen institutions and years; None keeps all."""
    if institutions is not None:
        metric = metric.where(F.col("institution_name").isin(list(institutions)))
    if years is not None:
        metric = metric.where(F.col("year").isin(list(years)))
    return metric


def check_selection(
    usage_rows: DataFrame,
    subscribed_names: DataFrame,
    institutions: Sequence[str] | None,
    years: Sequence[int] | None,
) -> None:
    """Raises for an unknown institution, or for years without data when several are asked for.

    A single year without data only gives a warning, and its report is empty.
    """
    spark = usage_rows.sparkSession
    if institutions:
        requested = spark.createDataFrame([(n,) for n in institutions], "institution_name string")
        metrics.require_institutions(requested, subscribed_names)
    if years:
        requested = spark.createDataFrame([(y,) for y in years], "year int")
        missing = sorted(r["year"] for r in metrics.years_without_data(requested, usage_rows).collect())
        if missing and len(years) > 1:
            raise ValueError(f"no activity in the years {missing}")
        if missing:
            warnings.warn(f"no activity in the year {missing[0]}", stacklevel=2)
