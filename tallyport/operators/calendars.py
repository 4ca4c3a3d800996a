"""Calendars generated by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar(bounds: DataFrame, step: str = "1 day", business_days: bool = True) -> DataFrame:
    """``date_cotation`` from ``start`` to ``end`` of each row of ``bounds``, both included.

    ``business_days`` keeps Monday to Friday; there are no holidays.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col("start"), F.col("end"), F.expr(f"interval {step}"))).alias("date_cotation")
    )
    # Sunday is 1 and Saturday 7
    return days.where(F.dayofweek("date_cotation").between(2, 6)) if business_days else days
