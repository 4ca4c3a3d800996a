"""Monthly workbook: four published tables and the chart frames made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyport.config import WORKBOOK, Profile
from tallyport.operators import clean, metrics, reports
from tallyport.operators.clean import PortalTables
from tallyport.plans.institution_statistics import stage
from tallyport.sources.snapshots import publish_table, published_table

# Published tables and their columns.
TABLES = {
    "stats_number_of_unique_users": ("year", "month_full", "month2", "nb_unique_users"),
    "stats_sum_of_codes": ("year", "month_full", "month2", "sum_of_codes"),
    "user_monthly_sum_of_codes": (
        "user_full", "statut", "database_name", "year", "month_full", "month2", "sum_of_codes",
    ),
    "institution_monthly_sum_of_codes": (
        "institution_name", "database_name", "year", "month_full", "month2", "sum_of_codes",
    ),
}


def workbook_tables(usage: DataFrame, subscriptions: DataFrame) -> dict[str, DataFrame]:
    return {
        "stats_number_of_unique_users": metrics.unique_users_month(usage),
        "stats_sum_of_codes": metrics.codes_month(usage, subscriptions),
        "user_monthly_sum_of_codes": metrics.user_monthly_codes(usage, subscriptions),
        "institution_monthly_sum_of_codes": metrics.institution_monthly_codes(usage, subscriptions),
    }


def publish_workbook(tables: PortalTables, out: str, profile: Profile = WORKBOOK) -> None:
    """Refreshes the four tables below ``out``, each sorted by name, year and month."""
    out = out.rstrip("/")
    usage = stage(clean.usage(tables, profile), f"{out}/staging/usage", "year")
    subscriptions = stage(clean.subscription(tables, profile), f"{out}/staging/subscription")
    for name, frame in workbook_tables(usage, subscriptions).items():
        owner = [c for c in TABLES[name] if c in ("user_full", "institution_name")]
        ordered = metrics.sorted_nulls_last(frame, [*owner, "year", "month_full", "month2"])
        publish_table(ordered, TABLES[name], f"{out}/{name}")


def workbook_charts(
    spark: SparkSession, out: str, years: Sequence[int] | None = None
) -> dict[str, DataFrame]:
    """Chart frames of the published tables."""
    read = {name: published_table(spark, f"{out.rstrip('/')}/{name}") for name in TABLES}
    activity = reports.institution_activity(read["institution_monthly_sum_of_codes"])
    return {
        "total_codes_by_month": metrics.month_by_year_pivot(read["stats_sum_of_codes"], years).orderBy("month"),
        "unique_users_by_month": reports.calendar_order(
            reports.unique_users_periods(read["stats_number_of_unique_users"])
        ),
        "institution_codes": reports.institution_activity_order(activity),
    }
