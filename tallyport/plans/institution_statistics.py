"""Statistics per institution: raw tables, metrics, chart frames and report pages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.config import PORTAL, Profile
from tallyport.operators import clean, metrics, reports
from tallyport.operators.clean import PortalTables
from tallyport.operators.search import distinct_names
from tallyport.plans.selection import check_selection, selected
from tallyport.sources.csv import read_pipe_folder, read_pipe_folder_quarantined, write_pipe_csv
from tallyport.sources.snapshots import write_per_institution

# The names of the result files.
SUBSCRIPTIONS = "raw_data_stats_daily_subscription.csv"
USAGE = "raw_data_stats_daily_users.csv"
USERS = "stats_all_users_with_subscription_informations.csv"
PER_STATUS = "stats_number_of_subscribers_per_labo_and_status.csv"
PER_CREATE_YEAR = "stats_number_of_subscribers_per_status_and_year_creation.csv"
PER_ACCESS_YEAR = "stats_number_of_subscribers_per_status_and_year_last_access.csv"


@dataclass(frozen=True)
class UsageMetrics:
    """The four metrics of a cleaned log."""

    all: DataFrame
    laboratory: DataFrame
    user: DataFrame
    database: DataFrame


def usage_metrics(usage_rows: DataFrame) -> UsageMetrics:
    return UsageMetrics(
        all=metrics.users_all_month(usage_rows),
        laboratory=metrics.codes_per_institution_month(usage_rows),
        user=metrics.users_per_institution_month(usage_rows),
        database=metrics.codes_per_institution_database_year(usage_rows),
    )


def stage(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    """Written once and read by every later step, so a shared step is not computed again."""
    rebalanced = df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")
    rebalanced.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def institution_statistics(
    tables: PortalTables,
    out: str,
    profile: Profile = PORTAL,
    institutions: Sequence[str] | None = None,
    strict: bool = False,
    positive_only: bool = True,
) -> UsageMetrics:
    """Writes all tables, chart frames and pages below ``out``; returns the metrics.

    The log is cleaned once, for all institutions unless ``profile`` names one, and staged by year. ``institutions`` selects
    whose charts and pages are written. With ``strict``, unknown institutions and missing years are
    errors instead of empty reports. ``positive_only`` is that of ``bar_chart_frames``.
    """
    out = out.rstrip("/")
    usage = stage(clean.usage(tables, profile), f"{out}/staging/usage", "year")
    subscriptions = stage(clean.subscription(tables, profile), f"{out}/staging/subscription")
    if strict:
        known = subscriptions.withColumnRenamed("labo_name", "institution_name")
        check_selection(usage, known, institutions, profile.years)

    def write_sorted(df: DataFrame, path: str, keys: Sequence[str]) -> None:
        write_pipe_csv(metrics.sorted_nulls_last(df, keys), path)

    write_sorted(subscriptions, f"{out}/{SUBSCRIPTIONS}", ["labo_name", "id_user"])
    write_sorted(clean.with_month_keys(usage), f"{out}/{USAGE}", ["institution_name", "year", "month"])
    pages_input = f"{out}/input_csv"
    schemas = {}
    for frame, name, keys in (
        (clean.usage_subscription(usage, subscriptions, keys=usage), USERS, ["labo_name", "id_user"]),
        (metrics.subscribers_per_status(subscriptions), PER_STATUS, ["labo_name", "statut"]),
        (metrics.subscribers_per_create_year(subscriptions), PER_CREATE_YEAR,
         ["labo_name", "date_create_year", "statut"]),
        (metrics.subscribers_per_access_year(subscriptions), PER_ACCESS_YEAR,
         ["labo_name", "date_last_access_year", "statut"]),
    ):
        write_sorted(frame, f"{pages_input}/{name}", keys)
        schemas[name] = frame.schema

    found = usage_metrics(usage)
    reports.users_line_chart(found.all).write.mode("overwrite").parquet(f"{out}/charts/users_per_month")
    bars = reports.bar_chart_frames(*[
        selected(frame, institutions, profile.years)
        for frame in (found.laboratory, found.user, found.database)
    ], positive_only)
    write_per_institution(bars, f"{out}/charts/bars")

    names = metrics.positive_codes(found.laboratory).select("institution_name").distinct()
    read = read_pipe_folder_quarantined(usage.sparkSession, pages_input, schemas)
    read.bad_rows.write.mode("overwrite").parquet(f"{out}/quarantine/rows")
    read.bad_files.write.mode("overwrite").parquet(f"{out}/quarantine/files")
    if read.tables:
        pages = reports.report_pages(reports.report_blocks(read.tables, selected(names, institutions, None)))
        write_per_institution(pages, f"{out}/pages", "institution")
    return found


def folder_report(
    spark: SparkSession, folder: str, usage_log: DataFrame, institution: str | None = None
) -> DataFrame:
    """Report pages of a folder of ``|``-delimited files for every group name in the log.

    ``institution`` asks for one institution instead, whether the log has it or not.
    """
    if institution is None:
        names = distinct_names(usage_log, "group_name")
    else:
        names = spark.range(1).select(F.lit(institution).alias("institution_name"))
    return reports.report_pages(reports.report_blocks(read_pipe_folder(spark, folder), names))


def folder_report_quarantined(
    spark: SparkSession, folder: str, usage_log: DataFrame, institution: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``folder_report`` that goes on past bad files and rows: (pages, bad rows, bad files).

    Bad rows are (file, line, reason), bad files (file, reason); see ``read_pipe_folder_quarantined``. A folder whose
    every file is bad gives no pages.
    """
    if institution is None:
        names = distinct_names(usage_log, "group_name")
    else:
        names = spark.range(1).select(F.lit(institution).alias("institution_name"))
    read = read_pipe_folder_quarantined(spark, folder)
    if not read.tables:
        empty = spark.createDataFrame([], "institution string, file string, page int, pages int, title string, columns string, lines array<string>")
        return empty, read.bad_rows, read.bad_files
    return reports.report_pages(reports.report_blocks(read.tables, names)), read.bad_rows, read.bad_files
