"""Counts of users, codes and subscribers per month, year, institution and source.

Groups with a missing key are left out throughout. ``usage_rows`` is ``clean.usage`` where codes are
summed; where only distinct users or values matter, ``clean.usage_lines`` gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.config import MONTHS
from tallyport.functions import labels
from tallyport.operators.joins import drop_null_keys


def sorted_nulls_last(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ascending sort by code point with missing values at the end.

    The other columns break ties. This makes the order definite, and lets the sort split rows of one
    key, such as a large institution's, over many tasks.
    """
    ties = [c for c in df.columns if c not in keys]
    return df.orderBy(*[F.asc_nulls_last(c) for c in (*keys, *ties)])


def _month_labels() -> list[Column]:
    """Labels that follow from year and month, added after grouping to keep the keys short."""
    return [
        labels.month_name("month").alias("month2"),
        F.make_date("year", "month", F.lit(1)).alias("date"),
        labels.short_month_label("year", "month").alias("month_name"),
    ]


# --- Usage metrics -----------------------------------------------------------------------------

def users_all_month(usage_rows: DataFrame) -> DataFrame:
    """Users per month over all institutions.

    Counts (institution, user name) pairs; a missing user name counts as one user of its institution.
    """
    pairs = usage_rows.select("institution_name", "user_name", "year", "month").dropDuplicates()
    counted = drop_null_keys(pairs, ["year", "month"]).groupBy("year", "month").count()
    return counted.select(
        "year", "month", labels.month_name("month").alias("month2"), F.col("count").alias("nb_users")
    )


def users_per_institution_month(usage_rows: DataFrame) -> DataFrame:
    """Users per institution and month, counted as in ``users_all_month``."""
    keys = ["institution_name", "year", "month"]
    pairs = usage_rows.select(*keys, "user_name").dropDuplicates()
    counted = drop_null_keys(pairs, keys).groupBy(*keys).count()
    return counted.select(
        *keys, labels.month_name("month").alias("month2"), F.col("count").alias("nb_users")
    )


def codes_per_institution_month(usage_rows: DataFrame) -> DataFrame:
    keys = ["institution_name", "year", "month"]
    summed = drop_null_keys(usage_rows, keys).groupBy(*keys).agg(F.sum("nb_codes").alias("nb_codes"))
    return summed.select(*keys, *_month_labels(), "nb_codes")


def codes_per_institution_database_year(usage_rows: DataFrame) -> DataFrame:
    """Codes per institution, class of source and year; unclassified sources have no group."""
    keys = ["institution_name", "database_name2", "year"]
    return drop_null_keys(usage_rows, keys).groupBy(*keys).agg(F.sum("nb_codes").alias("nb_codes"))


def positive_codes(metric: DataFrame) -> DataFrame:
    """Groups with a positive volume. Applied to sums, not to single requests."""
    return metric.where(F.col("nb_codes") > 0)


def slice_metric(metric: DataFrame, institution: str, years: Iterable[int]) -> DataFrame:
    """Rows of one institution, exactly as spelled, in the given years."""
    return metric.where(
        (F.col("institution_name") == F.lit(institution)) & F.col("year").isin([int(y) for y in years])
    )


def active_years(usage_rows: DataFrame) -> DataFrame:
    return usage_rows.select("year").where(F.col("year").isNotNull()).distinct()


def active_years_per_institution(usage_rows: DataFrame) -> DataFrame:
    return drop_null_keys(usage_rows.select("institution_name", "year"), ["institution_name", "year"]).distinct()


# --- Subscriber metrics ------------------------------------------------------------------------

def _count_subscriptions(subscriptions: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = drop_null_keys(subscriptions, keys).groupBy(*keys).count()
    return counted.withColumnRenamed("count", "nb_subscribers")


def subscribers_per_status(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions (not users) per institution and status."""
    return _count_subscriptions(subscriptions, ["labo_name", "statut"])


def subscribers_per_create_year(subscriptions: DataFrame) -> DataFrame:
    return _count_subscriptions(subscriptions, ["labo_name", "statut", "date_create_year"])


def subscribers_per_access_year(subscriptions: DataFrame) -> DataFrame:
    return _count_subscriptions(subscriptions, ["labo_name", "statut", "date_last_access_year"])


# --- Workbook metrics: usage joined to every subscription of its user ---------------------------
#
# A user with k subscriptions counts k times in the sums, one without counts once. Sums are taken
# per user first and multiplied by k afterwards, so log lines are never repeated by the join.

def _codes_per_user(usage_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return usage_rows.groupBy("id_user", *keys).agg(F.sum("nb_codes").alias("codes"))


def _sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).alias("sum_of_codes")


def _times_subscriptions(user_sums: DataFrame, subscriptions: DataFrame, keys: Sequence[str]) -> DataFrame:
    copies = subscriptions.groupBy("id_user").agg(F.count(F.lit(1)).alias("copies"))
    # few rows per user are left, so there are no hot keys
    joined = user_sums.join(copies, "id_user", "left")
    weighted = F.col("codes") * F.coalesce(F.col("copies"), F.lit(1))
    return joined.groupBy(*keys).agg(_sum_or_zero(weighted))


def unique_users_month(usage_rows: DataFrame) -> DataFrame:
    """Distinct user names per month, whatever the institution; missing names do not count."""
    grouped = drop_null_keys(usage_rows, ["year", "month"]).groupBy("year", "month")
    return grouped.agg(F.countDistinct("user_name").alias("nb_unique_users")).select(
        "year",
        labels.numbered_month_label("month").alias("month_full"),
        labels.month_name("month").alias("month2"),
        "nb_unique_users",
    )


def codes_month(usage_rows: DataFrame, subscriptions: DataFrame) -> DataFrame:
    keys = ["year", "month"]
    sums = _codes_per_user(drop_null_keys(usage_rows, keys), keys)
    return _times_subscriptions(sums, subscriptions, keys).select(
        "year",
        labels.numbered_month_label("month").alias("month_full"),
        labels.month_name("month").alias("month2"),
        "sum_of_codes",
    )


def user_monthly_codes(usage_rows: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Codes per user, status, source and month; users without a status have no group."""
    keys = ["database_name", "year", "month"]
    named = drop_null_keys(usage_rows, keys).withColumn(
        "user_full", labels.user_institution_label("user_name", "institution_name")
    )
    sums = _codes_per_user(named, ["user_full", *keys])
    per_status = (
        subscriptions.where(F.col("statut").isNotNull())
        .groupBy("id_user", "statut").agg(F.count(F.lit(1)).alias("copies"))
    )
    weighted = F.col("codes") * F.col("copies")
    joined = sums.join(per_status, "id_user")
    return joined.groupBy("user_full", "statut", *keys).agg(_sum_or_zero(weighted)).select(
        "user_full", "statut", "database_name", "year",
        labels.numbered_month_label("month").alias("month_full"),
        labels.month_name("month").alias("month2"),
        "sum_of_codes",
    )


def institution_monthly_codes(usage_rows: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Codes per institution, raw source name and month."""
    keys = ["institution_name", "database_name", "year", "month"]
    sums = _codes_per_user(drop_null_keys(usage_rows, keys), keys)
    return _times_subscriptions(sums, subscriptions, keys).select(
        "institution_name", "database_name", "year",
        labels.numbered_month_label("month").alias("month_full"),
        labels.month_name("month").alias("month2"),
        "sum_of_codes",
    )


def month_by_year_pivot(
    monthly: DataFrame, years: Sequence[int] | None = None, value: str = "sum_of_codes"
) -> DataFrame:
    """Twelve rows in calendar order, one column per year; a month without data is 0.

    ``monthly`` has year, month2 and ``value``. Without ``years``, the years present are looked up
    first, which runs one small job.
    """
    if years is None:
        found = active_years(monthly).orderBy("year").collect()
        years = [row["year"] for row in found]
    month = F.col("id").cast("int")
    calendar = monthly.sparkSession.range(1, len(MONTHS) + 1, numPartitions=1).select(
        month.alias("month"), labels.month_name(month).alias("month2")
    )
    pivoted = monthly.groupBy("month2").pivot("year", list(years)).agg(F.sum(value))
    # at most twelve rows on either side
    filled = calendar.join(F.broadcast(pivoted), "month2", "left")
    return filled.select("month", "month2", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(str(y)) for y in years])


# --- Lookups -----------------------------------------------------------------------------------

def databases_per_user(usage_rows: DataFrame) -> DataFrame:
    """Sorted classes of source each user has used. A set holds at most the classes of the rules."""
    classes = F.array_sort(F.collect_set("database_name2")).alias("databases")
    return usage_rows.where(F.col("id_user").isNotNull()).groupBy("id_user").agg(classes)


def user_profile_dates(usage_rows: DataFrame) -> DataFrame:
    """Sorted distinct creation and last-access dates per user, of usage joined to subscriptions.

    An account has one date of each kind, so the sets stay small.
    """
    dates = usage_rows.select("id_user", "date_created", "date_last_access").distinct()
    return dates.groupBy("id_user").agg(
        F.array_sort(F.collect_set("date_created")).alias("dates_created"),
        F.array_sort(F.collect_set("date_last_access")).alias("dates_last_access"),
    )


def _distinct_pairs(rows: DataFrame, key: Column, key_name: str, value: str) -> DataFrame:
    pairs = rows.select(key.alias(key_name), F.col(value))
    return drop_null_keys(pairs, [key_name, value]).distinct()


def users_per_database(usage_rows: DataFrame, name: Column) -> DataFrame:
    return _distinct_pairs(usage_rows, name, "database", "user_name")


def users_per_institution(usage_rows: DataFrame, name: Column) -> DataFrame:
    return _distinct_pairs(usage_rows, name, "institution", "user_name")


def databases_per_institution(usage_rows: DataFrame, name: Column) -> DataFrame:
    return _distinct_pairs(usage_rows, name, "institution", "database_name2")


def unknown_institutions(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested names that are not known, exactly as spelled.

    ``requested`` and ``known`` have a column ``institution_name``.
    """
    return requested.select("institution_name").distinct().join(
        known.select("institution_name").distinct(), "institution_name", "left_anti"
    )


def require_institutions(requested: DataFrame, known: DataFrame) -> None:
    """Raises ValueError naming the unknown institutions, which are at most those asked for."""
    missing = unknown_institutions(requested, known).orderBy("institution_name").collect()
    if missing:
        names = ", ".join(repr(row["institution_name"]) for row in missing)
        raise ValueError(f"unknown institutions: {names}; check spelling and capitals")


def years_without_data(requested: DataFrame, usage_rows: DataFrame) -> DataFrame:
    """Requested years in which no institution has any usage."""
    return requested.select("year").distinct().join(active_years(usage_rows), "year", "left_anti")
