"""From the portal's tables to the cleaned usage and subscription relations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.config import Profile
from tallyport.functions import dates, labels
from tallyport.operators.joins import lookup_join


@dataclass(frozen=True)
class PortalTables:
    """The portal's relations.

    usage_log            user_id, user_name, institution_id, group_name, source_name,
                         request_type, n_codes, requested_at
    institution          institution_id, institution_name
    account              user_id, created_s, access_s (epoch seconds)
    account_institution  user_id, institution_id
    account_status       user_id, status

    Role rows only repeat subscriptions, which are distinct, so no relation for them is read.
    """

    usage_log: DataFrame
    institution: DataFrame
    account: DataFrame
    account_institution: DataFrame
    account_status: DataFrame


def _within_years(log: DataFrame, profile: Profile) -> Column | None:
    """Year filter written on the raw timestamp, so that it reaches the scan."""
    stamp = F.col("requested_at")

    def starts(year: int) -> Column:
        return F.lit(f"{year:04d}-01-01 00:00:00").cast(log.schema["requested_at"].dataType)

    if profile.years is not None:
        years = sorted({int(y) for y in profile.years})
        if not years:
            return F.lit(False)
        span = (stamp >= starts(years[0])) & (stamp < starts(years[-1] + 1))
        gaps = len(years) != years[-1] - years[0] + 1
        return span & F.year(stamp).isin(years) if gaps else span
    if profile.first_year is not None:
        return stamp >= starts(profile.first_year)
    return None


def _not_in(column: str, values: tuple) -> Column:
    """SQL ``NOT IN``: a NULL on the left drops the row as well."""
    return ~F.col(column).isin(list(values)) if values else F.lit(True)


def _reportable_log(tables: PortalTables, profile: Profile) -> DataFrame:
    log = tables.usage_log.where(
        _not_in("group_name", profile.excluded_groups) & _not_in("user_id", profile.excluded_users)
    )
    if profile.require_institution:
        log = log.where(F.col("group_name").isNotNull())
    in_years = _within_years(log, profile)
    return log if in_years is None else log.where(in_years)


def _with_institution(log: DataFrame, tables: PortalTables, profile: Profile) -> DataFrame:
    names = tables.institution.select("institution_id", "institution_name").distinct()
    if profile.institution is not None:
        names = names.where(F.col("institution_name") == F.lit(profile.institution))
    elif profile.require_institution:
        names = names.where(F.col("institution_name").isNotNull())
    inner = profile.require_institution or profile.institution is not None
    how = "inner" if inner else "left"
    return lookup_join(log, names, "institution_id", how, keys=tables.usage_log)


_RAW = ("user_id", "user_name", "institution_id", "source_name", "request_type", "n_codes", "requested_at")


def _describe(rows: DataFrame) -> DataFrame:
    year, month = F.year("requested_at"), F.month("requested_at")
    rows = rows.select(
        F.col("user_id").alias("id_user"),
        "user_name",
        F.col("institution_id").alias("id_labo"),
        "institution_name",
        year.alias("year"),
        month.alias("month"),
        F.col("source_name").alias("database_name"),
        F.col("request_type").alias("type_interrogation"),
        F.col("n_codes").cast("int").alias("nb_codes"),
        F.col("requested_at").alias("date_heure_extraction"),
    )
    return rows.select(
        "*",
        labels.month_name("month").alias("month2"),
        labels.request_label("type_interrogation").alias("type_interrogation2"),
        labels.source_class("database_name").alias("database_name2"),
        labels.search_or_extract("database_name").alias("code_ou_data"),
    )


def usage(tables: PortalTables, profile: Profile) -> DataFrame:
    """Cleaned log: reportable requests with institution, class and month columns, each line once.

    Duplicates are removed on the seven raw columns before the join. All other columns follow from
    these, so the result is the same and less is shuffled.
    """
    lines = _reportable_log(tables, profile).select(*_RAW).distinct()
    return _describe(_with_institution(lines, tables, profile))


def usage_lines(tables: PortalTables, profile: Profile) -> DataFrame:
    """As ``usage`` with repeated lines left in.

    For metrics that count distinct users or list distinct values: repeats do not change them, and
    the shuffle of whole lines is saved.
    """
    lines = _reportable_log(tables, profile).select(*_RAW)
    return _describe(_with_institution(lines, tables, profile))


def with_month_keys(usage_rows: DataFrame) -> DataFrame:
    """Adds ``yearmonth``, ``date`` (first of month) and ``month_name``."""
    return usage_rows.select(
        "*",
        labels.year_month_key("year", "month").alias("yearmonth"),
        F.make_date("year", "month", F.lit(1)).alias("date"),
        labels.short_month_label("year", "month").alias("month_name"),
    )


def subscription(tables: PortalTables, profile: Profile) -> DataFrame:
    """One row per user, institution and status, with creation and last-access dates.

    Users need an account and a named institution; the status may be missing.
    """
    accounts = tables.account.where(_not_in("user_id", profile.excluded_subscribers)).select(
        "user_id",
        dates.epoch_date("created_s").alias("date_created"),
        dates.epoch_date("access_s").alias("date_last_access"),
    )
    names = tables.institution.where(
        F.col("institution_name").isNotNull()
        & _not_in("institution_name", profile.excluded_subscriber_institutions)
    ).select("institution_id", "institution_name")
    memberships = tables.account_institution.select("user_id", "institution_id")
    statuses = tables.account_status.select("user_id", "status")

    rows = lookup_join(memberships, names, "institution_id", keys=memberships)
    # a user has few memberships, one account and few statuses, so there are no hot keys
    rows = rows.join(accounts, "user_id").join(statuses, "user_id", "left")
    return rows.select(
        F.col("user_id").alias("id_user"),
        F.col("institution_name").alias("labo_name"),
        "date_created",
        "date_last_access",
        F.col("status").alias("statut"),
        F.year("date_created").alias("date_create_year"),
        F.year("date_last_access").alias("date_last_access_year"),
    ).distinct()


def usage_subscription(
    usage_rows: DataFrame, subscriptions: DataFrame, keys: DataFrame | None = None
) -> DataFrame:
    """Usage lines of subscribed users, once per subscription of the user.

    Both inputs are distinct, so the pairs are, and no further duplicate removal is needed. ``keys``
    is a cheap source of the log's ``id_user``, as in ``lookup_join``.
    """
    return lookup_join(usage_rows.drop("institution_name"), subscriptions, "id_user", keys=keys)
