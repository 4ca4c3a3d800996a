"""Distinct users as mergeable bitmaps: numbered once, marked per month, OR-ed into years and all time.

Counting distinct users per month, per year and over all time by ``count(DISTINCT ...)`` shuffles the log once for
each level. Here each distinct user (the values of the user columns) gets a dense number once; the log is grouped
once into one bitmap of user numbers per (group, year, month, bucket of 32,768 numbers), and years and all time are
OR-merges of those bitmaps, which are few and small. A count is the sum of the set bits over the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.operators.joins import drop_null_keys, fits_broadcast
from tallyport.operators.paging import numbered_rows
from tallyport.session import cut_lineage

LEVELS = ("month", "year", "all")


def numbered_users(usage_rows: DataFrame, user: Sequence[str]) -> DataFrame:
    """Each distinct value of the ``user`` columns (a missing value is a value) with ``user_no`` from 1, dense.

    Numbers come from ``numbered_rows`` over ranges, so no task numbers all users; the result is written.
    """
    distinct = usage_rows.select(*user).distinct()
    return cut_lineage(numbered_rows(distinct, [], list(user)).select(*user, F.col("row_no").alias("user_no")))


def monthly_bitmaps(usage_rows: DataFrame, by: Sequence[str], user: Sequence[str]) -> DataFrame:
    """(``by``..., year, month, bucket, users): the users of each group and month as bitmaps, by one grouping.

    Rows without year or month are left out; rows whose ``by`` keys are missing are kept (levels drop them).
    The numbers are broadcast when their estimated size allows, else joined by a shuffle.
    """
    rows = drop_null_keys(usage_rows.select(*by, *user, "year", "month"), ["year", "month"])
    numbers = numbered_users(rows, user)
    same = None
    for c in user:
        test = rows[c].eqNullSafe(numbers[c])
        same = test if same is None else same & test
    joined = rows.join(F.broadcast(numbers) if fits_broadcast(numbers) else numbers, same).select(
        *[rows[c] for c in by], rows["year"], rows["month"], numbers["user_no"])
    return joined.groupBy(*by, "year", "month", F.bitmap_bucket_number("user_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"))


def user_counts(bitmaps: DataFrame, by: Sequence[str], level: str) -> DataFrame:
    """Distinct users per (``by``..., year, month), per (``by``..., year) or per ``by`` (``level``: month, year, all).

    Groups with a missing ``by`` key are not reported. Buckets hold different users, so their counts add up.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, not {level!r}")
    keys = {"month": [*by, "year", "month"], "year": [*by, "year"], "all": list(by)}[level]
    present = drop_null_keys(bitmaps, list(by))
    merged = present if level == "month" else present.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("users")).alias("nb_users"))


def user_rollup(usage_rows: DataFrame, by: Sequence[str] = ("institution_name",),
                user: Sequence[str] = ("institution_name", "user_name")) -> DataFrame:
    """Users per month, year and all time in one table: (level, ``by``..., year, month, nb_users).

    Year is NULL on the level ``all``, month on ``year`` and ``all``. The log is grouped once; the bitmaps are staged.
    """
    bitmaps = cut_lineage(monthly_bitmaps(usage_rows, by, user))
    parts = []
    for level in LEVELS:
        counted = user_counts(bitmaps, by, level)
        for missing in ("year", "month"):
            if missing not in counted.columns:
                counted = counted.withColumn(missing, F.lit(None).cast(bitmaps.schema[missing].dataType))
        parts.append(counted.select(F.lit(level).alias("level"), *by, "year", "month", "nb_users"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
