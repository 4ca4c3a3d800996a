"""Staged tables bucketed by user, so that repeated joins on the user read both sides without an exchange.

Usage lines and subscriptions are saved as tables of the session's catalog, bucketed and sorted by (``id_user``,
``salt``) with the same number of buckets. A join on both columns then needs no shuffle. ``salt`` splits a user's
lines over ``salts`` values (by a hash of the line), and each subscription is written once per salt, so a user
with a third of all lines fills ``salts`` buckets instead of one. Subscriptions grow ``salts`` times: they are few.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def save_bucketed(df: DataFrame, name: str, buckets: int, keys: list[str]) -> DataFrame:
    """``df`` saved as the table ``name``, bucketed and sorted by ``keys``; the table as read back."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def stage_for_user_joins(usage_rows: DataFrame, subscriptions: DataFrame, buckets: int, salts: int = SALTS,
                         prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Usage (without ``institution_name``) and subscriptions as bucketed tables, salted by line.

    Table names start with ``prefix`` (a fresh one if not given). Both keep their columns plus ``salt``.
    """
    prefix = prefix or f"staged_{uuid.uuid4().hex[:12]}"
    usage = usage_rows.drop("institution_name")
    salted = usage.withColumn("salt", F.pmod(F.xxhash64(*usage.columns), F.lit(salts)).cast("int"))
    copies = subscriptions.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = ["id_user", "salt"]
    return (save_bucketed(salted, f"{prefix}_usage", buckets, keys),
            save_bucketed(copies, f"{prefix}_subscription", buckets, keys))


def usage_subscription_bucketed(usage: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """``clean.usage_subscription`` over tables from ``stage_for_user_joins``: the join reads the buckets as they lie."""
    return usage.join(subscriptions, ["id_user", "salt"]).drop("salt")
