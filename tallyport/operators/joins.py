"""Joins of a large table with a table that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a side is broadcast only when the optimizer's size estimate is at most this
BROADCAST_BYTES = 32 * 1024 * 1024

#: keys holding more than this share of the large side are spread over many tasks; less with more partitions
HOT_SHARE = 0.001

_SALT = "__salt"
_HOT = "__hot"


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, from file sizes and plan shape; no job is run."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    size = plan.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    keys: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``fact`` with ``lookup`` on one key; ``how`` is inner or left.

    A lookup estimated within ``limit`` is broadcast, so ``fact`` is not shuffled and no key can be
    hot. Beyond it, hot keys are salted if ``keys``, a cheap source of the fact's keys such as the
    raw table, is given to find them in. Without it the join is left to adaptive execution, which
    knows the true sizes at run time: it still broadcasts what turns out small and splits skewed
    partitions.
    """
    if fits_broadcast(lookup, limit):
        return fact.join(F.broadcast(lookup), on, how)
    if keys is not None:
        return salted_join(fact, lookup, on, how, keys)
    return fact.join(lookup, on, how)


def hot_share(partitions: int) -> float:
    """A quarter of an even partition's share, within the precision of the summary (a ten-thousandth)."""
    return max(1.01e-4, min(HOT_SHARE, 1 / (4 * partitions)))


def hot_keys(keys: DataFrame, on: str, share: float = HOT_SHARE) -> DataFrame:
    """Every key above ``share`` of the rows, perhaps with others, at most ``1 / share`` in all.

    One pass with a frequent-items summary per task; no row is shuffled.
    """
    found = keys.select(on).where(F.col(on).isNotNull()).stat.freqItems([on], share)
    return found.select(F.explode(F.col(f"{on}_freqItems")).alias(on), F.lit(True).alias(_HOT))


def salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    keys: DataFrame | None = None,
    salts: int | None = None,
    share: float | None = None,
) -> DataFrame:
    """Shuffled join in which hot keys of ``fact`` do not end up in one task.

    Fact rows of a hot key get a salt from the row's hash (the same on a retry), lookup rows of a
    hot key are repeated once per salt, and all other rows are joined as they are. The hot keys are
    broadcast: there are at most ``1 / share`` of them.
    """
    spark = fact.sparkSession
    salts = salts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(fact if keys is None else keys, on, share or hot_share(salts))
    row_salt = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts)).cast("int")
    # NULL keys match nothing, so a left join may spread them freely
    spread = F.when(F.col(_HOT) | F.col(on).isNull(), row_salt).otherwise(F.lit(0))
    left = fact.join(F.broadcast(hot), on, "left").withColumn(_SALT, spread).drop(_HOT)
    copies = F.when(F.col(_HOT), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.join(F.broadcast(hot), on, "left").withColumn(_SALT, F.explode(copies)).drop(_HOT)
    return left.join(right, [on, _SALT], how).drop(_SALT)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present; groups with a missing key are not reported."""
    return df.dropna(subset=list(keys))
