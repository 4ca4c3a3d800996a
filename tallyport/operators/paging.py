"""Row numbers and pages inside blocks of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyport.session import cut_lineage


def numbered_rows(df: DataFrame, block: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``row_no`` (from 1, in ``order`` inside each block, missing values last) and ``block_rows``.

    A window over the block would put a whole block into one task. Instead the rows are
    range-partitioned by block and order, which cuts a large block into several ranges. Rows are
    numbered inside each range and moved up by the sizes of the block's earlier ranges. The ranges
    are written down first, so that a lost executor cannot change them.
    """
    ranged = df.repartitionByRange(*[F.asc_nulls_last(c) for c in (*block, *order)]).withColumn(
        "__range", F.spark_partition_id()
    )
    ranged = cut_lineage(ranged)

    # one row per range and block: few, however many rows the blocks have
    sizes = ranged.groupBy(*block, "__range").agg(F.count(F.lit(1)).alias("__size"))
    of_block = Window.partitionBy(*block)
    offsets = sizes.select(
        *[F.col(c).alias(f"__{c}") for c in block], F.col("__range").alias("__of_range"),
        (F.sum("__size").over(of_block.orderBy("__range")) - F.col("__size")).alias("__before"),
        F.sum("__size").over(of_block).alias("block_rows"),
    )
    in_range = Window.partitionBy(*block, "__range").orderBy(*[F.asc_nulls_last(c) for c in order])
    numbered = ranged.withColumn("__in_range", F.row_number().over(in_range))
    # a missing block key is a block like any other
    same = F.col("__range") == F.col("__of_range")
    for c in block:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return numbered.join(offsets, same).select(
        *df.columns,
        (F.col("__before") + F.col("__in_range")).alias("row_no"),
        "block_rows",
    )


def paged_rows(
    df: DataFrame, block: Sequence[str], order: Sequence[str], page_size: int = 10
) -> DataFrame:
    """Adds ``page`` and ``pages`` (both from 1) to ``numbered_rows``."""
    numbered = numbered_rows(df, block, order)
    return numbered.select(
        "*",
        F.ceil(F.col("row_no") / page_size).cast("int").alias("page"),
        F.ceil(F.col("block_rows") / page_size).cast("int").alias("pages"),
    )
