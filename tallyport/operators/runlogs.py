"""Digests of run logs. A log has ``log_file``, ``line`` and ``position``, which sorts its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What marks an error, and where the text after the time stamp begins.
ERROR_WORDS = "ERREUR|ERROR"
ERROR_DETAIL = "(?m)ERROR:.*"
MESSAGE_START = 28


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text logs below ``path``; ``log_file`` is the file name unless a folder names it."""
    lines = spark.read.text(path)
    name = F.col("log_file") if "log_file" in lines.columns else F.col("_metadata.file_name")
    return lines.select(
        name.alias("log_file"),
        F.col("value").alias("line"),
        # a file is read in blocks; ids rise inside a block
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
        ).alias("position"),
    )


def error_digest(logs: DataFrame) -> DataFrame:
    """Distinct error lines of each log without their time stamp."""
    errors = logs.where(F.col("line").rlike(ERROR_WORDS))
    return errors.select(
        "log_file", F.substring("line", MESSAGE_START, 2**31 - 1).alias("error")
    ).distinct()


def log_status(logs: DataFrame) -> DataFrame:
    """ERROR with the first error text, or SUCCESS, per log.

    The first error is looked for among error lines only: a minimum of text is found by sorting, and
    whole logs need not be sorted for it.
    """
    detail = F.regexp_extract("line", ERROR_DETAIL, 0)
    errors = logs.where(detail != "").groupBy("log_file").agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.min(F.struct("position", detail.alias("detail"))).getField("detail").alias("first"),
    )
    summary = logs.select("log_file").distinct().join(errors, "log_file", "left")
    failed = F.col("n_errors").isNotNull()
    return summary.select(
        "log_file",
        F.when(failed, F.lit("ERROR")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        F.coalesce("first", F.concat(F.lit("SUCCESS - "), F.col("log_file"))).alias("details"),
    )


def log_tail(logs: DataFrame, n: int = 20) -> DataFrame:
    """Last ``n`` lines of each log, numbered in file order, with ``shown`` and ``total``.

    The rank filter is applied before the shuffle as well, so a task receives at most ``n`` lines
    per log from each of the tasks before it; line counts are summed separately.
    """
    if n < 1:
        raise ValueError("n must be positive")
    from_end = F.row_number().over(Window.partitionBy("log_file").orderBy(F.desc("position")))
    last = logs.withColumn("__from_end", from_end).where(F.col("__from_end") <= n)
    totals = logs.groupBy("log_file").agg(F.count(F.lit(1)).alias("total"))
    shown = F.least(F.col("total"), F.lit(n).cast("bigint"))
    return last.join(totals, "log_file").select(
        "log_file",
        (F.col("total") - F.col("__from_end") + 1).alias("line_no"),
        "line",
        shown.alias("shown"),
        "total",
    )


def last_lines(logs: DataFrame, n: int = 20) -> DataFrame:
    """Last ``n`` lines over all logs given."""
    return logs.orderBy(F.desc("position")).limit(n).orderBy("position").select("log_file", "line")
