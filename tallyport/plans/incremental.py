"""Metrics kept up to date by year: only years whose input files changed are computed again.

The input is a table partitioned by ``year`` (as ``institution_statistics`` stages the clean log). A refresh lists the
input's files (names, sizes, times; no row is read), compares them per year with the list kept by the last refresh,
reads the changed years only (a filter on the partition column, so other years' files are not opened), and overwrites
just their partitions of the result (dynamic partition overwrite). Years whose files are gone lose their partition.
A metric fit for this depends on the rows of one year at a time, as every monthly and yearly metric here does.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.sources import files

MANIFEST = "_inputs"
_YEAR = re.compile(r"/year=([^/]+)/")


def input_years(spark: SparkSession, path: str) -> dict[str, set[tuple[str, int, int]]]:
    """The files of each year partition under ``path``, by the year as written in the folder name."""
    years: dict[str, set[tuple[str, int, int]]] = defaultdict(set)
    for name, size, time in files.leaf_files(spark, path):
        found = _YEAR.search(name)
        if found:
            years[found.group(1)].add((name, size, time))
    return years


def _kept(spark: SparkSession, out: str) -> dict[str, set[tuple[str, int, int]]]:
    manifest = f"{out.rstrip('/')}/{MANIFEST}"
    years: dict[str, set[tuple[str, int, int]]] = defaultdict(set)
    if files.has_rows_written(spark, manifest):
        for row in spark.read.parquet(manifest).collect():  # one row per input file
            years[row["year"]].add((row["file"], row["size"], row["time"]))
    return years


def refresh_by_year(spark: SparkSession, source: str, metric: Callable[[DataFrame], DataFrame], out: str) -> list[str]:
    """Computes ``metric`` again for the years of ``source`` whose files changed; returns them, as written in folder names.

    The first refresh computes every year. ``out`` is partitioned by ``year`` and holds the list of input files in
    ``_inputs``, which Spark's readers pass over.
    """
    out = out.rstrip("/")
    now, before = input_years(spark, source), _kept(spark, out)
    changed = sorted(y for y in now if now[y] != before.get(y))
    gone = sorted(y for y in before if y not in now)
    if changed:
        rows = spark.read.parquet(source)
        wanted = F.col("year").cast("string").isin([y for y in changed if y != "__HIVE_DEFAULT_PARTITION__"])
        if "__HIVE_DEFAULT_PARTITION__" in changed:
            wanted = wanted | F.col("year").isNull()
        result = metric(rows.where(wanted))
        (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year").parquet(out))
    for year in gone:
        files.delete(spark, f"{out}/year={year}")
    listed = [(y, name, size, time) for y, found in sorted(now.items()) for name, size, time in sorted(found)]
    manifest = spark.createDataFrame(listed, "year string, file string, size long, time long")
    manifest.write.mode("overwrite").parquet(f"{out}/{MANIFEST}")
    return changed + gone


def read_by_year(spark: SparkSession, out: str, like: DataFrame) -> DataFrame:
    """The kept result with the columns, their order and types of ``like`` (the metric on any input)."""
    kept = spark.read.parquet(out)
    return kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])
