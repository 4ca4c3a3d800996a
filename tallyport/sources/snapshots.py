"""Saved extracts, dated snapshots and published tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.functions.text import folder_slug
from tallyport.sources import files
from tallyport.sources.csv import read_delimited, write_csv

# How the dates in snapshot names look.
FOLDER_DATE = r"(\d{4}-\d{2}-\d{2})$"
FILE_DATE = r"(\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2})"
# Names of the versions of a published table and of the markers that claim their numbers.
VERSION = "v-{:09d}"
VERSION_NAME = re.compile(r"v-(\d{9})")
CLAIM = "_claim-{:09d}"
CLAIM_NAME = re.compile(r"_claim-(\d{9})")
KEEP_VERSIONS = 2


# --- Extracts ----------------------------------------------------------------------------------

def typed_copy_path(path: str, schema: T.StructType) -> str:
    """Where the typed copy of an extract at ``path`` lives for a table of ``schema``: a changed column or type
    gives another place, so a copy of other columns is never taken for the table."""
    fingerprint = hashlib.sha256(schema.json().encode()).hexdigest()[:16]
    return f"{path.removesuffix('.csv')}_typed/{fingerprint}"


def extract_table(spark: SparkSession, table: str | DataFrame, path: str) -> DataFrame:
    """Saves a whole table as CSV at ``path``, with a typed Parquet copy beside it, and returns the table.

    The copy is written first and the CSV from it, so the table is read once; the CSV is the extract others read,
    the copy is what ``load_table`` reads back, with every text (``NA``, ``null`` and empty ones too) and type kept.
    """
    rows = spark.table(table) if isinstance(table, str) else table
    target = path if path.endswith(".csv") else f"{path}.csv"
    typed = typed_copy_path(target, rows.schema)
    rows.write.mode("overwrite").parquet(typed)
    write_csv(spark.read.parquet(typed), target)
    return rows


def load_table(
    spark: SparkSession, table: str | DataFrame, path: str, use_saved: bool = False
) -> DataFrame:
    """The saved copy if there is a finished one and it is asked for, else a new extract.

    A saved extract is read from its typed copy when that copy has the table's columns and types; an extract saved
    without one (before copies existed) is read from its CSV, where texts that stand for missing cells become NULL.
    """
    target = path if path.endswith(".csv") else f"{path}.csv"
    if use_saved and files.has_rows_written(spark, target):
        schema = (spark.table(table) if isinstance(table, str) else table).schema
        typed = typed_copy_path(target, schema)
        if files.has_rows_written(spark, typed):
            return spark.read.schema(schema).parquet(typed)
        if not files.exists(spark, typed.rsplit("/", 1)[0]):
            return read_delimited(spark, target, ",", schema)
    return extract_table(spark, table, target)


# --- Dated snapshots ---------------------------------------------------------------------------

def _newest(names: Sequence[str], pattern: str) -> str | None:
    """The name with the latest date in it; of several with one date, the last by name."""
    dated = [(found.group(1), name) for name in names if (found := re.search(pattern, name))]
    return max(dated)[1] if dated else None


def matching_folders(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """Folders under ``root`` whose names begin with ``prefix`` and end with a date."""
    return [
        n for n in files.child_names(spark, root) if n.startswith(prefix) and re.search(FOLDER_DATE, n)
    ]


def newest_folder(spark: SparkSession, root: str, prefix: str = "") -> str | None:
    name = _newest(matching_folders(spark, root, prefix), FOLDER_DATE)
    return f"{root.rstrip('/')}/{name}" if name else None


def newest_datapath(spark: SparkSession, root: str) -> str | None:
    name = _newest(files.child_names(spark, root), FILE_DATE)
    return f"{root.rstrip('/')}/{name}" if name else None


def newest_snapshot(
    spark: SparkSession, root: str, prefix: str = "", data_folder: str = "csv"
) -> str | None:
    """Path of the newest file in the newest dated folder; older ones are not read at all."""
    folder = newest_folder(spark, root, prefix)
    return newest_datapath(spark, f"{folder}/{data_folder}") if folder else None


# --- Published tables --------------------------------------------------------------------------

def published_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of a published table, ascending."""
    if not files.exists(spark, path):
        return []
    found = [int(m.group(1)) for n in files.child_names(spark, path) if (m := VERSION_NAME.fullmatch(n))]
    return sorted(v for v in found if files.exists(spark, f"{path.rstrip('/')}/{VERSION.format(v)}/_SUCCESS"))


def _claimed(spark: SparkSession, path: str) -> list[int]:
    if not files.exists(spark, path):
        return []
    return [int(m.group(1)) for n in files.child_names(spark, path) if (m := CLAIM_NAME.fullmatch(n))]


def publish_table(df: DataFrame, columns: Sequence[str], path: str, keep: int = KEEP_VERSIONS) -> str:
    """Replaces all rows of a published table; its columns and their order stay fixed. Returns the new version's path.

    The rows are written to a staging folder first; only a finished write becomes a version, by claiming the next
    number (exclusive creation of a marker, so two writers never share one) and renaming the folder to it. Readers of
    ``published_table`` see the old rows or the new ones, never a part; a write that fails leaves the table as it was
    and removes its staging folder. The ``keep`` newest versions stay, so readers still on the one before finish.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    try:
        df.select(*columns).write.parquet(staging)
    except Exception:
        files.delete(spark, staging)
        raise
    number = max(published_versions(spark, root) + _claimed(spark, root), default=0) + 1
    while not files.claim(spark, f"{root}/{CLAIM.format(number)}"):
        number += 1
    target = f"{root}/{VERSION.format(number)}"
    if not files.rename(spark, staging, target):
        files.delete(spark, staging)
        raise OSError(f"could not move the new rows of {root} into place")
    for old in published_versions(spark, root)[:-keep]:
        files.delete(spark, f"{root}/{VERSION.format(old)}")
        files.delete(spark, f"{root}/{CLAIM.format(old)}")
    return target


def published_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version; a folder written as one plain table before versions existed is read as it is."""
    versions = published_versions(spark, path)
    if versions:
        return spark.read.parquet(f"{path.rstrip('/')}/{VERSION.format(versions[-1])}")
    return spark.read.parquet(path)


def write_per_institution(df: DataFrame, path: str, name: str = "institution_name") -> None:
    """One sub-folder per institution in a single job.

    The rebalance hint gives files of even size: rows of a large institution go to several tasks,
    and small ones share one.
    """
    folders = df.withColumn("institution_folder", folder_slug(name)).hint("rebalance", "institution_folder")
    folders.write.mode("overwrite").partitionBy("institution_folder").parquet(path)


# --- Versions ----------------------------------------------------------------------------------

def next_version_label(existing: Sequence[str], base: str, on: dt.date | None = None) -> str:
    """``base_vNNN``, one above the highest among ``existing``, with ``_YYYYMMDD`` for a date."""
    pattern = re.compile(re.escape(base) + r"_v(\d+)(_\d{8})?")
    versions = [int(found.group(1)) for label in existing if (found := pattern.fullmatch(label))]
    label = f"{base}_v{max(versions, default=0) + 1:03d}"
    return f"{label}_{on:%Y%m%d}" if on else label


def write_version(df: DataFrame, path: str, base: str, on: dt.date | None = None) -> str:
    """Appends ``df`` as the next version of a dataset partitioned by ``version_label``.

    Earlier labels come from the partition folders and from the markers under ``_labels``, so no stored row is read.
    A label is taken by creating its marker exclusively before any row is written: two writers at once get two labels.
    Rows are written to a staging folder of their own and moved into ``version_label=<label>`` when complete, so
    writers do not share Spark's temporary folder and a failed write adds no partition.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    names = files.child_names(spark, root) if files.exists(spark, root) else []
    existing = [n.removeprefix("version_label=") for n in names if n.startswith("version_label=")]
    if files.exists(spark, f"{root}/_labels"):
        existing += files.child_names(spark, f"{root}/_labels")
    label = next_version_label(existing, base, on)
    while not files.claim(spark, f"{root}/_labels/{label}"):
        existing.append(label)
        label = next_version_label(existing, base, on)
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    try:
        df.drop("version_label").write.parquet(staging)
        if not files.rename(spark, staging, f"{root}/version_label={label}"):
            raise OSError(f"could not move version {label} of {root} into place")
    except Exception:
        files.delete(spark, staging)
        raise
    return label


def read_version(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Rows of one version; the filter on the partition column keeps other versions unread."""
    return spark.read.parquet(path).where(F.col("version_label") == F.lit(label))
