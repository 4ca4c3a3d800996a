"""Delimited text files."""

from __future__ import annotations

import csv as _csv
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyport.session import cut_lineage
from tallyport.sources import files

_RAGGED = "__ragged"
_MISFIT = "__misfit"
SEPARATORS = (",", ";", "\t")

# Texts that stand for a missing cell, and for a boolean.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")

_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# A quote inside a quoted cell is doubled. Blanks at the ends of cells and empty texts stay as they are.
_FORMAT = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False, "emptyValue": "",
}
# Cells may hold line breaks, so a file is read by one task; writing bounds its rows. All columns are parsed, so
# that no row with too few or too many cells goes unseen.
_READ = _FORMAT | {"multiLine": True, "columnPruning": False}
_WRITE = _FORMAT | {"maxRecordsPerFile": 1_000_000}


def _cell(name: str) -> Column:
    return F.col(f"`{name}`")


def _decoded(path: Column) -> Column:
    """A metadata path is a URI: its escapes are undone, a plus stays a plus."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _child_name() -> Column:
    """Name of the folder's child a scanned row comes from: its file, or the written folder that holds its part file.

    Evaluated for every row, so it looks at the last two levels of the path only, without a pattern.
    """
    path = F.col("_metadata.file_path")
    last, level = F.substring_index(path, "/", -1), F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return _decoded(F.when(F.endswith(level, F.lit(".csv")) & (F.length(level) > 4), level).otherwise(last))


def _inferred_types(texts: DataFrame, whole_doubles: bool) -> dict[str, str]:
    """bigint, double, boolean or string per column, the first that holds all values; one pass.

    With ``whole_doubles``, a column of numbers such as 1.0 is whole.
    """
    def tests(name: str) -> dict[str, Column]:
        text = _cell(name)
        number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
        whole = text.rlike(_WHOLE) & text.try_cast("bigint").isNotNull()
        if whole_doubles:
            whole = whole | ((number == F.floor(number)) & (F.abs(number) < F.lit(2.0**53)))
        return {"bigint": whole, "double": number.isNotNull(), "boolean": text.isin(*BOOLEANS)}

    # a missing cell has no say; a test that gives NULL for a present cell has failed
    found = texts.agg(*[
        F.bool_and(F.when(_cell(name).isNotNull(), F.coalesce(test, F.lit(False)))).alias(f"{kind}_{i}")
        for i, name in enumerate(texts.columns) for kind, test in tests(name).items()
    ]).first()
    return {
        name: next((kind for kind in ("bigint", "double", "boolean") if found[f"{kind}_{i}"]), "string")
        for i, name in enumerate(texts.columns)
    }


def split_by_line_breaks(spark: SparkSession, paths: str | list[str]) -> tuple[list[str], list[str]]:
    """The files under ``paths`` whose every line holds an even number of quotes, and the others.

    A cell with a line break opens its quotes on one line and closes them on another, so that line has an odd number;
    a file without such a line has no cell across lines and can be read in parts by several tasks. One splittable pass
    over the lines, one row per file to the driver. Files without any line are in neither list.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1).alias("odd"))
    # the path is decoded once per file, not per line
    found = lines.groupBy("path").agg(F.bool_or("odd").alias("odd")).select(_decoded(F.col("path")).alias("file"), "odd").collect()
    return sorted(r["file"] for r in found if not r["odd"]), sorted(r["file"] for r in found if r["odd"])


def _read_text_cells(reader, spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``reader.csv(paths)``, with files proven to have no cell across lines read in parts."""
    whole_lines, spanning = split_by_line_breaks(spark, paths)
    if not whole_lines:  # the reader keeps options set on it: each read names its own
        return reader.option("multiLine", True).csv(paths)
    parted = reader.option("multiLine", False).csv(whole_lines)
    if spanning:
        parted = parted.unionByName(reader.option("multiLine", True).csv(spanning))
    reader.option("multiLine", True)
    return parted


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    sep: str,
    schema: T.StructType | str | None = None,
    whole_doubles: bool = False,
) -> DataFrame:
    """Rows of delimited files with a header.

    Cells are read as text, missing ones become NULL, and the rest is cast, so a value that does not
    fit its type is an error and not NULL. Files whose lines all hold an even number of quotes (no cell spans lines)
    are read in parts by several tasks, the others by one task a file. So are a row with fewer or more cells than the header, and a
    header that differs from the schema or from file to file. Without a schema the types are inferred from all values,
    for which the files are read once more.
    """
    reader = spark.read.options(sep=sep, mode="FAILFAST", enforceSchema=False, **_READ)
    types: dict[str, str] = {}
    if schema is not None:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        types = {f.name: f.dataType.simpleString() for f in fields}
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in types]))
    raw = reader.csv(paths) if schema is None else _read_text_cells(reader, spark, paths)
    if not raw.columns:
        return raw
    if schema is None:  # read with the first file's names, every other file must have the same
        named = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in raw.columns]))
        raw = _read_text_cells(named, spark, paths)
    texts = raw.select(*[
        F.when(~_cell(name).isin(*MISSING), _cell(name)).alias(name) for name in raw.columns
    ])
    if schema is not None:
        return texts.select(*[_cell(name).cast(kind).alias(name) for name, kind in types.items()])

    def typed(name: str, kind: str) -> Column:
        text = _cell(name)
        if kind == "bigint" and whole_doubles:
            return F.coalesce(text.try_cast("bigint"), text.cast("double").cast("bigint"))
        return text.cast(kind)

    inferred = _inferred_types(texts, whole_doubles)
    return texts.select(*[typed(name, kind).alias(name) for name, kind in inferred.items()])


def read_pipe_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``|``-delimited UTF-8 file with header"""
    return read_delimited(spark, path, "|", schema)


def write_pipe_csv(df: DataFrame, path: str) -> None:
    """``|``-delimited UTF-8 files with header; the order of rows is that of ``df``."""
    df.write.mode("overwrite").options(sep="|", **_WRITE).csv(path)


def _check_request(spark: SparkSession, path: str, table_name: str) -> None:
    if not isinstance(table_name, str) or not table_name:
        raise ValueError(f"a table needs a name, got {table_name!r}")
    if not files.exists(spark, path):
        raise ValueError(f"nothing to read at {path}")


def read_csv(
    spark: SparkSession,
    path: str,
    table_name: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
) -> tuple[str, DataFrame]:
    """(table name, rows) of a file delimited by comma, semicolon or tab.

    Without a schema each column gets the narrowest of whole number, number, boolean and text.
    """
    _check_request(spark, path, table_name)
    if sep not in SEPARATORS:
        raise ValueError(f"cannot read with {sep!r} between cells, only with one of {SEPARATORS}")
    return table_name, read_delimited(spark, path, sep, schema, whole_doubles=True)


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    table_name: str,
    pattern: str = "*.csv",
    schema: T.StructType | str | None = None,
) -> tuple[str, DataFrame]:
    """(table name, rows) of all comma files in a folder whose names match, of one layout."""
    _check_request(spark, folder, table_name)
    if not pattern:
        raise ValueError("which files to read needs a pattern")
    names = files.matching_children(spark, folder, pattern)
    if not names:
        raise FileNotFoundError(f"nothing under {folder} is named like {pattern!r}")
    paths = [f"{folder.rstrip('/')}/{n}" for n in names]
    return table_name, read_delimited(spark, paths, ",", schema, whole_doubles=True)


def write_csv(df: DataFrame, path: str) -> str:
    """Comma-delimited files with header at ``path``, with ``.csv`` added where it is missing."""
    target = path if path.endswith(".csv") else f"{path}.csv"
    df.write.mode("overwrite").options(**_WRITE).csv(target)
    return target


def read_pipe_folder(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType | str] | None = None
) -> dict[str, DataFrame]:
    """The ``|``-delimited tables of a folder, by file name.

    A file without a schema in ``schemas`` is read once more to infer it; one without a header is
    left out.
    """
    known = schemas or {}
    names = [n for n in files.child_names(spark, folder) if n.endswith(".csv")]
    tables = {n: read_pipe_csv(spark, f"{folder.rstrip('/')}/{n}", known.get(n)) for n in names}
    return {n: table for n, table in tables.items() if table.columns}


def scan_pipe_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, str]]:
    """All rows of a folder's ``|``-delimited files as text, each with its ``file``.

    Files with one header are read together, and columns a layout lacks are NULL. The second value
    names the files that were skipped, with the reason: unreadable, without header, or with a row that has
    fewer or more cells than the header. The texts are parsed once, into a copy in the shared folder: bad rows are
    counted there and the rows read from there.
    """
    layouts: dict[str, list[str]] = defaultdict(list)
    skipped: dict[str, str] = {}
    for name in files.child_names(spark, folder):
        if not name.endswith(".csv"):
            continue
        try:
            header = files.first_line(spark, f"{folder.rstrip('/')}/{name}")
        except Exception as error:  # an unreadable file must not stop the others
            skipped[name] = str(error).splitlines()[0]
            continue
        if header.strip():
            layouts[header].append(name)
        else:
            skipped[name] = "no header"
    if not layouts:
        raise FileNotFoundError(f"no readable file in {folder}: {skipped}")

    scanned = None
    for header, names in sorted(layouts.items()):
        fields = [T.StructField(c, T.StringType()) for c in header.split("|")]
        schema = T.StructType([*fields, T.StructField(_RAGGED, T.StringType())])
        reader = spark.read.options(sep="|", columnNameOfCorruptRecord=_RAGGED, **_READ).schema(schema)
        # a written folder and a single file are both named by the level below ``folder``; the copy's columns are
        # numbered, as a header may hold any names
        numbered = [f"c{i}" for i in range(len(fields))]
        copy = cut_lineage(reader.csv([f"{folder.rstrip('/')}/{n}" for n in names]).select(
            _child_name().alias("file"), "*").toDF("file", *numbered, _RAGGED))
        ragged = copy.where(F.col(_RAGGED).isNotNull()).groupBy("file").count().collect()
        skipped.update({r["file"]: f"{r['count']} rows do not fit the header" for r in ragged})
        if not any(n not in skipped for n in names):
            continue
        good = copy.where(~F.col("file").isin([r["file"] for r in ragged])) if ragged else copy
        rows = good.drop(_RAGGED).toDF("file", *[f.name for f in fields])
        scanned = rows if scanned is None else scanned.unionByName(rows, allowMissingColumns=True)
    if scanned is None:
        raise FileNotFoundError(f"no readable file in {folder}: {skipped}")
    return scanned, skipped


# --- Reading a folder with a quarantine ----------------------------------------------------------

#: reasons given in the quarantine tables
NO_HEADER = "no header"
RAGGED = "cells do not fit the header"
UNTYPED = "a cell does not fit its type"
REPEATED = "repeated column names"


class Quarantined(NamedTuple):
    """Good rows by file, rows that could not be read (file, line, reason) and files left out (file, reason)."""

    tables: dict[str, DataFrame]
    bad_rows: DataFrame
    bad_files: DataFrame


def header_cells(line: str, sep: str = "|") -> list[str]:
    """The column names of a header line, quotes and doubled quotes taken as the reader takes them."""
    return next(_csv.reader([line], delimiter=sep, quotechar='"', doublequote=True), [])


def _layouts(spark: SparkSession, folder: str, sep: str) -> tuple[dict[tuple[str, ...], list[str]], dict[str, str]]:
    """Files by their header's names, and the files left out with the reason. Only first lines are read."""
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    skipped: dict[str, str] = {}
    for name in files.child_names(spark, folder):
        if not name.endswith(".csv"):
            continue
        try:
            header = files.first_line(spark, f"{folder.rstrip('/')}/{name}")
        except Exception as error:  # an unreadable file must not stop the others
            skipped[name] = str(error).splitlines()[0]
            continue
        cells = tuple(header_cells(header, sep)) if header.strip() else ()
        if not cells:
            skipped[name] = NO_HEADER
        elif len(set(cells)) < len(cells):
            skipped[name] = REPEATED
        else:
            layouts[cells].append(name)
    return layouts, skipped


def _misfit(cells: Sequence[str], typed_fields: Mapping[str, list[T.StructField]]) -> Column:
    """Whether a present cell of the row does not fit its type; never for a file without a schema, never null.

    Texts always fit and are not looked at. A cell is compared with the missing ones only if its cast fails.
    """
    same: dict[tuple, list[str]] = defaultdict(list)
    for name, fields in typed_fields.items():
        same[tuple((f.name, f.dataType) for f in fields if f.name in cells and not isinstance(f.dataType, T.StringType))].append(name)
    found = F.lit(False)
    for checked, names in same.items():
        bad = [_cell(c).isNotNull() & _cell(c).try_cast(kind).isNull() & ~_cell(c).isin(*MISSING) for c, kind in checked]
        if bad:
            found = F.when(F.col("__file").isin(names), reduce(or_, bad)).otherwise(found)
    return found


def read_pipe_folder_quarantined(
    spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType | str] | None = None, sep: str = "|"
) -> Quarantined:
    """The delimited tables of a folder by file name, with what could not be read set aside instead of failing.

    Files with one header are read by one scan, written to the shared folder with a mark on rows that do not fit their
    file's schema; each file's table is that copy filtered by file, and bad rows are found by their marks. A row with fewer or more cells than its header goes to ``bad_rows`` with its text; so does, for a file
    with a schema in ``schemas``, a row with a present cell that does not fit its type. Files without a header (empty,
    or a blank first line), with repeated column names or that cannot be opened go to ``bad_files``. Missing cells
    (``MISSING``) are NULL; without a schema the types are inferred from the good rows as by ``read_delimited``.
    """
    known = schemas or {}
    layouts, skipped = _layouts(spark, folder, sep)
    reader = spark.read.options(sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord=_RAGGED, **_READ)
    tables: dict[str, DataFrame] = {}
    bad_parts = []
    for cells, names in sorted(layouts.items()):
        schema = T.StructType([*(T.StructField(c, T.StringType()) for c in cells), T.StructField(_RAGGED, T.StringType())])
        typed_fields = {n: (T.StructType.fromDDL(known[n]) if isinstance(known[n], str) else known[n]).fields
                        for n in names if n in known}
        # written once: every file's table and the bad rows read the written scan, and Spark may not read the
        # bad-row column of a text file by itself
        scanned = reader.schema(schema).csv([f"{folder.rstrip('/')}/{n}" for n in names]).select(
            _child_name().alias("__file"), *[_cell(c) for c in cells], _RAGGED)
        rows = cut_lineage(scanned.withColumn(_MISFIT, _misfit(cells, typed_fields)))
        bad_parts.append(rows.where(F.col(_RAGGED).isNotNull()).select(
            F.col("__file").alias("file"), F.col(_RAGGED).alias("line"), F.lit(RAGGED).alias("reason")))
        good = rows.where(F.col(_RAGGED).isNull())
        present = [F.when(~_cell(c).isin(*MISSING), _cell(c)).alias(c) for c in cells]
        for name in names:
            of_file = good.where(F.col("__file") == F.lit(name))
            if name in known:
                fields = typed_fields[name]
                typed = {f.name: _cell(f.name).try_cast(f.dataType) if f.name in cells else F.lit(None).cast(f.dataType)
                         for f in fields}
                line = F.concat_ws(sep, *[F.coalesce(_cell(c), F.lit("")) for c in cells])
                bad_parts.append(of_file.where(F.col(_MISFIT)).select(*present).select(
                    F.lit(name).alias("file"), line.alias("line"), F.lit(UNTYPED).alias("reason")))
                tables[name] = of_file.where(~F.col(_MISFIT)).select(*present).select(
                    *[typed[f.name].alias(f.name) for f in fields])
            else:
                texts = of_file.select(*present)
                inferred = _inferred_types(texts, False)
                tables[name] = texts.select(*[_cell(c).cast(kind).alias(c) for c, kind in inferred.items()])
    empty_rows = spark.createDataFrame([], "file string, line string, reason string")
    bad_rows = empty_rows
    for part in bad_parts:
        bad_rows = bad_rows.unionByName(part)
    bad_files = spark.createDataFrame(sorted(skipped.items()), "file string, reason string")
    return Quarantined(tables, bad_rows, bad_files)
