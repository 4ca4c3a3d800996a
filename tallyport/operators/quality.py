"""Checks and profiles of incoming tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract types and the Spark types they stand for.
CONTRACT_TYPES = {
    "int": "bigint",
    "float": "double",
    "str": "string",
    "bool": "boolean",
    "timestamp": "timestamp",
}


def check_contract(df: DataFrame, contract: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per contract column: is it there, in its place, and how many values do not fit.

    ``contract`` lists (name, type) in order, with the types of ``CONTRACT_TYPES``; further columns
    may follow. Values are tested by the column at the contract's position, all in one pass.
    """
    unknown = [t for _, t in contract if t not in CONTRACT_TYPES]
    if unknown:
        raise TypeError(f"unknown contract types: {unknown}")
    found = df.columns[: len(contract)]

    def misfits(position: int, kind: str) -> Column:
        if position >= len(found):
            return F.lit(None).cast("bigint")
        value = F.col(f"`{found[position]}`").cast("string")
        return F.count_if(value.isNotNull() & value.try_cast(CONTRACT_TYPES[kind]).isNull())

    if not contract:
        raise ValueError("the contract is empty")
    counts = df.agg(*[misfits(i, kind).alias(f"bad_{i}") for i, (_, kind) in enumerate(contract)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("expected_type"),
            F.lit(found[i] if i < len(found) else None).cast("string").alias("found_column"),
            F.lit(name in df.columns).alias("present"),
            F.lit(i < len(found) and found[i] == name).alias("position_ok"),
            F.col(f"bad_{i}").alias("n_bad"),
        )
        for i, (name, kind) in enumerate(contract)
    ]
    return counts.select(F.inline(F.array(*rows)))


def require_contract(df: DataFrame, contract: Sequence[tuple[str, str]]) -> None:
    """Raises ValueError unless columns and values meet the contract."""
    failed = check_contract(df, contract).where("NOT position_ok OR n_bad > 0").orderBy("position").collect()
    if failed:
        parts = [f"{r['column_name']} (found {r['found_column']}, {r['n_bad']} misfits)" for r in failed]
        raise ValueError("contract not met: " + "; ".join(parts))


def _sql_type(field: T.StructField, text_length: Column) -> Column:
    kind = field.dataType
    if isinstance(kind, T.IntegralType):
        return (
            F.when(text_length > 9, F.lit("BIGINT"))
            .when(text_length > 4, F.lit("INTEGER"))
            .otherwise(F.lit("SMALLINT"))
        )
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit("REAL")
    if isinstance(kind, T.BooleanType):
        return F.lit("BOOLEAN")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("TIMESTAMP")
    if isinstance(kind, T.DateType):
        return F.lit("DATE")
    if isinstance(kind, T.StringType):
        return F.concat(F.lit("VARCHAR("), F.coalesce(text_length, F.lit(0)).cast("string"), F.lit(")"))
    raise ValueError(f"column {field.name}: type {kind.simpleString()} is not recognized")


def column_profile(df: DataFrame) -> DataFrame:
    """Narrowest SQL type per column: (position, column_name, sql_type).

    Integers go by the length of their text, sign included; text by its longest value. One pass
    over the table gives all lengths.
    """
    lengths = df.agg(*[
        F.max(F.char_length(F.col(f"`{f.name}`").cast("string"))).alias(f"len_{i}")
        if isinstance(f.dataType, (T.IntegralType, T.StringType)) else F.lit(None).cast("int").alias(f"len_{i}")
        for i, f in enumerate(df.schema.fields)
    ])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            _sql_type(f, F.col(f"len_{i}")).alias("sql_type"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return lengths.select(F.inline(F.array(*rows)))


def _load_type(sql_type: str) -> str:
    # REAL would lose digits, so floats stay double
    return {"REAL": "double", "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint"}.get(sql_type, "")


def narrowed(df: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Columns cast to their profiled types, with the load date in front.

    Only the profile, one row per column, comes to the driver. Every whole number fits the type that
    its length gives.
    """
    types = {r["column_name"]: _load_type(r["sql_type"]) for r in column_profile(df).collect()}
    loaded = F.lit(as_of) if as_of else F.current_date()
    return df.select(
        loaded.alias("date_loading"),
        *[F.col(f"`{c}`").cast(types[c]).alias(c) if types[c] else F.col(f"`{c}`") for c in df.columns],
    )


def load_narrowed(df: DataFrame, path: str, as_of: dt.date | None = None) -> DataFrame:
    """Writes ``narrowed`` rows as a table at ``path`` and reads them back."""
    narrowed(df, as_of).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
