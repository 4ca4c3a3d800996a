"""Tables from SQL: the session's catalog or a database behind JDBC."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallyport.operators.clean import PortalTables


def run_query(
    spark: SparkSession, query: str, params: Mapping[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Result of a SQL text. ``params`` are bound to ``:name`` markers, ``frames`` to ``{name}``.

    Errors are raised, never turned into an empty table.
    """
    if not query or not query.strip():
        raise ValueError("there is no SQL text to run")
    return spark.sql(query, args=dict(params) if params else None, **frames)


#: rows a JDBC task asks the database for at a time (drivers default to as few as 10, or to all rows)
FETCH_SIZE = 10_000
_MARKER = re.compile(r"(?<![:\w]):([A-Za-z_]\w*)")


def sql_literal(value: Any) -> str:
    """``value`` as a typed SQL literal: text quoted with inner quotes doubled, dates and times with their keyword."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"{value} has no SQL literal")
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def bind(query: str, params: Mapping[str, Any]) -> str:
    """``query`` with each ``:name`` marker replaced by the literal of ``params[name]``.

    Every marker needs a value and every value a marker; a name inside quotes is not a marker (quoted texts are
    left as they are).
    """
    pieces = re.split(r"('(?:[^']|'')*')", query)
    used = set()

    def replace(found):
        name = found.group(1)
        if name not in params:
            raise KeyError(f"no value for :{name}")
        used.add(name)
        return sql_literal(params[name])

    bound = "".join(p if i % 2 else _MARKER.sub(replace, p) for i, p in enumerate(pieces))
    unused = set(params) - used
    if unused:
        raise KeyError(f"values without a marker: {sorted(unused)}")
    return bound


def jdbc_options(
    options: Mapping[str, str],
    query: str | None = None,
    table: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    params: Mapping[str, Any] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """The reader options of ``read_database``, without reading."""
    if bool(query) == bool(table):
        raise ValueError("give either a query or a table")
    if params and not query:
        raise ValueError("parameters need a query")
    settings = {"fetchsize": str(fetch_size), **options}
    if query:
        text = bind(query, params or {})
        if not split:
            return settings | {"query": text}
        # a split needs a table: the query becomes a derived one
        table = f"({text}) split_source"
    if split:
        column, lower, upper, partitions = split
        settings |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                     "numPartitions": str(partitions)}
    return settings | {"dbtable": table}


def read_database(
    spark: SparkSession,
    options: Mapping[str, str],
    query: str | None = None,
    table: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    params: Mapping[str, Any] | None = None,
    predicates: Sequence[str] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """Table or query result of a JDBC source; ``options`` hold url, driver and credentials.

    ``params`` are bound to ``:name`` markers of ``query`` as typed literals. ``split`` is (column, lower, upper,
    partitions): the source is then read by that many tasks, each with its own range of the column; a query is read
    as a derived table for it. ``predicates`` instead give one task per condition (they should cover each row once).
    Every task fetches ``fetch_size`` rows at a time.
    """
    if predicates:
        if split:
            raise ValueError("give a split or predicates, not both")
        settings = jdbc_options(options, query, table, None, params, fetch_size)
        source = settings.pop("dbtable", None) or f"({settings.pop('query')}) predicate_source"
        url = settings.pop("url")
        return spark.read.jdbc(url, source, predicates=list(predicates), properties=settings)
    return spark.read.format("jdbc").options(**jdbc_options(options, query, table, split, params, fetch_size)).load()


# The portal's tables and columns, as (table, {our column: their column}).
PORTAL_SCHEMA = {
    "usage_log": ("statistique_requete", {
        "user_id": "id_utilisateur_drupal",
        "user_name": "nom_utilisateur",
        "institution_id": "id_groupe_labo",
        "group_name": "nom_groupe_labo",
        "source_name": "nom_base_interrogee",
        "request_type": "type_interrogation",
        "n_codes": "nb_codes_en_entree",
        "requested_at": "date_heure_extraction",
    }),
    "institution": ("institution_entity", {"institution_id": "id", "institution_name": "name"}),
    "account": ("users_field_data", {"user_id": "uid", "created_s": "created", "access_s": "access"}),
    "account_institution": ("user__field_institution", {
        "user_id": "entity_id", "institution_id": "field_institution_target_id",
    }),
    "account_status": ("user__field_statut", {"user_id": "entity_id", "status": "field_statut_value"}),
}


def portal_tables(load) -> PortalTables:
    """The portal's relations; ``load`` gives the DataFrame of a table name.

    ``portal_tables(spark.table)`` reads the catalog, and
    ``portal_tables(lambda t: read_database(spark, options, table=t))`` a database.
    """
    def relation(table: str, columns: Mapping[str, str]) -> DataFrame:
        source = load(table)
        return source.select(*[source[theirs].alias(ours) for ours, theirs in columns.items()])

    return PortalTables(**{name: relation(*spec) for name, spec in PORTAL_SCHEMA.items()})
