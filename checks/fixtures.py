"""Portal-shaped relations derived from the driver's tables, and the profiles used with them."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyport.config import LEGACY, OPEN_YEARS, PORTAL, WORKBOOK
from tallyport.operators.clean import PortalTables

SOURCE_NAMES = (
    "histo_actions_eu", "actions_eu", "indices_telekurs_d", "histo_indices_telekurs",
    "indices_eurofidai_m", "histo_indices_eurofidai", "corres_code", "fonds_mutuel_fr",
    "change_spot", "histo_ost", "ost_eu", "esg_scores", "greenbonds", "unmapped_base",
)

# the driver's orders run from 1995 to 2001
PORTAL_CHECK = replace(
    PORTAL, excluded_groups=("ADMIN_GROUP", "STAFF_GROUP"),
    excluded_subscriber_institutions=("NATION_7", "NATION_9"), first_year=1996,
)
WORKBOOK_CHECK = replace(
    WORKBOOK, excluded_groups=("ADMIN_GROUP", "STAFF_GROUP"),
    excluded_subscriber_institutions=("NATION_7",), years=(1996, 1997, 1999, 2000),
)
PIVOT_YEARS = WORKBOOK_CHECK.years
OPEN_YEARS_CHECK = replace(OPEN_YEARS, excluded_groups=PORTAL_CHECK.excluded_groups,
                           excluded_subscriber_institutions=PORTAL_CHECK.excluded_subscriber_institutions)
LEGACY_CHECK = replace(LEGACY, excluded_groups=PORTAL_CHECK.excluded_groups,
                       excluded_subscriber_institutions=PORTAL_CHECK.excluded_subscriber_institutions, first_year=1996)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file once; every later read is given it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _epoch(column: str):
    """Epoch seconds of a timestamp without zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


class DerivedTables:
    """The portal's relations, each built when it is first asked for; see ``PortalTables``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._table = partial(table, spark, sf_dir)

    @cached_property
    def _users(self) -> DataFrame:
        """Customers with their group"""
        nation = self._table("nation")
        nationkey = F.col("c_nationkey")
        return self._table("customer").join(nation, F.col("n_nationkey") == nationkey).select(
            F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_custkey") % 97 != 0, F.col("c_name")).alias("user_name"),
            nationkey.alias("institution_id"),
            F.when(nationkey == 0, "ADMIN_GROUP").when(nationkey != 23, F.col("n_name")).alias("group_name"),
        )

    @cached_property
    def usage_log(self) -> DataFrame:
        part = self._table("part").select("p_partkey")
        requests = self._table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
            .otherwise(3).alias("request_type"),
            F.col("o_orderdate").alias("requested_at"),
        ).join(self._users, "user_id")
        items = self._table("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(
            part, F.col("l_partkey") == F.col("p_partkey")
        )
        sources = F.array(*[F.lit(n) for n in SOURCE_NAMES])
        return items.join(requests, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "user_id", "user_name", "institution_id", "group_name",
            F.element_at(sources, (1 + F.col("p_partkey") % 14).cast("int")).alias("source_name"),
            "request_type",
            F.col("l_quantity").cast("int").alias("n_codes"),
            "requested_at",
        )

    @cached_property
    def institution(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._table("nation").select(
            key.alias("institution_id"),
            F.when(key == 3, "Nation 3, North ").when(key != 24, F.col("n_name")).alias("institution_name"),
        )

    @cached_property
    def account(self) -> DataFrame:
        orders = self._table("orders")
        seen = orders.groupBy("o_custkey").agg(
            F.min(_epoch("o_orderdate")).alias("created_s"),
            F.max(
                F.when(F.col("o_orderkey") % 7 != 0, _epoch("o_orderdate")).otherwise(0)
            ).alias("access_s"),
        )
        customers = self._table("customer").select("c_custkey")
        return customers.join(seen, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            F.col("c_custkey").alias("user_id"), "created_s", "access_s"
        )

    @cached_property
    def account_institution(self) -> DataFrame:
        customer, nation = self._table("customer"), F.col("c_nationkey")
        first = customer.select(F.col("c_custkey").alias("user_id"), nation.alias("institution_id"))
        second = customer.where(F.col("c_custkey") % 10 == 0).select(
            F.col("c_custkey").alias("user_id"), ((nation + 1) % 25).alias("institution_id")
        )
        return first.unionByName(second)

    @cached_property
    def account_status(self) -> DataFrame:
        customer, segment = self._table("customer"), F.col("c_mktsegment")
        known = customer.where("c_acctbal >= 0").select(
            F.col("c_custkey").alias("user_id"),
            F.when(segment == "HOUSEHOLD", "Student").when(segment == "MACHINERY", "PhD")
            .when(segment == "FURNITURE", "Administration").otherwise("Researcher").alias("status"),
        )
        without_account = customer.where(F.col("c_custkey") % 50 == 0).select(
            (F.col("c_custkey") + 1000000).alias("user_id"), F.lit("Researcher").alias("status")
        )
        return known.unionByName(without_account)


def portal_tables(spark: SparkSession, sf_dir: str) -> PortalTables:
    return DerivedTables(spark, sf_dir)
