"""Attempts and merchants derived from the star-schema tables.

Time of day, nulls and dirt come from integer arithmetic on keys, so the data is the same on every
engine.  Dates are handed on as text, to exercise parsing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.silver import Silver, to_silver, typed_attempts

# Stating the schemas spares a job per table that would read file footers to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, or in a local session without one,
    a temporary folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{shared or tempfile.gettempdir()}/tallyforge-{uuid.uuid4().hex}"


def raw_attempts(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.selectExpr(
        "CASE WHEN l_orderkey % 97 <> 0 THEN concat('M_', l_suppkey) END AS merchant_id",
        """concat(cast(cast(l_shipdate AS date) AS string), ' ',
            lpad(cast((18 + l_orderkey % 8 + l_partkey % 8) % 24 AS string), 2, '0'),
            ':00:00') AS purchase_date""",
        """CASE WHEN l_orderkey % 499 = 0 THEN 0D WHEN l_orderkey % 503 = 0 THEN -l_extendedprice
            ELSE l_extendedprice END AS purchase_amount""",
        """CASE WHEN l_orderkey % 89 = 0 THEN -1L
            WHEN l_orderkey % 101 <> 0 THEN cast(c_nationkey AS bigint) END AS city_id""",
        """CASE WHEN l_orderkey % 83 = 0 THEN -1L
            WHEN l_orderkey % 103 <> 0 THEN cast(n_regionkey AS bigint) END AS state_id""",
        """CASE WHEN l_partkey % 53 = 0 THEN ' '
            WHEN l_partkey % 59 <> 0 THEN l_returnflag END AS category""",
        """CASE WHEN l_orderkey % 211 = 0 THEN 999L WHEN l_orderkey % 223 = 0 THEN -1L
            WHEN l_orderkey % 227 <> 0 THEN l_linenumber - 1L END AS installments""",
        """CASE WHEN l_orderkey % 307 = 0 THEN NULL
            WHEN l_linestatus = 'O' AND l_linenumber <= 2 THEN 'N' ELSE 'Y' END
            AS authorized_flag""",
    )


def raw_merchants(spark: SparkSession, folder: str) -> DataFrame:
    """Most suppliers, some with blank names, some with a second name, and one without an id."""
    supplier = table(spark, folder, "supplier")
    listed = supplier.filter("s_suppkey % 20 <> 7").selectExpr(
        "concat('M_', s_suppkey) AS merchant_id",
        "CASE WHEN s_suppkey % 33 = 5 THEN '  ' ELSE s_name END AS merchant_name",
    )
    aliased = supplier.filter("s_suppkey % 25 = 3").selectExpr(
        "concat('M_', s_suppkey) AS merchant_id", "concat('Alias ', s_name) AS merchant_name"
    )
    orphan = spark.range(0, 1, 1, 1).selectExpr(
        "cast(NULL AS string) AS merchant_id", "'Orphan' AS merchant_name"
    )
    return listed.unionByName(aliased).unionByName(orphan)


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Typed attempts, all that questions without merchant names need."""
    return typed_attempts(raw_attempts(spark, folder))


def silver(spark: SparkSession, folder: str) -> Silver:
    return to_silver(raw_attempts(spark, folder), raw_merchants(spark, folder), validate=False)
