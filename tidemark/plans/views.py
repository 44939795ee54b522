"""Bronze-shaped views derived from the driver tables.

The driver ships TPC-H-like tables, not replicated airline systems, so each
scenario maps one of them onto the bronze contract: business columns plus
``_synced`` (sync time) and ``_deleted`` (nullable soft-delete flag).
Every view reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleanse import ts_lit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def b_coupon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket-coupon bronze over lineitem; (ticket_number, coupon_number) repeats across versions."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("ticket_number"),
        F.col("l_linenumber").alias("coupon_number"),
        F.col("l_suppkey").cast("string").alias("flight_number"),
        F.col("l_shipdate").cast("date").cast("string").alias("flight_date"),
        "l_partkey", "l_suppkey", "l_quantity",
        F.col("l_extendedprice").alias("total_amount"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice") * F.col("l_discount"))
         .alias("commission_amount"),
        F.when(F.col("l_returnflag") == "R", "FLOWN")
         .when(F.col("l_returnflag") == "A", "VOID")
         .otherwise("OPEN").alias("ticket_status"),
        F.col("l_shipdate").alias("_synced"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), F.lit(True))
         .when(F.col("l_linestatus") == "F", F.lit(False))
         .otherwise(F.lit(None).cast("boolean")).alias("_deleted"),
    )


# Deterministic total order among versions of one coupon with equal sync time.
COUPON_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "total_amount"]


def b_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-sourced state bronze over events; an 'error' event is a soft delete."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id", "event_type", "value",
        F.col("ts").alias("_synced"),
        (F.col("event_type") == "error").alias("_deleted"),
    )


def b_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight-leg bronze over orders, with text-typed fields as the source delivers them."""
    o = table(spark, sf_dir, "orders")
    day_text = F.col("o_orderdate").cast("date").cast("string")
    return o.select(
        F.col("o_orderkey").cast("string").alias("flight_id"),
        F.col("o_custkey").alias("flight_number"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
         .when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "O"), F.lit(""))
         .otherwise(day_text).alias("flight_date"),
        F.col("o_orderdate").cast("string").alias("scheduled_dep"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate").cast("string"))
         .otherwise(F.lit("not departed")).alias("actual_dep"),
        F.col("o_totalprice").cast("string").alias("block_hours"),
        F.col("o_orderstatus").alias("flight_status"),
        F.col("o_orderdate").alias("_synced"),
        F.lit(False).alias("_deleted"),
    )


# ---------------------------------------------------------------------------
# The same views as DuckDB SQL, for the oracle.
# ---------------------------------------------------------------------------
SQL_B_COUPON = """
SELECT CAST(l_orderkey AS VARCHAR) AS ticket_number,
       l_linenumber AS coupon_number,
       CAST(l_suppkey AS VARCHAR) AS flight_number,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS flight_date,
       l_partkey, l_suppkey, l_quantity,
       l_extendedprice AS total_amount,
       CASE WHEN l_discount <> 0 THEN l_extendedprice * l_discount END AS commission_amount,
       CASE WHEN l_returnflag = 'R' THEN 'FLOWN' WHEN l_returnflag = 'A' THEN 'VOID' ELSE 'OPEN' END AS ticket_status,
       l_shipdate AS _synced,
       CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN TRUE
            WHEN l_linestatus = 'F' THEN FALSE ELSE NULL END AS _deleted
FROM lineitem
"""

SQL_B_STATE = """
SELECT event_id, user_id, event_type, value, ts AS _synced, (event_type = 'error') AS _deleted
FROM events
"""

SQL_B_LEG = """
SELECT CAST(o_orderkey AS VARCHAR) AS flight_id,
       o_custkey AS flight_number,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN ''
            ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS flight_date,
       CAST(o_orderdate AS VARCHAR) AS scheduled_dep,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS VARCHAR) ELSE 'not departed' END AS actual_dep,
       CAST(o_totalprice AS VARCHAR) AS block_hours,
       o_orderstatus AS flight_status,
       o_orderdate AS _synced,
       FALSE AS _deleted
FROM orders
"""

SQL_COUPON_TIEBREAK = "l_partkey DESC, l_suppkey DESC, l_quantity DESC, total_amount DESC"


def b_waybill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-waybill bronze over orders: pending orders have no status yet (NULL)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("awb_number"),
        F.col("o_custkey").cast("string").alias("flight_id"),
        F.col("o_totalprice").alias("fjd_amount"),
        F.when(F.col("o_orderstatus") == "F", F.lit("DELIVERED"))
         .when(F.col("o_orderstatus") == "O", F.lit("CANCELLED")).alias("status"),
        F.col("o_orderdate").alias("_synced"),
        F.lit(None).cast("boolean").alias("_deleted"),
    )


def b_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GL-journal bronze over lineitem: approval flag from the return flag (A -> not yet decided)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("journal_id"),
        F.col("l_partkey").cast("string").alias("gl_account_code"),
        F.col("l_extendedprice").alias("base_amount"),
        F.col("l_orderkey").cast("string").alias("flight_id"),
        F.when(F.col("l_returnflag") == "N", F.lit("Y"))
         .when(F.col("l_returnflag") == "R", F.lit("N")).alias("approved_flag"),
        "l_partkey", "l_suppkey", "l_quantity",
        F.col("l_shipdate").alias("_synced"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 45), F.lit(True))
         .when(F.col("l_linestatus") == "F", F.lit(False))
         .otherwise(F.lit(None).cast("boolean")).alias("_deleted"),
    )


JOURNAL_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "base_amount"]

# Replication delay: purchase events come through a slower connector and land
# this many days after their sync time; everything else lands immediately.
PURCHASE_DELAY_DAYS = 5


def arrival() -> Column:
    """Instant a bronze event row landed: its sync time plus the connector delay."""
    return F.when(F.col("event_type") == "purchase",
                  F.col("_synced") + F.expr(f"INTERVAL {PURCHASE_DELAY_DAYS} DAYS")).otherwise(F.col("_synced"))


def landed_by(df: DataFrame, t) -> DataFrame:
    """Rows of an event bronze that had landed before instant ``t`` (the bronze a run at ``t`` sees)."""
    return df.filter(arrival() < ts_lit(t))


SQL_B_WAYBILL = """
SELECT CAST(o_orderkey AS VARCHAR) AS awb_number,
       CAST(o_custkey AS VARCHAR) AS flight_id,
       o_totalprice AS fjd_amount,
       CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'CANCELLED' END AS status,
       o_orderdate AS _synced,
       CAST(NULL AS BOOLEAN) AS _deleted
FROM orders
"""

SQL_B_JOURNAL = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS journal_id,
       CAST(l_partkey AS VARCHAR) AS gl_account_code,
       l_extendedprice AS base_amount,
       CAST(l_orderkey AS VARCHAR) AS flight_id,
       CASE WHEN l_returnflag = 'N' THEN 'Y' WHEN l_returnflag = 'R' THEN 'N' END AS approved_flag,
       l_partkey, l_suppkey, l_quantity,
       l_shipdate AS _synced,
       CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN TRUE
            WHEN l_linestatus = 'F' THEN FALSE ELSE NULL END AS _deleted
FROM lineitem
"""

SQL_ARRIVAL = "CASE WHEN event_type = 'purchase' THEN _synced + INTERVAL 5 DAY ELSE _synced END"
