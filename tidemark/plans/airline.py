"""Airline-shaped bronze for the 13 source tables, derived from the driver tables.

Each source column is one SQL expression over a driver table; the same text is
run by Spark (``selectExpr``) and by the DuckDB oracle, so both sides refine the
identical bronze and the comparison tests the model logic only. Every mapping
reads its whole driver table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.specs import SOURCES, ddl_fields

LINE_DELETED = "CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN TRUE WHEN l_linestatus = 'F' THEN FALSE END"
LINE_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
ORDER_DELETED = "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
LINE_SYS = {"_synced": "l_shipdate", "_deleted": LINE_DELETED}
ORDER_SYS = {"_synced": "o_orderdate", "_deleted": ORDER_DELETED}
AIRCRAFT_TYPE = "l_returnflag || l_linestatus"

# source table -> (driver table, {column: SQL expression}); unlisted columns are NULL.
BRONZE: dict[str, tuple[str, dict[str, str]]] = {
    "flight_leg": ("orders", {
        "flight_id": "CAST(o_orderkey AS STRING)",
        "flight_number": "o_custkey",
        "flight_date": "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' "
                       "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
        "service_type": "o_orderpriority",
        "origin": "CASE WHEN o_orderstatus = 'F' THEN 'NAN' ELSE 'SUV' END",
        "destination": "CASE WHEN o_orderstatus = 'F' THEN 'SUV' ELSE 'NAN' END",
        "scheduled_dep": "CAST(o_orderdate AS STRING)",
        "scheduled_arr": "CAST(o_orderdate + INTERVAL 2 HOUR AS STRING)",
        "actual_dep": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 10 MINUTE AS STRING) END",
        "actual_arr": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 130 MINUTE AS STRING) END",
        "aircraft_reg": "'DQ-' || CAST(o_custkey AS STRING)",
        "aircraft_type": "o_orderpriority",
        "block_hours": "CAST(o_totalprice AS STRING)",
        "flight_hours": "CAST(o_custkey AS STRING) || '.5'",
        "distance_km": "o_custkey",
        "seat_capacity": "180",
        "pax_booked": "o_custkey",
        "pax_boarded": "o_custkey",
        "cargo_capacity_kg": "o_totalprice",
        "flight_status": "o_orderstatus",
        "cancelled_flag": "CASE WHEN o_orderstatus = 'O' THEN 'Y' ELSE 'N' END",
        "diverted_flag": "'N'",
        **ORDER_SYS}),
    "crew_assignment": ("lineitem", {
        "assignment_id": LINE_KEY,
        "flight_id": "CAST(l_orderkey AS STRING)",
        "employee_id": "CAST(l_suppkey AS STRING)",
        "crew_role": "l_returnflag",
        "crew_type": "l_linestatus",
        "duty_start": "CAST(l_shipdate AS STRING)",
        "duty_end": "CAST(l_shipdate + INTERVAL 8 HOUR AS STRING)",
        "block_hours": "CAST(l_quantity AS STRING)",
        "hourly_rate": "l_extendedprice",
        "crew_cost": "l_extendedprice",
        "overtime_flag": "CASE WHEN l_quantity > 40 THEN 'Y' ELSE 'N' END",
        "overtime_hours": "l_quantity",
        "base_station": "l_returnflag",
        **LINE_SYS}),
    "ticket_coupon": ("lineitem", {
        "ticket_number": "CAST(l_orderkey AS STRING)",
        "coupon_number": "l_linenumber",
        "pnr_locator": "'P' || CAST(l_orderkey AS STRING)",
        "pax_id": "CAST(l_partkey AS STRING)",
        "flight_number": "CAST(l_suppkey AS STRING)",
        "flight_date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
        "total_amount": "l_extendedprice",
        "commission_amount": "CASE WHEN l_discount >= 0.05 THEN l_quantity END",
        "ticket_status": "CASE WHEN l_returnflag = 'A' THEN 'VOID' WHEN l_linestatus = 'F' THEN 'FLOWN' "
                         "WHEN l_returnflag = 'R' THEN 'REFUNDED' ELSE 'OPEN' END",
        **LINE_SYS}),
    "passenger_name_record": ("orders", {  # a passenger's row changes with every booking
        "pnr_locator": "'P' || CAST(o_custkey % 25 AS STRING)",
        "pax_id": "CAST(o_custkey AS STRING)",
        "pax_first_name": "'Passenger ' || CAST(o_custkey AS STRING)",
        "pax_last_name": "o_orderpriority",
        "passport_number": "CASE WHEN o_totalprice > 100000 THEN 'X' || CAST(o_custkey AS STRING) "
                           "ELSE 'x-' || CAST(o_custkey AS STRING) END",
        "date_of_birth": "CASE WHEN o_custkey % 3 = 0 THEN '1980-01-15' WHEN o_custkey % 3 = 1 THEN '1975-06-30' "
                         "ELSE 'unknown' END",
        **ORDER_SYS}),
    "reservation_pnr": ("orders", {
        "pnr_locator": "'P' || CAST(o_custkey AS STRING)",
        "creation_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
        "booking_channel": "o_orderpriority",
        **ORDER_SYS}),
    "air_waybill": ("orders", {
        "awb_number": "CAST(o_orderkey AS STRING)",
        "flight_id": "CAST(o_custkey AS STRING)",
        "fjd_amount": "o_totalprice",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'CANCELLED' END",
        "chargeable_weight_kg": "o_custkey",
        "_synced": "o_orderdate", "_deleted": "CAST(NULL AS BOOLEAN)"}),
    "gl_journal_entry": ("lineitem", {
        "journal_id": LINE_KEY,
        "gl_account_code": "CAST(l_partkey AS STRING)",
        "base_amount": "l_extendedprice",
        "flight_id": "CASE WHEN l_returnflag <> 'A' THEN CAST(l_orderkey AS STRING) END",
        "approved_flag": "CASE WHEN l_returnflag = 'N' THEN 'Y' WHEN l_returnflag = 'R' THEN 'N' END",
        **LINE_SYS}),
    "fuel_invoice": ("lineitem", {
        "invoice_id": "CAST(l_partkey AS STRING)",
        "flight_id": "CAST(l_orderkey AS STRING)",
        "fjd_amount": "l_extendedprice",
        "quantity_liters": "l_quantity",
        **LINE_SYS}),
    "flight_cost_allocation": ("lineitem", {
        "allocation_id": "CAST(l_suppkey AS STRING) || '-' || l_returnflag",
        "flight_id": "CAST(l_orderkey AS STRING)",
        "cost_category": "l_linestatus",
        "amount": "l_extendedprice",
        "approved_flag": "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END",
        **LINE_SYS}),
    "work_order": ("lineitem", {
        "wo_number": "CAST(l_orderkey AS STRING)",
        "aircraft_reg": "'DQ-' || CAST(l_suppkey AS STRING)",
        "total_cost": "l_extendedprice",
        **LINE_SYS}),
    "aircraft_fleet": ("lineitem", {
        "aircraft_reg": "'DQ-' || CAST(l_suppkey AS STRING)",
        "aircraft_type": AIRCRAFT_TYPE,
        "fuel_burn_rate": "l_quantity",
        "maint_reserve_rate": "l_discount",
        **LINE_SYS}),
    "aircraft_cost_rate": ("lineitem", {
        "aircraft_type": AIRCRAFT_TYPE,
        "effective_date": "CAST(date_trunc('year', l_shipdate) AS DATE)",
        "crew_cost_per_hour": "l_extendedprice",
        "maint_reserve_per_hour": "l_quantity",
        **LINE_SYS}),
    "airport_fees": ("lineitem", {
        "airport_code": "'A' || CAST(l_suppkey AS STRING)",
        "aircraft_type": AIRCRAFT_TYPE,
        "effective_date": "CAST(date_trunc('month', l_shipdate) AS DATE)",
        "landing_fee": "l_extendedprice",
        **LINE_SYS}),
}

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
               "date": "DATE"}


def fields(source: str) -> list[tuple[str, str]]:
    return ddl_fields(SOURCES[source].schema_ddl)


def select_list(source: str, engine: str) -> list[str]:
    """``CAST(expr AS type) AS col`` for every column of the source schema, in schema order."""
    _, exprs = BRONZE[source]
    out = []
    for name, spark_type in fields(source):
        typ = spark_type if engine == "spark" else _DUCK_TYPES.get(spark_type, spark_type.upper())
        ts = "TIMESTAMP_NTZ" if engine == "spark" else "TIMESTAMP"
        expr = exprs.get(name, "NULL").replace("{TS}", ts)
        out.append(f"CAST(({expr}) AS {typ}) AS {name}")
    return out


def bronze(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    table, _ = BRONZE[source]
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").selectExpr(*select_list(source, "spark"))


def bronze_sql(source: str) -> str:
    table, _ = BRONZE[source]
    return f"SELECT {', '.join(select_list(source, 'duckdb'))} FROM {table}"
