"""Some outputs against SQL written by hand over the driver tables: nothing here is derived from the specs."""

import duckdb
import pytest

from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

AIR_WAYBILL = """
WITH rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS awb_number, CAST(o_custkey AS VARCHAR) AS flight_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS cargo_revenue,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'CANCELLED' END AS status,
         CAST(o_custkey AS DECIMAL(12,2)) AS chargeable_weight_kg, o_orderdate AS synced
  FROM orders),
live AS (SELECT * FROM rows WHERE status <> 'CANCELLED'),  -- a waybill without a status is dropped too
mark AS (SELECT max(synced) AS mark FROM live WHERE synced < TIMESTAMP '1998-06-01')
SELECT awb_number, flight_id, cargo_revenue, status, chargeable_weight_kg, synced AS _bronze_sync_timestamp,
       CASE WHEN synced < TIMESTAMP '1998-06-01' THEN TIMESTAMP '1998-06-01' ELSE TIMESTAMP '2001-11-05' END AS _silver_load_timestamp,
       CASE WHEN synced > (SELECT mark FROM mark) OR synced >= TIMESTAMP '2001-11-02' THEN 'run-0002' ELSE 'run-0001' END AS _run_id,
       CAST(NULL AS BOOLEAN) AS _is_deleted
FROM live
"""

RESERVATION = """
WITH rows AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS pnr_locator, CAST(o_orderdate AS DATE) AS creation_date,
         o_orderpriority AS booking_channel, o_orderdate AS synced, (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS gone
  FROM orders),
live AS (SELECT * FROM rows WHERE NOT gone),
one AS (SELECT DISTINCT ON (pnr_locator) * FROM live WHERE synced < TIMESTAMP '1998-06-01'
        ORDER BY pnr_locator, synced DESC, creation_date DESC, booking_channel DESC),
mark AS (SELECT max(synced) AS mark FROM one),
two AS (SELECT DISTINCT ON (pnr_locator) * FROM live
        WHERE synced > (SELECT mark FROM mark) OR synced >= TIMESTAMP '2001-11-02'
        ORDER BY pnr_locator, synced DESC, creation_date DESC, booking_channel DESC)
SELECT pnr_locator, creation_date, booking_channel, synced AS _bronze_sync_timestamp,
       CASE WHEN pnr_locator IN (SELECT pnr_locator FROM one) THEN TIMESTAMP '1998-06-01' ELSE TIMESTAMP '2001-11-05' END AS _silver_load_timestamp,
       'run-0002' AS _run_id, gone AS _is_deleted
FROM two
UNION ALL
SELECT pnr_locator, creation_date, booking_channel, synced, TIMESTAMP '1998-06-01', 'run-0001', gone
FROM one WHERE pnr_locator NOT IN (SELECT pnr_locator FROM two)
"""

FLEET = """
WITH rows AS (
  SELECT 'DQ-' || CAST(l_suppkey AS VARCHAR) AS aircraft_reg, l_returnflag || l_linestatus AS aircraft_type,
         CAST(l_quantity AS DECIMAL(18,4)) AS fuel_burn_rate, CAST(l_discount AS DECIMAL(18,4)) AS maint_reserve_rate,
         l_shipdate AS _synced,
         CASE WHEN l_linestatus = 'O' AND l_quantity > 45 THEN TRUE WHEN l_linestatus = 'F' THEN FALSE END AS _deleted
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY aircraft_reg, half ORDER BY _synced DESC NULLS FIRST, aircraft_type DESC NULLS LAST,
         fuel_burn_rate DESC NULLS LAST, maint_reserve_rate DESC NULLS LAST, _deleted DESC NULLS LAST) AS n
  FROM (SELECT *, 1 AS half FROM rows WHERE _synced < TIMESTAMP '1998-06-01' UNION ALL SELECT *, 2 FROM rows)),
newest AS (SELECT * FROM ranked WHERE n = 1 AND _deleted IS DISTINCT FROM TRUE),
a AS (SELECT * FROM newest WHERE half = 1),
b AS (SELECT * FROM newest WHERE half = 2),
versions AS (
  SELECT a.aircraft_reg, a.aircraft_type, a.fuel_burn_rate, a.maint_reserve_rate, a._synced AS valid_from,
         CASE WHEN b.aircraft_reg IS NULL THEN TIMESTAMP '2001-11-05' WHEN b._synced > a._synced THEN b._synced
              ELSE TIMESTAMP '9999-12-31' END AS valid_to, FALSE AS is_deleted
  FROM a LEFT JOIN b USING (aircraft_reg)
  UNION ALL  -- gone by the second snapshot
  SELECT aircraft_reg, aircraft_type, fuel_burn_rate, maint_reserve_rate, TIMESTAMP '2001-11-05', TIMESTAMP '9999-12-31', TRUE
  FROM a WHERE aircraft_reg NOT IN (SELECT aircraft_reg FROM b)
  UNION ALL
  SELECT b.aircraft_reg, b.aircraft_type, b.fuel_burn_rate, b.maint_reserve_rate, b._synced, TIMESTAMP '9999-12-31', FALSE
  FROM b LEFT JOIN a USING (aircraft_reg) WHERE a.aircraft_reg IS NULL OR b._synced > a._synced)
SELECT * FROM versions
"""


@pytest.mark.parametrize("query,sql", [("q_model_air_waybill", AIR_WAYBILL), ("q_model_reservation_pnr", RESERVATION),
                                       ("q_history_aircraft_fleet_history", FLEET)])
def test_output_equals_sql_written_by_hand(spark, query, sql):
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = sorted(repr(tuple(r)) for r in QUERIES[query](spark, SF).select(*columns).collect())
    assert got == want and len(want) > 5
