"""Driver queries: each maps (spark, sf_dir) -> DataFrame over the driver tables.

Every query reads whole tables (or data Spark derives from them); the matching
DuckDB text lives in ``tidemark.plans.oracle``. Fixed clocks and run ids make
the results deterministic and replayable.

Scenarios
* coupon   - lineitem as a ticket-coupon bronze (versions per key, soft deletes).
* state    - events as a user-state bronze; purchase events land 2 days late.
  Run 1 at T1 sees what had landed, run 2 at T2 sees the whole table.
* leg      - orders as a flight-leg bronze with text-typed fields.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import governance as gov
from tidemark.functions.cleanse import (
    active, composite_key, date_text, email_structure_valid, email_test_valid, ts_lit,
)
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.merge import merge_upsert
from tidemark.operators.quality import (
    check_column_type, check_rows, check_unique, check_unique_combination, freshness, newest_day, orphans, run_checks,
    run_checks_once, run_fk_checks, update_unique,
)
from tidemark.operators.scd2 import scd2_apply, spliced_history
from tidemark.plans import airline, views
from tidemark.plans.models import refine, run_model, run_outputs, run_snapshot, snapshot_source
from tidemark.session import scratch_path
from tidemark.sources.bronze import (
    ALLOW_ALL, ALLOW_COLUMNS, DELETED, SYNC_DATE, SYNCED, admit_tables, high_water_mark, incremental_filter, land,
    load_profile, scan,
)
from tidemark.sources.changes import api_delta, apply_changes
from tidemark.sources.ingest import diff_against, ingest_api_delta, ingest_change_feed, ingest_file_drop, ingest_snapshot
from tidemark.sources.ranges import rewrite_ranges
from tidemark.sources.tables import VersionedTable, stage, staged
from tidemark.specs import FOREIGN_KEYS, MODELS, SNAPSHOTS, SOURCES, Check, Col, SnapshotSpec, TableSpec
from tidemark.streaming.ingest import file_stream, stream_scd1, stream_scd2

# ---------------------------------------------------------------------------
# Scenario clocks and run ids
# ---------------------------------------------------------------------------
COUPON_NOW = "2002-01-01 00:00:00"
LEG_NOW = "2002-01-01 00:00:00"
DEV_TODAY = "1998-08-02"
T1 = "2024-01-31 00:00:00"          # state run 1
T2 = "2024-02-02 00:00:00"          # state run 2 (everything has landed)
SNAP_CUTOFFS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-02-01 00:00:00")
FEED_SPLIT = "2024-01-16 00:00:00"  # change-feed scenario: first feed before, second feed from here
DIFF_CUTOFF = "1999-01-01 00:00:00"  # snapshot-diff scenario: earlier copy taken here
LINES_PER_RANGE = 20_000
DRIFT_CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")  # schema-drift scenario: a new column, then wider types
FRESH_NOW = "2024-01-31 01:30:00"
RUN_1, RUN_2 = "run-0001", "run-0002"
# Token character for the email scan: not ASCII whitespace, spelled out so every regex engine agrees.
NOT_WHITESPACE = r"[^ \t\n\x0B\f\r]"

# ---------------------------------------------------------------------------
# Specs of the scenario outputs
# ---------------------------------------------------------------------------
COUPON_SPEC = TableSpec(
    "ticket_coupon", "b_coupon", ("ticket_number", "coupon_number"),
    (Col("ticket_number"), Col("coupon_number"), Col("flight_number"), Col("flight_date", "date"),
     Col("total_amount"), Col("commission_amount"),
     Col("net_passenger_revenue", "net", args=("total_amount", "commission_amount")),
     Col("ticket_status")),
    include={"ticket_status": ("FLOWN",)},
    exclude={"ticket_status": ("VOID", "REFUNDED")},
    tiebreak=tuple(views.COUPON_TIEBREAK),
    checks=(Check("not_null", ("ticket_number",)),
            Check("expression", ("total_amount",), "error", "> 0"),
            Check("unique_combination", ("ticket_number", "coupon_number")),
            Check("regex", ("flight_number",), "warn", r"^[A-Z]+$"),
            Check("not_null", ("commission_amount",), "warn"),
            Check("unique", ("ticket_number",), "warn")),
)

STATE_SPEC = TableSpec("user_state", "b_state", ("user_id",),
                       (Col("user_id"), Col("event_id"), Col("event_type"), Col("value")),
                       tiebreak=("event_id",))
EVENT_SPEC = TableSpec("event_log", "b_state", ("event_id",),
                       (Col("event_id"), Col("user_id"), Col("event_type"), Col("value")))
EVENT_SPEC_V1 = TableSpec("event_log", "b_state", ("event_id",),
                          (Col("event_id"), Col("user_id"), Col("event_type")))
STATE_HISTORY = SnapshotSpec("user_state_history", "b_state", ("user_id",),
                             ("user_id", "event_id", "event_type", "value"))

LEG_SPEC = TableSpec(
    "flight_leg", "b_leg", ("flight_id",),
    (Col("flight_id"), Col("flight_number", "varchar"), Col("flight_date", "date"),
     Col("scheduled_dep", "ts"), Col("actual_dep", "ts"), Col("block_hours", "dec"), Col("flight_status")),
    dev_date_col="flight_date",
)
WAYBILL_SPEC = TableSpec(
    "air_waybill", "b_waybill", ("awb_number",),
    (Col("awb_number"), Col("flight_id"), Col("cargo_revenue", src="fjd_amount"), Col("status")),
    exclude={"status": ("CANCELLED",)},
)
JOURNAL_SPEC = TableSpec(
    "gl_journal_entry", "b_journal", ("journal_id",),
    (Col("journal_id"), Col("gl_account_code"), Col("base_amount"), Col("flight_id"), Col("approved_flag")),
    include={"approved_flag": ("Y",)},
    tiebreak=tuple(views.JOURNAL_TIEBREAK),
)
DIFF_KEYS = ("ticket_number", "coupon_number")
DIFF_COMPARE = ("flight_number", "flight_date", "total_amount", "commission_amount", "ticket_status")

# Expected column types checked by q_type_check: (table, column, expected).
TYPE_EXPECTATIONS = (("lineitem", "l_quantity", "double"), ("lineitem", "l_linenumber", "bigint"),
                     ("orders", "o_orderdate", "timestamp"), ("customer", "c_name", "string"),
                     ("events", "user_id", "BIGINT"))
# Sync column per driver table for the load profile (tables without one report NULL).
PROFILE_SYNC = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}
ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# ---------------------------------------------------------------------------
# Shared building blocks
# ---------------------------------------------------------------------------
def silver_coupon(spark: SparkSession, sf: str) -> DataFrame:
    return refine(COUPON_SPEC, views.b_coupon(spark, sf), COUPON_NOW, RUN_1)


def typed_leg(spark: SparkSession, sf: str) -> DataFrame:
    return refine(LEG_SPEC, views.b_leg(spark, sf), LEG_NOW, RUN_1)


def state_runs(spark: SparkSession, sf: str, spec: TableSpec, spec_run1: TableSpec | None = None):
    """Run 1 over what had landed by T1, the watermark, and the run-2 update batch over the whole table."""
    bronze = views.b_state(spark, sf)
    target1 = stage(refine(spec_run1 or spec, views.landed_by(bronze, T1), T1, RUN_1), "state-run1")
    wm = high_water_mark(target1)
    updates2 = refine(spec, bronze, T2, RUN_2, watermark=wm)
    return target1, wm, updates2


def merged_runs(spark: SparkSession, sf: str, spec: TableSpec, spec_run1: TableSpec | None = None) -> DataFrame:
    """The same two runs through a versioned table in key ranges, as the command line runs them."""
    bronze = views.b_state(spark, sf)
    table = VersionedTable(spark, scratch_path(spark, f"merge-{spec.name}"))
    run_model(spec_run1 or spec, views.landed_by(bronze, T1), table, T1, RUN_1)
    run_model(spec, bronze, table, T2, RUN_2)
    return table.read()


def state_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three snapshot runs; the replicated bronze at each cutoff holds one row per user.

    The earlier runs see what was synced before their clock, the last one the whole table.
    """
    bronze = views.b_state(spark, sf)
    history = None
    for cut in SNAP_CUTOFFS:
        seen = bronze if cut == SNAP_CUTOFFS[-1] else bronze.filter(F.col("_synced") < F.lit(cut).cast("timestamp_ntz"))
        upserted = latest_per_key(seen, ["user_id"], "_synced", ["event_id"])
        current = snapshot_source(STATE_HISTORY, upserted)
        history = stage(scd2_apply(history, current, STATE_HISTORY.keys, cut), "state-history")
    return history


def state_feed(df: DataFrame) -> DataFrame:
    """Events as a change feed: an error event is a delete, anything else an update."""
    op = F.when(F.col("event_type") == "error", F.lit("D")).otherwise(F.lit("U"))
    return df.select("user_id", "event_id", "event_type", "value", "_synced", op.alias("op"))


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------
def q_active(spark, sf):
    """rows whose soft-delete flag is FALSE or NULL."""
    return active(views.b_coupon(spark, sf))


def q_silver_ticket_coupon(spark, sf):
    """The ticket-coupon silver batch (filter, then latest per key)."""
    return silver_coupon(spark, sf)


def q_silver_air_waybill(spark, sf):
    """NULL-dropping NOT IN on status, fjd_amount renamed to cargo_revenue."""
    return refine(WAYBILL_SPEC, views.b_waybill(spark, sf), LEG_NOW, RUN_1)


def q_silver_gl_journal(spark, sf):
    """approved_flag = 'Y' before dedup (an unapproved newest version lets an older one win)."""
    return refine(JOURNAL_SPEC, views.b_journal(spark, sf), COUPON_NOW, RUN_1)


def q_typed_leg(spark, sf):
    """try_to_date, try_to_timestamp_ntz, decimal(10,2), varchar."""
    return typed_leg(spark, sf)


def q_dev_limit(spark, sf):
    """Dev limiter keeps flights whose parsed date is within 90 days of 'today'."""
    return refine(LEG_SPEC, views.b_leg(spark, sf), LEG_NOW, RUN_1, dev_today=DEV_TODAY)


def q_incremental_candidates(spark, sf):
    """S3 A1: run-2 rows past the high-water mark or inside the 3-day lookback."""
    _, wm, _ = state_runs(spark, sf, STATE_SPEC)
    bronze = views.b_state(spark, sf)
    return (bronze.filter(incremental_filter(wm, T2))
            .withColumn("via_lookback", ~(F.col("_synced") > F.lit(str(wm)).cast("timestamp_ntz"))))


def q_late_rows_lost(spark, sf):
    """S3 detail 7: rows that landed after run 1 at or below the mark and outside the lookback."""
    _, wm, _ = state_runs(spark, sf, STATE_SPEC)
    bronze = views.b_state(spark, sf)
    landed_late = bronze.filter(views.arrival() >= F.lit(T1).cast("timestamp_ntz"))
    return landed_late.filter(~incremental_filter(wm, T2))


def q_merge_state(spark, sf):
    """Two incremental runs keyed by user_id; first load time is kept on update."""
    return merged_runs(spark, sf, STATE_SPEC)


def q_merge_events(spark, sf):
    """K1: two runs keyed by event_id; the second reads and rewrites only the key ranges of its batch."""
    return merged_runs(spark, sf, EVENT_SPEC)


def q_merge_events_shuffle(spark, sf):
    """K1 with the full-outer shuffle join shape forced."""
    target1, _, updates2 = state_runs(spark, sf, EVENT_SPEC)
    return merge_upsert(target1, updates2, EVENT_SPEC.keys, strategy="shuffle")


def q_merge_only_newer(spark, sf):
    """K1 option: a matched update applies only when its sync time is newer."""
    target1, _, updates2 = state_runs(spark, sf, STATE_SPEC)
    return merge_upsert(target1, updates2, STATE_SPEC.keys, only_if_newer=True, strategy="shuffle")


def q_schema_drift(spark, sf):
    """Run 2 adds the 'value' column; untouched older rows hold NULL."""
    return merged_runs(spark, sf, EVENT_SPEC, EVENT_SPEC_V1)


def q_full_refresh_guard(spark, sf):
    """K8: a refused full refresh runs incrementally (late rows stay lost); an allowed one rebuilds the table."""
    bronze = views.b_state(spark, sf)
    out = []
    for allowed in (False, True):
        spec = replace(STATE_SPEC, allow_full_refresh=allowed)
        table = VersionedTable(spark, scratch_path(spark, "full-refresh"))
        run_model(spec, views.landed_by(bronze, T1), table, T1, RUN_1)
        run_model(spec, bronze, table, T2, RUN_2, full_refresh=True)
        out.append(table.read().withColumn("refresh_allowed", F.lit(allowed)))
    return out[0].unionByName(out[1])


def q_scan_declared(spark, sf):
    """Landed bronze read with its declared schema and the columns asked for."""
    path = scratch_path(spark, "declared")
    airline.bronze(spark, sf, "flight_leg").write.parquet(path)
    return scan(spark, path, SOURCES["flight_leg"].schema_ddl, ["flight_id", "flight_status", "block_hours", SYNCED])


def q_schema_admission(spark, sf):
    """Three landings in turn - narrow types, a new column, wider types - into one keyed bronze table."""
    ev = views.b_state(spark, sf).withColumn("op", F.lit("U"))
    first, second = (F.lit(c).cast("timestamp_ntz") for c in DRIFT_CUTS)
    landings = [
        ev.filter(F.col(SYNCED) < first).select("event_id", F.col("user_id").cast("int"), "event_type", SYNCED, "op"),
        ev.filter((F.col(SYNCED) >= first) & (F.col(SYNCED) < second)).select(
            "event_id", F.col("user_id").cast("int"), "event_type", F.col("value").cast("float"), SYNCED, "op"),
        ev.filter(F.col(SYNCED) >= second).select("event_id", "user_id", "event_type", "value", SYNCED, "op")]
    table = VersionedTable(spark, scratch_path(spark, "drift"))
    for i, landed in enumerate(landings):
        ingest_change_feed(landed, ["event_id"], table, f"run-{i}")
    out = table.read()
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in out.schema.fields if f.name in ("user_id", "value"))
    tables = admit_tables(["events", "new_table"], ["events"], ALLOW_ALL) + admit_tables(["events", "new_table"], ["events"], ALLOW_COLUMNS)
    return out.select("event_id", "user_id", "event_type", "value", F.lit(kinds).alias("kinds"), F.lit(",".join(tables)).alias("admitted"))


def q_ingest_bronze(spark, sf):
    """One bronze table per capture method, each fed twice, the cursor kept with the data."""
    ev, keys = views.b_state(spark, sf).drop(DELETED), ["user_id"]
    new = lambda m: VersionedTable(spark, scratch_path(spark, f"ingest-{m}"))
    early = F.col(SYNCED) < F.lit(FEED_SPLIT).cast("timestamp_ntz")
    feed = state_feed(views.b_state(spark, sf))
    tables = {m: new(m) for m in ("change_feed", "api_delta", "file_drop", "snapshot_diff")}
    for landed in (feed.filter(early), feed):
        ingest_change_feed(landed, keys, tables["change_feed"], tiebreak=["event_id"])
    for landed in (views.landed_by(ev, T1), ev):
        ingest_api_delta(landed, keys, tables["api_delta"], tiebreak=["event_id"])
    base = scratch_path(spark, "ingest-files")
    for rows in (ev.filter(~early), ev.filter(early)):  # the later files land first
        rows.repartition(2, "event_id").write.mode("append").parquet(f"{base}/landing")
        ingest_file_drop(file_stream(spark, f"{base}/landing", ev.schema, 1), keys, tables["file_drop"], f"{base}/checkpoint",
                         tiebreak=["event_id"])
    for now, seen in ((FEED_SPLIT, views.b_state(spark, sf).filter(early)), (T2, views.b_state(spark, sf))):
        copy = active(latest_per_key(seen, keys, SYNCED, ["event_id"])).drop(SYNCED, DELETED)
        ingest_snapshot(copy, keys, tables["snapshot_diff"], now)
    out = [t.read().select(F.lit(m).alias("method"), "user_id", "event_id", "event_type", "value", SYNCED, DELETED)
           for m, t in tables.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def q_scd2(spark, sf):
    """K2 K3 K4 K6: three snapshot runs with tombstones for vanished users."""
    return state_history(spark, sf)


def q_fk_orphans(spark, sf):
    """Documents that have no row among the labels."""
    docs = views.table(spark, sf, "documents").select("doc_id", "source")
    return orphans(docs, views.table(spark, sf, "labels"), ["doc_id"])


def q_fk_composite(spark, sf):
    """Coupons whose (flight_number, flight_date) has no flight leg; NULL date is an orphan."""
    child = silver_coupon(spark, sf).select("ticket_number", "coupon_number", "flight_number", "flight_date")
    return orphans(child, typed_leg(spark, sf), ["flight_number", "flight_date"])


def q_fk_current(spark, sf):
    """Events whose user has no current history row (a current tombstone counts as parent)."""
    child = views.b_state(spark, sf).select("event_id", "user_id")
    return orphans(child, state_history(spark, sf), ["user_id"], parent_filter=F.col("is_current"))


def q_fk_current_live(spark, sf):
    """J3 option: only live current history rows are parents."""
    child = views.b_state(spark, sf).select("event_id", "user_id")
    return orphans(child, state_history(spark, sf), ["user_id"],
                   parent_filter=F.col("is_current") & ~F.col("is_deleted"))


def q_unique(spark, sf):
    """Q4 A3: duplicated (l_orderkey, l_linenumber) tuples."""
    li = views.table(spark, sf, "lineitem")
    return check_unique_combination(li, ["l_orderkey", "l_linenumber"])


def q_unique_incremental(spark, sf):
    """Q4 A3 kept per key range: line items appended in two runs, the second counts the ranges it met again."""
    li = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    table, state = (VersionedTable(spark, scratch_path(spark, n)) for n in ("lines", "lines-unique"))
    early = F.col("l_shipdate") < F.lit(DIFF_CUTOFF).cast("timestamp_ntz")
    for batch in (li.filter(early), li.filter(~early | F.col("l_shipdate").isNull())):
        with staged(batch, "lines") as rows:
            rewrite_ranges(table, rows, "l_orderkey", None, rows_per_range=LINES_PER_RANGE, gather=True)
        out = update_unique(table, state, ["l_orderkey", "l_linenumber"])
    return out


def q_freshness_landed(spark, sf):
    """Q10 over bronze landed by sync day: only the newest day's folder is read."""
    path = scratch_path(spark, "landed-fresh")
    land(views.b_state(spark, sf), path)
    return freshness(newest_day(spark.read.parquet(path)), "events", FRESH_NOW, 1, 4)


def q_unique_value(spark, sf):
    """Q1: customers with more than one order (NULL ignored)."""
    return check_unique(views.table(spark, sf, "orders"), "o_custkey")


def q_not_null(spark, sf):
    """Q2: typed flight legs whose flight_date did not parse."""
    return check_rows(typed_leg(spark, sf), Check("not_null", ("flight_date",))).select("flight_id", "flight_date")


def q_positive(spark, sf):
    """Q3: customers violating c_acctbal > 0 (NULL passes)."""
    cust = views.table(spark, sf, "customer")
    return check_rows(cust, Check("expression", ("c_acctbal",), arg="> 0")).select("c_custkey", "c_acctbal")


def q_positive_amount(spark, sf):
    """Q6: suppliers with a non-null balance <= 0."""
    sup = views.table(spark, sf, "supplier")
    return check_rows(sup, Check("positive", ("s_acctbal",))).select("s_suppkey", "s_acctbal")


def q_email(spark, sf):
    """Every whitespace token containing '@' in every document, both validators."""
    docs = views.table(spark, sf, "documents").filter(F.col("text").contains("@"))
    # whole texts; only maximal non-whitespace runs that contain '@' are extracted and exploded
    tokens = docs.select("doc_id", F.explode(F.regexp_extract_all(
        F.col("text"), F.lit(f"{NOT_WHITESPACE}*@{NOT_WHITESPACE}*"), F.lit(0))).alias("token"))
    return (tokens
            .select("doc_id", "token", email_structure_valid("token").alias("macro_valid"),
                    email_test_valid("token").alias("test_valid")))


def q_regex(spark, sf):
    """Q5: market segments and brands not matching ^[A-Z0-9]+$."""
    chk = Check("regex", ("v",), arg=r"^[A-Z0-9]+$")
    cust = views.table(spark, sf, "customer").select(F.lit("customer").alias("table_name"),
                                                       F.col("c_mktsegment").alias("v"))
    part = views.table(spark, sf, "part").select(F.lit("part").alias("table_name"), F.col("p_brand").alias("v"))
    return check_rows(cust.unionByName(part), chk).withColumnRenamed("v", "value")


def q_type_check(spark, sf):
    """Q8: (col, expected, actual) for columns whose type differs, case-insensitively."""
    parts = [check_column_type(views.table(spark, sf, t), c, e) for t, c, e in TYPE_EXPECTATIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_checks_suite(spark, sf):
    """Q11: the coupon check suite; the refined batch is computed once, row-level checks are counted on its way."""
    return run_checks_once("ticket_coupon", silver_coupon(spark, sf), COUPON_SPEC.checks)


def q_freshness(spark, sf):
    """Q10: latest sync per source against fixed warn/error limits."""
    return (freshness(views.b_state(spark, sf), "events", FRESH_NOW, 1, 4)
            .unionByName(freshness(views.b_coupon(spark, sf), "coupons", FRESH_NOW, 26, 30))
            .unionByName(freshness(views.b_leg(spark, sf), "legs", FRESH_NOW, 26, 30)))


def q_profile(spark, sf):
    """Q12 A2: row count and latest sync per driver table."""
    tables = {}
    for t in ALL_TABLES:
        df = views.table(spark, sf, t)
        sync = PROFILE_SYNC.get(t)
        tables[t] = df.select(F.col(sync).alias("_synced")) if sync else df.select(F.lit(1).alias("_one"))
    return load_profile(tables)


def q_snapshot_diff(spark, sf):
    """Live coupon state at an earlier copy vs now, compared null-safely per column."""
    b = views.b_coupon(spark, sf)
    cols = list(DIFF_KEYS) + list(DIFF_COMPARE)

    def state(df):
        upserted = latest_per_key(df, DIFF_KEYS, "_synced", views.COUPON_TIEBREAK)
        return active(upserted).select(*cols)

    # the earlier copy as ingested bronze: per key range a digest tells whether the new copy must be joined there
    table = VersionedTable(spark, scratch_path(spark, "diff"))
    ingest_snapshot(state(b.filter(F.col("_synced") < F.lit(DIFF_CUTOFF).cast("timestamp_ntz"))), DIFF_KEYS, table, DIFF_CUTOFF)
    return diff_against(table, stage(state(b), "diff-copy"), DIFF_KEYS)[0]


def q_apply_changes(spark, sf):
    """Two change feeds applied; a delete keeps the last bronze payload."""
    feed = state_feed(views.b_state(spark, sf))
    split = F.lit(FEED_SPLIT).cast("timestamp_ntz")
    bronze0 = stage(apply_changes(None, feed.filter(F.col("_synced") < split), ["user_id"], tiebreak=["event_id"]), "bronze")
    return apply_changes(bronze0, feed.filter(F.col("_synced") >= split), ["user_id"], tiebreak=["event_id"])


def q_apply_changes_shuffle(spark, sf):
    """S5 with the full-outer shuffle shape forced (same result as the broadcast shape)."""
    feed = state_feed(views.b_state(spark, sf))
    split = F.lit(FEED_SPLIT).cast("timestamp_ntz")
    bronze0 = apply_changes(None, feed.filter(F.col("_synced") < split), ["user_id"], tiebreak=["event_id"])
    return apply_changes(bronze0, feed.filter(F.col("_synced") >= split), ["user_id"], tiebreak=["event_id"],
                         strategy="shuffle")


def q_incremental_landed(spark, sf):
    """S3 over bronze landed by sync day: the run-2 bound also prunes whole day folders."""
    path = scratch_path(spark, "landed-events")
    land(views.b_state(spark, sf), path)
    landed = spark.read.parquet(path)
    _, wm, _ = state_runs(spark, sf, STATE_SPEC)
    cols = [c for c in landed.columns if c != SYNC_DATE]
    return (landed.filter(incremental_filter(wm, T2, partition_col=SYNC_DATE)).select(*cols)
            .withColumn("via_lookback", ~(F.col("_synced") > F.lit(str(wm)).cast("timestamp_ntz"))))


def q_api_delta(spark, sf):
    """Full historical load of what had landed, then only rows past the cursor."""
    bronze = views.b_state(spark, sf).drop("_deleted")
    first = views.landed_by(bronze, T1).withColumn("op", F.lit("U"))
    bronze0 = stage(apply_changes(None, first, ["user_id"], tiebreak=["event_id"]), "bronze")
    cursor = bronze0.agg(F.max("_synced")).first()[0]
    return apply_changes(bronze0, api_delta(bronze, cursor), ["user_id"], tiebreak=["event_id"])


def q_mask_customer(spark, sf):
    """Tagged customer name masked for an unprivileged role; untagged columns clear."""
    cust = views.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return gov.masked_view(gov.tag_pii(cust, {"c_name": "FULL_NAME"}), roles=["ANALYST_ROLE"])


def q_mask_orders(spark, sf):
    """A tagged date masked to January 1 of its year."""
    o = views.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return gov.masked_view(gov.tag_pii(o, {"order_date": "DOB"}), roles=["ANALYST_ROLE"])


def q_composite_key(spark, sf):
    """K5: priority || '-' || status || '-' || date text; a NULL part makes the key NULL."""
    o = views.table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))   # pending: not yet known
    return o.select("o_orderkey",
                    composite_key(F.col("o_orderpriority"), status, date_text(F.col("o_orderdate").cast("date")))
                    .alias("business_key"))


def q_stream_scd1(spark, sf):
    """Events landed as files, streamed exactly once, merged per micro-batch."""
    base = scratch_path(spark, "stream-scd1")
    landing = f"{base}/landing"
    bronze = views.b_state(spark, sf)
    bronze.repartitionByRange(4, "_synced").write.parquet(landing)
    table = VersionedTable(spark, f"{base}/silver")
    stream = file_stream(spark, landing, bronze.schema, max_files_per_trigger=2)
    stream_scd1(stream, STATE_SPEC, table, f"{base}/_checkpoint", T2)
    return table.read().select("user_id", "event_id", "event_type", "value", "_bronze_sync_timestamp")


def q_stream_scd2(spark, sf):
    """Events landed as files in no order of time, streamed one file a batch, spliced into a history."""
    base = scratch_path(spark, "stream-scd2")
    bronze = views.b_state(spark, sf)
    bronze.repartition(4, "event_id").write.parquet(f"{base}/landing")
    table = VersionedTable(spark, f"{base}/history")
    stream_scd2(file_stream(spark, f"{base}/landing", bronze.schema, max_files_per_trigger=1), STATE_HISTORY, table,
                f"{base}/_checkpoint", tiebreak=("event_id",))
    return spliced_history(table.read())


# ---------------------------------------------------------------------------
# The 13 whole-model compositions (M1-M13) over airline-shaped bronze
# ---------------------------------------------------------------------------
MODEL_T1 = "1998-06-01 00:00:00"    # run 1 sees the rows synced before this instant
MODEL_T2 = "2001-11-05 00:00:00"    # run 2 sees every row


def model_query(name: str):
    """Two incremental runs of a keyed output through ``run_model``."""
    spec = MODELS[name]

    def q(spark, sf):
        bronze = airline.bronze(spark, sf, spec.source)
        table = VersionedTable(spark, scratch_path(spark, f"model-{name}"))
        run_model(spec, bronze.filter(F.col("_synced") < ts_lit(MODEL_T1)), table, MODEL_T1, RUN_1)
        run_model(spec, bronze, table, MODEL_T2, RUN_2)
        return table.read()

    q.__doc__ = f"M: keyed output {name}, two runs merged."
    return q


def history_query(name: str):
    """Two snapshot runs of a history output through ``run_snapshot``."""
    spec = SNAPSHOTS[name]

    def q(spark, sf):
        bronze = airline.bronze(spark, sf, spec.source)
        table = VersionedTable(spark, scratch_path(spark, f"history-{name}"))
        run_snapshot(spec, bronze.filter(F.col("_synced") < ts_lit(MODEL_T1)), table, MODEL_T1, RUN_1)
        run_snapshot(spec, bronze, table, MODEL_T2, RUN_2)
        return table.read()

    q.__doc__ = f"M: history output {name}, two snapshot runs."
    return q


def q_model_pnr_masked(spark, sf):
    """G4 G5 on the passenger-name-record output: tagged PII masked for an unprivileged role."""
    out = model_query("passenger_name_record")(spark, sf)  # the committed table carries its tags
    return gov.masked_view(out, roles=["ANALYST_ROLE"], required=gov.PASSENGER_TAGS)


def model_outputs(spark, sf, names=None) -> dict[str, DataFrame]:
    """The committed outputs (checks read tables, as after a run)."""
    wanted = set(names) if names else set(MODELS) | set(SNAPSHOTS)
    jobs = {n: (lambda n=n: model_query(n)(spark, sf)) for n in MODELS if n in wanted}
    jobs.update({n: (lambda n=n: history_query(n)(spark, sf)) for n in SNAPSHOTS if n in wanted})
    return run_outputs(jobs)


def q_model_checks(spark, sf):
    """Q1-Q5 Q11: every declared check of the 13 outputs, one summary row each, with severity."""
    outs = model_outputs(spark, sf)
    parts = [run_checks(n, outs[n], spec.checks) for n, spec in list(MODELS.items()) + list(SNAPSHOTS.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_model_fk_suite(spark, sf):
    """The five referential assertions over the model outputs."""
    names = {fk.child for fk in FOREIGN_KEYS} | {fk.parent for fk in FOREIGN_KEYS}
    return run_fk_checks(model_outputs(spark, sf, names), FOREIGN_KEYS)


QUERIES = {name: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}
QUERIES.update({f"q_model_{n}": model_query(n) for n in MODELS})
QUERIES.update({f"q_history_{n}": history_query(n) for n in SNAPSHOTS})
