"""Whole-output plans (survey M1-M13, E2, E3): spec -> one DataFrame plan -> versioned table.

``refine`` builds the update batch of a keyed output as ONE lazy plan:
scan -> incremental filter (literal bounds, pushed to Parquet) -> dev limiter ->
active + business filter -> latest-per-key (partial top-1, key shuffle, final top-1)
-> typed projection + audit columns. ``run_model`` stages that batch (a reliable
staged Parquet write cuts lineage and gives the merge an exact size), merges it into the
key ranges it meets and commits a new version. ``run_snapshot`` does the same for
history outputs with ``scd2_apply``.
"""

from __future__ import annotations

import logging
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.cleanse import (
    LOOKBACK_DAYS, MIN_DATE, audit_columns, is_active, net_amount, status_filter, to_decimal, to_varchar,
    try_to_date, try_to_timestamp_ntz, within_days,
)
from tidemark.operators.dedup import KeyShape, by_key, latest_per_key
from tidemark.operators.keys import any_null
from tidemark.operators.merge import merge_upsert
from tidemark.operators.quality import check_counters, gate
from tidemark.functions.governance import tag_pii
from tidemark.operators.scd2 import business_key, scd2_apply
from tidemark.sources.bronze import SYNC_DATE, high_water_mark, incremental_filter
from tidemark.sources.ranges import MAX_RANGES, ROWS_PER_RANGE, KeyRanges, rewrite_ranges, split_ranges
from tidemark.sources.tables import RANGE, VersionedTable, bucketed, few_tasks, fits_sort, row_index, staged
from tidemark.specs import Col, SnapshotSpec, TableSpec

log = logging.getLogger(__name__)

ROW_ORDER = "_row_order"
BUSINESS_KEY = "_business_key"


def column_expr(c: Col, schema: StructType | None = None) -> Column:
    src = F.col(c.src or c.name)
    if c.kind == "keep":
        e = src
    elif c.kind == "varchar":
        e = to_varchar(src)
    elif c.kind == "date":
        e = try_to_date(src)
    elif c.kind == "ts":
        e = try_to_timestamp_ntz(src)
    elif c.kind == "dec":
        e = to_decimal(src, 10, 2)
    elif c.kind == "net":
        e = net_amount(*c.args)
        if schema is not None:  # a decimal subtraction widens the type: cast back
            e = e.cast(schema[c.args[0]].dataType)
    else:
        raise ValueError(f"unknown column kind {c.kind!r}")
    return e.alias(c.name)


def row_filter(spec: TableSpec) -> Column:
    """F1 active records AND the spec's business filters (F2-F4); evaluated before dedup."""
    cond = is_active("_deleted")
    for col, values in spec.include.items():
        cond = cond & status_filter(col, include=values)
    for col, values in spec.exclude.items():
        cond = cond & status_filter(col, exclude=values)
    return cond


def tiebreak_columns(spec: TableSpec) -> list[str]:
    """The spec's tiebreak, or by default every selected source column plus the delete flag.

    The source warehouse leaves ties on (key, sync time) to chance; a total order
    makes every run reproducible (rows equal in all of these project identically).
    """
    if spec.tiebreak:
        return list(spec.tiebreak)
    return [c for c in spec.source_columns if c not in spec.keys] + ["_deleted"]


def live_rows(spec: TableSpec, bronze: DataFrame, now, watermark=None, lookback_days: int = LOOKBACK_DAYS, dev_today=None,
              dev_days: int = 90) -> DataFrame:
    """The source columns of the rows a run looks at: incremental filter, dev limiter, active and business filters."""
    extra = [t for t in tiebreak_columns(spec) if t not in spec.source_columns and t != "_deleted"]
    if watermark is not None:
        part = SYNC_DATE if SYNC_DATE in bronze.columns else None
        bronze = bronze.filter(incremental_filter(watermark, now, lookback_days, partition_col=part))
    src = bronze.select(*spec.source_columns, *extra, "_synced", "_deleted")
    if dev_today is not None and spec.dev_date_col:
        src = src.filter(within_days(spec.dev_date_col, dev_days, dev_today))
    return src.filter(row_filter(spec))


def refine_live(spec: TableSpec, live: DataFrame, now, run_id: str, with_order: bool = False) -> DataFrame:
    """The newest of the live rows per key, typed, with audit columns."""
    tiebreak = tiebreak_columns(spec)
    latest = latest_per_key(live, spec.keys, "_synced", tiebreak)
    place = [F.struct(F.col("_synced").isNull().alias("unsynced"), "_synced", *tiebreak).alias(ROW_ORDER)] if with_order else []
    return latest.select(*[column_expr(c, latest.schema) for c in spec.columns], *audit_columns(now, run_id), *place)


def refine(spec: TableSpec, bronze: DataFrame, now, run_id: str, watermark=None,
           lookback_days: int = LOOKBACK_DAYS, dev_today=None, dev_days: int = 90, with_order: bool = False) -> DataFrame:
    """The update batch of one keyed output (no I/O). ``watermark=None`` means first run.

    ``with_order`` adds ``ROW_ORDER``: the row's place among the rows of its key, larger is later, as the
    deduplication orders them (a NULL sync time last of all, then sync time, then tiebreak with NULLs lowest).
    """
    return refine_live(spec, live_rows(spec, bronze, now, watermark, lookback_days, dev_today, dev_days), now, run_id, with_order)


def snapshot_rows(spec: SnapshotSpec, bronze: DataFrame) -> DataFrame:
    return bronze.select(*spec.payload, "_synced", "_deleted")


def snapshot_tiebreak(spec: SnapshotSpec) -> list[str]:
    return [c for c in spec.payload if c not in spec.keys] + ["_deleted"]


def snapshot_source(spec: SnapshotSpec, bronze: DataFrame) -> DataFrame:
    """The ephemeral relation of a history output: the newest row per key (W2), unless it is a deleted one.

    Over bronze with one row per key the order of the two steps makes no difference; over append-only bronze a
    key whose newest row is deleted must vanish, not fall back to an older live row.
    """
    src = snapshot_rows(spec, bronze)
    return latest_per_key(src, spec.keys, spec.updated_at, snapshot_tiebreak(spec)).filter(is_active("_deleted"))


def upsert(spec: TableSpec, table: VersionedTable, updates: DataFrame, run_id: str, only_if_newer: str | None = None,
           batch_id: int | None = None, rows_per_range: int = ROWS_PER_RANGE, checked: bool = False,
           keys: DataFrame | None = None, shape: KeyShape = KeyShape()) -> int:
    """K1 into a ``VersionedTable``: merges a staged batch into the key ranges it meets; returns the new version.

    ``only_if_newer`` names a column: a stored row gives way only to an update that is larger there. ``checked``
    counts the spec's row-level checks while writing and publishes only if those of error severity hold (Q11).
    A large batch that is in buckets by key, with its ``keys`` and ``shape``, meets stored rows put in buckets too.
    """
    plain = plain_outputs(spec, shape)
    current = table.current_version()
    folders = len((table.commit_info(current).get("ranges") or {"ids": ()})["ids"]) + 1 if current else 1
    newer = {"only_if_newer": only_if_newer is not None, "order_col": only_if_newer or "_bronze_sync_timestamp"}
    with ExitStack() as copies:
        def combine(stored: DataFrame | None, changes: DataFrame) -> DataFrame:
            if shape.buckets and stored is not None:  # rows with a NULL key part match nothing
                here = copies.enter_context(bucketed(stored.filter(~any_null(spec.keys)), list(spec.keys), shape.buckets,
                                                     f"{spec.name}-stored", plain, fits_stored(stored, shape)))
                merged = merge_upsert(here, changes.filter(~any_null(spec.keys)), spec.keys, spec.keep_on_update, strategy="bucketed", **newer)
                merged = few_tasks(merged, folders)
                for alone in (stored, changes):
                    merged = merged.unionByName(few_tasks(alone.filter(any_null(spec.keys)), folders), allowMissingColumns=True)
            else:
                merged = merge_upsert(stored, changes, spec.keys, spec.keep_on_update, **newer)
            return tag_pii(merged, spec.pii_tags)  # the merge's expressions drop column metadata

        version = rewrite_ranges(table, updates, spec.keys[0], combine, run_id, batch_id, {**output_metrics(), **counters(spec, checked)},
                                 largest=("high_water_mark",), rows_per_range=rows_per_range, gate=spec_gate(spec, checked), keys=keys, plain=plain)
    table.vacuum()
    return version


def run_model(spec: TableSpec, bronze: DataFrame, table: VersionedTable, now, run_id: str,
              lookback_days: int = LOOKBACK_DAYS, dev_today=None, full_refresh: bool = False,
              batch_id: int | None = None, rows_per_range: int = ROWS_PER_RANGE, checked: bool = False) -> int:
    """Incremental run of a keyed output into a ``VersionedTable``; returns the new version."""
    if full_refresh and not spec.allow_full_refresh:
        log.warning("%s: full refresh requested but disabled; running incrementally", spec.name)
        full_refresh = False
    first = full_refresh or table.current_version() is None
    # the mark was observed while the current version was written; scan only if it is missing
    wm = None if first else table.metrics().get("high_water_mark") or high_water_mark(table.read())
    live = live_rows(spec, bronze, now, wm, lookback_days, dev_today)
    held = 0 if first else table.metrics().get("rows", 0)
    with by_key(live, spec.keys, "_synced", tiebreak_columns(spec), f"{spec.name}-rows", held) as (rows, shape):
        updates = refine_live(spec, rows, now, run_id)
        if first:  # S9: the batch is the table
            return replace_all(spec, table, updates, rows, shape, run_id, batch_id, rows_per_range, checked)
        if shape.buckets:
            return upsert(spec, table, updates, run_id, batch_id=batch_id, rows_per_range=rows_per_range, checked=checked,
                          keys=refine_keys(spec, rows), shape=shape)
        with staged(updates, f"{spec.name}-updates") as updates:
            return upsert(spec, table, updates, run_id, batch_id=batch_id, rows_per_range=rows_per_range, checked=checked)


def refine_keys(spec: TableSpec, rows: DataFrame) -> DataFrame:
    """The typed keys of live rows, repeats included."""
    return rows.select(*[column_expr(c, rows.schema) for c in spec.columns if c.name in spec.keys])


ADDED_BYTES = 64  # of the columns that a run adds to those of its source


def fits_stored(stored: DataFrame, shape: KeyShape) -> bool:
    """Whether a task that reads stored rows sorts them in memory; their number comes from the files' footers alone."""
    found = stored.select(row_index().alias("i")).agg(F.max("i")).first()[0]
    return fits_sort(stored.sparkSession, (found or 0) + 1, shape.row_bytes + ADDED_BYTES)


def plain_outputs(spec: TableSpec, shape: KeyShape) -> list[str]:
    """Output columns of source columns that need no dictionary."""
    return [c.name for c in spec.columns if (c.src or c.name) in shape.plain]


def replace_all(spec: TableSpec, table: VersionedTable, updates: DataFrame, rows: DataFrame, shape: KeyShape, run_id: str,
                batch_id: int | None, rows_per_range: int, checked: bool) -> int:
    """The batch becomes the table; a large one is laid out in ranges before it is written, from its keys."""
    ranges = KeyRanges.of(updates, spec.keys[0])
    if shape.keys > 2 * rows_per_range:
        ranges = ranges.cut(refine_keys(spec, rows), min(-(-shape.keys // rows_per_range), MAX_RANGES), shape.rows)
    with_range = few_tasks(tag_pii(updates, spec.pii_tags).withColumn(RANGE, ranges.column()), len(ranges.ids) + 1)
    version = table.commit(with_range, run_id=run_id, batch_id=batch_id, partition_by=[RANGE],
                           observe={**output_metrics(), **counters(spec, checked)}, gate=spec_gate(spec, checked),
                           extra={"ranges": ranges.dump()}, plain=plain_outputs(spec, shape))
    held = table.metrics(version)["rows"]
    return split_ranges(table, list(ranges.ids), held, rows_per_range, run_id) if held > 2 * rows_per_range * len(ranges.ids) else version


def counters(spec: TableSpec, checked: bool) -> dict[str, Column]:
    return check_counters(spec.checks) if checked else {}


def spec_gate(spec: TableSpec, checked: bool):
    return (lambda found: gate(spec.name, spec.checks, found)) if checked else None


def output_metrics() -> dict:  # noqa: N802 - a factory of Column expressions
    """Observed during every keyed-output write: rows written and the next run's high-water mark."""
    return {"rows": F.count(F.lit(1)),
            "high_water_mark": F.coalesce(F.max("_bronze_sync_timestamp"), F.lit(MIN_DATE).cast("timestamp_ntz"))}


def run_snapshot(spec: SnapshotSpec, bronze: DataFrame, table, now, run_id: str) -> int:
    """Snapshot a history output into a ``VersionedTable``; returns the new version.

    Only the current slice is read for the join and only this run's rows are written;
    closed rows of earlier runs stay in their folders (append-only history).
    """
    history, src, alone = table.read(), snapshot_rows(spec, bronze), any_null(spec.keys)
    keyed = src.withColumn(BUSINESS_KEY, business_key(spec.keys, src.schema))
    stored = history.filter(F.col("is_current")) if history is not None else None
    apply = {"updated_at": spec.updated_at, "include_closed": False}
    with ExitStack() as copies:
        rows, shape = copies.enter_context(by_key(keyed, spec.keys, spec.updated_at, snapshot_tiebreak(spec), f"{spec.name}-rows",
                                                  stored.count() if stored is not None else 0, [BUSINESS_KEY], apart=True))
        plain = [*shape.plain, "scd_id"]
        if not shape.buckets:
            return table.commit_history(scd2_apply(history, snapshot_source(spec, bronze), spec.keys, now, **apply), run_id=run_id)
        # many rows: both sides in buckets by business key; rows with a NULL key part match nothing
        current = latest_per_key(rows, [BUSINESS_KEY, *spec.keys], spec.updated_at, snapshot_tiebreak(spec)).filter(is_active("_deleted"))
        here = None
        if stored is not None:
            named = stored.filter(~alone).withColumn(BUSINESS_KEY, business_key(spec.keys, history.schema))
            here = copies.enter_context(bucketed(named, [BUSINESS_KEY], shape.buckets, f"{spec.name}-stored", plain,
                                                 fits_stored(stored, shape)))
        produced = scd2_apply(here, current, spec.keys, now, key_col=BUSINESS_KEY, **apply)
        if shape.alone or (stored is not None and not stored.filter(alone).isEmpty()):
            rest = scd2_apply(stored.filter(alone) if stored is not None else None, snapshot_source(spec, bronze.filter(alone)),
                              spec.keys, now, **apply)
            produced = produced.unionByName(rest)
        return table.commit_history(produced, run_id=run_id, plain=plain)


# Fixed value: parallel model threads of a production run (the reference's client setting).
MODEL_THREADS = 4


def run_outputs(jobs: dict, threads: int = MODEL_THREADS) -> dict:
    """Run independent output builds concurrently, like the reference's 4 model threads.

    ``jobs`` maps a name to a zero-argument callable that runs one output (its own
    Spark jobs) and returns its result. Spark schedules the concurrent jobs across
    the cluster; nothing but the per-job results passes through the driver.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
