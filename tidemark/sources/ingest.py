"""Bronze ingest (survey S5-S8, S10): one current row per key, deletes flagged, by the source's capture method.

====================  ==================================================================================
change_feed           change rows (``op`` I/U/D) past the cursor; the latest per key is applied
api_delta             rows past the cursor, as upserts
file_drop             new files, each exactly once (file stream); a row applies unless a newer one is stored
snapshot_diff         a full copy; key ranges whose digests equal the last copy's are not read, the others are
                      joined with the stored rows, and what differs is applied at the run's clock
====================  ==================================================================================

Bronze is a keyed table in key ranges (``sources.ranges``): a run rewrites the ranges that hold a changed key. The
cursor (the largest sync time applied), the micro-batch id and the copy's digests are part of the commit, so data
and position move together: a run that fails before its commit is simply run again.

Schemas only grow (S10): a new column reads NULL on older rows, a column that arrives wider widens the table, one that
arrives narrower is widened to it, and types without a common wider one stop the run before anything is written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleanse import ts_lit
from tidemark.sources.bronze import ALLOW_ALL, DELETED, SYNCED, admit_tables, conform, merged_schema
from tidemark.sources.changes import OP_UPDATE, api_delta, apply_latest, latest_changes, snapshot_diff
from tidemark.sources.ranges import ROWS_PER_RANGE, KeyRanges, rewrite_ranges
from tidemark.sources.tables import VersionedTable, staged
from tidemark.specs import MODELS, SNAPSHOTS, SOURCES

CURSOR = "cursor"
# business key of every source table
SOURCE_KEYS: dict[str, tuple[str, ...]] = {spec.source: spec.keys for spec in [*MODELS.values(), *SNAPSHOTS.values()]}


def apply_batch(table: VersionedTable, batch: DataFrame, keys: Sequence[str], run_id: str = "", tiebreak: Sequence[str] = (),
                newer_only: bool = False, batch_id: int | None = None, extra: dict | None = None,
                rows_per_range: int = ROWS_PER_RANGE) -> int | None:
    """Applies change rows (payload, ``op``, ``_synced``) to a bronze table; returns the current version.

    Equal sync times are settled by ``tiebreak`` (by default the whole payload), within the batch and, with
    ``newer_only``, against the stored row: then the order in which batches come makes no difference.
    """
    tiebreak = list(tiebreak) or [c for c in batch.columns if c not in (*keys, "op", SYNCED, DELETED)]
    newer_by = (SYNCED, *tiebreak) if newer_only else ()
    with staged(latest_changes(batch, keys, "op", SYNCED, tiebreak), "ingest") as changes:
        stored = table.read()
        schema = merged_schema(stored.schema, changes.schema) if stored is not None else changes.schema

        def combine(old: DataFrame | None, new: DataFrame) -> DataFrame:
            old = None if old is None else conform(old, schema)
            return apply_latest(old, conform(new, schema), keys, "shuffle", newer_by)

        if stored is None and not changes.take(1):
            return None
        return rewrite_ranges(table, changes, keys[0], combine, run_id, batch_id, {CURSOR: F.max(SYNCED)}, largest=(CURSOR,),
                              rows_per_range=rows_per_range, extra=extra)


def ingest_change_feed(landed: DataFrame, keys: Sequence[str], table: VersionedTable, run_id: str = "", **options) -> int | None:
    cursor = table.metrics().get(CURSOR)
    feed = landed if cursor is None else landed.filter(F.col(SYNCED) > ts_lit(cursor))
    return apply_batch(table, feed, keys, run_id, **options)


def ingest_api_delta(landed: DataFrame, keys: Sequence[str], table: VersionedTable, run_id: str = "", **options) -> int | None:
    """The first run is the full historical load; later ones read past the cursor only."""
    cursor = table.metrics().get(CURSOR)
    rows = landed.withColumn("op", F.lit(OP_UPDATE)) if cursor is None else api_delta(landed, cursor)
    return apply_batch(table, rows.drop(DELETED), keys, run_id, **options)


def ingest_file_drop(stream: DataFrame, keys: Sequence[str], table: VersionedTable, checkpoint: str, run_id: str = "",
                     **options) -> int | None:
    """Drains a file stream; files may come in any order, so an older row never replaces a newer one."""
    from tidemark.streaming.ingest import drain

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.drop(DELETED).withColumn("op", F.lit(OP_UPDATE))
        apply_batch(table, rows, keys, f"{run_id}-{batch_id}", newer_only=True, batch_id=batch_id, **options)

    drain(stream, per_batch, checkpoint)
    return table.current_version()


# --- snapshot diff in two phases ------------------------------------------------------------
def range_digests(df: DataFrame, ranges: KeyRanges, columns: Sequence[str]) -> dict[str, list[str]]:
    """Per key range: row count and two order-free sums of independent row hashes (a row a range to the driver)."""
    columns = list(columns)
    whole = "decimal(38,0)"
    found = df.groupBy(ranges.column().alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast(whole)).alias("a"),
        F.sum(F.xxhash64(F.lit(1), *columns).cast(whole)).alias("b")).collect()
    return {str(r.r): [str(r.n), str(r.a), str(r.b)] for r in found}


def changed_ranges(table: VersionedTable, copy: DataFrame, columns: Sequence[str]) -> tuple[KeyRanges, list[int], dict]:
    """(ranges, those whose digests differ from the last copy's, the copy's digests)."""
    info = table.commit_info(table.current_version())
    ranges = KeyRanges.load(info["ranges"])
    now, before = range_digests(copy, ranges, columns), info.get("digests", {})
    return ranges, sorted(int(r) for r in now.keys() | before.keys() if now.get(r) != before.get(r)), now


def diff_against(table: VersionedTable, copy: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
                 ) -> tuple[DataFrame, dict]:
    """I/U/D rows of a full copy against the table's live rows, and the copy's digests.

    Phase one compares a digest per key range with the one kept at the last copy; phase two joins the ranges that
    differ. Stored rows and files of equal ranges are not read.
    """
    columns = [*keys, *[c for c in copy.columns if c not in keys]]
    ranges, differing, digests = changed_ranges(table, copy, columns)
    stored = table.read(ranges=differing).filter(~F.col(DELETED)).drop(SYNCED, DELETED)
    schema = merged_schema(stored.schema, copy.schema)
    part = copy.filter(ranges.column().isin(differing)) if differing else copy.limit(0)
    return snapshot_diff(conform(stored, schema), conform(part, schema), keys, compare), digests


def ingest_snapshot(copy: DataFrame, keys: Sequence[str], table: VersionedTable, now, run_id: str = "", **options) -> int | None:
    """Applies a full copy (business columns; system columns are ignored): changes take effect at ``now``."""
    copy = copy.drop(SYNCED, DELETED)
    columns = [*keys, *[c for c in copy.columns if c not in keys]]
    if table.current_version() is None:
        first = copy.withColumn("op", F.lit("I")).withColumn(SYNCED, ts_lit(now))
        one = KeyRanges.of(copy, keys[0])
        return apply_batch(table, first, keys, run_id, extra={"digests": range_digests(copy, one, columns)}, **options)
    before = table.commit_info(table.current_version())
    diff, digests = diff_against(table, copy, keys)
    version = apply_batch(table, diff.withColumn(SYNCED, ts_lit(now)), keys, run_id, extra={"digests": digests}, **options)
    if version == before["version"] and digests != before.get("digests"):  # ranges were split since the last copy
        version = table.restate({"digests": digests})
    return version


# --- a whole landing area ------------------------------------------------------------------
def discovered(spark: SparkSession, root: str) -> list[str]:
    """Table folders below a landing root."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)
                  if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))) if fs.exists(path) else []


def ingest_source(spark: SparkSession, source: str, landing: str, table: VersionedTable, now, run_id: str = "",
                  checkpoint: str | None = None) -> int | None:
    """One source by its capture method. A table that is in no spec is kept as the last copy that landed."""
    spec, keys = SOURCES.get(source), SOURCE_KEYS.get(source)
    if spec is None:
        return table.commit(spark.read.parquet(landing), run_id=run_id)
    if spec.method == "file_drop":
        schema = T.StructType([f for f in T._parse_datatype_string(spec.schema_ddl).fields])
        arrived = spark.read.parquet(landing).schema  # what the files hold beyond the declared columns flows too
        from tidemark.streaming.ingest import file_stream
        return ingest_file_drop(file_stream(spark, landing, merged_schema(schema, arrived)), keys, table,
                                checkpoint or f"{table.path}/_checkpoint", run_id)
    landed = spark.read.parquet(landing)
    if spec.method == "change_feed":
        return ingest_change_feed(landed, keys, table, run_id)
    if spec.method == "api_delta":
        return ingest_api_delta(landed, keys, table, run_id)
    if spec.method == "snapshot_diff":
        return ingest_snapshot(landed, keys, table, now, run_id)
    raise ValueError(f"{source}: unknown capture method {spec.method!r}")


def admitted(spark: SparkSession, landing_root: str, enabled: Iterable[str] = tuple(SOURCES), policy: str = ALLOW_ALL) -> list[str]:
    """The landed tables that flow under the schema policy."""
    return admit_tables(discovered(spark, landing_root), enabled, policy)
