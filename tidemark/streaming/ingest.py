"""Structured Streaming ingest (survey S8, T1, T2).

Landed files are read with the file source (each file exactly once, tracked in
the query checkpoint), and every micro-batch is refined and merged into a
versioned table inside ``foreachBatch``. The micro-batch id is recorded with the
committed version, so a batch replayed after a failure between commit and
checkpoint is a no-op. ``availableNow`` drains what has landed and stops, which
is how a scheduled (5 min ... 24 h) sync runs.

Arrival order of files is not guaranteed, and the result must not depend on it. T1 keeps every row's place in the
batch's order (NULL sync first, sync time, tiebreak) beside it in the table, and a stored row gives way only to one
that comes later in that order; the state of a key is its row, so none is held twice and none expires. T2 cuts the
intervals of the touched keys anew from all their change rows (``scd2.splice``). Both read and rewrite only the key
ranges that the micro-batch meets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.scd2 import change_rows, splice
from tidemark.plans.models import ROW_ORDER, refine, upsert
from tidemark.sources.ranges import ROWS_PER_RANGE, rewrite_ranges
from tidemark.sources.tables import VersionedTable, staged
from tidemark.specs import SnapshotSpec, TableSpec


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files under ``source_dir``, each read exactly once."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def stream_scd1(stream: DataFrame, spec: TableSpec, table: VersionedTable, checkpoint: str,
                now, run_prefix: str = "stream", rows_per_range: int = ROWS_PER_RANGE) -> None:
    """F1 -> W1 -> F5 -> F8 per micro-batch, merged into ``table``; equals the batch over the same files.

    The table holds one column more than the batch's, ``ROW_ORDER``.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{run_prefix}-{batch_id}"
        with staged(refine(spec, batch, now, run_id, with_order=True), f"{spec.name}-micro-batch") as updates:
            upsert(spec, table, updates, run_id, only_if_newer=ROW_ORDER, batch_id=batch_id, rows_per_range=rows_per_range)

    drain(stream, per_batch, checkpoint)


def stream_scd2(stream: DataFrame, spec: SnapshotSpec, table: VersionedTable, checkpoint: str, run_prefix: str = "stream",
                tiebreak: tuple[str, ...] = (), rows_per_range: int = ROWS_PER_RANGE) -> None:
    """Per micro-batch, the change rows (deletes included) spliced into the history; see ``scd2.spliced_history``."""
    payload = [*spec.payload, spec.updated_at, "_deleted"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with staged(change_rows(batch, payload, spec.updated_at, tiebreak), f"{spec.name}-changes") as events:
            rewrite_ranges(table, events, spec.keys[0], lambda stored, rows: splice(stored, rows, spec.keys, payload),
                           f"{run_prefix}-{batch_id}", batch_id, rows_per_range=rows_per_range)
            table.vacuum()

    drain(stream, per_batch, checkpoint)


def drain(stream: DataFrame, fn, checkpoint: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
