"""Latest-version-per-key deduplication (survey W1/W2).

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY synced DESC) = 1`` written as a
DataFrame window so Catalyst infers a ``WindowGroupLimit``: a partial top-1 runs
in every map task before the key shuffle, so even a key holding a third of all
rows ships at most one row per map task, and the final top-1 runs after it.
The source dialect sorts NULL first under DESC; that is written explicitly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.keys import any_null
from tidemark.sources.tables import FILE_BYTES, bucketed, file_room, fits_sort, head_facts, row_index

BUCKET_ROWS = 1_000_000  # rows that one task sorts by key
SLOTS = 1024             # hash slots in which rows are counted
SLOT_BITS = 10


def _desc(c: str | Column, nulls_first: bool) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str = "_synced",
                   tiebreak: Sequence[str] = (), nulls_first: bool = True) -> DataFrame:
    """Keep the newest row per key; ``tiebreak`` columns (descending) make the pick total."""
    order = [_desc(order_by, nulls_first)] + [_desc(t, False) for t in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


@dataclass(frozen=True)
class KeyShape:
    """What one narrow scan tells of rows to be put together by key; ``buckets`` is 0 where shuffling them is cheaper.

    ``alone`` rows have a NULL key part and are not among ``rows`` if they go apart. The ``largest`` task of the scan had so
    many rows. ``plain`` columns need no dictionary, a row has about ``row_bytes``."""
    rows: int = 0
    keys: int = 0
    hot: tuple[int, ...] = ()
    buckets: int = 0
    alone: int = 0
    largest: int = 0
    plain: tuple[str, ...] = ()
    row_bytes: int = 0


def _slot(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(SLOTS))


def key_shape(df: DataFrame, keys: Sequence[str], held: int = 0, apart: bool = False) -> KeyShape:
    """Rows, keys (about) and hot slots; ``held`` more rows will be joined by key. ``apart``: rows with a NULL key part
    are counted apart.

    Few keys in many rows leave little after the partial top-1 of ``latest_per_key``: such rows are shuffled.
    """
    slot = F.when(any_null(keys), F.lit(-1)).otherwise(_slot(keys)) if apart else _slot(keys)
    narrow = df.select(slot.cast("int").alias("slot"), F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), SLOT_BITS).alias("k"),
                       F.spark_partition_id().alias("p"), row_index().alias("i"))
    counted = (narrow.groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k"),
                                          F.max("p").alias("p"), F.max("i").alias("i")).collect())  # at most SLOTS rows and one
    slots = [r for r in counted if r.slot >= 0]
    rows, alone = sum(r.n for r in slots), sum(r.n for r in counted if r.slot < 0)
    # the least of k even hashes is about 1/k: a slot's keys by the others' minima, an empty slot's being above 1
    least = sum((r.k + 1) / 2.0 ** (64 - SLOT_BITS) for r in slots) + SLOTS - len(slots)
    found = min(rows, round(SLOTS * len(slots) / least))
    tasks = max((r.p for r in counted), default=0) + 1
    if rows < BUCKET_ROWS or 3 * found * tasks < rows:
        return KeyShape(rows, found, alone=alone)
    hot = tuple(r.slot for r in slots if r.n > max(BUCKET_ROWS, 8 * rows // SLOTS))
    spark = df.sparkSession
    cores, buckets = spark.sparkContext.defaultParallelism, -(-(rows + held) // BUCKET_ROWS)
    room = file_room(spark) // FILE_BYTES - 1
    if room < buckets <= 2 * room:  # somewhat larger buckets spare the sort by file
        buckets = room
    return KeyShape(rows, found, hot, max(cores, buckets), alone, max(r.i for r in counted) + 1)


@contextmanager
def by_key(df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str], name: str, held: int = 0,
           bucket_by: Sequence[str] | None = None, apart: bool = False) -> Iterator[tuple[DataFrame, KeyShape]]:
    """Rows of ``df`` ready for ``latest_per_key`` by the same order, in buckets by key if they are many; ``apart``: the
    buckets are without the rows that have a NULL key part.

    The buckets are written without a partial top-1; rows of hash slots that a hot key overfills are cut down to the
    newest per key before.
    """
    shape = key_shape(df, keys, held, apart)
    if not shape.buckets:
        yield df, shape
        return
    if apart and shape.alone:
        df = df.filter(~any_null(keys))
    plain, row_bytes = head_facts(df)
    shape = replace(shape, plain=plain, row_bytes=row_bytes)
    newest = None
    if shape.hot:
        is_hot = _slot(keys).isin(list(shape.hot))
        df, newest = df.filter(~is_hot), latest_per_key(df.filter(is_hot), keys, order_by, tiebreak)
    gather = fits_sort(df.sparkSession, shape.largest, row_bytes)
    with bucketed(df, list(bucket_by or keys), shape.buckets, name, plain, gather, newest) as rows:
        yield rows, shape
