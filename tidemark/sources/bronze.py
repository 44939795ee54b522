"""Bronze reads (survey S1-S4, S9, S10).

The incremental read turns the high-water mark into a literal before filtering,
so both branches of ``synced > wm OR synced >= now - lookback`` are
column-vs-literal comparisons that Catalyst pushes into the Parquet scan
(row-group skipping on the sync column).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleanse import LOOKBACK_DAYS, MIN_DATE, ts_lit

SYNCED, DELETED = "_synced", "_deleted"
# Partition column of landed bronze: the calendar day of the sync time.
SYNC_DATE = "_sync_date"


def scan(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
         columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan with an explicit schema and column list (pruned at the reader)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def high_water_mark(target: DataFrame | None, col: str = "_bronze_sync_timestamp",
                    floor: str = MIN_DATE):
    """A1: ``COALESCE(MAX(col), floor)`` of the target: one row to the driver."""
    floor_ts = dt.datetime.fromisoformat(floor)
    if target is None:
        return floor_ts
    row = target.agg(F.max(col).alias("wm")).first()
    return row["wm"] if row is not None and row["wm"] is not None else floor_ts


def incremental_filter(wm, now, lookback_days: int = LOOKBACK_DAYS, synced: str = SYNCED,
                       partition_col: str | None = None) -> Column:
    """S3 predicate ``synced > wm OR synced >= now - lookback`` folded to ONE literal bound.

    Both bounds are known on the driver, so the disjunction is a single range:
    ``synced >= floor`` when the lookback floor is at or below the mark, else
    ``synced > wm``. A single comparison prunes Parquet row groups (and date
    partitions) directly.
    """
    floor = _as_ts(now) - dt.timedelta(days=lookback_days)
    wm = _as_ts(wm)
    c = F.col(synced)
    bound = floor if floor <= wm else wm
    cond = c >= ts_lit(floor) if floor <= wm else c > ts_lit(wm)
    if partition_col:
        # the same bound on the day partition: whole folders are skipped before any file is opened
        cond = cond & (F.col(partition_col) >= F.lit(bound.date().isoformat()).cast("date"))
    return cond


def land(df: DataFrame, path: str, synced: str = SYNCED, mode: str = "append") -> None:
    """Write bronze the way it is laid out at rest: Parquet partitioned by the sync day."""
    df.withColumn(SYNC_DATE, F.to_date(F.col(synced))).write.mode(mode).partitionBy(SYNC_DATE).parquet(path)


def incremental(src: DataFrame, target: DataFrame | None, now, lookback_days: int = LOOKBACK_DAYS,
                min_date: str = MIN_DATE, synced: str = SYNCED) -> DataFrame:
    """First run (no target) reads everything; later runs read past the mark or inside the lookback."""
    if target is None:
        return src
    wm = high_water_mark(target, floor=min_date)
    return src.filter(incremental_filter(wm, now, lookback_days, synced))


def late_rows(src: DataFrame, target: DataFrame, now, lookback_days: int = LOOKBACK_DAYS,
              synced: str = SYNCED) -> DataFrame:
    """Rows at or below the mark and older than the lookback: these are never re-read."""
    wm = high_water_mark(target)
    return src.filter(~incremental_filter(wm, now, lookback_days, synced) | F.col(synced).isNull())


def load_profile(tables: dict[str, DataFrame], synced: str = SYNCED) -> DataFrame:
    """A2/Q12: one row per table with its row count and latest sync time."""
    parts = []
    for name, df in sorted(tables.items()):
        latest = F.max(synced) if synced in df.columns else F.lit(None).cast("timestamp_ntz")
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                            latest.alias("latest_sync")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")  # W4: the admin listing is ordered (one row per table)


# --- S10 schema drift ---------------------------------------------------------
ALLOW_ALL, ALLOW_COLUMNS = "ALLOW_ALL", "ALLOW_COLUMNS"


def admit_tables(discovered: Iterable[str], enabled: Iterable[str], policy: str) -> list[str]:
    """New tables flow under ALLOW_ALL; under ALLOW_COLUMNS only explicitly enabled ones do."""
    enabled = set(enabled)
    if policy == ALLOW_ALL:
        return sorted(set(discovered))
    if policy == ALLOW_COLUMNS:
        return sorted(t for t in discovered if t in enabled)
    raise ValueError(f"unknown schema change policy {policy!r}")


# per type, the types it may widen to (Parquet files of the narrower type read as the wider one)
_WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
          "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp_ntz",)}


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both, or TypeError where there is none without loss."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    x, y = a.simpleString(), b.simpleString()
    above = [t for t in (x, *_WIDER.get(x, ())) if t in (y, *_WIDER.get(y, ()))]
    if not above:
        raise TypeError(f"type changed from {x} to {y}")
    return T._parse_datatype_string(above[0])


def merged_schema(stored: T.StructType, arriving: T.StructType) -> T.StructType:
    """The stored columns, widened where the arriving ones are wider, then new ones. Columns never go and never narrow.

    Names are matched without regard to case, as sources rename so.
    """
    have = {f.name.lower(): f for f in arriving.fields}
    out = []
    for f in stored.fields:
        got = have.pop(f.name.lower(), None)
        try:
            out.append(T.StructField(f.name, widened(f.dataType, got.dataType) if got else f.dataType, True, f.metadata))
        except TypeError as e:
            raise TypeError(f"column {f.name}: {e}") from None
    return T.StructType(out + [T.StructField(f.name, f.dataType, True, f.metadata) for f in have.values()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``: missing columns NULL, narrower ones cast up."""
    have = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        got = have.get(f.name.lower())
        if got is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            widened(got.dataType, f.dataType)  # never down
            cols.append(F.col(f"`{got.name}`").cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(*cols)


def align_schema(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """Both policies let new columns flow: target columns first (NULL when missing), then new ones."""
    return conform(df, merged_schema(target_schema, df.schema))


def _as_ts(v):
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))
