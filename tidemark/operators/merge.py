"""Keyed upsert (survey K1, J4, K7): the SCD1 merge without a row-level table format.

Contract (per business key, plain ``=`` matching):
* matched   -> every column from the update, except ``keep`` columns (first load time) from the target;
* unmatched update -> inserted as is;
* untouched target row -> unchanged; nothing is ever deleted;
* columns new in the update are appended (older rows NULL); columns missing from
  the update keep their target value; a type only ever widens (S10), any other change is an error.
* a NULL key never matches: such target rows pass through, such update rows are
  inserted (each run adds a copy, as the source warehouse does).

Physical shapes (same result), none of which forces a broadcast:
* ``lookup``  - the target left-joins the batch and the batch anti-joins the target's keys. Spark picks
  broadcast or sort-merge from the real sizes of the staged batch: with a small batch the target is
  never shuffled.
* ``shuffle`` - one full-outer sort-merge join; both sides hash-partitioned by key, the target read once.
* ``bucketed`` - the same join of two copies with complete keys that stand in buckets by key (``tables.bucketed``):
  neither side is shuffled.
NULL keys never match; a deterministic salt spreads them over all partitions (``tidemark.operators.keys``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keys import SALT, key_match, with_null_salt
from tidemark.sources.bronze import widened


def _output_columns(target: DataFrame, updates: DataFrame) -> list[tuple[str, T.DataType, str]]:
    """(name, type, origin) with origin in both | target | update, target order first."""
    tf = {f.name: f.dataType for f in target.schema.fields}
    uf = {f.name: f.dataType for f in updates.schema.fields}
    out = []
    for name, typ in tf.items():
        if name in uf:
            try:
                out.append((name, widened(typ, uf[name]), "both"))
            except TypeError as e:
                raise TypeError(f"merge: column {name}: {e}") from None
        else:
            out.append((name, typ, "target"))
    out += [(n, t, "update") for n, t in uf.items() if n not in tf]
    return out


def _resolve(cols, keys, keep, t: Callable[[str], Column], u: Callable[[str], Column],
             t_present: Column, u_present: Column, take_update: Column) -> list[Column]:
    exprs = []
    for name, typ, origin in cols:
        if name in keys:
            e = F.when(u_present, u(name)).otherwise(t(name))
        elif origin == "target":
            e = t(name)
        elif origin == "update":
            e = F.when(take_update, u(name)).otherwise(F.lit(None).cast(typ))
        elif name in keep:
            e = F.when(t_present, t(name)).otherwise(u(name))
        else:
            e = F.when(take_update, u(name)).otherwise(t(name))
        exprs.append(e.cast(typ).alias(name))
    return exprs


def merge_upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str],
                 keep: Sequence[str] = ("_silver_load_timestamp",), only_if_newer: bool = False,
                 order_col: str = "_bronze_sync_timestamp", strategy: str = "lookup") -> DataFrame:
    """Return the new full state of the target after upserting ``updates``.

    ``updates`` is read twice in the ``lookup`` shape: stage it first when it is more than a scan.
    """
    keys = list(keys)
    if target is None:
        return updates
    cols = _output_columns(target, updates)
    keep = [k for k in keep if k in target.columns]
    t = target.withColumn("__t", F.lit(True))
    u = updates.withColumn("__u", F.lit(True))

    def tcol(c: str) -> Column:
        return F.col(f"t.{c}")

    def ucol(c: str) -> Column:
        return F.col(f"u.{c}")

    t_present = F.col("t.__t").isNotNull()
    u_present = F.col("u.__u").isNotNull()
    take_update = u_present
    if only_if_newer and order_col in target.columns and order_col in updates.columns:
        newer = F.coalesce(ucol(order_col) > tcol(order_col),
                           tcol(order_col).isNull() & ucol(order_col).isNotNull(), F.lit(False))
        take_update = u_present & (~t_present | newer)
    resolve = lambda: _resolve(cols, keys, keep, tcol, ucol, t_present, u_present, take_update)

    if strategy == "bucketed":
        return t.alias("t").join(u.alias("u"), key_match(keys, "t", "u", salted=False), "full_outer").select(*resolve())
    ts_, us_ = with_null_salt(t, keys), with_null_salt(u, keys)
    if strategy == "shuffle":
        return ts_.alias("t").join(us_.alias("u"), key_match(keys, "t", "u"), "full_outer").select(*resolve())
    if strategy == "lookup":
        rewritten = ts_.alias("t").join(us_.alias("u"), key_match(keys, "t", "u"), "left").select(*resolve())
        known = ts_.select(*keys, SALT).alias("t")
        inserts = us_.alias("u").join(known, key_match(keys, "t", "u"), "left_anti").select(*updates.columns)
        return rewritten.unionByName(_fill(inserts, cols))
    raise ValueError(f"unknown merge strategy {strategy!r}")


def _fill(df: DataFrame, cols) -> DataFrame:
    """Project ``df`` onto the output columns, NULL where it lacks one."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t, _ in cols])


def merge_into_table(table_name: str, updates: DataFrame, keys: Sequence[str],
                     keep: Sequence[str] = ("_silver_load_timestamp",)) -> None:
    """K1 as a row-level MERGE on a catalog table that supports it (``DataFrame.mergeInto``).

    On a table format with row-level operations only the files holding matched keys
    are rewritten. Built-in Parquet tables refuse MERGE
    (``UNSUPPORTED_FEATURE.TABLE_OPERATION``); use ``merge_upsert`` + ``VersionedTable``
    there. Same contract: matched -> every column but ``keep``; unmatched -> insert.
    """
    cond = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    set_cols = {c: F.col(f"s.`{c}`") for c in updates.columns if c not in keep and c not in keys}
    (updates.alias("s").mergeInto(table_name, F.expr(cond.replace("t.", f"{table_name}.")))
     .whenMatched().update(set_cols)
     .whenNotMatched().insertAll()
     .merge())
