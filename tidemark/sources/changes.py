"""Change capture into bronze (survey S5-S7).

* ``apply_changes``  - a change feed (op I/U/D, sequence) applied to a bronze table:
  latest change per key wins; I/U upsert the payload; D soft-deletes
  (``_deleted = true``) and keeps the last bronze payload.
* ``snapshot_diff``  - no change log: compare two full copies on the key with
  null-safe equality per column and emit I/U/D rows.
* ``api_delta``      - only rows past a cursor are fetched; they are upserts.

The feed is reduced to one row per key first (partial top-1 before its shuffle),
so a hot key costs one row per map task, not a third of the feed in one task.
Applying it is one keyed join; NULL keys are salted. Over a bronze table in key ranges
(``sources.ingest``) the join meets only the ranges that hold a changed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleanse import ts_lit
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.keys import SALT, key_match, with_null_salt
from tidemark.sources.tables import stage

OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"


def latest_changes(feed: DataFrame, keys: Sequence[str], op_col: str = "op", seq_col: str = "_synced",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: payload, ``_synced`` (the change time) and ``_deleted``."""
    payload = [c for c in feed.columns if c not in (op_col, seq_col, "_deleted")]
    latest = latest_per_key(feed, list(keys), seq_col, tiebreak, nulls_first=False)
    return latest.select(*payload, F.col(seq_col).alias("_synced"), (F.col(op_col) == F.lit(OP_DELETE)).alias("_deleted"))


def apply_changes(bronze: DataFrame | None, feed: DataFrame, keys: Sequence[str], op_col: str = "op",
                  seq_col: str = "_synced", tiebreak: Sequence[str] = (), strategy: str = "lookup") -> DataFrame:
    """Return the new bronze state (payload columns + ``_synced`` + ``_deleted``).

    ``feed`` carries the payload, ``op_col`` and ``seq_col`` (the change time, which
    becomes ``_synced``). Shapes as in the merge: ``lookup`` (the per-key changes are staged, Spark
    broadcasts them or not by their real size; ``bronze`` is read twice) or ``shuffle`` (one full-outer join).
    """
    changes = latest_changes(feed, keys, op_col, seq_col, tiebreak)
    if bronze is not None and strategy == "lookup":
        changes = stage(changes, "changes")
    return apply_latest(bronze, changes, keys, strategy)


def apply_latest(bronze: DataFrame | None, changes: DataFrame, keys: Sequence[str], strategy: str = "lookup",
                 newer_by: Sequence[str] = ()) -> DataFrame:
    """``changes`` (from ``latest_changes``) applied. ``newer_by``: a stored row that is later in these columns stays."""
    keys = list(keys)
    if bronze is None:
        return changes
    cols = [c for c in changes.columns if c not in ("_synced", "_deleted")] + ["_synced", "_deleted"]
    b = bronze.select(*cols).withColumn("__b", F.lit(True))
    c = changes.withColumn("__c", F.lit(True))
    has_b, has_c = F.col("b.__b").isNotNull(), F.col("c.__c").isNotNull()
    if newer_by:
        later = F.struct(*[F.col(f"b.{x}") for x in newer_by]) > F.struct(*[F.col(f"c.{x}") for x in newer_by])
        has_c = has_c & ~(has_b & later)
    c_del = F.col("c._deleted")
    out = []
    for name in cols:
        b_, c_ = F.col(f"b.{name}"), F.col(f"c.{name}")
        if name in keys or name in ("_synced", "_deleted"):
            e = F.when(has_c, c_).otherwise(b_)
        else:
            # a delete keeps the last bronze payload when there is one
            e = F.when(has_c & ~(c_del & has_b), c_).otherwise(b_)
        out.append(e.alias(name))

    bs, cs = with_null_salt(b, keys), with_null_salt(c, keys)
    if strategy == "shuffle":
        return bs.alias("b").join(cs.alias("c"), key_match(keys, "b", "c"), "full_outer").select(*out)
    if strategy == "lookup":
        rewritten = bs.alias("b").join(cs.alias("c"), key_match(keys, "b", "c"), "left").select(*out)
        known = bs.select(*keys, SALT).alias("b")
        inserts = cs.alias("c").join(known, key_match(keys, "b", "c"), "left_anti").select(*cols)
        return rewritten.unionByName(inserts)
    raise ValueError(f"unknown strategy {strategy!r}")


def snapshot_diff(prev: DataFrame, curr: DataFrame, keys: Sequence[str],
                  compare: Sequence[str] | None = None, op_col: str = "op") -> DataFrame:
    """Rows of ``curr`` that are new (I) or changed (U), and rows of ``prev`` that vanished (D).

    ``compare`` defaults to every non-key column; equality is null-safe (``<=>``).
    Output: keys, op, then the payload (from ``curr`` for I/U, from ``prev`` for D).
    """
    keys = list(keys)
    payload = [c for c in curr.columns if c not in keys]
    compare = list(compare) if compare is not None else payload
    p = with_null_salt(prev.withColumn("__p", F.lit(True)), keys)
    c = with_null_salt(curr.withColumn("__c", F.lit(True)), keys)
    j = p.alias("p").join(c.alias("c"), key_match(keys, "p", "c"), "full_outer")
    has_p, has_c = F.col("p.__p").isNotNull(), F.col("c.__c").isNotNull()
    differs = F.lit(False)
    for col in compare:
        differs = differs | ~F.col(f"p.{col}").eqNullSafe(F.col(f"c.{col}"))
    op = (F.when(has_c & ~has_p, F.lit(OP_INSERT))
          .when(has_p & ~has_c, F.lit(OP_DELETE))
          .when(differs, F.lit(OP_UPDATE)))
    side = lambda name: F.when(has_c, F.col(f"c.{name}")).otherwise(F.col(f"p.{name}"))
    return (j.select(*[side(k).alias(k) for k in keys], op.alias(op_col), *[side(x).alias(x) for x in payload])
            .filter(F.col(op_col).isNotNull()))


def api_delta(landed: DataFrame, cursor, seq_col: str = "_synced", op_col: str = "op") -> DataFrame:
    """Rows strictly past the cursor, as upserts ready for ``apply_changes``."""
    return landed.filter(F.col(seq_col) > ts_lit(cursor)).withColumn(op_col, F.lit(OP_UPDATE))
