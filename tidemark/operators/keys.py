"""Key helpers shared by the keyed joins (merge, history, change capture).

A NULL key never matches under plain ``=``, but a hash-partitioned join still
routes every NULL-key row to the same partition. If one third of a table has a
NULL key, that is one task holding a third of the data. ``null_salt`` adds a
second join column that is 0 for complete keys (so matching is unchanged) and a
deterministic hash bucket of the whole row for rows with a NULL key part, which
spreads those rows over all partitions. Deterministic (not ``rand``) so a
re-executed map task sends every row to the same reducer as before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
SALT_BUCKETS = 4096


def any_null(keys: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(f"{prefix}{k}").isNull()
    return cond


def with_null_salt(df: DataFrame, keys: Sequence[str], buckets: int = SALT_BUCKETS) -> DataFrame:
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets))
    return df.withColumn(SALT, F.when(any_null(keys), spread).otherwise(F.lit(0)).cast("int"))


def key_match(keys: Sequence[str], left: str, right: str, salted: bool = True) -> list[Column]:
    cond = [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]
    if salted:
        cond.append(F.col(f"{left}.{SALT}") == F.col(f"{right}.{SALT}"))
    return cond
