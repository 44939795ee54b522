"""Keyed tables laid out in key ranges: a run reads and rewrites only the ranges that hold a changed key.

The table's rows stand in one folder per range of the leading key column; the bounds are kept with every commit.
A run finds the ranges of its (small, staged) change batch, reads just these, combines stored rows and changes, and
writes them to a fresh folder; the commit lists the new folders beside the untouched ones, which keep their files
byte for byte. Replicated business keys grow with time (ticket, invoice and work-order numbers), so a batch of recent
changes meets few ranges; a batch spread over all keys still rewrites all of them.

A range that outgrows ``rows_per_range`` is split at sampled bounds; rows without a leading key have a range of their
own that is only ever appended to, since they match nothing.
"""

from __future__ import annotations

import datetime as dt
import decimal
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import RANGE, VersionedTable

ROWS_PER_RANGE = 2_000_000
KEYS_PER_RANGE = 100  # sampled to find a bound
MAX_FOLDERS = 16       # folders of a range that is only added to
MAX_RANGES = 256   # bounds are literals of one expression
NO_KEY = -1        # the range of rows without a leading key

# how a bound is kept in the commit file, by the key's type
_PARSE = {"string": str, "int": int, "bigint": int, "smallint": int, "tinyint": int, "date": dt.date.fromisoformat,
          "timestamp_ntz": dt.datetime.fromisoformat, "timestamp": dt.datetime.fromisoformat}


@dataclass(frozen=True)
class KeyRanges:
    """``bounds[i]`` is where the range ``ids[i + 1]`` begins; ``ids[0]`` begins at the smallest key."""
    key: str
    kind: str = "string"
    bounds: tuple = ()
    ids: tuple = (0,)

    @classmethod
    def of(cls, df: DataFrame, key: str) -> KeyRanges:
        return cls(key, df.schema[key].dataType.simpleString())

    @classmethod
    def load(cls, info: dict | None) -> KeyRanges | None:
        if not info:
            return None
        parse = _PARSE.get(info["kind"], decimal.Decimal)
        return cls(info["key"], info["kind"], tuple(map(parse, info["bounds"])), tuple(info["ids"]))

    def dump(self) -> dict:
        return {"key": self.key, "kind": self.kind, "ids": list(self.ids),
                "bounds": [b.isoformat() if hasattr(b, "isoformat") else str(b) for b in self.bounds]}

    def column(self) -> Column:
        """The range of a row, by a balanced tree of comparisons (as many per row as the tree is deep)."""
        def tree(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(self.ids[lo])
            mid = (lo + hi) // 2
            return F.when(F.col(self.key) < F.lit(self.bounds[mid]).cast(self.kind), tree(lo, mid)).otherwise(tree(mid + 1, hi))
        return F.when(F.col(self.key).isNull(), F.lit(NO_KEY)).otherwise(tree(0, len(self.bounds))).cast("int")

    def split(self, starts: list) -> KeyRanges:
        """The ranges cut at further keys; the part of a range that begins with it keeps its number."""
        bounds, ids, fresh = list(self.bounds), list(self.ids), max(self.ids) + 1
        for s in starts:
            at = bisect_right(bounds, s)
            if at and bounds[at - 1] == s:
                continue
            bounds.insert(at, s)
            ids.insert(at + 1, fresh)
            fresh += 1
        return replace(self, bounds=tuple(bounds), ids=tuple(ids))

    def cut(self, df: DataFrame, n: int, rows: int) -> KeyRanges:
        """The ranges cut where ``n`` equal ranges of the ``rows`` rows of ``df`` begin; a key that has no text form is not cut."""
        return self.split(range_starts(df, self.key, n, rows)) if self.kind in _PARSE or self.kind.startswith("decimal") else self


def range_starts(df: DataFrame, key: str, n: int, rows: int) -> list:
    """Keys at which ``n`` ranges of about equal rows begin (the first left out); at most ``n - 1`` values.

    The bounds come from a sample of the ``rows`` keys, ``KEYS_PER_RANGE`` a range; they only lay the table out.
    """
    if n < 2:
        return []
    keys = df.select(key).where(F.col(key).isNotNull())
    share = KEYS_PER_RANGE * n / max(rows, 1)
    found = sorted(r[0] for r in (keys.sample(share, 7) if share < 1 else keys).collect())
    return sorted({found[i * len(found) // n] for i in range(1, n)} - {found[0]}) if found else []


def split_ranges(table: VersionedTable, touched: list[int], rows: int, rows_per_range: int = ROWS_PER_RANGE,
                 run_id: str = "") -> int:
    """Cuts ``touched`` ranges that hold ``rows`` rows together into ranges of ``rows_per_range``; the new version."""
    current = table.current_version()
    info = table.commit_info(current)
    ranges = KeyRanges.load(info["ranges"])
    spare = MAX_RANGES - len(ranges.ids)
    n = min(-(-rows // rows_per_range), spare + 1)
    held = table.read(current, touched)
    cut = ranges.cut(held, n, rows)
    if cut == ranges:
        return info["version"]
    return table.commit(held.withColumn(RANGE, cut.column()), run_id=run_id or info["run_id"], batch_id=info.get("batch_id"),
                        again=True, base=current, partition_by=[RANGE], keep=table.parts_without(touched, current),
                        extra={**{k: v for k, v in info.items() if k in ("metrics", "digests")}, "ranges": cut.dump()})


def rewrite_ranges(table: VersionedTable, changes: DataFrame, key: str,
                   combine: Callable[[DataFrame | None, DataFrame], DataFrame] | None, run_id: str = "",
                   batch_id: int | None = None, observe: dict[str, Column] | None = None, largest: tuple[str, ...] = (),
                   rows_per_range: int = ROWS_PER_RANGE, extra: dict | None = None, gate: Callable[[dict], None] | None = None,
                   gather: bool = False, keys: DataFrame | None = None, rows: int | None = None, plain: Sequence[str] = ()) -> int:
    """Publishes the version that ``changes`` lead to; returns it.

    ``combine(stored, changes)`` gives the new rows of the ranges that hold a changed key, from the rows stored
    there (None: no table yet). Without ``combine`` the changes are added as they are: only they are written, and a
    range is put together again when it has ``MAX_FOLDERS`` folders. ``changes`` are read several times: stage them, or
    give their ``keys`` and about how many ``rows`` they are. Metrics named in ``largest`` never fall below those of
    the version before, whose other ranges stay. ``gather`` shuffles the rows by range, for few files instead of one
    per task and range.
    """
    current = table.current_version()
    info = table.commit_info(current) if current else {}
    if batch_id is not None and info.get("batch_id") is not None and batch_id <= info["batch_id"]:
        return current
    ranges = KeyRanges.load(info.get("ranges"))
    observe = {**(observe or {}), "rows_written": F.count(F.lit(1))}
    keys = changes if keys is None else keys
    if ranges is None:  # no table yet, or one without ranges, which is read whole once
        ranges, stored, keep = KeyRanges.of(changes, key), table.read(current), []
        if stored is None:  # laid out before it is written, not written and split
            rows = changes.count() if rows is None else rows
            if rows > 2 * rows_per_range:
                ranges = ranges.cut(keys, min(-(-rows // rows_per_range), MAX_RANGES), rows)
        touched = list(ranges.ids)
    else:
        found = keys.select(ranges.column().alias("r")).distinct().collect()  # at most as many as there are ranges
        touched = sorted(r.r for r in found)
        if not touched:
            return current
        folders = Counter(p.rsplit("=", 1)[1] for p in info["parts"])
        again = [r for r in touched if r != NO_KEY and (combine is not None or folders[str(r)] >= MAX_FOLDERS)]
        stored = table.read(current, again) if again or combine is not None else None
        keep = table.parts_without(again, current)
    if combine is not None:
        new = combine(stored, changes)
    else:
        new = changes if stored is None else stored.unionByName(changes, allowMissingColumns=True)
    new = new.withColumn(RANGE, ranges.column())
    version = table.commit(new.hint("rebalance", RANGE) if gather else new, run_id=run_id, batch_id=batch_id, partition_by=[RANGE],
                           base=current or 0, observe=observe, keep=keep, extra={**(extra or {}), "ranges": ranges.dump()}, largest=largest, gate=gate, plain=plain)
    held = [r for r in touched if r != NO_KEY]
    rows = table.metrics(version)["rows_written"] if combine is not None else table.read(version, held).count()
    if rows > 2 * rows_per_range * len(touched) and len(ranges.ids) < MAX_RANGES:
        version = split_ranges(table, held, rows, rows_per_range, run_id)
    return version


def ranges_changed(table: VersionedTable, since: int | None) -> list[int]:
    """Ranges whose folders are not those of version ``since`` (None: all ranges)."""
    before = set(table.parts(since)) if since else set()
    return sorted({int(p.rsplit("=", 1)[1]) for p in table.parts() if p not in before})
