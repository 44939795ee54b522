"""Bulk-synchronous best-fit packing of tokenized documents into sequences of at most ``capacity`` tokens.

Pieces are range-sorted by length and numbered inside their length, in Spark. As lengths are integers up to
``capacity``, pieces of one length are interchangeable and so are gaps of one width: both sides of a round
are runs, at most ``capacity`` of them however large the corpus. A round is one sweep over the runs in
sorted order: every gap takes the largest piece that still fits and that no gap nearer to it takes; where
more pieces than gaps (or the reverse) meet, ranks decide who matches. All matches of a round take effect
at once, the gaps shrink, and the next round begins. When nothing fits any more, the largest remaining
pieces open as many sequences as their tokens need. The rounds' matches are rank ranges; one join against
that small table places every piece, so no row is moved more than once, whatever the number of rounds.
That the sweep itself runs on the driver, over run lengths instead of rows, is a departure from a sweep over distributed
gaps: it makes the same matches (equal pieces are interchangeable) from at most ``capacity`` numbers a side.

Defined results: null and empty texts are one piece that holds the end id alone; repeated rows are placed each; an empty
table gives an empty result; a very long text is cut into pieces, its ids in memory; which of equal pieces goes where is
settled by their row numbers. Only the key and the text are read, so no other column can clash.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stage, with_row_id
from tidemark.llm.tokens import byte_tokenizer

CAPACITY = 2048
END_ID = 0


def pieces_of(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: only the first may be shorter."""
    head = n % capacity or min(n, capacity)
    cuts = [0, *range(head, n + 1, capacity)] if n else [0]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def tokenized_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     vocabulary: str | None = None) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32. A null or empty text is its end id alone."""
    def rows(batches):
        tok = byte_tokenizer(vocabulary)
        for b in batches:
            out: dict = {c: [] for c in (key, "piece", "start", "length", "ids_crc32")}
            for k, t in zip(b[key], b[text]):
                ids = np.append(tok.ids(t), END_ID).astype("<u4")
                for i, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for c, v in zip(out, (k, i, start, length, crc)):
                        out[c].append(v)
            yield out

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint", rows)


def sweep(pieces: np.ndarray, gaps: np.ndarray) -> list[tuple[int, int, int]]:
    """(size, gap, count) matches of one round. ``pieces[s]``, ``gaps[g]``: how many of that size or width.

    Over the sorted union of both, a gap takes the nearest smaller piece that is still free.
    """
    free: list[list[int]] = []
    out = []
    for v in np.nonzero((pieces > 0) | (gaps > 0))[0].tolist():
        if pieces[v]:
            free.append([v, int(pieces[v])])
        left = int(gaps[v])
        while left and free:
            size, n = free[-1]
            m = min(left, n)
            out.append((size, v, m))
            left -= m
            free[-1][1] -= m
            if not free[-1][1]:
                free.pop()
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Placement ranges (size, first rank, count, first sequence, offset) for so many pieces of each size."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in histogram.items():
        left[size] = n
    total = left.copy()
    open_runs: dict[int, list[list[int]]] = {}  # gap width -> runs [first sequence, count]
    sequences, placed = 0, []

    def start(n: int) -> None:
        nonlocal sequences
        for size in range(capacity, 0, -1):
            m = min(n, int(left[size]))
            if m:
                placed.append((size, int(total[size] - left[size]), m, sequences, 0))
                open_runs.setdefault(capacity - size, []).append([sequences, m])
                left[size] -= m
                sequences += m
                n -= m

    sizes = np.arange(capacity + 1)
    needed = lambda: -(-int((left * sizes).sum()) // capacity)
    start(max(needed(), int(left[capacity // 2 + 1:].sum())))  # no two pieces over half a sequence share one
    while left.any():
        gaps = np.zeros(capacity + 1, dtype=np.int64)
        for width, runs in open_runs.items():
            gaps[width] = sum(n for _, n in runs)
        matches = sweep(left, gaps)
        if not matches:
            start(max(1, needed()))
            continue
        fresh: dict[int, list[list[int]]] = {}
        for size, width, m in matches:
            while m:
                run = open_runs[width][-1]
                k = min(m, run[1])
                first = run[0] + run[1] - k
                placed.append((size, int(total[size] - left[size]), k, first, capacity - width))
                fresh.setdefault(width - size, []).append([first, k])
                left[size] -= k
                run[1] -= k
                m -= k
                if not run[1]:
                    open_runs[width].pop()
        for width, runs in fresh.items():
            open_runs.setdefault(width, []).extend(runs)
    return placed


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``: the row's number among pieces of its length, gapless from 0. Staged.

    A range sort, then counts per (task, length): each task holds a contiguous range of lengths, so there
    are at most tasks + lengths such counts, and no length, however common, meets in one task.
    """
    rid = "__rid"
    numbered = with_row_id(pieces, rid, "pieces")
    order = with_row_id(numbered.repartitionByRange("length", rid).sortWithinPartitions("length", rid),
                        "__at", "pieces-sorted").drop(rid)
    task = F.shiftright("__at", 33)
    counts = order.groupBy(task.alias("__task"), F.col("length").alias("__len")).agg(
        F.count("*").alias("n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("__len").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(counts.withColumn("__base", F.coalesce(F.sum("n").over(before), F.lit(0))), "pieces-base")
    return (order.join(F.broadcast(base), (task == F.col("__task")) & (F.col("length") == F.col("__len")))
            .withColumn("rank", F.col("__at") - F.col("__first") + F.col("__base"))
            .drop("__at", "__task", "__len", "n", "__first", "__base"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` column, 1 to capacity) plus sequence_id and offset.

    Every row gets a place; equal rows get places of their own; an empty table gives an empty one.
    """
    rows = ranked(pieces)
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # capacity rows at most
    ranges = [tuple(map(int, p)) for p in plan(histogram, capacity)]
    places = pieces.sparkSession.createDataFrame(
        ranges, "__size bigint, __lo bigint, __n bigint, __seq bigint, offset bigint")
    # bounded: a round adds at most 2 * capacity ranges, and rounds depend on the lengths, not on the rows
    return (rows.join(F.broadcast(places), (F.col("length") == F.col("__size")) & (F.col("rank") >= F.col("__lo"))
                      & (F.col("rank") < F.col("__lo") + F.col("__n")))
            .withColumn("sequence_id", F.col("__seq") + F.col("rank") - F.col("__lo"))
            .drop("rank", "__size", "__lo", "__n", "__seq"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(tokenized_pieces(docs, key, text, capacity, vocabulary), capacity).select(
        key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
