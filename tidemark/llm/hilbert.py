"""Sharding along a Hilbert curve: rows close in several metadata dimensions land in the same shards.

Each dimension is quantised to ``2 ** bits`` cells by its own quantiles (strings as a whole, by the exact share
of rows with a smaller value), the cells' curve index orders the
rows (equal texts stay together through their checksum, then the id), and the order is cut into runs of
equal row counts, so every shard holds a narrow box of values in all dimensions and files can be skipped
by their minima and maxima. DataFrame functions only: the curve is a fold over the bits with two small
state tables, built from the rule of the curve for any number of dimensions.

Global positions come from one range sort: rows are numbered inside their task by the order they are
written in, and one count per task shifts them. The sort key ends with a unique row number, so neither a
hot value nor repeated rows can pile up in one task.

Defined results: null dimensions count as the smallest value, null text has no bytes and checksum 0; null
and repeated ids are rows like any other; an empty table gives an empty result; of a very long text only its size and
checksum take part. Only the named columns are read, so no other column can clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.llm.common import stage

SHARDS = 24
BITS = 6
DIMENSIONS = ("source", "lang", "n_chars")
ROW_OVERHEAD = 8


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """(digit, next state) by ``state * 2**n + corner`` for the n-dimensional curve.

    A state is the entry corner and the direction of a sub-cube: entry * n + direction.
    """
    mask = (1 << n) - 1
    turn = lambda x, k: ((x << k % n) | (x >> (n - k % n))) & mask
    gray = [i ^ (i >> 1) for i in range(1 << n)]
    rank = {g: i for i, g in enumerate(gray)}
    ones = lambda i: ((i ^ (i + 1)).bit_length() - 1) % n  # trailing set bits
    entry = lambda i: gray[2 * ((i - 1) // 2)] if i else 0
    way = lambda i: 0 if not i else ones(i - 1) if i % 2 == 0 else ones(i)
    digits, follow = [], []
    for e in range(1 << n):
        for d in range(n):
            for corner in range(1 << n):
                w = rank[turn(corner ^ e, n - (d + 1) % n)]
                digits.append(w)
                follow.append((e ^ turn(entry(w), d + 1)) * n + (d + way(w) + 1) % n)
    return digits, follow


def curve_index(cells: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of integer cells in [0, 2**bits), a long below 2 ** (bits * dimensions)."""
    n = len(cells)
    digits, follow = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def step(acc: Column, bit: Column) -> Column:
        corner = reduce(lambda a, b: a + b, [F.getbit(c, bit).cast("int") * (1 << j) for j, c in enumerate(cells)])
        at = acc["s"] * (1 << n) + corner
        return F.struct((acc["h"] * (1 << n) + F.get(digits, at)).alias("h"), F.get(follow, at).alias("s"))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("s"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, step, lambda acc: acc["h"])


def _value(docs: DataFrame, name: str) -> Column:
    """A dimension as a double or a whole string, in the same order."""
    return F.col(name).cast("double" if _is_number(docs, name) else "string")


def _is_number(docs: DataFrame, name: str) -> bool:
    return isinstance(docs.schema[name].dataType, NumericType)


def _string_cells(slim: DataFrame, column: str, cell: str, bits: int) -> DataFrame:
    """(value, cell) of the distinct strings of ``column``: the share of rows with a smaller value, in 2 ** bits steps."""
    counts = stage(slim.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
                   .repartitionByRange(column).sortWithinPartitions(column)
                   .withColumn("__part", F.spark_partition_id()), "hilbert-values")
    total, offsets = 0, []
    for part, n in sorted(tuple(r) for r in counts.groupBy("__part").agg(F.sum("__n")).collect()):  # one row a task
        offsets.append((part, total))
        total += n
    shift = slim.sparkSession.createDataFrame(offsets, "__part int, __shift bigint")
    earlier = Window.partitionBy("__part").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
            .join(F.broadcast(shift), "__part")
            .select(column, F.expr(f"cast(((__before + __shift) * {1 << bits}) div {max(total, 1)} as int)").alias(cell)))


def assign_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", dimensions: tuple = DIMENSIONS,
                  shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row: key, size, text_crc32, curve (index), shard, slot (place in the shard, gapless from 0)."""
    spark = docs.sparkSession
    body = F.col(text).cast("binary")
    slim = stage(docs.select(
        F.col(key).alias("__key"), F.monotonically_increasing_id().alias("__rid"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0).cast("long")).alias("text_crc32"),
        *[_value(docs, d).alias(f"__d{i}") for i, d in enumerate(dimensions)]), "hilbert-slim")
    texts = [i for i, d in enumerate(dimensions) if not _is_number(docs, d)]
    numbers = [i for i in range(len(dimensions)) if i not in texts]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = slim.agg(F.count("*"), *[F.percentile_approx(f"__d{i}", steps, 1 << (bits + 4)).alias(f"c{i}")
                                    for i in numbers]).first()  # 2 ** bits numbers a dimension

    def cell(i: int) -> Column:
        if i in texts:
            return F.coalesce(F.col(f"__t{i}"), F.lit(0))
        marks = F.array(*[F.lit(float(c)) for c in cuts[f"c{i}"] or []]).cast("array<double>")
        return F.size(F.filter(marks, lambda c: F.coalesce(F.col(f"__d{i}") > c, F.lit(False))))

    for i in texts:
        slim = slim.join(_string_cells(slim, f"__d{i}", f"__t{i}", bits), f"__d{i}", "left")
    cells = slim.select("__key", "__rid", "size", "text_crc32", *[cell(i).alias(f"__c{i}") for i in range(len(dimensions))])
    order = ["curve", "text_crc32", "__key", "__rid"]
    curve = cells.select("__key", "__rid", "size", "text_crc32",
                         curve_index([F.col(f"__c{i}") for i in range(len(dimensions))], bits).alias("curve"))
    placed = stage(curve.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("__at", F.monotonically_increasing_id()), "hilbert-sorted")
    task = F.shiftright("__at", 33)
    counts = sorted(tuple(r) for r in placed.groupBy(task.alias("t")).agg(F.count("*"), F.min("__at")).collect())
    total, offsets = 0, []
    for t, n, first in counts:  # one row a task
        offsets.append((t, total - first))
        total += n
    shift = spark.createDataFrame(offsets, "__task bigint, __shift bigint")
    rank = F.col("__at") + F.col("__shift")
    shard = F.expr(f"(__rank * {shards}) div {max(total, 1)}")
    start = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return (placed.join(F.broadcast(shift), task == F.col("__task"))
            .withColumn("__rank", rank).withColumn("shard", shard.cast("int"))
            .withColumn("slot", F.col("__rank") - start)
            .select(F.col("__key").alias(key), "__rid", "size", "text_crc32", "curve", "shard", "slot"))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 dimensions: tuple = DIMENSIONS, shards: int = SHARDS, bits: int = BITS) -> None:
    """Whole rows, one folder ``__shard=<n>`` a shard, in curve order inside: Parquet minima and maxima prune all dimensions."""
    rows = stage(docs.withColumn("__id", F.monotonically_increasing_id()), "hilbert-docs")
    where = assign_shards(rows, "__id", text, dimensions, shards, bits).select("__id", F.col("shard").alias("__shard"), "slot")
    (rows.join(where, "__id").withColumnRenamed("slot", "__slot").drop("__id")
     .repartition("__shard", F.shiftright("__slot", 20)).sortWithinPartitions("__shard", "__slot")
     .drop("__slot").write.partitionBy("__shard").parquet(path))
