"""SimHash near-duplicates by multi-index hashing.

A fingerprint of ``BITS`` bits is cut into ``segments`` parts. Two fingerprints at most ``max_bits``
apart agree in at least one part up to ``max_bits // segments`` bits, so every fingerprint looks up the
small Hamming ball around each of its parts in a table keyed by the exact parts, and the complete
distance is verified for what the table returns. Only distinct fingerprints take part: copies were
merged by a grouped minimum before, however large their group.

A part shared by more than ``hot_bucket`` distinct fingerprints would make a quadratic number of
candidates. Such hot parts get an exact way of their own: their members are first linked through
common neighbours one bit away (a grouped minimum, linear in the members; it links everything up to two
bits apart), and only members of different groups of that kind are compared, under a key lengthened by
sub-parts of the remaining bits (still about n * n / 64 pairs of the n distinct fingerprints of one hot part).

Defined results: null, empty and word-less texts have fingerprint 0 and link like any other; very long texts are hashed
in parts; ties do not occur. Only the key and the text are read, so no other column can clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, plain_words, stage
from tidemark.llm.components import components

BITS = 64
CHUNK = 1 << 16  # shingles whose bits are counted at once: bounds memory on very long texts


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's word shingles, repeats included, as a signed 64-bit integer; no words: 0."""
    words = plain_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    hash64, join = xxhash.xxh64_intdigest, b" ".join
    for lo in range(0, n, CHUNK):
        part = words[lo:min(n, lo + CHUNK) + shingle - 1] if n > CHUNK else words
        shingles = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else (part,)
        codes = np.array([hash64(join(s), 42) for s in shingles], dtype="<u8")
        ones += np.unpackbits(codes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, key: str, text: str = "text", shingle: int = 3) -> DataFrame:
    """``(key, fp)`` for every row; null and empty texts have fingerprint 0."""
    def rows(batches):
        for b in batches:
            yield {key: b[key], "fp": [fingerprint(t, shingle) for t in b[text]]}

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, fp bigint", rows)


def _ball(width: int, radius: int) -> list[int]:
    """Masks of all patterns with at most ``radius`` of ``width`` bits set."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _part(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _masks(masks: list[int]) -> Column:
    return F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("bigint") for m in masks])


def _probes(fps: DataFrame, segments: int, radius: int) -> DataFrame:
    """(key, fp) for every part and every pattern in its ball; key = part number in front of the part."""
    width = BITS // segments
    masks = _masks(_ball(width, radius))
    parts = F.array(*[F.struct(F.lit(i).alias("i"), _part(F.col("fp"), i * width, width).alias("v"))
                      for i in range(segments)])
    return (fps.select("fp", F.explode(parts).alias("p"))
            .select("fp", "p.i", "p.v", F.explode(masks).alias("m"))
            .select((F.col("v").bitwiseXOR(F.col("m")) * segments + F.col("i")).alias("key"), "fp"))


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(fps: DataFrame, max_bits: int = 3, segments: int = 2, hot_bucket: int = 256) -> DataFrame:
    """Links ``(a, b)``, a > b, whose components are those of "at most max_bits differing bits".

    ``fps`` holds distinct fingerprints in column ``fp``, staged. Outside hot parts all links come out;
    inside, groups that common neighbours connect come as stars.
    """
    table = _probes(fps, segments, 0).withColumnRenamed("fp", "b")
    hot = stage(table.groupBy("key").count().where(F.col("count") > hot_bucket).select("key"), "mih-hot")
    probes = _probes(fps, segments, max_bits // segments).withColumnRenamed("fp", "a")
    some_hot = bool(hot.take(1))
    cold = table.join(hot, "key", "left_anti") if some_hot else table
    found = probes.join(cold, "key").where(F.col("a") > F.col("b")).where(_near("a", "b", max_bits)).select("a", "b")
    if not some_hot:
        return found.distinct()
    # hot parts: star links through common neighbours (two bits at most), then keys with sub-parts
    members = stage(table.join(hot, "key", "left_semi").select(F.col("b").alias("fp")).distinct(), "mih-members")
    around = members.select(F.explode(_masks(_ball(BITS, 1))).alias("m"), "fp").select(
        F.col("fp").bitwiseXOR(F.col("m")).alias("z"), "fp")
    low = around.groupBy("z").agg(F.min("fp").alias("b"))
    stars = stage(around.join(low, "z").where("fp > b").select(F.col("fp").alias("a"), "b").distinct(), "mih-stars")
    label = components(stars)
    def keyed(rows: DataFrame, fp: str) -> DataFrame:
        """The other bits, rotated to the front, in max_bits + 1 sub-parts: one of them agrees exactly."""
        width = BITS // segments
        turn = f"cast((key % {segments} + 1) * {width} as int)"
        sub = (BITS - width) // (max_bits + 1)
        turned = F.expr(f"shiftrightunsigned({fp}, {turn}) | shiftleft({fp}, {BITS} - {turn})")
        subs = F.array(*[_part(turned, i * sub, sub) for i in range(max_bits + 1)])
        return rows.select("key", fp, "g", F.posexplode(subs).alias("s", "v"))

    def grouped(rows: DataFrame, fp: str) -> DataFrame:
        return (rows.join(label, F.col(fp) == F.col("node"), "left")
                .withColumn("g", F.coalesce("component", fp)).drop("node", "component"))

    side_b = grouped(table.join(hot, "key", "left_semi"), "b")
    side_a = grouped(probes.join(hot, "key", "left_semi"), "a")
    t, p = keyed(side_b, "b"), keyed(side_a, "a")
    mixed = (t.groupBy("key", "s", "v").agg(F.min("g").alias("lo"), F.max("g").alias("hi")))
    t = t.withColumnRenamed("g", "gb")
    p = p.join(mixed, ["key", "s", "v"]).where("not (lo = hi and lo = g)").drop("lo", "hi").withColumnRenamed("g", "ga")
    cross = (p.join(t, ["key", "s", "v"]).where("ga <> gb").where(_near("a", "b", max_bits))
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    return found.unionByName(stars).unionByName(cross).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(key, fp, component)``: each row's fingerprint and the smallest ``key`` reachable over links.

    Rows with equal fingerprints are one node; the largest component may hold any share of the rows.
    A component whose keys are all null has component null; null keys never win over others. Repeated
    rows come out repeatedly; an empty table gives an empty one.
    """
    staged = stage(fingerprints(docs, key, shingle=shingle), "simhash")
    nodes = stage(staged.groupBy("fp").agg(F.min(key).alias("low")), "simhash-nodes")
    found = components(links(nodes.select("fp"), max_bits))
    label = stage(nodes.join(found, nodes.fp == found.node, "left")
                  .select("fp", "low", F.coalesce("component", "fp").alias("root")), "simhash-label")
    roots = label.groupBy("root").agg(F.min("low").alias("component"))
    named = label.join(roots, "root").select("fp", "component")
    return staged.join(named, "fp").select(key, "fp", "component")
