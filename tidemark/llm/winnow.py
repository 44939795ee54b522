"""Benchmark decontamination by winnowing.

Texts and benchmark items are word sequences. Of every ``span - gram + 1`` consecutive word ``gram``-grams
the one with the smallest hash (the leftmost on ties) is kept as a fingerprint, so any span of ``span``
words shared by a text and an item holds a fingerprint that both kept at the same place: no shared span of
that length can be missed. Fingerprints are joined, and every hit is extended: the words around it are
compared and each run of ``span`` equal words counts as an occurrence.

Items shorter than ``span`` words are one window of their own length; texts keep all grams of exactly the
lengths (at most span - 1 of them) that such items have.

A bit filter of the benchmark's hashes (``FILTER_BITS`` bits, whatever the benchmark's size) drops text
fingerprints that no item can have before anything is shuffled; what passes carries its own words, so
neither texts nor items are read again.

Null and word-less texts have no words and no hits; null and word-less items have no window. Repeated rows
come out repeatedly (rows are told apart by a staged row id); an empty benchmark hits nothing, an empty table gives an
empty result; very long texts are read whole, their words in memory; equal hashes in a window are settled by the leftmost.
Only the named columns are read, so no other column can clash.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import item_words, map_columns, stage, with_row_id

SPAN = 10
GRAM = 5
FILTER_BITS = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)
MEMO = 400_000


class WordCodes(dict):
    """word -> 64-bit code, filled as words come; forgotten when large (codes never change)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` codes."""
    m = len(codes) - n + 1
    if m < 1:
        return codes[:0]
    h = np.full(m, n, dtype=np.uint64)
    for i in range(n):
        h = (h ^ codes[i:i + m]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def winnowed(codes: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept fingerprints; none for fewer than ``span`` words."""
    h = gram_hashes(codes, gram)
    w = span - gram + 1
    n = len(h) - w + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), h[:0]
    best, at = h[:n].copy(), np.arange(n)
    for i in range(1, w):
        lower = h[i:i + n] < best
        best[lower] = h[i:i + n][lower]
        at[lower] = np.nonzero(lower)[0] + i
    kept = np.unique(at)
    return kept, h[kept]


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


def _prints(words: list[bytes], codes: np.ndarray, span: int, gram: int, lengths, keep=None):
    """(hash, length, place, first, words) rows: ``place`` of the gram, ``first`` of the carried words."""
    found = [(0, *winnowed(codes, span, gram))]
    for n in lengths:
        h = gram_hashes(codes, n)
        found.append((n, np.arange(len(h)), h))
    out = []
    for n, at, h in found:
        if keep is not None and len(h):
            hit = keep[(h & np.uint64(FILTER_BITS - 1)).astype(np.int64)]
            at, h = at[hit], h[hit]
        for p, code in zip(at.tolist(), _signed(h)):
            lo = max(0, p - (span - gram)) if not n else p
            hi = p + span if not n else p + n
            out.append((code, n, p, lo, [x.decode("utf-8", "surrogatepass") for x in words[lo:hi]]))
    return out


def benchmark_prints(items: DataFrame, key: str = "item_id", text: str = "text", span: int = SPAN,
                     gram: int = GRAM) -> DataFrame:
    """(item, h, len, place, first, words): fingerprints of every item, len 0 for winnowed ones."""
    def rows(batches):
        for b in batches:
            out: dict = {c: [] for c in ("item", "h", "len", "place", "first", "words")}
            for k, t in zip(b[key], b[text]):
                words = item_words(t)
                codes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
                short = [len(words)] if 0 < len(words) < span else []
                for h, n, p, lo, ws in _prints(words, codes, span, gram, short):
                    for c, v in zip(out, (k, h, n, p, lo, ws)):
                        out[c].append(v)
            yield out

    kind = items.schema[key].dataType.simpleString()
    return map_columns(items, [key, text], f"item {kind}, h bigint, len int, place int, first int, words array<string>", rows)


def text_prints(docs: DataFrame, key: str, keep: np.ndarray, lengths: list[int], text: str = "text",
                span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row: key, n_words, and ``prints``: its fingerprints that the filter lets pass."""
    spark = docs.sparkSession
    packed = spark.sparkContext.broadcast(np.packbits(keep).tobytes())

    def rows(batches):
        mask = np.unpackbits(np.frombuffer(packed.value, dtype=np.uint8)).astype(bool)
        memo = WordCodes()
        for b in batches:
            n_words, prints = [], []
            for t in b[text]:
                words = item_words(t)
                codes = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
                n_words.append(len(words))
                prints.append([dict(zip(("h", "len", "place", "first", "words"), x))
                               for x in _prints(words, codes, span, gram, lengths, mask)])
            yield {key: b[key], "n_words": n_words, "prints": prints}

    kind = docs.schema[key].dataType.simpleString()
    return map_columns(docs, [key, text], f"`{key}` {kind}, n_words bigint, prints array<struct<h: bigint, "
                       "len: int, place: int, first: int, words: array<string>>>", rows)


def bit_filter(prints: DataFrame) -> np.ndarray:
    """FILTER_BITS booleans: at most that many slots reach the driver, however large the benchmark."""
    slots = prints.select(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("s")).distinct()
    keep = np.zeros(FILTER_BITS, dtype=bool)
    keep[slots.toPandas()["s"].to_numpy(dtype=np.int64)] = True
    return keep


def occurrences(prints: DataFrame, bench: DataFrame, rid: str, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(rid, item, start, length): every place where a window of the item stands in the row's words."""
    d = prints.select(rid, F.explode("prints").alias("p")).select(rid, "p.*")
    b = bench.select("item", "h", "len", F.col("place").alias("b_place"), F.col("first").alias("b_first"),
                     F.col("words").alias("b_words"))
    both = d.join(b, ["h", "len"])
    # a window starts `back` words before the common gram; it must lie within both carried runs
    backs = F.sequence(F.lit(0), F.when(F.col("len") > 0, F.lit(0)).otherwise(F.lit(span - gram)))
    n = F.when(F.col("len") > 0, F.col("len")).otherwise(F.lit(span))
    at, b_at = F.col("place") - F.col("back") - F.col("first"), F.col("b_place") - F.col("back") - F.col("b_first")
    return (both.withColumn("back", F.explode(backs)).withColumn("n", n)
            .where((at >= 0) & (b_at >= 0) & (at + F.col("n") <= F.size("words")) & (b_at + F.col("n") <= F.size("b_words")))
            .where(F.slice("words", at + 1, F.col("n")) == F.slice("b_words", b_at + 1, F.col("n")))
            .select(rid, "item", (F.col("place") - F.col("back")).alias("start"), F.col("n").alias("length"))
            .distinct())


def covered(starts: str) -> F.Column:
    """Words inside the intervals of a sorted array of (start, length) structs."""
    step = lambda acc, x: F.struct(
        (acc["c"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(acc["end"], x["start"]))).alias("c"),
        F.greatest(acc["end"], x["start"] + x["length"]).alias("end"))
    return F.aggregate(starts, F.struct(F.lit(0).alias("c"), F.lit(0).alias("end")), step, lambda acc: acc["c"])


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, item_ids (distinct, sorted as strings; null ids are not listed)."""
    rid = "__rid"
    bench = stage(benchmark_prints(items, item_key, text, span, gram), "winnow-items")
    lengths = sorted(r[0] for r in bench.where("len > 0").select("len").distinct().collect())  # below span
    prints = with_row_id(text_prints(docs, key, bit_filter(bench), lengths, text, span, gram), rid, "winnow-prints")
    found = stage(occurrences(prints.where(F.size("prints") > 0), bench, rid, span, gram), "winnow-hits")
    # a place may belong to many items: places and items are made distinct apart, then gathered per row
    places = (found.select(rid, "start", "length").distinct().groupBy(rid)
              .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("s"))
              .select(rid, covered("s").cast("long").alias("n_hit")))
    named = (found.select(rid, F.col("item").cast("string").alias("item")).distinct().groupBy(rid)
             .agg(F.sort_array(F.collect_list("item")).alias("item_ids")))
    return (prints.select(rid, key, "n_words").join(places, rid, "left").join(named, rid, "left")
            .select(key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))
