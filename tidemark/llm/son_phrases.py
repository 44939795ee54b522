"""Collocations by SON partitioning: phrases frequent in some shard are candidates, counted exactly over all.

The table's partitions are dealt to ``shards`` shards of about equal size. Where a phrase occurs ``min_count`` times
in all, some shard holds an equal share of them, ``min_count / shards``, whatever the shards' sizes. So each shard is
mined completely at that lowered support, the phrases locally frequent anywhere are united, and a last pass counts
just these over the whole table, by their text. The number of shards is fixed, so the local support is as strict on a
large table as on a small one; a shard of any size is mined by as many tasks as it has partitions, and no task
holds more than a group of documents (``GROUP_BYTES``, or one longer text) and some millions of counts.

A shard is mined level by level: a phrase of n words can be frequent only if both its parts of n - 1 words are. These
passes work on hashes in numpy: a task counts the hashed phrases of its texts and sends them as sorted, delta-coded
blocks (some three bytes a phrase), one for each slot of the hash space; a slot's blocks are added up shard by shard.
The previous level is carried as a bit filter of a fixed size (``FILTER_BITS``). Filters and equal hashes can only let
phrases through in excess, never lose one: what is returned rests on the last pass, which counts phrases as text.
Phrases are counted per task before they leave it, so one in a third of all rows costs no more than any other.

Defined results: a null text has no words; a null lang reads ``und``; repeated rows count again; a table without
frequent phrases gives no rows; ties in score and count are settled by the phrase's bytes; very long texts are hashed
in blocks, with their words' places and hashes in memory (some sixty bytes a word). Only the two named columns are
read, so no other column can clash.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

LONGEST, MIN_COUNT, TOP, COVER = 5, 100, 2000, 100
SHARDS = 4
GROUP_BYTES = 8 << 20
HELD = 1 << 22  # counted phrases a task holds before it sends them, as hashes and as text
HELD_PHRASES = 1 << 19
GRAM_BITS = 40  # of a hashed phrase
BLOCK_BYTES = 1 << 20  # hashed at once
FILTER_BITS = 26
FILTER_PART = 16  # bits of a filter that one row carries, as a power of two
NO_LANG = "und"

# The byte classes of the contract. 0: in a word, 1: between words, 2: between pieces.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[0x09, 0x20]] = 1
_CLASS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # the base of each of two hashes
_MASK = (1 << 64) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class WordHash:
    """Hashes of words given by their places in a byte array: sums of byte values times powers of an odd base."""

    def __init__(self, which: int):
        self.which, base = which, _ODD[which]
        self.byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))[_LOWER]
        self.power = self._powers(base)
        self.inverse = self._powers(pow(base, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        out = np.full(BLOCK_BYTES, base & _MASK, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        lo = 0
        while lo < len(starts):
            first = int(starts[lo])
            hi = int(np.searchsorted(ends, first + BLOCK_BYTES, "right"))
            if hi <= lo:  # one word longer than a block
                total, step = 0, 1
                for at in range(first, int(ends[lo]), BLOCK_BYTES):
                    part = data[at:min(at + BLOCK_BYTES, int(ends[lo]))]
                    total += int((self.byte[part] * self.power[:len(part)]).sum(dtype=np.uint64)) * step
                    step = step * int(self.power[-1]) * int(self.power[1]) & _MASK
                out[lo] = total & _MASK
                lo += 1
                continue
            part = data[first:int(ends[hi - 1])]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(self.byte[part] * self.power[:len(part)], dtype=np.uint64, out=sums[1:])
            s, e = starts[lo:hi] - first, ends[lo:hi] - first
            out[lo:hi] = (sums[e] - sums[s]) * self.inverse[s]
            lo = hi
        return out


class Group:
    """Words of some documents: places in ``data``, piece numbers, language codes and hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: list[str], hashes: list[WordHash]):
        kind = _CLASS[data]
        inside = kind == 0
        self.data, self.low = data, None
        edge = np.zeros(len(data) + 1, dtype=bool)  # a document's first byte
        edge[bounds] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        doc = np.searchsorted(bounds, self.starts, "right") - 1
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.starts) + doc
        names = {x: i for i, x in enumerate(dict.fromkeys(langs))}
        self.names = list(names)
        code = np.array([names[x] for x in langs], dtype=np.int32)
        self.lang = code[doc]
        seeds = [np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), h.which) for x in names], dtype=np.uint64)
                 for h in hashes]
        self.hash = [_mix(h(data, self.starts, self.ends) ^ s[self.lang]) for h, s in zip(hashes, seeds)]

    def text(self, at: int, words: int) -> bytes:
        if self.low is None:
            self.low, self.first, self.last = _LOWER[self.data].tobytes(), self.starts.tolist(), self.ends.tolist()
        return b" ".join([self.low[self.first[i]:self.last[i]] for i in range(at, at + words)])


def _groups(batches: Iterator[pa.RecordBatch], hashes: list[WordHash]) -> Iterator[Group]:
    for b in batches:
        langs = [NO_LANG if x is None else x for x in b.column(0).to_pylist()]
        texts = b.column(1).fill_null("").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + GROUP_BYTES, "right")) - 1)
            if offsets[hi] > offsets[lo]:
                yield Group(data[offsets[lo]:offsets[hi]], offsets[lo:hi] - offsets[lo], langs[lo:hi], hashes)
            lo = hi


def _gram(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - GRAM_BITS)


def _has(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    low = gram & np.uint64((1 << FILTER_BITS) - 1)
    high = gram >> np.uint64(GRAM_BITS - FILTER_BITS)
    at = lambda i: bits[(i >> np.uint64(3)).astype(np.int64)] >> (i & np.uint64(7)).astype(np.uint8) & 1
    return (at(low) & at(high)).astype(bool)


def _levels(g: Group, filters: list[np.ndarray], upto: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """``(n, places, hashes)`` of the phrases of n words whose parts passed the filters before; levels with a
    filter of their own are narrowed by it."""
    at = np.arange(len(g.starts))
    grams = g.hash
    for n in range(1, upto + 1):
        if n > 1:
            pair = np.flatnonzero(at[1:] == at[:-1] + 1)
            if n == 2:
                pair = pair[g.piece[at[pair]] == g.piece[at[pair] + 1]]
            at = at[pair]
            grams = [_mix(x[pair] * np.uint64(0xA0761D6478BD642F) + h[at + n - 1]) for x, h in zip(grams, g.hash)]
        if n <= len(filters):
            keep = _has(filters[n - 1], _gram(grams[0]))
            at, grams = at[keep], [x[keep] for x in grams]
        yield n, at, grams


def _runs(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Index of one place per run of equal hashes, and the runs' lengths. All hashes of a run agree."""
    order = np.argsort(grams[0])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for x in grams:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))


def _added(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, ascending, with their counts added up."""
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.diff(gram, prepend=gram[:1] + np.uint64(1))) if len(gram) else np.zeros(0, dtype=np.int64)
    return gram[first], np.add.reduceat(n, first) if len(first) else n


def squeeze(values: np.ndarray) -> bytes:
    """Numbers of any width by byte planes, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes(), 1)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def gram_blocks(docs: DataFrame, lang: str, text: str, shards: int, n: int, filters, slot_bits: int) -> DataFrame:
    """``(slot, shard, grams, counts)``: hashed phrases of n words whose parts passed the filters, counted per task."""
    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        kept, held = filters.value, []

        def send():
            gram, count = _added(*(np.concatenate(x) for x in zip(*held)))
            slot = gram >> np.uint64(GRAM_BITS - slot_bits)
            cuts = np.flatnonzero(np.diff(slot)) + 1
            rest = gram & np.uint64((1 << GRAM_BITS - slot_bits) - 1)
            grams = [squeeze(np.diff(x, prepend=np.uint64(0)).astype("<u4")) for x in np.split(rest, cuts)]
            counts = [squeeze(np.minimum(x, 0xFFFFFFFF).astype("<u4")) for x in np.split(count, cuts)]
            slots = slot[np.append(0, cuts)].astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array([shard] * len(slots), type=pa.int32()), pa.array(grams),
                                               pa.array(counts)], names=["slot", "shard", "grams", "counts"])

        for g in _groups(batches, [WordHash(0)]):
            for k, _, grams in _levels(g, kept, n):
                if k == n and len(grams[0]):
                    held.append(_added(_gram(grams[0]), np.ones(len(grams[0]), dtype=np.int64)))
            if sum(len(x) for x, _ in held) > HELD:
                yield send()
                held = []
        if held:
            yield send()

    return _texts(docs, lang, text).mapInArrow(run, "slot int, shard int, grams binary, counts binary")


def frequent_grams(blocks: DataFrame, support: int, slot_bits: int) -> DataFrame:
    """``(gram)``: all that reach ``support`` in some shard."""
    def merge(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
        for slot, of_slot in groupby(rows, key=itemgetter(0)):
            found = []
            for _, of_shard in groupby(of_slot, key=itemgetter(1)):
                parts = [(np.cumsum(unsqueeze(g, "<u4"), dtype=np.uint64), unsqueeze(n, "<u4").astype(np.int64))
                         for _, _, g, n in of_shard]
                gram, n = _added(*(np.concatenate(x) for x in zip(*parts)))
                found.append(gram[n >= support])
            gram = np.unique(np.concatenate(found)) | np.uint64(slot << GRAM_BITS - slot_bits)
            yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64))], names=["gram"])

    return blocks.repartition("slot").sortWithinPartitions("slot", "shard").mapInArrow(merge, "gram bigint")


def phrase_blocks(docs: DataFrame, lang: str, text: str, longest: int, filters, slots: int) -> DataFrame:
    """``(slot, lang, phrases, counts)``: the candidates as text, counted per task and sent sorted and compressed, one
    block a language for each slot of their checksums; a block without phrases carries the language's words."""
    names = ["slot", "lang", "phrases", "counts"]

    def blocks(held: dict[str, Counter], sizes: Counter):
        rows = [(0, x, None, squeeze(np.array([n], dtype="<i8"))) for x, n in sizes.items()]
        for x, counter in held.items():
            by_slot: dict[int, list[bytes]] = {}
            for phrase in sorted(counter):
                by_slot.setdefault(zlib.crc32(phrase) % slots, []).append(phrase)
            rows += [(slot, x, zstandard.compress(b"\n".join(some), 1), squeeze(np.array([counter[p] for p in some], dtype="<i8")))
                     for slot, some in by_slot.items()]
        cols = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
            cols, (pa.int32(), pa.string(), pa.binary(), pa.binary()))], names=names)

    def run(batches):
        kept, held, sizes = filters.value, defaultdict(Counter), Counter()
        for g in _groups(batches, [WordHash(i) for i in range(2)]):
            for x, n in zip(g.names, np.bincount(g.lang, minlength=len(g.names)).tolist()):
                sizes[x] += n
            for k, at, grams in _levels(g, kept, longest):
                first, count = _runs(grams)
                at = at[first]
                for x, i, n in zip(g.lang[at].tolist(), at.tolist(), count.tolist()):
                    held[g.names[x]][g.text(i, k)] += n
            if sum(map(len, held.values())) > HELD_PHRASES:
                yield blocks(held, sizes)
                held, sizes = defaultdict(Counter), Counter()
        yield blocks(held, sizes)

    return _texts(docs, lang, text).mapInArrow(run, "slot int, lang string, phrases binary, counts binary")


def phrase_totals(blocks: DataFrame, min_count: int) -> DataFrame:
    """``(lang, phrase, words, f)`` of all that reach ``min_count``; the null phrase carries a language's words."""
    def merge(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
        for (_, lang), some in groupby(rows, key=itemgetter(0, 1)):
            total: Counter = Counter()
            for _, _, phrases, counts in some:
                names = [None] if phrases is None else zstandard.decompress(phrases).split(b"\n")
                for p, n in zip(names, unsqueeze(counts, "<i8").tolist()):
                    total[p] += n
            found = [(p, n) for p, n in total.items() if p is None or n >= min_count]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), type=pa.string()),
                 pa.array([p and p.decode("utf-8", "surrogatepass") for p, _ in found], type=pa.string()),
                 pa.array([0 if p is None else p.count(b" ") + 1 for p, _ in found], type=pa.int32()),
                 pa.array([n for _, n in found], type=pa.int64())], names=["lang", "phrase", "words", "f"])

    together = blocks.repartition("slot").sortWithinPartitions("slot", "lang")
    return together.mapInArrow(merge, "lang string, phrase string, words int, f bigint")


def gram_filter(grams: DataFrame) -> np.ndarray:
    """The bit filter of ``grams(gram)``: two bits each out of 2^FILTER_BITS. Only the filter reaches the driver."""
    place = F.explode(F.array(F.col("gram").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)),
                              F.shiftright("gram", GRAM_BITS - FILTER_BITS)))
    placed = (grams.select(place.alias("i"))
              .select(F.shiftright("i", FILTER_PART).cast("int").alias("part"),
                      F.col("i").bitwiseAND(F.lit((1 << FILTER_PART) - 1)).cast("int").alias("bit"))
              .repartition("part"))

    def pack(batches):
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            part, bit = (b.column(i).to_numpy() for i in range(2))
            order = np.argsort(part, kind="stable")
            part, bit = part[order], bit[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            for p, bits in zip(part[np.append(0, cuts)] if len(part) else [], np.split(bit, cuts)):
                parts.setdefault(int(p), np.zeros(1 << FILTER_PART, dtype=bool))[bits] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), type=pa.int32()),
             pa.array([np.packbits(x, bitorder="little").tobytes() for x in parts.values()], type=pa.binary())],
            names=["part", "bits"])

    out = np.zeros(1 << FILTER_BITS - 3, dtype=np.uint8)
    size = 1 << FILTER_PART - 3
    for row in placed.mapInArrow(pack, "part int, bits binary").collect():
        out[row.part * size:(row.part + 1) * size] |= np.frombuffer(row.bits, dtype=np.uint8)
    return out


def candidates(docs: DataFrame, lang: str, text: str, min_count: int, longest: int, shards: int) -> list[np.ndarray]:
    """Filters of the locally frequent phrases of each length; a length without any ends the list."""
    spark, filters = docs.sparkSession, []
    support = -(-min_count // shards)
    slot_bits = max(8, (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())
    for n in range(1, longest + 1):
        held = spark.sparkContext.broadcast(filters)
        found = gram_filter(frequent_grams(gram_blocks(docs, lang, text, shards, n, held, slot_bits), support, slot_bits))
        if not found.any():
            break
        filters = [*filters, found]
    return filters


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
             longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, f)`` of all phrases of up to ``longest`` words that occur ``min_count`` times or more,
    single words included, and ``(lang, n)`` with all word occurrences; staged."""
    filters = candidates(docs, lang, text, min_count, longest, shards)
    held = docs.sparkSession.sparkContext.broadcast(filters)
    slots = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = stage(phrase_totals(phrase_blocks(docs, lang, text, len(filters), held, slots), min_count), "son-phrases")
    return every.where("phrase is not null"), every.where("phrase is null").select("lang", F.col("f").alias("n"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                 longest: int = LONGEST, top: int = TOP, cover: int = COVER, shards: int = SHARDS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    every, sizes = frequent(docs, lang, text, min_count, longest, shards)
    part = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    phrases = every.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    # phrases inside a longer one that is (almost) always around them
    inner = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
                   "i -> array_join(slice(w, i, m), ' '))))")
    longer = (phrases.where("words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("around")))
    own = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(cover) * F.col("a")))
    # every cut's halves are frequent themselves, so their counts are in the same table
    cuts = (own.select("lang", "phrase", "words", "a", "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
            .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"),
                    part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest")))
    left = every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang")
              .withColumn("above", F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n"))
              .withColumn("below", whole("l") * whole("r"))
              .withColumn("score", F.expr("above div below")))
    cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(cut).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
