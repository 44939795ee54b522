"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased UTF-8 bytes and one end symbol; every byte is eight binary decisions, and each
decision node has a context tree of its own over the ``depth`` preceding bytes. A node of the tree mixes
its Krichevsky-Trofimov estimate with what its children say, half and half before the data: so all depths
from 0 to ``depth`` weigh in by how well they predicted the whole training corpus. Training counts are fixed;
scoring follows the path of contexts and mixes the estimates by the posterior weights.

How it runs on Spark: texts are cut into blocks of bounded size and kept bucketed by block. Every block sends its
distinct byte grams (context and byte) and distinct words with their training counts to slots: a gram's slot
follows from its nearest context bytes, so a slot holds whole subtrees below that depth. What is sent is sorted from
the nearest context byte outwards, delta-coded and compressed (some three bytes a gram). A slot adds up the counts of
all blocks, works out its subtrees and hands their roots on; the few depths above are worked out by grouped steps, and
only the two shallowest levels, at most 65,536 nodes, go to the driver. What the shallower depths say comes back to the
slots, and every slot answers each block with one number per gram or word, in the order in which the block sent them.
Blocks then score their texts. A block's grams are told apart by one sort of numbers that hold a gram and its text.
Nothing that grows with the corpus is broadcast or collected, and no count is cut off.

Null texts count as empty (one end symbol); a null id counts as training; repeated rows are scored each;
an empty table gives an empty result; a corpus without training rows scores every bit one half; a very long text is
a block of its own, in memory; ties do not occur. Only the two named columns are read, so no other column can clash.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import stage
from tidemark.session import scratch_path

DEPTH = 6  # contexts deep enough that their number grows with the corpus; grams of depth + 1 bytes fit a long up to 7
BLOCK_BYTES = 8 << 20
END = 0xFF  # no byte of UTF-8: end symbol, and what precedes a text
END_WORD = b"\xff"
BITS = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---- byte grams of a run of texts -------------------------------------------------------------------------

def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): the gram of every symbol of every text in a row, and where each text begins."""
    pad = bytes([END]) * depth
    raw = np.frombuffer(pad + pad.join(texts) + pad, dtype=np.uint8) if texts else np.zeros(0, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if not len(sizes):
        return np.zeros(0, dtype=np.int64), sizes
    codes = np.zeros(len(raw) - depth, dtype=np.int64)
    for i in range(depth + 1):
        codes <<= 8
        codes |= raw[i:len(raw) - depth + i]
    # the padding behind a text is its end symbol and depth - 1 bytes that nobody predicts
    begin = np.concatenate([[0], np.cumsum(sizes + depth)[:-1]])
    keep = np.ones(len(codes), dtype=bool)
    for k in range(1, depth):
        keep[(begin + sizes + k)[begin + sizes + k < len(codes)]] = False
    return codes[keep], np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])


# ---- the weighted trees -----------------------------------------------------------------------------------

def lgamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for positive arguments (recurrence, then Stirling's series)."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability that the KT estimator gives any sequence of a zeros and b ones."""
    return lgamma(a + 0.5) + lgamma(b + 0.5) - math.log(math.pi) - lgamma(a + b + 1.0)


def bit_path(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, bit) of the eight decisions of each symbol; node 1 is the first."""
    j = np.arange(BITS)
    nodes = (1 << j) | (symbols[:, None] >> (BITS - j))
    return nodes, (symbols[:, None] >> (BITS - 1 - j)) & 1


class Level:
    """Counts of every (context, decision node) of one depth, sorted by key = context << 8 | node."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        """``below``: per key, the sum of the children's weighted log probabilities; None at full depth."""
        self.keys, self.n0, self.n1 = keys, n0, n1
        kt = log_kt(n0, n1)
        if below is None:
            self.log_pw, self.stop = kt, np.ones(len(keys))
        else:
            self.log_pw = np.logaddexp(kt, below) - math.log(2)
            self.stop = np.exp(kt - math.log(2) - self.log_pw)

    def mixed(self, state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        """``state`` of every key with this level's estimates mixed in.

        A state is what the shallower levels say: (mass on 0, mass on 1, weight left for this level and deeper).
        """
        zero, one, left = state
        own, n = left * self.stop, self.n0 + self.n1 + 1.0
        return zero + own * (self.n0 + 0.5) / n, one + own * (self.n1 + 0.5) / n, left - own


def parents(keys: np.ndarray, width: int) -> np.ndarray:
    """Keys one depth shallower; the contexts of ``keys`` are ``width`` bytes."""
    return ((keys >> 8) & ((1 << 8 * (width - 1)) - 1)) << 8 | (keys & 0xFF)


def take(state: tuple[np.ndarray, ...], at: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(x[at] for x in state)


def level_from_children(child: Level, width: int) -> Level:
    """The next shallower depth; contexts of the children are ``width`` bytes."""
    keys, at = np.unique(parents(child.keys, width), return_inverse=True)
    total = lambda x: np.bincount(at, weights=x, minlength=len(keys))
    return Level(keys, total(child.n0), total(child.n1), total(child.log_pw))


def gram_level(codes: np.ndarray, counts: np.ndarray) -> Level:
    """The deepest level: the contexts of the gram codes; a count of 0 makes nodes that say one half."""
    nodes, bits = bit_path(codes & 0xFF)
    keys = (((codes >> 8)[:, None] << 8) | nodes).ravel()
    n = np.repeat(counts.astype(np.float64), BITS)
    found, at = np.unique(keys, return_inverse=True)
    at = at.ravel()
    ones = np.bincount(at, weights=n * bits.ravel(), minlength=len(found))
    return Level(found, np.bincount(at, weights=n, minlength=len(found)) - ones, ones, None)


def levels_up(deepest: Level, width: int, base: int) -> list[Level]:
    """Levels of depth ``width`` (the given one) to ``base``."""
    out = [deepest]
    for w in range(width, base, -1):
        out.append(level_from_children(out[-1], w))
    return out


def states_down(levels: list[Level], base: int, state: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """State at each key of the deepest of ``levels`` (deepest first), before that level is mixed in.

    ``state`` is that of the keys of the last level, whose contexts are ``base`` bytes.
    """
    for width, (child, level) in enumerate(zip(levels[-2::-1], levels[:0:-1]), base + 1):
        state = take(level.mixed(state), np.searchsorted(level.keys, parents(child.keys, width)))
    return state


# ---- what blocks and slots tell each other ------------------------------------------------------------------

GRAMS, WORDS = 0, 1
FIXED = 1 << 24  # log10 probabilities travel as integers of this part


def slot_depth(depth: int) -> int:
    """Context bytes that decide a gram's slot; the trees below that depth lie in one slot."""
    return 3 if depth > 4 else 2


def slots_of(contexts: np.ndarray, width: int, slots: int) -> np.ndarray:
    """Slot of contexts, by their ``width`` nearest bytes."""
    near = (contexts & ((1 << 8 * width) - 1)).astype(np.uint64)
    return ((near * _MIX >> np.uint64(32)) % np.uint64(slots)).astype(np.int32)


def outwards(codes: np.ndarray, depth: int) -> np.ndarray:
    """Codes with the nearest context byte in front and the symbol last; its own inverse but for the order of bytes."""
    codes, out = codes.view(np.uint64), np.zeros(len(codes), dtype=np.uint64)
    for i in [*range(1, depth + 1), 0]:
        out = out << np.uint64(8) | codes >> np.uint64(8 * i) & np.uint64(0xFF)
    return out


def inwards(turned: np.ndarray, depth: int) -> np.ndarray:
    out = np.zeros(len(turned), dtype=np.uint64)
    for i in [*range(1, depth + 1), 0]:
        out = out << np.uint64(8) | turned >> np.uint64(8 * i) & np.uint64(0xFF)
    return out.view(np.int64)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers of any width by byte planes, compressed."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Distinct:
    """Distinct codes, ascending, with their counts. Codes are told apart by a hash table; only those that lost their
    place in it to another code are sorted."""

    BITS = 22

    def __init__(self, codes: np.ndarray):
        slot = self._slot(codes)
        self.seen = np.zeros(1 << self.BITS, dtype=np.int64)
        self.seen[slot] = codes
        same = self.seen[slot] == codes
        n = np.bincount(slot[same], minlength=1 << self.BITS)
        used = np.flatnonzero(n)
        rest, rest_n = np.unique(codes[~same], return_counts=True)
        keys = np.concatenate([self.seen[used], rest])
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], np.concatenate([n[used], rest_n])[order]
        self.place = np.zeros(1 << self.BITS, dtype=np.int32)  # of a slot's code among the keys
        back = np.empty(len(order), dtype=np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        self.place[used] = back[:len(used)]

    @classmethod
    def _slot(cls, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * _MIX) >> np.uint64(64 - cls.BITS)).astype(np.int32)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Places of ``codes`` (every one is there) among the keys."""
        slot = self._slot(codes)
        at = self.place[slot]
        lost = np.flatnonzero(self.seen[slot] != codes)
        at[lost] = np.searchsorted(self.keys, codes[lost])
        return at


def in_slots(codes: np.ndarray, depth: int, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(turned codes, slot of each, order of ``codes``) by slot, then outwards."""
    turned, slot = outwards(codes, depth), slots_of(codes >> 8, slot_depth(depth), slots)
    order = np.argsort(turned)
    order = order[np.argsort(slot[order], kind="stable")]
    return turned[order], slot[order], order


class Tagged:
    """Every gram of some texts with its text's tag, by one sort of numbers that hold both.

    A gram is a number to the base of how many different bytes the texts have, the nearest context byte in front, the
    symbol last, then the tag's bits: the grams come outwards in order, equal ones beside each other, with no table to
    look anything up in.
    """

    def __init__(self, raw: np.ndarray, sizes: np.ndarray, tags: np.ndarray, depth: int, present: np.ndarray, shift: int):
        self.depth, self.present, self.base, self.shift = depth, present, np.uint64(len(present)), shift
        dense = np.zeros(256, dtype=np.uint8)
        dense[present] = np.arange(len(present), dtype=np.uint8)
        dense, n = dense[raw], len(raw) - depth
        full = np.zeros(n, dtype=np.uint64)
        for k in [*range(1, depth + 1), 0]:
            full *= self.base
            full += dense[depth - k:depth - k + n]
        full <<= np.uint64(shift)
        full |= np.repeat(tags.astype(np.uint64), sizes + depth)
        behind = np.cumsum(sizes + depth)
        for k in range(1, depth):  # the padding behind an end symbol, which nobody predicts: to the end and off
            full[behind - k] = np.uint64(np.iinfo(np.uint64).max)
        full.sort()
        self.full = full[:n - len(sizes) * (depth - 1)]
        codes = self.full >> np.uint64(shift)
        self.first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        self.keys = codes[self.first]
        self.counts = np.diff(self.first, append=len(codes))

    @classmethod
    def of(cls, texts: list[bytes], tags: np.ndarray, depth: int) -> Tagged | None:
        """None where 63 bits don't hold a gram and a tag, and without texts."""
        if not texts:
            return None
        pad = bytes([END]) * depth
        raw = np.frombuffer(pad + pad.join(texts) + pad, dtype=np.uint8)
        present = np.flatnonzero(np.bincount(raw, minlength=256))
        shift = int(tags.max()).bit_length()
        if (len(present) ** (depth + 1) - 1).bit_length() + shift > 63:
            return None
        return cls(raw, np.array([len(t) for t in texts], dtype=np.int64), tags, depth, present, shift)

    def tags(self) -> np.ndarray:
        return (self.full & np.uint64((1 << self.shift) - 1)).view(np.int64)

    def bytes_of(self, values: np.ndarray, n: int) -> list[np.ndarray]:
        """The ``n`` bytes of each value, the first in front."""
        out = []
        for _ in range(n):
            rest = values // self.base
            out.append(self.present[(values - rest * self.base).view(np.int64)])
            values = rest
        return out[::-1]

    def turned(self) -> np.ndarray:
        """The distinct grams as ``outwards`` has them."""
        out = np.zeros(len(self.keys), dtype=np.uint64)
        for x in self.bytes_of(self.keys, self.depth + 1):
            out = out << np.uint64(8) | x.astype(np.uint64)
        return out

    def in_slots(self, slots: int) -> tuple[np.ndarray, np.ndarray]:
        """(slot of each, order) of the distinct grams by slot, then outwards: runs of near contexts move as they are."""
        base = slot_depth(self.depth)
        near = self.keys // np.uint64(len(self.present) ** (self.depth + 1 - base))
        first = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]]))
        context = sum(x << 8 * k for k, x in enumerate(self.bytes_of(near[first], base)))
        slot, n = slots_of(context, base, slots), np.diff(first, append=len(near))
        order = np.argsort(slot, kind="stable")
        n = n[order]
        return np.repeat(slot[order], n), np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(len(near))


def sent_grams(held: list[bool], body: list[bytes], depth: int, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(turned codes, slot of each, training count) of a block's distinct grams by slot, then outwards."""
    if told := Tagged.of(body, np.array(held, dtype=np.int64), depth):
        out = np.add.reduceat(told.tags(), told.first)
        slot, order = told.in_slots(slots)
        return told.turned()[order], slot, (told.counts - out)[order].astype("<u4")
    found = Distinct(grams([t for h, t in zip(held, body) if not h], depth)[0])
    other = np.setdiff1d(Distinct(grams([t for h, t in zip(held, body) if h], depth)[0]).keys, found.keys, assume_unique=True)
    n = np.concatenate([found.counts, np.zeros(len(other), dtype=np.int64)]).astype("<u4")
    turned, slot, order = in_slots(np.concatenate([found.keys, other]), depth, slots)
    return turned, slot, n[order]


def text_sums(body: list[bytes], depth: int, slots: int, answered: np.ndarray) -> np.ndarray:
    """Per text, the sum of what was answered to its grams; the answers are in the order of ``sent_grams``."""
    values = np.empty(len(answered))
    if told := Tagged.of(body, np.arange(len(body)), depth):
        values[told.in_slots(slots)[1]] = answered
        return np.bincount(told.tags(), weights=np.repeat(values, told.counts), minlength=len(body))
    codes, first = grams(body, depth)
    distinct = Distinct(codes)
    values[in_slots(distinct.keys, depth, slots)[2]] = answered
    each = np.empty(len(codes))
    for lo in range(0, len(codes), 1 << 20):  # some at a time: the block's codes are large enough
        each[lo:lo + (1 << 20)] = values[distinct.find(codes[lo:lo + (1 << 20)])]
    return np.add.reduceat(each, first) if len(body) else np.zeros(0)


_SPACED = bytes(0x20 if 0x09 <= c <= 0x0D else c for c in range(256))


def words_of(body: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct words, number of every word in a row, words of each text) by bytes alone; without the end words."""
    raw = np.frombuffer(b" ".join([b"", *body, b""]).translate(_SPACED), dtype=np.uint8)
    space = raw == 0x20
    begins = ~space[1:] & space[:-1]
    ends = np.cumsum([0, *(len(t) + 1 for t in body)])
    sizes = np.diff(np.searchsorted(np.flatnonzero(begins), ends))
    raw = raw[1:][~(space[1:] & space[:-1])]  # every word and one space
    cut = np.flatnonzero(raw == 0x20) + 1
    told = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [
        None, pa.py_buffer(np.append(0, cut)), pa.py_buffer(raw)]).dictionary_encode()
    return (b"".join(told.dictionary.to_numpy(zero_copy_only=False).tolist()).split(b" ")[:-1],
            told.indices.to_numpy().astype(np.int64), sizes)


def word_slot(word: bytes, slots: int) -> int:
    return zlib.crc32(word) % slots


PARTS = "slot int, block bigint, kind int, keys binary, counts binary"
PARTS_ARROW = pa.schema([("slot", pa.int32()), ("block", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def block_parts(block: int, held: list[bool], body: list[bytes], depth: int, slots: int) -> pa.RecordBatch:
    """What one block sends: a row a slot for its grams and one for its words (those without training count 0)."""
    found, at, sizes = words_of(body)
    n = np.bincount(at[np.repeat(~np.array(held, dtype=bool), sizes)], minlength=len(found))
    words = dict(zip(found, n.tolist()))
    words[END_WORD] = len(held) - sum(held)
    turned, slot, n = sent_grams(held, body, depth, slots)
    cuts = np.flatnonzero(np.diff(slot)) + 1
    rows = [(int(s[0]), block, GRAMS, squeeze(np.diff(t, prepend=np.uint64(0))), squeeze(c))
            for s, t, c in zip(np.split(slot, cuts), np.split(turned, cuts), np.split(n, cuts)) if len(s)]
    by_slot: dict[int, list[bytes]] = {}
    for w in sorted(words):
        by_slot.setdefault(word_slot(w, slots), []).append(w)
    rows += [(s, block, WORDS, zstandard.compress(b"\n".join(ws), 1), squeeze(np.array([words[w] for w in ws], dtype="<u4")))
             for s, ws in by_slot.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), PARTS_ARROW)], schema=PARTS_ARROW)


class Slot:
    """The parts of one slot, added up."""

    def __init__(self, parts: pa.Table, depth: int):
        rows = list(zip(*(parts.column(c).to_pylist() for c in ("block", "kind", "keys", "counts"))))
        self.grams = [(b, np.cumsum(unsqueeze(k, "<u8"), dtype=np.uint64), unsqueeze(n, "<u4")) for b, kind, k, n in rows if kind == GRAMS]
        self.words = [(b, zstandard.decompress(k).split(b"\n"), unsqueeze(n, "<u4")) for b, kind, k, n in rows if kind == WORDS]
        turned = np.concatenate([k for _, k, _ in self.grams]) if self.grams else np.zeros(0, dtype=np.uint64)
        n = np.concatenate([n for *_, n in self.grams]).astype(np.int64) if self.grams else np.zeros(0, dtype=np.int64)
        order = np.argsort(turned)
        turned, n = turned[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], turned[1:] != turned[:-1]])) if len(turned) else np.zeros(0, dtype=np.int64)
        self.turned = turned[first]
        self.codes = inwards(self.turned, depth)
        self.n = np.add.reduceat(n, first) if len(first) else n
        self.total: Counter = Counter()
        for _, ws, n in self.words:
            for w, c in zip(ws, n.tolist()):
                self.total[w] += c


STATS = -1  # the node number of a slot's word statistics


def model_answers(parts: DataFrame, depth: int, slots: int) -> tuple[DataFrame, int, int]:
    """``(block, slot, kind, values)`` for every part, the training tokens and the distinct ones."""
    base = slot_depth(depth)
    node_columns = "node bigint, n0 double, n1 double, log_pw double"

    def roots(table: pa.Table) -> pa.Table:
        slot = Slot(table, depth)
        cols = [[STATS], [float(sum(slot.total.values()))], [float(sum(c > 0 for c in slot.total.values()))], [0.0]]
        if len(slot.codes):
            root = levels_up(gram_level(slot.codes, slot.n), depth, base)[-1]
            cols = [np.concatenate([a, b]) for a, b in zip(cols, (root.keys, root.n0, root.n1, root.log_pw))]
        return pa.Table.from_arrays([pa.array(np.asarray(c), type=f.type) for c, f in zip(cols, nodes_arrow)], schema=nodes_arrow)

    nodes_arrow = to_arrow_schema(StructType.fromDDL(node_columns))
    found = stage(parts.groupBy("slot").applyInArrow(roots, node_columns), "ctw-nodes")
    stats = found.where(F.col("node") == STATS).agg(F.coalesce(F.sum("n0"), F.lit(0.0)), F.coalesce(F.sum("n1"), F.lit(0.0))).first()
    nodes = found.where(F.col("node") != STATS)

    def level_of(pdf: pd.DataFrame) -> Level:
        pdf = pdf.sort_values("node")
        level = Level(*(pdf[c].to_numpy() for c in ("node", "n0", "n1")), None)
        level.log_pw = pdf["log_pw"].to_numpy()
        return level

    def step_up(pdf: pd.DataFrame) -> pd.DataFrame:
        root = level_from_children(level_of(pdf), base)
        return pd.DataFrame({"node": root.keys, "n0": root.n0, "n1": root.n1, "log_pw": root.log_pw})

    context2 = F.shiftright("node", 8).bitwiseAND(F.lit(0xFFFF))  # at most 256 contexts of three bytes each
    two = nodes if base == 2 else stage(nodes.groupBy(context2.alias("c")).applyInPandas(step_up, node_columns), "ctw-nodes")
    # sums over the children of the 256 contexts of one byte: at most 65,536 rows
    rows = two.groupBy(F.col("node").bitwiseAND(F.lit(0xFFFF)).alias("node")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_pw").alias("below")).toPandas().sort_values("node")
    one = Level(*(rows[c].to_numpy() for c in ("node", "n0", "n1", "below")))
    zero = level_from_children(one, 1)
    start = (np.zeros(len(zero.keys)), np.zeros(len(zero.keys)), np.ones(len(zero.keys)))
    top_keys, top = one.keys, one.mixed(states_down([one, zero], 0, start))

    def below_top(keys: np.ndarray) -> tuple[np.ndarray, ...]:
        return take(top, np.searchsorted(top_keys, parents(keys, 2)))

    def answers(table: pa.Table, state) -> pa.Table:
        """``state(keys)`` is what the shallower depths say at the slot's roots."""
        slot = Slot(table, depth)
        at = int(table.column("slot")[0].as_py()) if len(table) else 0
        out = []
        if len(slot.codes):
            levels = levels_up(gram_level(slot.codes, slot.n), depth, base)
            told = states_down(levels, base, state(levels[-1].keys))
            p0, p1, _ = levels[0].mixed(told)
            value = np.zeros(len(slot.codes))
            for lo in range(0, len(slot.codes), 1 << 16):  # eight decisions a gram, some grams at a time
                codes = slot.codes[lo:lo + (1 << 16)]
                path, bits = bit_path(codes & 0xFF)
                node = np.searchsorted(levels[0].keys, ((codes >> 8)[:, None] << 8) | path)
                value[lo:lo + len(codes)] = np.log10(np.where(bits == 1, p1[node], p0[node])).sum(axis=1)
            fixed = np.round(value * FIXED).astype("<i4")
            out += [(b, at, GRAMS, squeeze(fixed[np.searchsorted(slot.turned, k)])) for b, k, _ in slot.grams]
        out += [(b, at, WORDS, squeeze(np.array([slot.total[w] for w in ws], dtype="<u8"))) for b, ws, _ in slot.words]
        cols = list(zip(*out)) or [()] * 4
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, answer_arrow)], schema=answer_arrow)

    answer_columns = "block bigint, slot int, kind int, data binary"
    answer_arrow = to_arrow_schema(StructType.fromDDL(answer_columns))
    if base == 2:
        told = parts.groupBy("slot").applyInArrow(lambda t: answers(t, below_top), answer_columns)
    else:
        def step_down(pdf: pd.DataFrame) -> pd.DataFrame:
            child = level_of(pdf)
            levels = [child, level_from_children(child, base)]
            state = states_down(levels, 2, below_top(levels[-1].keys))
            return pd.DataFrame({"slot": slots_of(child.keys >> 8, base, slots), "node": child.keys, "zero": state[0],
                                 "one": state[1], "rest": state[2]})

        states = stage(nodes.groupBy(context2.alias("c")).applyInPandas(
            step_down, "slot int, node bigint, zero double, one double, rest double"), "ctw-states")

        def with_states(table: pa.Table, said: pa.Table) -> pa.Table:
            keys = said.column("node").to_numpy()
            order = np.argsort(keys)
            told = tuple(said.column(c).to_numpy()[order] for c in ("zero", "one", "rest"))
            return answers(table, lambda wanted: take(told, np.searchsorted(keys[order], wanted)))

        told = parts.groupBy("slot").cogroup(states.groupBy("slot")).applyInArrow(with_states, answer_columns)
    return told, int(stats[0]), int(stats[1])


# ---- blocks -----------------------------------------------------------------------------------------------

def in_blocks(docs: DataFrame, key: str, text: str, block_bytes: int) -> DataFrame:
    """Kept (block, key, held_out, body): rows in the order read, blocks of about ``block_bytes``."""
    kind = docs.schema[key].dataType.simpleString()
    schema = StructType.fromDDL(f"block bigint, `{key}` {kind}, held_out boolean, body binary")
    arrow = to_arrow_schema(schema)
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))

    def run(batches):
        block, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            body = [(t or "").encode("utf-8", "surrogatepass").lower() for t in b.column(2).to_pylist()]
            blocks = []
            for x in body:
                if held >= block_bytes:
                    block, held = block + 1, 0
                held += len(x) + 1
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, type=pa.int64()), b.column(0), b.column(1),
                                              pa.array(body, type=arrow.field(3).type)], schema=arrow)

    spark = docs.sparkSession
    cut = docs.select(key, (crc % 7 == 2).alias("held_out"), text).mapInArrow(run, schema)
    # bucketed by block in the shared folder: the texts are not shuffled when the answers join them
    name = f"ctw_blocks_{uuid.uuid4().hex[:12]}"
    (cut.write.option("compression", "zstd").option("path", scratch_path(spark, name))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name))
    return spark.table(name)


def all_parts(blocks: DataFrame, depth: int, slots: int) -> DataFrame:
    """What the blocks send to the slots; the buckets bring a block's texts together."""
    def run(texts: pa.Table) -> pa.Table:
        block, held, body = (texts.column(c).to_pylist() for c in ("block", "held_out", "body"))
        return pa.Table.from_batches([block_parts(block[0], held, body, depth, slots)])

    return blocks.select("block", "held_out", "body").groupBy("block").applyInArrow(run, PARTS)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    blocks = in_blocks(docs, key, text, block_bytes)
    slots = max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = stage(all_parts(blocks, depth, slots), "ctw-parts")
    answers, n_train, n_distinct = model_answers(parts, depth, slots)
    denominator = float(n_train + n_distinct + 1)
    kind = docs.schema[key].dataType.simpleString()
    out = StructType.fromDDL(f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                             "base_score double, score double, bits_per_byte double")
    arrow = to_arrow_schema(out)

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        body = texts.column("body").to_pylist()
        rows = sorted(zip(*(told.column(c).to_pylist() for c in ("kind", "slot", "data"))), key=lambda r: r[:2])
        lp = text_sums(body, depth, slots, np.concatenate([unsqueeze(d, "<i4") for k, _, d in rows if k == GRAMS]) / FIXED)
        found, at, sizes = words_of(body)
        found.append(END_WORD)
        by_slot: dict[int, list[bytes]] = {}
        for w in sorted(found):
            by_slot.setdefault(word_slot(w, slots), []).append(w)
        index = {w: i for i, w in enumerate(w for s in sorted(by_slot) for w in by_slot[s])}
        c = np.concatenate([unsqueeze(d, "<u8") for k, _, d in rows if k == WORDS]).astype(np.float64)
        c = c[np.fromiter(map(index.__getitem__, found), dtype=np.int64, count=len(found))]
        logs, known = np.log10((c + 1) / denominator), c > 0
        of = np.repeat(np.arange(len(body)), sizes)
        base = np.bincount(of, weights=logs[at], minlength=len(body)) + logs[-1]
        n_known = np.bincount(of, weights=known[at], minlength=len(body)).astype(np.int64) + int(known[-1])
        n_bytes = np.array([len(t) + 1 for t in body])
        return pa.Table.from_arrays(
            [texts.column(key).cast(arrow.field(0).type), texts.column("held_out"), pa.array(sizes + 1),
             pa.array(n_known), pa.array(np.full(len(body), n_train)),
             pa.array(base), pa.array(lp), pa.array(-lp / math.log10(2) / n_bytes)],
            schema=arrow)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, out)
