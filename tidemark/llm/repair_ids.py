"""Token ids in binary shards under Re-Pair grammar compression.

Documents are range-sorted by id and tokenized where they land. Each task cuts its run into shards of about
``SHARD_IDS`` ids; a shard is compressed by itself: in every round all adjacent pairs that pay for a rule become
nonterminals and are replaced, and rounds go on until no pair pays, or until a round saves less than one symbol in
``STALLED``: a rule and its length take twelve bytes, every use saves a symbol. Symbols take two bytes while they fit and four afterwards, which must pay too. No pair holds the end id,
so no nonterminal spans two documents, and any document can be decoded alone from its slice of the body. A shard is one row of a Parquet table:

    part, seq          the task and the shard's number in it; both ascend with the ids
    start              ids of the task before this shard
    rules              unsigned 32-bit pairs (left, right); nonterminal i is ``vocabulary + i``
    lengths            unsigned 32-bit expansion length of every nonterminal
    body               unsigned 32-bit or, if all symbols fit, 16-bit symbols (``wide``), all documents in a row
    ends               unsigned 32-bit end of every document in the body
    keys               ids of the documents, ascending, nulls first

Null and empty texts hold their end id alone; repeated ids are documents like any other (equal ids are
ordered by text, equal rows are interchangeable); an empty table gives an empty table; a very long text is a shard of its
own, in memory. Only the key and the text are read, so no other column can clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.tokens import word_tokenizer
from tidemark.session import scratch_path

END_ID = 2
VOCABULARY = 49_408
SHARD_IDS = 1 << 20
TOGETHER = 1 << 22  # characters of the documents that are tokenized together
ROWS = 256  # rows of a batch that are Python strings at once
RULE_BYTES = 12
STALLED = 1024
NARROW = 1 << 16  # symbols that two bytes tell apart


def counted_pairs(seq: np.ndarray, end: int, least: int, places: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(pairs, their counts, places, pair of each place) of the pairs found ``least`` times at ``places`` (none: all).

    Pairs and their places are sorted as one number, or by the pairs where 62 bits don't hold both.
    """
    symbol, bits = int(seq.max()).bit_length(), len(seq).bit_length()
    if places is None and 2 * symbol + bits <= 62:  # all at once: pairs with the end id go to the end and off
        both = (seq[:-1] << symbol | seq[1:]) << bits | np.arange(len(seq) - 1)
        ends = np.flatnonzero(seq == end)
        both[ends[ends < len(both)]] = both[ends[ends > 0] - 1] = np.iinfo(np.int64).max
        both.sort()
        both = both[:np.searchsorted(both, np.iinfo(np.int64).max)]
    else:
        if places is None:
            places = np.flatnonzero((seq[:-1] != end) & (seq[1:] != end))
        codes = seq[places] << symbol | seq[places + 1]
        both = np.sort(codes << bits | places) if 2 * symbol + bits <= 62 else None
    if both is not None:
        codes, places = both >> bits, both & (1 << bits) - 1
    else:
        order = np.argsort(codes, kind="stable")
        codes, places = codes[order], places[order]
    first = np.flatnonzero(np.concatenate([codes[:1] >= 0, codes[1:] != codes[:-1]]))
    size = np.diff(first, append=len(codes))
    left, right = codes[first] >> symbol, codes[first] & (1 << symbol) - 1
    n = np.where(left == right, (size + 1) // 2, size)  # of a row of equal symbols half the pairs can go
    enough = n >= least
    of = np.repeat(np.where(enough, np.cumsum(enough) - 1, -1).astype(np.int32), size)
    pair_at = np.full(len(seq), -1, dtype=np.int32)
    pair_at[places] = of
    at = np.flatnonzero(pair_at >= 0)
    return (left << 32 | right)[enough], n[enough], at, pair_at[at]


def paying_pairs(seq: np.ndarray, end: int, least: int, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, places, pair of each place): places to replace, no two overlapping, every pair used ``least`` times."""
    return paying_places(seq, end, least, places)[:3]


def paying_places(seq: np.ndarray, end: int, least: int, places: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """What ``paying_pairs`` gives, and the places that may still pay; only pairs at ``places`` (none: all) are counted."""
    pairs, n, at, of = counted_pairs(seq, end, least, places)
    left = at
    # of pairs that overlap the more frequent one goes (or the later by code: the same one in every repetition)
    rank = np.empty(len(pairs), dtype=np.int32)
    rank[np.argsort(n, kind="stable")] = np.arange(len(pairs), dtype=np.int32)
    gone, chosen = np.zeros(len(seq) + 1, dtype=bool), []
    while len(at):
        mine, touch = rank[of], np.diff(at) == 1
        top = np.ones(len(at), dtype=bool)
        top[1:] &= ~touch | (mine[1:] >= mine[:-1])
        top[:-1] &= ~touch | (mine[:-1] >= mine[1:])
        # what still overlaps is a row of equal symbols: its first, third, ... pair
        peak = np.flatnonzero(top)
        first = np.ones(len(peak), dtype=bool)
        first[1:] = np.diff(at[peak]) > 1
        peak = peak[(at[peak] - at[peak][first][np.cumsum(first) - 1]) % 2 == 0]
        chosen.append((at[peak], of[peak]))
        gone[at[peak]] = gone[at[peak] + 1] = True
        free = ~(gone[at] | gone[at + 1])
        at, of = at[free], of[free]
    if chosen:
        at, of = (np.concatenate(x) for x in zip(*chosen))
    uses = np.bincount(of, minlength=len(pairs))
    keep = uses[of] >= least
    return pairs, at[keep], of[keep], left


def compress(ids: np.ndarray, vocabulary: int = VOCABULARY, end: int = END_ID, narrow: int = NARROW) -> tuple[np.ndarray, np.ndarray]:
    """(rules, body): rules is an (n, 2) array of pairs, body the compressed symbols.

    A pair that was found too seldom never pays later on, for other rules only take places from it: after the first round
    only the places of other pairs and those beside new symbols are counted.
    """
    seq, places = ids.astype(np.int64), None
    rules: list[np.ndarray] = []
    n_rules, width = 0, 2 if vocabulary < narrow else 4
    while len(seq) > 1:
        pairs, at, of, left = paying_places(seq, end, RULE_BYTES // width + 1, places)
        if STALLED * len(at) < len(seq) or not len(at):
            break
        uses = np.bincount(of, minlength=len(pairs))
        chosen = np.flatnonzero(uses)
        room = narrow - vocabulary - n_rules
        if width == 2 and len(chosen) > room:
            if not room:  # every symbol of the body grows to four bytes: only where each is followed by one that pays
                if 5 * len(at) < 2 * len(seq):
                    break
                width = 4
            else:
                chosen = np.sort(chosen[np.argsort(-uses[chosen], kind="stable")[:room]])
        number = np.full(len(pairs), -1)
        number[chosen] = np.arange(len(chosen))
        new = number[of]
        at, new = at[new >= 0], new[new >= 0]
        seq[at] = vocabulary + n_rules + new
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        seq = seq[keep]
        moved = np.cumsum(keep, dtype=np.int32) - 1
        # what was left and stands yet, and the pairs before and behind a new symbol
        open_ = np.zeros(len(seq) + 1, dtype=bool)
        open_[moved[left[keep[left]]]] = True
        at = moved[at]
        open_[at] = open_[at - 1] = True  # before the first symbol: the last one, which is left out next
        places = np.flatnonzero(open_[:len(seq) - 1])
        places = places[(seq[places] != end) & (seq[places + 1] != end)]
        rules.append(np.stack([pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF], axis=1))
        n_rules += len(chosen)
    grammar = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    return grammar, seq


def lengths_of(rules: np.ndarray, vocabulary: int = VOCABULARY) -> np.ndarray:
    out = np.ones(vocabulary + len(rules), dtype=np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[vocabulary + i] = out[a] + out[b]
    return out[vocabulary:]


def expand(body: np.ndarray, rules: np.ndarray, lengths: np.ndarray, vocabulary: int = VOCABULARY) -> np.ndarray:
    """The ids of any slice of a body, by one gather from the written-out nonterminals."""
    length = np.concatenate([np.ones(vocabulary, dtype=np.int64), lengths])
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    pool = np.empty(int(length.sum()), dtype=np.uint32)
    pool[:vocabulary] = np.arange(vocabulary)
    for i, (a, b) in enumerate(rules.tolist()):
        lo = begin[vocabulary + i]
        pool[lo:lo + length[a]] = pool[begin[a]:begin[a] + length[a]]
        pool[lo + length[a]:lo + length[a] + length[b]] = pool[begin[b]:begin[b] + length[b]]
    n = length[body]
    shift = begin[body] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(body) else n
    return pool[np.repeat(shift, n) + np.arange(int(n.sum()))]


def _schema(kind: str) -> StructType:
    return StructType.fromDDL("part int, seq int, start bigint, n_ids bigint, rules binary, lengths binary, "
                              f"body binary, wide boolean, ends binary, keys array<{kind}>")


def _shard_row(part: int, seq: int, start: int, keys: list, ids: list[bytes]) -> dict:
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    rules, body = compress(flat)
    lengths = lengths_of(rules)
    # every document ends in the end id, which no rule absorbs: its places in the body are the ends
    ends = np.nonzero(body == END_ID)[0] + 1
    sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    if len(ends) != len(keys):  # the end id also stands inside texts: count the documents by their sizes
        done = np.cumsum(np.concatenate([np.ones(VOCABULARY, dtype=np.int64), lengths])[body])
        ends = np.searchsorted(done, np.cumsum(sizes)) + 1
    wide = VOCABULARY + len(rules) > NARROW
    return {"part": part, "seq": seq, "start": start, "n_ids": len(flat), "rules": rules.astype("<u4").tobytes(),
            "lengths": lengths.astype("<u4").tobytes(), "body": body.astype("<u4" if wide else "<u2").tobytes(),
            "wide": wide, "ends": ends.astype("<u4").tobytes(), "keys": keys}


def in_groups(rows, characters: int):
    """Lists of rows (key, text) of about so many characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1] or "")
        if size >= characters:
            yield held
            held, size = [], 0
    if held:
        yield held


def write_ids(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
              vocabulary: str | None = None) -> None:
    """Writes the shards of all rows in ascending ``key`` order (the sort also splits a hot key)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = _schema(kind)
    arrow = to_arrow_schema(schema)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches):
        tok = word_tokenizer(vocabulary)
        part, seq, start, held, keys, ids = TaskContext.get().partitionId(), 0, 0, 0, [], []
        # some rows at a time: a batch of Arrow as Python strings would take its room twice
        some_rows = (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS))
        rest = (x for b in some_rows for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        told = (x for some in in_groups(rest, TOGETHER) for x in zip((k for k, _ in some), tok.many([t for _, t in some])))
        for k, mine in told:
            keys.append(k)
            ids.append(mine + end)
            held += len(ids[-1]) // 4
            if held >= SHARD_IDS:
                yield pa.RecordBatch.from_pylist([_shard_row(part, seq, start, keys, ids)], schema=arrow)
                seq, start, held, keys, ids = seq + 1, start + held, 0, [], []
        if keys:
            yield pa.RecordBatch.from_pylist([_shard_row(part, seq, start, keys, ids)], schema=arrow)

    rows = docs.select(key, text, F.xxhash64(text).alias("__h"), F.monotonically_increasing_id().alias("__rid"))
    order = [F.col(key).asc_nulls_first(), "__h", "__rid"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, text).mapInArrow(run, schema).write.parquet(path)


def read_shard(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, document ends in ids) of one shard row."""
    rules = np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
    lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
    body = np.frombuffer(row["body"], dtype="<u4" if row["wide"] else "<u2").astype(np.int64)
    each = np.concatenate([np.ones(VOCABULARY, dtype=np.int64), lengths])[body]
    ends = np.cumsum(each)[np.frombuffer(row["ends"], dtype="<u4").astype(np.int64) - 1]
    return expand(body, rules, lengths), ends


def read_document(row: dict, i: int) -> np.ndarray:
    """Ids of the ``i``-th document of a shard, decoded alone."""
    ends = np.frombuffer(row["ends"], dtype="<u4")
    body = np.frombuffer(row["body"], dtype="<u4" if row["wide"] else "<u2").astype(np.int64)
    rules = np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2)
    lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
    return expand(body[ends[i - 1] if i else 0:ends[i]], rules, lengths)


def read_index(spark, path: str, kind: str = "bigint", key: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = spark.read.schema(_schema(kind)).parquet(path)
    parts = sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect())  # one row a task
    before, total = [], 0
    for p, n in parts:
        before.append((p, total))
        total += n
    offsets = spark.createDataFrame(before, "part int, __before bigint")
    out = StructType.fromDDL(f"`{key}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    arrow = to_arrow_schema(out)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                ids, ends = read_shard(row)
                begin = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[a:z].astype("<u4").tobytes()) for a, z in zip(begin.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["keys"], type=arrow.field(0).type), pa.array(begin + row["start"] + row["__before"]),
                     pa.array(ends - begin), pa.array(crc, type=pa.int64())], schema=arrow)

    return shards.join(F.broadcast(offsets), "part").mapInArrow(run, out)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Writes the files to the shared scratch folder and reads them back."""
    path = scratch_path(docs.sparkSession, "repair")
    write_ids(docs, path, key, text, vocabulary)
    return read_index(docs.sparkSession, path, docs.schema[key].dataType.simpleString(), key)
