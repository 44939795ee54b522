"""Spelling variants: words one inserted, deleted or replaced character apart, by permuterm rotations.

A word ``xcy`` marked with a terminator has the rotation ``y$xc``. All words that differ from it in ``c`` alone,
and the word ``xy`` without it, have rotations that begin with ``y$x``: the former go on with another character,
the latter ends there. So every rotation is split into the prefix and the edited character behind it, the
rotations are brought together by prefix and sorted, and one scan over each partition meets every prefix range as
a run of neighbouring rows. A run holds at most one row per character of the alphabet and one word without it, so
it fits in memory whatever the table holds. Pairs are never written out: a run gives each member the number of its
near words there and the best one, with at most two candidates kept per run.

Two words that differ by a letter within a row of equal letters (``aab`` and ``ab``) meet in several runs. The pair
counts in one alone: where the edited character is the first of its row.

Defined results: a null text has no words; very long texts are read in pieces cut between words; repeated rows count
again; a null key reads as an empty string before the colon of the hashed text; equal best words are settled by the
smallest in code-point order; an empty table gives an empty result. Only the key and the text are read, so no
other column can clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_columns, stage

MIN_LENGTH, MIN_COUNT, FACTOR, DAMAGE = 7, 2, 10, 31
TERMINATOR = "$"  # no letter of a word
LETTERS = "a-zÀ-ÿ"  # after lower-casing A-Z
PIECE = 1 << 20  # characters of a long text read at once
HELD = 300_000  # distinct words counted in a worker before they are handed on
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_RUN = re.compile(f"[{LETTERS}]{{{MIN_LENGTH},}}")
_BREAK = re.compile(f"[^{LETTERS}]")


def word_counts(key: object, text: str | None) -> Counter:
    """Words of one text with their counts, one character deleted from the runs whose hash says so."""
    found: Counter = Counter()
    if not text:
        return found
    low = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    at = 0
    while at < len(low):
        stop = _BREAK.search(low, at + PIECE) if at + PIECE < len(low) else None
        end = stop.start() if stop else len(low)
        found.update(_RUN.findall(low, at, end))
        at = end
    start = zlib.crc32(f"{'' if key is None else key}:".encode())
    damaged = {r: found.pop(r) for r in [r for r in found if zlib.crc32(r.encode(), start) % DAMAGE == 0]}
    for run, n in damaged.items():
        at = zlib.crc32(run.encode(), start) % len(run)
        if len(run) > MIN_LENGTH:
            found[run[:at] + run[at + 1:]] += n
    return found


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of all words long and frequent enough."""
    def rows(batches):
        held: Counter = Counter()
        for b in batches:
            for k, t in zip(b[key], b[text]):
                held.update(word_counts(k, t))
                if len(held) > HELD:
                    yield {"word": list(held), "n": list(held.values())}
                    held = Counter()
        yield {"word": list(held), "n": list(held.values())}

    counted = map_columns(docs, [key, text], "word string, n bigint", rows)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def rotations(table: DataFrame) -> DataFrame:
    """``(prefix, skip, n)``: every rotation of every marked word, the last character split off as ``skip``, and
    every rotation whole (``skip`` empty), as the range of words one character longer."""
    marked = F.concat(F.col("word"), F.lit(TERMINATOR))
    turned = F.concat(F.expr("substring(marked, at + 1)"), F.expr("substring(marked, 1, at)"))
    turns = (table.select("n", "word", marked.alias("marked"))
             .select("n", "word", "marked", F.explode(F.expr("sequence(1, length(marked))")).alias("at"))
             .select("n", "word", turned.alias("turn"), "at"))
    # the rotation that ends with the terminator has no edited character
    skipped = F.when(F.col("at") < F.expr("length(turn)"), F.struct(
        F.expr("substring(turn, 1, length(turn) - 1)").alias("prefix"), F.expr("right(turn, 1)").alias("skip")))
    whole = F.struct(F.col("turn").alias("prefix"), F.lit("").alias("skip"))
    return (turns.select("n", F.explode(F.array(skipped, whole)).alias("r")).where("r is not null")
            .select("r.prefix", "r.skip", "n"))


def _word(prefix: str, skip: str) -> str:
    y, _, x = prefix.partition(TERMINATOR)
    return x + skip + y


def _members(prefix: str, run: list[tuple[str, int]]) -> list[tuple[str, int, int, str]]:
    """Per member of one prefix range: the word, its near words that count here, the best near word with its n."""
    named = [(_word(prefix, skip), skip, n) for skip, n in run]
    first, second = sorted(((-n, w) for w, _, n in named))[:2]
    before = prefix.partition(TERMINATOR)[2][-1:]  # the character in front of the gap
    longer = [skip for _, skip, _ in named if skip]
    shorter = len(longer) < len(named)
    counted = sum(skip != before for skip in longer)  # deletions that are first in their row of equal letters
    out = []
    for w, skip, _ in named:
        best = second if first[1] == w else first
        near = len(longer) - 1 + (shorter and skip != before) if skip else counted
        out.append((w, near, -best[0], best[1]))
    return out


def _scan(batches):
    prefix, run, out = None, [], []

    def flush():
        cols = list(zip(*out)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "near", "best_n", "best"])

    for b in batches:
        for p, s, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            if p != prefix:
                if len(run) > 1:
                    out += _members(prefix, run)
                prefix, run = p, []
            run.append((s, n))
        if len(out) > 20_000:
            yield flush()
            out = []
    if len(run) > 1:
        out += _members(prefix, run)
    yield flush()


def neighbours(table: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` of every word of ``table`` (word, n; distinct words) that has a near word."""
    sorted_turns = rotations(table).repartition("prefix").sortWithinPartitions("prefix")
    met = sorted_turns.mapInArrow(_scan, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return (met.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("top"))
            .select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.w").alias("best")))


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(word, root)``: the last form reached from each word of ``forms`` (word, form). A form is at least ``FACTOR``
    times as frequent as its word, so chains are short; every round doubles the steps taken."""
    now = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(max_rounds):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "variant-roots")
        now = moved.select("word", "root")
        if not moved.where("moved").take(1):
            return now
    raise RuntimeError(f"forms did not end in {max_rounds} rounds")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT,
             factor: int = FACTOR) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    table = stage(words(docs, key, text, min_count), "variant-words")
    near = neighbours(table)
    is_form = F.col("best_n") >= F.lit(factor) * F.col("n")
    full = stage(table.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variant-forms")
    ends = roots(full.where("form is not null").select("word", "form"))
    return (full.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
