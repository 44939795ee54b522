"""Exact duplicates by content-defined chunk recipes.

A text, lower-cased in A-Z alone, is cut where its own content says so: after the first sentence end or line
break once ``MIN_CHUNK`` characters have gone by, or after ``MAX_CHUNK`` characters without one. Equal texts
have equal cuts, and texts that share long stretches share most of their chunks. Chunks become identifiers:
two independent 64-bit hashes, verified by a grouped distinct over the chunks themselves. That is the one time
text moves: every distinct chunk once per task, however many documents hold it, and never a whole document.
Where verification finds an identifier with two contents, all identifiers are made anew as SHA-256 and verified
again. A document is then its recipe, the ordered list of its identifiers, and documents are grouped by recipe.

Everything is DataFrame functions. No group is gathered: a recipe's rows leave a count and a maximum per task,
and only recipes of several rows are joined back, in a join whose hot keys Spark can split.

Defined results: a null text counts as empty, and empty texts (no chunks) form one group; of equal texts the row
with the largest key stays, null keys come last, and of repeated rows with that key exactly one stays; a group of
null keys alone has keep_id null; very long texts only have longer recipes (sixteen bytes a chunk); an empty table
gives an empty result. Columns of the input other than key and text are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

MIN_CHUNK, MAX_CHUNK = 256, 4096
CUT_AFTER = r"[.!?\n]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; null is empty."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def pair_hash(chunk: Column) -> Column:
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(1), chunk).alias("b"))


def strong_hash(chunk: Column) -> Column:
    return F.sha2(chunk, 256)


def chunks_of(folded_text: Column, smallest: int = MIN_CHUNK, largest: int = MAX_CHUNK) -> Column:
    """The text's chunks in order; joined they are the text."""
    return F.regexp_extract_all(folded_text, F.lit(f"(?s).{{{smallest},{largest}}}?{CUT_AFTER}|.{{1,{largest}}}"), F.lit(0))


def ambiguous(chunks: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Identifiers with more than one content among ``chunks`` (column ``chunk``)."""
    contents = chunks.select(digest(F.col("chunk")).alias("id"), "chunk").distinct()
    return contents.groupBy("id").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")


def recipes(docs: DataFrame, key: str = "doc_id", text: str = "text",
            digests: tuple[Callable[[Column], Column], ...] = (pair_hash, strong_hash),
            smallest: int = MIN_CHUNK, largest: int = MAX_CHUNK) -> DataFrame:
    """``(key, text_sha256, recipe, row)`` for every row, recipes verified; staged."""
    cut = (docs.select(F.col(key).alias("key"), folded(F.col(text)).alias("folded"))
           .select("key", F.sha2("folded", 256).alias("text_sha256"), chunks_of(F.col("folded"), smallest, largest).alias("chunks")))
    pieces = cut.select(F.explode("chunks").alias("chunk"))
    for digest in digests:
        if ambiguous(pieces, digest).take(1):
            continue
        return stage(cut.select("key", "text_sha256", F.transform("chunks", digest).alias("recipe"),
                                F.monotonically_increasing_id().alias("row")), "recipes")
    raise RuntimeError("the last digest gives one identifier to two contents")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, key, text, **options)
    # staged: joined straight behind its grouping, a hot recipe's rows could not be split
    groups = stage(rows.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("key", "row")).alias("top"))
                   .where("group_size > 1"), "recipe-groups")
    found = rows.join(groups, "recipe", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("top.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"),
        "text_sha256")
