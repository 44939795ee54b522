"""Quality rules: hashed n-gram log-likelihood ratio between trusted target and raw corpus.

Unigrams and bigrams of words and of punctuation runs are hashed into ``buckets`` cells. Two multinomials
over the cells are counted: one on the whole raw corpus, one on trusted documents (labelled quality 1,
not toxic). A text's verdict is the mean of log p_target(cell) - log p_raw(cell) over its n-grams,
compared with a fixed threshold: deterministic, no sampling of verdicts.

DataFrame functions only. Counting explodes the n-grams inside whole-stage codegen and combines them
per task, so only tasks x buckets rows are shuffled; scoring folds over each row's own n-grams against
the ratio table, which is one array of ``buckets`` doubles (a scalar subquery), and shuffles nothing.

Defined results: null, empty and word-less texts have no n-grams, score null and fail the base rules;
repeated rows and ties are judged each on its own; an empty table gives an empty result; with no
trusted document every ratio is 0, every document scores 0 and only the base rules decide; very long texts are
judged whole, a row's n-grams in memory; columns of the input with the name of a result are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
#: At most so many trusted documents (the first by hash of their id) train the target multinomial.
TRUSTED_DOCS = 20_000
#: Mean log ratio per n-gram below which a document is rejected.
MIN_SCORE = -0.35
#: Pseudo-count of every cell in both multinomials.
SMOOTHING = 1.0

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr_score", "kept")

# Fixed values of the base rules.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACES}]+", -1), "")


def ngram_tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters/digits and of the runs of other visible characters."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}\p{M}]+|[^\p{L}\p{N}\p{M}\s]+"), F.lit(0))
    return F.transform(runs, lambda x: F.xxhash64(x))


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda s: s.rlike(f"[^{SPACES}]"))


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at the sorted ``starts``."""
    step = lambda acc, p: F.struct(
        (acc["c"] + F.least(F.lit(3), p - acc["last"])).alias("c"), p.alias("last"))
    return F.aggregate(starts, F.struct(F.lit(0).alias("c"), F.lit(-3).alias("last")), step, lambda acc: acc["c"])


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    Three-word windows are compared by 64-bit hash. Texts without a repeated window (the usual case) stop
    at a distinct count; the others sort (hash, position) pairs once, n log n however repetitive they are.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    w, h, s = F.col("__words"), F.col("__hashes"), F.col("__sorted")
    lines = F.col("__lines")
    n_windows = F.greatest(F.size(w) - 2, F.lit(0))
    windows = F.slice(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))),
                      F.lit(1), n_windows)
    tagged = F.sort_array(F.transform(F.col("__windows"), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    twice = lambda p, k: (F.get(s, k - 1)["h"].eqNullSafe(p["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(p["h"]))
    starts = F.sort_array(F.transform(F.filter(s, twice), lambda p: p["i"]))
    has_twice = F.size(F.array_distinct(F.col("__windows"))) < F.size(F.col("__windows"))
    # every array is a column of its own, so that it is made once however often it is used
    return (docs.withColumn("__words", words(body))
            .withColumn("__lines", worded_lines(body))
            .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
            .withColumn("__hashes", F.transform(w, lambda x: F.xxhash64(x)))
            .withColumn("__windows", windows)
            .withColumn("__sorted", F.when(has_twice, tagged))
            .withColumn("n_words", F.size(w).cast("long"))
            .withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
            .withColumn("n_symbols", (F.size(F.split(body, f"[{SYMBOLS}]", -1)) - 1).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(_covered(starts), F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .drop("__words", "__lines", "__hashes", "__windows", "__sorted"))


def ngram_cells(tokens: Column, buckets: int) -> tuple[Column, Column]:
    """Cells of the unigrams and of the bigrams; ``tokens`` are hashes."""
    cell = lambda *x: F.pmod(F.xxhash64(*x), F.lit(buckets)).cast("int")
    ones = F.transform(tokens, lambda x: cell(x))
    twos = F.slice(F.transform(tokens, lambda x, i: cell(x, F.get(tokens, i + 1))),
                   F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return ones, twos


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_DOCS) -> DataFrame:
    """Ids labelled quality 1 and never quality 0 or toxic; at most ``limit`` of them, by hash of the id."""
    return (labels.where("doc_id is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("x"))
            .where("q = 1 and x = 0").select("doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def ratio_table(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
                buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with one array ``ratio`` of ``buckets`` log ratios. ``trusted``: a bounded table of ids."""
    ids = F.broadcast(trusted.select(F.col("doc_id").alias("__trusted")))
    t = F.col("__tokens")
    rows = (docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
            .join(ids, F.col("__key") == F.col("__trusted"), "left")
            .select(F.col("__trusted").isNotNull().cast("int").alias("y"), ngram_tokens(F.col("__text")).alias("__tokens"))
            .select("y", F.concat(*ngram_cells(t, buckets)).alias("cells")))
    # outer: a plain explode makes the optimizer evaluate the whole array twice more in a filter on its size
    n = (rows.select("y", F.explode_outer("cells").alias("cell")).where("cell is not null")
         .groupBy("cell").agg(F.count("*").alias("raw"), F.sum("y").alias("target")))
    cells = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    full = cells.join(n, "cell", "left").select(
        "cell", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    whole = full.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"),
                     F.sort_array(F.collect_list(F.struct("cell", "raw", "target"))).alias("cells"))
    share = lambda x, total: F.log((x + smoothing) / (total + smoothing * buckets))
    ratio = F.transform("cells", lambda c: F.when(F.col("target") == 0, F.lit(0.0)).otherwise(
        share(c["target"], F.col("target")) - share(c["raw"], F.col("raw"))))
    return whole.select(ratio.alias("ratio"))


def with_score(docs: DataFrame, ratios: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Adds ``llr_score``: the mean log ratio over the row's n-grams, null without any."""
    t, r = F.col("__tokens"), F.col("__ratio")
    cells = F.concat(*ngram_cells(t, buckets))
    total = F.aggregate(cells, F.lit(0.0), lambda acc, c: acc + F.get(r, c))
    return (docs.withColumn("__tokens", ngram_tokens(F.col(text)))
            .withColumn("__ratio", ratios.scalar())
            .withColumn("llr_score", F.when(F.size(t) > 0, total / (2 * F.size(t) - 1)))
            .drop("__tokens", "__ratio"))


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  buckets: int = BUCKETS, min_score: float = MIN_SCORE,
                  trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """``docs`` with the base counts, base_failed, llr_score and kept added; every row judged, none dropped."""
    docs = docs.drop(*RESULTS)
    ratios = ratio_table(docs, trusted_ids(labels, trusted_docs), key, text, buckets)
    scored = with_score(base_rules(docs, text), ratios, text, buckets)
    judged = scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr_score") >= min_score, F.lit(False)))
    # Results leave through an outer generator: a filter on them would else be pushed below every projection
    # above, and the optimizer then writes out each array expression at each of its uses.
    results = F.array(F.struct(*[c for c in judged.columns if c not in docs.columns]))
    return judged.select(*docs.columns, F.inline_outer(results))
