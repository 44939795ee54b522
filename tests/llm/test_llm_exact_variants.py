"""Exact duplicates by chunk recipes and spelling variants by permuterm rotations, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chunk_recipes, permuterm

from test_llm_scans import EDGE, documents, frame

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "One sentence here. " * 4000


def key_of(x):
    return (x is not None, x)


# ---- op12 -------------------------------------------------------------------------------------------------

def groups_brute(rows):
    texts = [(t or "").translate(A_Z) for _, t in rows]
    members = defaultdict(list)
    for (d, _), t in zip(rows, texts):
        members[t].append(key_of(d))
    return sorted((key_of(d), max(members[t]), len(members[t]), hashlib.sha256(t.encode()).hexdigest())
                  for (d, _), t in zip(rows, texts))


def check_groups(got, rows):
    assert sorted((key_of(r.doc_id), key_of(r.keep_id), r.group_size, r.text_sha256) for r in got) == groups_brute(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == dict.fromkeys(kept, 1) and len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


ROWS = [(1, "Some Text."), (2, "some text."), (3, None), (4, ""), (5, "ÄB"), (6, "äb"), (7, "Äb"), (8, LONG), (9, LONG.upper()),
        (10, LONG + "x"), (11, "x" + LONG), (12, "y" * 20_000), (13, "y" * 20_000), (14, "y" * 20_001), (None, "some text."),
        (None, "nobody"), (None, "nobody"), (2, "Some text."), (15, "a\nb"), (16, "a\n\nb"), (17, "😀" * 5000), (18, "😀" * 5000)]


def test_exact_groups(spark):
    rows = ROWS + EDGE[:6] + documents(spark)
    docs = frame(spark, rows).withColumn("recipe", F.lit(1)).withColumn("kept", F.lit("mine")).withColumn("row", F.lit(0))
    check_groups(chunk_recipes.exact_groups(docs).collect(), rows)


def test_chunks_join_to_the_text_and_follow_content(spark):
    df = spark.createDataFrame([(t,) for t in ("", "short", LONG, "intro of another length! " + LONG, "y" * 9000, "é\n" * 3000)],
                               "t string").select("t", chunk_recipes.chunks_of(F.col("t")).alias("c"))
    cut = {r.t: r.c for r in df.collect()}
    assert all("".join(c) == t and all(len(x) <= chunk_recipes.MAX_CHUNK + 1 for x in c) for t, c in cut.items())
    assert len(set(cut["intro of another length! " + LONG]) - set(cut[LONG])) <= 2  # the rest is cut alike again


@pytest.mark.parametrize("weak", [lambda c: F.length(c), lambda c: F.lit(0)])
def test_identifiers_of_two_contents_are_replaced(spark, weak):
    rows = ROWS[:15]
    got = chunk_recipes.exact_groups(frame(spark, rows), digests=(weak, chunk_recipes.strong_hash)).collect()
    check_groups(got, rows)
    with pytest.raises(RuntimeError):
        chunk_recipes.exact_groups(frame(spark, rows), digests=(weak,))


def test_exact_groups_of_nothing(spark):
    assert chunk_recipes.exact_groups(frame(spark, [])).count() == 0


def test_recipes_use_no_python_worker(spark):
    plan = chunk_recipes.exact_groups(frame(spark, ROWS))._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)


# ---- op13 -------------------------------------------------------------------------------------------------

def words_brute(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(A_Z)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants_brute(rows):
    n = words_brute(rows)
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    form, count = {}, {}
    for w in n:
        found = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if near(w, v)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        count[w] = len(found)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, key_of(form[w]), root(w), n[w], count[w], key_of(n.get(form[w]))) for w in n)


def check_variants(spark, rows):
    docs = frame(spark, rows).withColumn("word", F.lit("mine")).withColumn("n", F.lit(0))
    got = sorted((r.word, key_of(r.form), r.root, r.n, r.n_near, key_of(r.form_n)) for r in permuterm.variants(docs).collect())
    assert got == variants_brute(rows)
    return got


def test_variants_of_documents(spark):
    got = check_variants(spark, EDGE + documents(spark))
    assert any(f[0] for _, f, *_ in got)


def test_variants_of_edge_words(spark):
    words = {"aaaaaaa": 3, "aaaaaaaa": 40, "aaaaaaaaa": 500, "abaaaaa": 2, "aabaaaa": 2, "Straßen": 5, "strasen": 60, "straßenx": 2,
             "façadeñ": 7, "facadeñ": 70, "façaden": 70, "ÀÀÀÀÀÀÀ": 2, "ÀÀÀÀÀÀÀÀ": 9, "xabcdefg": 2, "abcdefg": 30, "abcdefgh": 30,
             "abcdef": 99, "bbccddee": 4, "bccddee": 45, "bbcddee": 45, "once": 9, "mississippi": 2, "misissippi": 30, "missisippi": 3}
    rows = [(i, " ".join([w] * c)) for i, (w, c) in enumerate(words.items())]
    rows += [(None, "WORDWORD wordword\nWordWord1wordword_"), (7, None), (8, ""), (9, "abcdefg×abcdefg÷"), (9, "abcdefg×abcdefg÷")]
    rows += [(100 + i, "probablyx probably probably probably") for i in range(200)]  # some are damaged, by their doc_id
    check_variants(spark, rows)


def test_variant_chains_end_at_their_root(spark):
    chain = [("aaaaaaaa", 2), ("aaaaaaab", 20), ("aaaaaabb", 200), ("aaaaabbb", 2000), ("aaaabbbb", 20000)]
    table = spark.createDataFrame([(a, b) for (a, _), (b, _) in zip(chain, chain[1:])], "word string, form string")
    assert {r.root for r in permuterm.roots(table).collect()} == {"aaaabbbb"}


def test_long_text_in_pieces(monkeypatch):
    text = "wordlength " * 3000 + "z" * 5000
    whole = permuterm.word_counts(1, text)
    monkeypatch.setattr(permuterm, "PIECE", 100)
    assert permuterm.word_counts(1, text) == whole


def test_variants_of_nothing(spark):
    assert permuterm.variants(frame(spark, [])).count() == 0
    assert permuterm.variants(frame(spark, [(1, "one two")])).count() == 0
