"""Collocations by SON partitioning against brute force."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import son_phrases

SF = "/root/testdata/sf0.001"
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(A_Z)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        hidden = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and p[i:j] in cand and 100 * a >= 100 * cand[p[i:j]]}
        scored = []
        for p, a in cand.items():
            if p not in hidden:
                s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def frame(spark, rows):
    docs = spark.createDataFrame([(x, t, 1, "p", "s") for x, t in rows], "lang string, text string, n int, phrase string, shard string")
    return docs.withColumn("word", F.lit("w")).withColumn("f", F.lit(0))


def found(spark, rows, **options):
    got = son_phrases.collocations(frame(spark, rows), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_documents(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows, 20)
    assert len(want) > 100 and max(len(r[2].split()) for r in want) == 5
    assert found(spark, rows, min_count=20) == want
    assert found(spark, rows, min_count=20, top=7, shards=1) == brute(rows, 20, top=7)


def edge_rows():
    rng = random.Random(5)
    vocabulary = ["New", "york", "san", "FRANCISCO", "the", "a", "été", "ÉTÉ", "你好", "x" * 50, "\x00", "o'clock"]
    rows = [(rng.choice(["en", "fr", None, "", "a language with a long name " * 3]),
             "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " \x0b"]) for _ in range(60)))
            for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, None), ("fr", " \t\n.,;:!?"), ("xx", "one"), ("en", "New York city hall now")] * 12
    rows += [("en", "New York city hall"), ("en", "New York city"), ("en", "loop loop loop loop loop loop loop loop")] * 5
    return rows


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_edge_rows(spark, shards):
    rows = edge_rows()
    assert found(spark, rows, min_count=5, shards=shards) == brute(rows, 5)


def test_a_phrase_frequent_in_one_place_only(spark):
    rows = [("en", "rare pair here")] * 6 + [("en", f"other words {i}") for i in range(400)]
    assert found(spark, rows, min_count=6) == brute(rows, 6)


def grams_here(rows, n=3):
    """Counts of hashed phrases with their language and text, without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([t for _, t in rows], pa.string())],
                                       names=["lang", "text"])
    out = Counter()
    for g in son_phrases._groups(iter([batch]), [son_phrases.WordHash(i) for i in range(2)]):
        for k, at, grams in son_phrases._levels(g, [], n):
            first, count = son_phrases._runs(grams)
            for i, x, c in zip(at[first], grams[0][first], count):
                out[g.names[g.lang[i]], k, int(x), g.text(i, k)] += int(c)
    return out


def test_small_groups_and_blocks_change_nothing(monkeypatch):
    rows = edge_rows()
    rows += [("en", "y" * 100 + " a b " + "Y" * 100), ("en", "z" * 40)]
    want = grams_here(rows)
    assert sum(want.values()) == sum(want[k] for k in want) and len({k[2] for k in want}) == len(want)
    monkeypatch.setattr(son_phrases, "GROUP_BYTES", 300)
    monkeypatch.setattr(son_phrases, "BLOCK_BYTES", 64)
    assert grams_here(rows) == want


def test_nothing(spark):
    assert found(spark, []) == []
    assert found(spark, [("en", None)]) == []
    assert found(spark, [("en", "no phrase is frequent here")]) == []


def test_counts_past_64_bits_in_products(spark, monkeypatch):
    big = 3 * 10**9
    every = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)],
                                  "lang string, phrase string, words int, f bigint")
    sizes = spark.createDataFrame([("en", 4 * 10**12)], "lang string, n bigint")
    monkeypatch.setattr(son_phrases, "frequent", lambda *_: (every, sizes))
    row = son_phrases.collocations(frame(spark, [])).first()
    assert row.score == 1000 * (big - 1) * 4 * 10**12 // (big * big)
