"""SimHash groups, decontamination, packing, shards, scores, id files and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import best_fit, components, context_tree, hilbert, repair_ids, simhash_mih, tokens, winnow
from tidemark.llm.queries import QUERIES

from test_llm_scans import EDGE, SF, SCHEMA, documents, frame, words_of


def key_of(x):
    return (x is not None, x)


# ---- op10 -------------------------------------------------------------------------------------------------

def fp_brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_brute(rows, fp):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return [low[find(i)] for i in range(len(rows))]


def test_simhash_groups(spark):
    rows = EDGE[:6] + EDGE[7:] + documents(spark)
    fp = [fp_brute(t) for _, t in rows]
    want = sorted(zip([key_of(d) for d, _ in rows], fp, map(key_of, groups_brute(rows, fp))))
    got = sorted((key_of(r.doc_id), r.fp % (1 << 64), key_of(r.component))
                 for r in simhash_mih.near_duplicates(frame(spark, rows)).collect())
    assert got == want


def test_simhash_long_text_in_chunks(monkeypatch):
    text = " ".join(f"a{i}" for i in range(5000))
    whole = simhash_mih.fingerprint(text)
    monkeypatch.setattr(simhash_mih, "CHUNK", 700)
    assert simhash_mih.fingerprint(text) == whole


@pytest.mark.parametrize("hot", [1, 3, 10**6])
def test_links_give_the_same_components_whatever_counts_as_hot(spark, hot):
    rng = np.random.default_rng(1)
    fps = set()
    for _ in range(40):
        x = int(rng.integers(0, 1 << 62))
        fps.add(x)
        for _ in range(6):  # neighbours up to 5 bits away, many in one half
            y = x
            for b in rng.choice(40, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    fps = sorted(fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    got = {r.node: r.component for r in components.components(simhash_mih.links(df, hot_bucket=hot)).collect()}
    comp = groups_brute([(x, None) for x in fps], fps)
    assert [got.get(x, x) for x in fps] == comp


def test_components_of_a_chain_and_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.components(chain.limit(0)).count() == 0


# ---- op4 --------------------------------------------------------------------------------------------------

def hits_brute(text, items):
    words = words_of(text)
    hit, names = set(), set()
    for name, t in items:
        w = words_of(t)
        n = min(10, len(w))
        wins = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i:i + n]) in wins:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_decontamination(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "short item"), (903, "Short ITEM"), (904, "a"), (905, "x " * 40)]
    body = words_of(items[0][1])
    rows = EDGE[:6] + EDGE[7:] + documents(spark)
    rows += [(5000, "p q " + " ".join(body[3:13]) + " z"), (5001, " ".join(body[3:12])), (5002, "the short, item! a"),
             (5003, "x " * 25), (5004, "x " * 9), (5005, items[1][1] + " " + items[2][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((key_of(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in winnow.contamination(frame(spark, rows), bench).collect())
    assert got == sorted((key_of(d), *hits_brute(t, items)) for d, t in rows)


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.n_hit == 0 for r in winnow.contamination(frame(spark), none).collect())
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert winnow.contamination(frame(spark, []), some).count() == 0


# ---- op8 --------------------------------------------------------------------------------------------------

def check_packing(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at and n > 0
            at += n
        assert at <= capacity
    return len(seqs)


SPECIAL = [(3000 + i, t) for i, t in enumerate([
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "don't<|startoftext|>'s", "<|EndOfText|> <|ENDOFTEXT|>",
    "<|endoftext", "x  <|endoftext|>  y", "<|startoftext|>é\u0301<|endoftext|>\n\n"])]


def test_packing_query(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.public_path("byte_bpe_50k.json"))
    rows = EDGE + documents(spark) + SPECIAL
    got = best_fit.pack_documents(frame(spark, rows)).collect()
    n = check_packing(got, 2048)
    want = Counter()
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    total = sum(r.length for r in got)
    assert n <= math.ceil(total / 2048) * 1.02 + 1


def test_plan_places_every_rank_once():
    rng = np.random.default_rng(3)
    sizes = Counter(rng.integers(1, 65, 4000).tolist() + [64] * 50 + [33] * 700)
    seen, fill = set(), Counter()
    for size, lo, n, seq, offset in best_fit.plan(sizes, 64):
        for k in range(n):
            assert (size, lo + k) not in seen and fill[seq + k] == offset
            seen.add((size, lo + k))
            fill[seq + k] += size
    assert len(seen) == sum(sizes.values()) and max(fill.values()) <= 64
    least = max(math.ceil(sum(s * n for s, n in sizes.items()) / 64), sum(n for s, n in sizes.items() if s > 32))
    assert len(fill) <= least * 1.03
    assert best_fit.plan({}, 64) == []


def test_pieces():
    assert best_fit.pieces_of(5000) == [(0, 904), (904, 2048), (2952, 2048)]
    assert best_fit.pieces_of(4096) == [(0, 2048), (2048, 2048)] and best_fit.pieces_of(1) == [(0, 1)]


def test_packing_empty_table(spark):
    assert best_fit.pack_documents(frame(spark, [])).count() == 0


# ---- op5 --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    df = spark.range(side ** dims)
    cells = [F.expr(f"cast(id div {side ** i} % {side} as int)") for i in range(dims)]
    rows = df.select(hilbert.curve_index(cells, bits).alias("h"), *[c.alias(f"c{i}") for i, c in enumerate(cells)]).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side ** dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(dims)) == 1


def sharded(spark, rows):
    docs = frame(spark, rows).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3)).withColumn(
        "lang", F.lit("en")).withColumn("n_chars", F.length("text"))
    return docs


def test_shards(spark):
    rows = EDGE + documents(spark) + [(77, "same")] * 150
    got = hilbert.assign_shards(sharded(spark, rows)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.curve for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_shards_of_few_rows_and_none(spark):
    got = hilbert.assign_shards(sharded(spark, EDGE[:3])).collect()
    assert len(got) == 3 and len({r.shard for r in got}) == 3 and all(r.slot == 0 for r in got)
    assert hilbert.assign_shards(sharded(spark, [])).count() == 0


def test_shard_files_hold_whole_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hilbert.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("__shard").count().count() == 4
    assert back.drop("__shard").exceptAll(docs).count() == 0 and docs.exceptAll(back.drop("__shard")).count() == 0


def test_sources_with_a_long_common_prefix_get_shards_of_their_own(spark):
    names = ["common_crawl_2023", "common_crawl_2024", "common_crawl_2024_b", "common_crawl_ä"]
    rows = [(i, f"text {i}", names[i % 4], "en", 10) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    got = hilbert.assign_shards(docs, shards=4).collect()
    for shard in range(4):
        assert {names[r.doc_id % 4] for r in got if r.shard == shard and r.slot >= 0} in [{n} for n in names]
    assert len({r.curve for r in got}) == 4 and len(got) == 400


def test_string_cells_are_exact_row_shares(spark):
    values = ["https://a.example/x"] * 5 + ["https://a.example/y"] * 3 + [None] * 4 + ["https://b"] * 7 + [""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: r.cell for r in hilbert._string_cells(df, "v", "cell", 4).collect()}
    whole = [v for v in values if v is not None]
    assert got == {v: sum(x < v for x in whole) * 16 // len(whole) for v in set(whole)}


# ---- op3 --------------------------------------------------------------------------------------------------

def ctw_brute(train, texts, depth):
    """The definition, one bit at a time: counts per (context, node), recursion over all seen contexts."""
    end = 255
    seqs = lambda t: [end] * depth + list(t) + [end]
    n = Counter()
    for t in train:
        s = seqs(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                ctx, node = tuple(s[i - d:i]), 1
                for j in range(7, -1, -1):
                    bit = s[i] >> j & 1
                    n[(ctx, node, bit)] += 1
                    node = node * 2 + bit
    kids = {}
    for ctx, node, _ in n:
        if ctx:
            kids.setdefault((ctx[1:], node), set()).add(ctx)
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
    memo = {}

    def log_pw(ctx, node):
        if (ctx, node) not in memo:
            own = kt(n[(ctx, node, 0)], n[(ctx, node, 1)])
            if len(ctx) < depth:
                own = math.log(.5) + np.logaddexp(own, sum(log_pw(c, node) for c in kids.get((ctx, node), ())))
            memo[(ctx, node)] = own
        return memo[(ctx, node)]

    def prob(s, i, d, node, bit):
        ctx = tuple(s[i - d:i])
        a, b = n[(ctx, node, 0)], n[(ctx, node, 1)]
        own = ((b if bit else a) + .5) / (a + b + 1)
        if d == depth or not a + b:
            return own
        w = math.exp(math.log(.5) + kt(a, b) - log_pw(ctx, node))
        return w * own + (1 - w) * prob(s, i, d + 1, node, bit)

    out = []
    for t in texts:
        s, total = seqs(t), 0.0
        for i in range(depth, len(s)):
            node = 1
            for j in range(7, -1, -1):
                bit = s[i] >> j & 1
                total += math.log10(prob(s, i, 0, node, bit))
                node = node * 2 + bit
        out.append(total)
    return out


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


@pytest.mark.parametrize("depth,block", [(3, 8 << 20), (4, 500)])
def test_context_tree_scores(spark, depth, block):
    rows = EDGE[:6] + EDGE[7:] + [(d, t[:400]) for d, t in documents(spark)[:25]]
    low = [(t or "").encode().lower() for _, t in rows]
    train = [t for (d, _), t in zip(rows, low) if not held(d)]
    counts = Counter(w for t in train for w in t.split())
    counts["END"] = len(train)
    total = sum(counts.values())
    lp = lambda c: math.log10((c + 1) / (total + len(counts) + 1))
    scores = ctw_brute(train, low, depth)
    want = sorted((key_of(d), held(d), len(t.split()) + 1, sum(counts[w] > 0 for w in t.split()) + 1, total,
                   round(sum(lp(counts[w]) for w in t.split()) + lp(len(train)), 6), round(s, 6))
                  for (d, _), t, s in zip(rows, low, scores))
    got = sorted((key_of(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                 for r in context_tree.score(frame(spark, rows), depth=depth, block_bytes=block).collect())
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=2e-5)


def test_held_out_code_length_beats_uniform_and_shallow_models(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mean = lambda d: context_tree.score(docs, depth=d).where("held_out").agg(F.avg("bits_per_byte")).first()[0]
    assert mean(3) < 3.5


def test_production_depth_scores_equal_brute_force_and_learn_long_contexts(spark):
    """Words that differ only more than three bytes back: the answer is in the longer contexts."""
    rows = [(d, " ".join(("abcxyz1", "dbcxyz2")[(d >> i) & 1] for i in range(6))) for d in range(120)]
    low = [t.encode() for _, t in rows]
    depth = context_tree.DEPTH
    want = dict(zip(range(120), ctw_brute([t for (d, _), t in zip(rows, low) if not held(d)], low, depth)))
    got = {r.doc_id: r for r in context_tree.score(frame(spark, rows)).collect()}
    assert all(got[d].score == pytest.approx(want[d], abs=2e-5) for d in want)
    shallow = {r.doc_id: r.score for r in context_tree.score(frame(spark, rows), depth=3).collect()}
    # six words, each with a digit that depth 3 can only guess (0.30 = log10 2)
    assert all(got[d].score - shallow[d] > 1.2 for d in want if held(d))


@pytest.mark.parametrize("depth", [5, 7])
def test_context_tree_other_depths(spark, depth):
    rows = [(d, t[:200]) for d, t in documents(spark)[:15]] + [(900 + d, None) for d in range(3)]
    low = [(t or "").encode().lower() for _, t in rows]
    scores = ctw_brute([t for (d, _), t in zip(rows, low) if not held(d)], low, depth)
    got = {r.doc_id: r.score for r in context_tree.score(frame(spark, rows), depth=depth, block_bytes=700).collect()}
    assert all(got[d] == pytest.approx(s, abs=2e-5) for (d, _), s in zip(rows, scores))


def test_context_tree_edges(spark):
    assert context_tree.score(frame(spark, [])).count() == 0
    only_held = [(d, "abc") for d in range(50) if held(d)][:2]
    got = context_tree.score(frame(spark, only_held)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(-32 * math.log10(2)) for r in got)


# ---- op9 --------------------------------------------------------------------------------------------------

def test_id_files_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json"))
    rows = EDGE + documents(spark) + SPECIAL + [(2000, "it's. 'x' a.'s don't, \"y\" # ### <|endoftext|> \x1c É İ ﬁ 1234")]
    unique = {}
    for d, t in rows:
        unique.setdefault(d, t)
    rows = [(d, t) for d, t in unique.items()]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in repair_ids.round_trip(frame(spark, rows)).collect()}
    at = 0
    for d, t in sorted(rows, key=lambda x: key_of(x[0])):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert got[d] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_repair_repeated_rows_and_empty(spark):
    got = sorted((r.start, r.n_tokens) for r in repair_ids.round_trip(frame(spark, [(1, "a b")] * 5 + [(0, None)])).collect())
    assert got == [(0, 1), (1, 3), (4, 3), (7, 3), (10, 3), (13, 3)]
    assert repair_ids.round_trip(frame(spark, [])).count() == 0


def test_repair_grammar_is_exact_and_random_access():
    rng = np.random.default_rng(5)
    docs = [np.append(np.concatenate([rng.integers(0, 9, 30)] * int(k)), 2).astype("<u4") for k in rng.integers(0, 9, 200)
            if k] + [np.array([2], dtype="<u4"), np.array([2, 2, 5, 2], dtype="<u4")]
    row = repair_ids._shard_row(0, 0, 0, list(range(len(docs))), [d.tobytes() for d in docs])
    ids, ends = repair_ids.read_shard(row)
    assert (ids == np.concatenate(docs)).all() and (ends == np.cumsum([len(d) for d in docs])).all()
    assert len(row["body"]) // 2 < 0.7 * len(ids)
    for i in (0, 1, len(docs) // 2, len(docs) - 1):
        assert (repair_ids.read_document(row, i) == docs[i]).all()


# ---- pipeline ---------------------------------------------------------------------------------------------

def test_pipeline_against_its_parts(spark):
    """Every stage's survivors follow from brute force over the stage before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit("e")).withColumn("__rid", F.lit(1))
    cols = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    one = corpus_pipeline.quality_rules(spark, docs, SF)
    kept = {r.doc_id for r in QUERIES["op2_quality_llr"](spark, SF).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert one.columns == cols and {d for d, _ in rows} == kept and len(rows) == len(kept)
    two = corpus_pipeline.simhash_near_dedup(spark, one, SF)
    first = set(groups_brute(rows, [fp_brute(t) for _, t in rows]))
    rows = [(r.doc_id, r.text) for r in two.collect()]
    assert two.columns == cols and sorted(d for d, _ in rows) == sorted(first)
    three = corpus_pipeline.decontaminate(spark, two, SF)
    clean = {d for d, t in rows if not hits_brute(t, items)[1]}
    rows = [(r.doc_id, r.text) for r in three.collect()]
    assert three.columns == cols and {d for d, _ in rows} == clean
    four = corpus_pipeline.redact_secrets(spark, three, SF)
    assert four.columns == cols and {r.doc_id for r in four.collect()} == clean
    five = corpus_pipeline.best_fit_packing(spark, four, SF).collect()
    check_packing(five, 2048)
    assert {r.doc_id for r in five} == clean
    whole = QUERIES["pipeline"](spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in five)


def test_pipeline_stages_on_edge_rows_and_nothing(spark):
    for rows in (EDGE, []):
        docs = frame(spark, rows).withColumn("lang", F.lit("en"))
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, SF)
            n = out.count()
            if name == "simhash_near_dedup" and rows:
                assert sum(r.doc_id == 4 for r in out.collect()) == 1  # repeated rows: one stays
            assert n == 0 or rows


def test_repair_goes_on_until_no_pair_pays():
    rng = np.random.default_rng(7)
    passage = rng.choice(np.arange(100, 40_000), 64, replace=False)
    text = np.concatenate([np.concatenate([passage, [60]]) for _ in range(20)]).astype("<u4")
    rules, body = repair_ids.compress(text)
    lengths = repair_ids.lengths_of(rules)
    assert len(body) <= 60 and lengths.max() >= 64  # 1300 ids
    assert (repair_ids.expand(body, rules, lengths) == text).all()
    one = np.full(5000, 7, dtype="<u4")
    rules, body = repair_ids.compress(one)
    assert len(rules) + len(body) < 40 and (repair_ids.expand(body, rules, repair_ids.lengths_of(rules)) == one).all()
    # what is left has no pair that pays for a rule
    for ids in (text, rng.choice(np.arange(3, 60), 50_000).astype("<u4")):
        rules, body = repair_ids.compress(ids)
        pairs = Counter(zip(body[:-1].tolist(), body[1:].tolist()))
        uses = {p: repair_ids.paying_pairs(body, repair_ids.END_ID, 7) for p in list(pairs)[:1]}
        assert all(len(at) == 0 for _, at, _ in uses.values())
        assert (repair_ids.expand(body, rules, repair_ids.lengths_of(rules)) == ids).all()


def test_repair_wide_symbols(monkeypatch):
    rng = np.random.default_rng(8)
    passages = [rng.choice(np.arange(100, 40_000), 200, replace=False) for _ in range(40)]
    ids = np.concatenate([p for _ in range(30) for p in passages]).astype("<u4")
    narrow = repair_ids.VOCABULARY + 50  # two bytes are full soon, and four pay: nearly everything repeats
    rules, body = repair_ids.compress(ids, narrow=narrow)
    assert len(rules) > 50 and (repair_ids.expand(body, rules, repair_ids.lengths_of(rules)) == ids).all()
    monkeypatch.setattr(repair_ids, "NARROW", narrow)
    monkeypatch.setattr(repair_ids.compress, "__defaults__", (repair_ids.VOCABULARY, repair_ids.END_ID, narrow))
    docs = [np.append(p, [repair_ids.END_ID]).astype("<u4") for _ in range(30) for p in passages]
    row = repair_ids._shard_row(0, 0, 0, list(range(len(docs))), [d.tobytes() for d in docs])
    assert row["wide"]
    for i in (0, 5, len(docs) - 1):
        assert (repair_ids.read_document(row, i) == docs[i]).all()
    got, ends = repair_ids.read_shard(row)
    assert (got == np.concatenate(docs)).all() and len(ends) == len(docs)
    # random ids repeat nothing: two bytes stay
    noise = rng.integers(100, 40_000, 20_000).astype("<u4")
    assert len(repair_ids.compress(noise, narrow=narrow)[0]) == 0


def test_pipeline_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("__row", F.col("doc_id") * 3).withColumn("kept", F.lit("mine"))
    for name, step in corpus_pipeline.STAGES[:4]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.where("__row <> doc_id * 3 or kept <> 'mine'").count() == 0 and out.count() > 0, name


@pytest.mark.parametrize("bits", [2, 8, 22])
def test_distinct_codes_whatever_collides(monkeypatch, bits):
    monkeypatch.setattr(context_tree.Distinct, "BITS", bits)
    codes = np.random.default_rng(bits).integers(-60, 60, 4000) * (1 << 55)
    for some in (codes, codes[:1], codes[:0]):
        got = context_tree.Distinct(some)
        keys, n = np.unique(some, return_counts=True)
        assert (got.keys == keys).all() and (got.counts == n).all()
        assert (keys[got.find(some)] == some).all()


def test_new_chunks_are_numbers_in_the_memo_and_get_the_ids_of_the_library(monkeypatch):
    from tokenizers import Tokenizer
    path = tokens.public_path("word_bpe_49k.json")
    tok, library = tokens.WordTokenizer(path), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = ["Élan vital, ÀÖØÞ naïve façade.", "3×4÷2 c'est l'été isn't we'll", "e\u0301tude ﬁn ǅ ß ÿ µ ª", None, "", "a" * 3000,
             "x.\u0301y über-groß…»« 2024-01-02", " \t\n ", "élan VITAL"] * 3
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert tok.many(texts) == want == [tok.ids(t) for t in texts]
    # one pool of ids for all chunks instead of bytes for each
    assert all(type(n) is int for n in tok.memo.values()) and len(tok.size) == len(tok.memo) and tok.size.sum() == len(tok.pool)
    monkeypatch.setattr(tokens, "MEMO", 3)
    monkeypatch.setattr(tokens, "PART", 2)
    monkeypatch.setattr(tokens, "PARTS", 2)
    assert tok.many(texts) == want


def test_a_chunk_that_repeats_is_looked_up_once(monkeypatch):
    from tokenizers import Tokenizer
    asked = []

    class Asked(tokens.Memo):
        def __getitem__(self, chunk):
            asked.append(chunk)
            return super().__getitem__(chunk)

    monkeypatch.setattr(tokens, "Memo", Asked)
    path = tokens.public_path("word_bpe_49k.json")
    tok, library = tokens.WordTokenizer(path), Tokenizer.from_file(path)
    texts = ["the cat, the dog. 7 cats" * 50, "a dog (the cat)"] * 200
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts[:2]]
    assert tok.many(texts) == want * 200
    assert 0 < len(asked) == len(set(asked)) < 40  # of some 50,000 chunks


@pytest.mark.parametrize("parts", [1, 256])
def test_cuts_change_no_id_of_the_library(monkeypatch, parts):
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "PARTS", parts)
    monkeypatch.setattr(tokens, "PART", 3 if parts == 1 else 4096)
    path = tokens.public_path("word_bpe_49k.json")
    tok, library = tokens.WordTokenizer(path), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rng = np.random.default_rng(17)
    signs = list("abtSRELM019 ,.'<=>&-\"\t\n\x00\x1c\x7f\u00a0\u0301\u0338\u2028éÀ×ßǅ中😀")
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 40, 1500)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert tok.many(texts) == want


@pytest.mark.parametrize("depth", [2, 4, 6])
def test_blocks_count_grams_by_one_sort_and_by_a_table_alike(monkeypatch, depth):
    rng = np.random.default_rng(depth)
    few = [bytes(rng.choice(list(b"ab \n\xc3\xa9"), n)) for n in rng.integers(0, 60, 300)] + [b"", b" ", b"a  b\t"]
    many = [bytes(rng.integers(0, 255, n, dtype=np.uint8)) for n in rng.integers(0, 60, 300)]
    for body in (few, many, few[:1], [b""]):
        held = (rng.random(len(body)) < 0.3).tolist()
        sent = context_tree.sent_grams(held, body, depth, 64)
        answered = rng.integers(-1000, 0, len(sent[0])) / 8
        sums = context_tree.text_sums(body, depth, 64, answered)
        with monkeypatch.context() as m:
            m.setattr(context_tree.Tagged, "of", lambda *a: None)
            assert all((x == y).all() for x, y in zip(sent, context_tree.sent_grams(held, body, depth, 64)))
            assert (sums == context_tree.text_sums(body, depth, 64, answered)).all()
        pad = b"\xff" * depth  # by hand: context, nearest byte first, and symbol
        by_hand = [Counter((pad + t + b"\xff")[i:i + depth + 1] for i in range(len(t) + 1)) for t in body]
        train = sum((c for c, h in zip(by_hand, held) if not h), Counter())
        codes = context_tree.inwards(sent[0], depth)
        got = {int(c).to_bytes(8, "big")[7 - depth:]: int(n) for c, n in zip(codes, sent[2])}
        assert got == {g: train[g] for c in by_hand for g in c}
        value = dict(zip(got, answered))
        assert sums.tolist() == [sum(n * value[g] for g, n in c.items()) for c in by_hand]
        found, at, sizes = context_tree.words_of(body)
        assert [found[i] for i in at] == [w for t in body for w in t.split()] and sizes.tolist() == [len(t.split()) for t in body]


def test_texts_are_scored_without_a_table_of_their_grams(monkeypatch):
    def fail(*a):
        raise AssertionError("a table of all grams")

    monkeypatch.setattr(context_tree.Distinct, "__init__", fail)
    body = ["the cat sat on the mat é ".encode() * n for n in range(40)]
    part = context_tree.block_parts(0, [i % 7 == 2 for i in range(40)], body, 6, 64)
    grams = sum(len(context_tree.unsqueeze(n, "<u4")) for k, n in zip(part["kind"].to_pylist(), part["counts"].to_pylist()) if k == 0)
    sums = context_tree.text_sums(body, 6, 64, np.full(grams, -1.0))
    assert sums.tolist() == [-1.0 - len(t) for t in body]


def test_pairs_are_counted_exactly_whatever_their_width():
    rng = np.random.default_rng(23)
    for big in (1, 1 << 27):  # pairs and places in one number, and each in its own
        seq = rng.integers(0, 12, 5000) * big
        for places in (None, np.sort(rng.choice(4999, 2000, replace=False))):
            some = np.arange(4999) if places is None else places
            some = some[(seq[some] != 2 * big) & (seq[some + 1] != 2 * big)]
            want = Counter(zip(seq[some].tolist(), seq[some + 1].tolist()))
            want = {p: (n + 1) // 2 if p[0] == p[1] else n for p, n in want.items()}
            pairs, n, at, of = repair_ids.counted_pairs(seq, 2 * big, 20, some if places is not None else None)
            got = list(zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()))
            assert dict(zip(got, n.tolist())) == {p: k for p, k in want.items() if k >= 20}
            assert [(i, got[k]) for i, k in zip(at.tolist(), of.tolist())] == [
                (i, p) for i, p in zip(some.tolist(), zip(seq[some].tolist(), seq[some + 1].tolist())) if want[p] >= 20]
