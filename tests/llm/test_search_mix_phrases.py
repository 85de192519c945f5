"""Ranked search, mixing and collocations against plain Python versions, and the awkward rows each must take."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from llm import op11_search, op12_mix, op13_collocations
from llm.text import span_hashes, words
from test_text_operators import CLASH, LONG, ODD, low, spaced

SMALL = "/root/testdata/sf0.001"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def thue_morse(length):
    a, b = "a", "b"
    while len(a) < length:
        a, b = a + b, b + a
    return a, b


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, len(t or ""), "f", 1, 2, 3, "w", 4, "x" if i else None, "s1" if i != 2 else None) for i, t in ODD]
    return spark.createDataFrame(rows, f"{CLASH}, lang string, source string")


# ---- hashes ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("length", [1024, 4096])
def test_words_of_a_pattern_have_hashes_of_their_own(length):
    import pyarrow as pa

    a, b = thue_morse(length)
    found = words(pa.array([f"{a} {b} {a}"]))
    one, two, again = found.hashes()
    assert one == again != two
    assert span_hashes(found.data, found.starts, found.ends, 1)[0] != one


# ---- search ----------------------------------------------------------------------------------------


def plain_search(docs, items, k=20):
    """Score every document for every item."""
    terms = [re.findall(TERM, low(t)) for _, t in docs]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(x for ts in terms for x in set(ts))
    out = []
    for item, text in items:
        wanted = Counter(re.findall(TERM, low(text)))
        scores = []
        for (doc, _), ts in zip(docs, terms):
            tf = Counter(ts)
            m = 75 + (25 * len(ts) * n) // max(1, total)
            score = 0
            for x, times in wanted.items():
                if tf[x]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                    score += times * w * ((1000000000 * tf[x]) // (1000 * tf[x] + 12 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        for rank, (score, known, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, doc if known else None, -score))
    return out


@pytest.mark.parametrize("k, first", [(20, 256), (3, 1)])
def test_search_against_scoring_everything(spark, monkeypatch, k, first):
    monkeypatch.setattr(op11_search, "FIRST_VISIT", first)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    assert sorted(want) == sorted(map(tuple, op11_search.search(docs.repartition(5), items, k).collect()))


def test_search_blocks_of_items_and_texts(spark, monkeypatch):
    """Results don't depend on how items and texts are cut into blocks."""
    monkeypatch.setattr(op11_search, "BLOCK_BYTES", 400)
    monkeypatch.setattr(op11_search, "INDEX_BYTES", 3000)
    monkeypatch.setattr(op11_search, "FIRST_VISIT", 2)
    rng = random.Random(5)
    vocabulary = [f"w{int(rng.expovariate(0.1))}" for _ in range(200)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 5, 40])))) for k in range(150)]
    docs += [(k + 1000, docs[k % 7][1]) for k in range(60)]  # many copies, so equal scores
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 12)))) for k in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = op11_search.search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(plain_search(docs, items)) == sorted(map(tuple, found.collect()))


def test_search_odd_rows(spark, odd):
    items = [(1, "THE cat"), (1, "THE cat"), (1, "again"), (2, None), (3, ""), (4, "?!"), (None, "wort5 ä"), (6, "nowhere")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "'d' as doc_id", "2 as score")
    found = op11_search.search(odd, frame).collect()
    distinct = [items[0], items[2], *items[3:]]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(plain_search([(i, t) for i, t in ODD], distinct), key=key) == sorted(map(tuple, found), key=key)
    assert op11_search.search(odd.limit(0), frame).count() == 0
    assert op11_search.search(odd, frame.limit(0)).count() == 0


# ---- mix -------------------------------------------------------------------------------------------


def plain_targets(sizes):
    """Share by weight; while some are above their limit, fix those there and share the rest again."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    fixed = {i: Fraction(0) for i, n in enumerate(sizes) if n == 0}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = sum(sizes) - sum(fixed.values())
        share = {i: Fraction(left * weight[i], sum(weight[j] for j in free)) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: Fraction(3 * sizes[i]) for i in over}


def test_targets():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 7, 100, 5000, 10**6]) for _ in range(rng.randint(1, 12))]
        assert op12_mix.targets(sizes) == plain_targets(sizes)


def test_permutation_and_tree():
    for n in [1, 2, 3, 5, 16, 17, 1000, 4096, 70_001]:
        for key in (1, 2**63 + 5):
            places = op12_mix.permute(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(places.tolist()) == list(range(n))
    draws = np.array([1000, 3, 0, 517])
    leaves = op12_mix.split(draws, 7, 3)
    assert (leaves.sum(axis=1) == draws).all() and (leaves >= 0).all()
    assert leaves.sum(axis=0).max() - leaves.sum(axis=0).min() <= 3
    assert (leaves == op12_mix.split(draws, 7, 3)).all()
    # each leaf's share of a source is hypergeometric: its mean over seeds is its share
    mean = np.mean([op12_mix.split(draws, 7, s)[0] for s in range(200)], axis=0)
    assert np.abs(mean - 1000 / 7).max() < 3


def check_mix(rows, out):
    """The targets, and that every block is drawn as often as its source's rounds say."""
    sizes = {(i, t, s): len(spaced(t)) for i, t, s in rows}
    by_source = defaultdict(int)
    for i, t, s in rows:
        by_source[s] += len(spaced(t))
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    goal = dict(zip(order, plain_targets([by_source[s] for s in order])))
    got = defaultdict(int)
    for row, (i, t, s) in zip(out, rows):
        assert (row.doc_id, row.size, row.source_size) == (i, sizes[i, t, s], by_source[s])
        assert row.target == float(goal[s])
        assert row.taken == sum(p.end - p.first for p in row.pieces) <= 3 * row.size
        got[s] += row.taken
        times = Counter(k for p in row.pieces for k in range(p.first, p.end))
        least = goal[s] // by_source[s] if by_source[s] else 0
        assert all(least <= times[k] <= least + 1 for k in range(row.size))
    for s in order:
        assert abs(got[s] - goal[s]) <= Fraction(1, 2)
    return got


@pytest.mark.parametrize("shards, block", [(None, 4096), (5, 3), (3, 1)])
def test_mix_takes_its_targets(spark, monkeypatch, shards, block):
    if block > 1:
        monkeypatch.setattr(op12_mix, "LEAST_BLOCKS", 4)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    made = op12_mix.taken(docs, 7, shards, block)
    out = made.orderBy("doc_id").collect()
    check_mix(rows, out)
    again = op12_mix.taken(docs.repartition(9), 7, shards, block).orderBy("doc_id").collect()
    assert again == out
    assert op12_mix.taken(docs, 8, shards, block).orderBy("doc_id").collect() != out
    # shards hold equal numbers of draws, and no draw is in two
    per_shard, where = Counter(), defaultdict(set)
    for r, (_, _, s) in zip(out, rows):
        for p in r.pieces:
            where[s, p.place].add(p.shard)
    for places in where.values():
        assert len(places) == 1
        per_shard[min(places)] += 1
    if shards:
        assert sorted(per_shard) == list(range(shards))
        assert max(per_shard.values()) - min(per_shard.values()) <= 3


def test_mix_texts(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    pieces = {(r.doc_id, p.shard, p.place, p.at): p for r in op12_mix.taken(docs, 1, 4, 50).collect() for p in r.pieces}
    texts = {r.doc_id: r.text for r in docs.collect()}
    op12_mix.mixture(docs, 1, 4, 50).write.partitionBy("shard").parquet(f"{tmp_path}/mix")
    out = spark.read.parquet(f"{tmp_path}/mix").collect()
    assert len(out) == len(pieces)
    for r in out:
        p = pieces[r.doc_id, r.shard, r.place, r.at]
        assert r.text in texts[r.doc_id]
        assert spaced(r.text) == spaced(texts[r.doc_id])[p.first : p.end]
        if p.first == 0 and p.end == len(spaced(texts[r.doc_id])):
            assert r.text == texts[r.doc_id]
    assert {r.shard for r in out} == {0, 1, 2, 3}


def test_mix_odd_rows(spark, odd):
    out = op12_mix.taken(odd, block_words=7).collect()
    assert len(out) == len(ODD)
    sizes = Counter((i, len(spaced(t))) for i, t in ODD)
    assert Counter((r.doc_id, r.size) for r in out) == sizes
    taken = sum(r.taken for r in out)
    assert taken == 3 * 0 + sum(n * c for (_, n), c in sizes.items()) and all(r.taken <= 3 * r.size for r in out)
    assert op12_mix.mixture(odd, block_words=7).count() == sum(len(r.pieces) for r in out)
    assert op12_mix.taken(odd.limit(0)).count() == 0 and op12_mix.mixture(odd.limit(0)).count() == 0


# ---- collocations ----------------------------------------------------------------------------------


def plain_collocations(rows, threshold, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(len(ws)):
                for size in range(1, min(4, len(ws) - k) + 1):
                    f[lang][tuple(ws[k : k + size])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        dropped = set()
        for p, b in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    part = p[k : k + size]
                    if 100 * b >= 80 * counts[part]:
                        dropped.add(part)
        scored = []
        for p, a in candidates.items():
            if p in dropped:
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("mass, slack, local", [(1 << 24, 4, 1 << 22), (3000, 1, 500), (20000, 2, 10)])
def test_collocations_against_counting_everything(spark, monkeypatch, mass, slack, local):
    """Small summaries that lose counts all the time, and many partitions, must not change the result."""
    monkeypatch.setattr(op13_collocations, "PARTITION_MASS", mass)
    monkeypatch.setattr(op13_collocations, "SLACK", slack)
    monkeypatch.setattr(op13_collocations, "LOCAL_GRAMS", local)
    monkeypatch.setattr(op13_collocations, "BATCH_BYTES", 60_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    for threshold, top in ((30, 2000), (6, 40)):
        found = op13_collocations.collocations(docs.repartition(4), threshold, top).collect()
        want = plain_collocations(rows, threshold, top)
        assert len(want) > 20 and sorted(map(tuple, found)) == want


def test_summary_keeps_every_frequent_key():
    rng = np.random.default_rng(2)
    stream = np.concatenate([rng.zipf(1.2, 40_000) % 100_000, rng.integers(0, 100_000, 60_000)]).astype(np.uint32)
    rng.shuffle(stream)
    true = Counter(stream.tolist())
    for threshold in (30, 200):
        parts = np.array_split(stream, 300)
        summary = op13_collocations.Summary(len(stream) // threshold + 1)
        for part in parts:
            key, count = np.unique(part, return_counts=True)
            summary.waiting.append((key, count.astype(np.int64)))
            summary.settle()
            assert len(summary.key) <= summary.capacity
        assert summary.lost < threshold
        assert {k for k, n in true.items() if n >= threshold} <= set(summary.frequent(threshold).tolist())


def test_collocations_odd_rows(spark, odd):
    a, b = thue_morse(1024)
    rows = [(t, "x" if i else None) for i, t in ODD]
    rows += [(f"{a} {b}\t{a}; {b} {b}", "und"), ("x y\x0bx y\rx  y", None), ("x y", ""), ("X Y x", "und")]
    frame = spark.createDataFrame([(t, l, 1, "n") for t, l in rows], "text string, lang string, n int, phrase string")
    for threshold in (1, 2, 5):
        found = op13_collocations.collocations(frame, threshold).collect()
        assert sorted(map(tuple, found)) == plain_collocations(rows, threshold, 2000)
    assert op13_collocations.collocations(odd.limit(0)).count() == 0
    assert op13_collocations.collocations(odd, 100_000).count() == 0


def test_long_text_is_read_whole(spark):
    rows = [(LONG + ". end of it", "en")] * 2
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, op13_collocations.collocations(frame).collect())) == plain_collocations(rows, 30, 2000)
