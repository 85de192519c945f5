"""Trained operators and joins of vectors: exact parts against brute force, the rest by held-out accuracy."""

from __future__ import annotations

import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from llm import op4_hmm, op7_language, op8_toxicity, op9_embeddings

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"wort{k % 997} and{k % 13}" for k in range(20_000))
ODD = [(1, "The cat sat"), (1, "The cat sat"), (2, None), (3, ""), (None, "the cat"), (4, " \n"), (5, LONG), (6, "1 2 !"), (8, "Ärger")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "xx", "s", 1.0, 2) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, held string, score double, key int")


def tiny_model(rng, classes):
    emit = rng.random((op4_hmm.CLASSES, op4_hmm.STATES))
    move = rng.random((op4_hmm.STATES, op4_hmm.STATES))
    start = rng.random(op4_hmm.STATES)
    emit[classes:] = 0
    return op4_hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def all_paths(model, line):
    """Likelihood and expected counts by summing over every path of states."""
    total = 0.0
    start, move = np.zeros(op4_hmm.STATES), np.zeros((op4_hmm.STATES, op4_hmm.STATES))
    emit = np.zeros((op4_hmm.CLASSES, op4_hmm.STATES))
    for path in itertools.product(range(op4_hmm.STATES), repeat=len(line)):
        p = model.start[path[0]] * model.emit[line[0], path[0]]
        for a, b, c in zip(path[:-1], path[1:], line[1:]):
            p *= model.move[a, b] * model.emit[c, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path[:-1], path[1:]):
            move[a, b] += p
        for c, s in zip(line, path):
            emit[c, s] += p
    return total, np.concatenate([start, move.ravel(), emit.ravel()]) / total


def test_forward_and_counts_against_all_paths(monkeypatch):
    monkeypatch.setattr(op4_hmm, "STATES", 3)
    monkeypatch.setattr(op4_hmm, "CLASSES", 5)
    monkeypatch.setattr(op4_hmm, "PIECE", 3)
    rng = np.random.default_rng(0)
    model = tiny_model(rng, 5)
    lines = [rng.integers(0, 5, n) for n in (1, 8, 3, 4, 7, 2, 6)]
    exact = [all_paths(model, line) for line in lines]
    assert np.allclose(op4_hmm.likelihoods(model, lines), [math.log10(t) for t, _ in exact])
    assert np.allclose(op4_hmm.expected_counts(model, lines), sum(c for _, c in exact))


def test_hmm_counts_of_uneven_windows():
    """Windows of very different lengths: no room or work for steps that a window doesn't have, and no step lost to scaling."""
    rng = np.random.default_rng(5)
    model = op4_hmm.Model.begin(rng.random(op4_hmm.CLASSES) ** 40 + 1e-18)
    lines = [rng.integers(0, op4_hmm.CLASSES, size) for size in (256, 9, 8, 7, *[1] * 500)]
    apart = sum(op4_hmm.expected_counts(model, [line]) for line in lines)
    tracemalloc.start()
    together = op4_hmm.expected_counts(model, lines)
    assert tracemalloc.get_traced_memory()[1] < 2 << 20
    tracemalloc.stop()
    assert np.allclose(together, apart)
    emitted = together[-op4_hmm.CLASSES * op4_hmm.STATES :].reshape(op4_hmm.CLASSES, op4_hmm.STATES).sum(axis=1)
    assert np.allclose(emitted, np.bincount(np.concatenate(lines), minlength=op4_hmm.CLASSES))


def test_training_rounds_never_lower_the_likelihood(monkeypatch):
    monkeypatch.setattr(op4_hmm, "CLASSES", 12)
    rng = np.random.default_rng(1)
    lines = [rng.integers(0, 6, 40) + 6 * (k % 2) for k in range(30)]
    unigram = np.full(12, 1 / 12)
    model, last = op4_hmm.Model.begin(unigram), -np.inf
    for _ in range(6):
        now = op4_hmm.likelihoods(model, lines).sum()
        assert now > last - 1.0
        last = now
        model = op4_hmm.Model.from_counts(op4_hmm.expected_counts(model, lines), unigram)
    assert last > 1.1 * np.log10(1 / 12) * 30 * 40 and last > np.log10(1 / 12) * 30 * 40


def test_all_rounds_see_all_training_texts(spark, monkeypatch):
    seen = []

    def count(texts, model, _):
        seen.append(texts.count())
        return model

    monkeypatch.setattr(op4_hmm, "_round", count)
    zeros = np.zeros(op4_hmm.CLASSES)
    counts = op4_hmm.Counts(10**9, 2, 900, np.zeros(0, np.uint64), zeros, zeros)
    texts = spark.range(1000).selectExpr("id % 10 = 0 AS held", "CAST(CAST(id AS STRING) AS BINARY) AS classes")
    op4_hmm.train(texts, counts)
    assert seen == [900] * 12


def plain_base(rows):
    tokens = {k: [w.decode() for w in (t or "").encode().lower().split()] + [None] for k, (_, t) in enumerate(rows)}
    held = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for k, (i, _) in enumerate(rows)}
    counts: dict = {}
    for k, line in tokens.items():
        for w in line if not held[k] else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for k, (i, _) in enumerate(rows):
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[k])
        yield i, held[k], len(tokens[k]), sum(w in counts for w in tokens[k]), n, base


@pytest.mark.parametrize("rows", [ODD, None])
def test_scores(spark, odd, rows):
    frame = odd if rows else spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = rows or [(r.doc_id, r.text) for r in frame.collect()]
    found = op4_hmm.score(frame).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    for got, want in zip(sorted(map(tuple, found), key=key), sorted(plain_base(rows), key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], abs=1e-6)
        assert math.isfinite(got[6]) and got[6] <= 1e-9
    if len(rows) > 100:
        assert sum(r.score for r in found if r.held_out) > sum(r.base_score for r in found if r.held_out)


def test_scores_of_nothing(odd):
    assert op4_hmm.score(odd.limit(0)).count() == 0


def test_languages_of_held_out_texts(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = [r for r in op7_language.op7_language(spark, MIDDLE).collect()]
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_odd_rows(odd):
    rows = op7_language.identify(odd).collect()
    assert len(rows) == len(ODD)
    und = [r.doc_id for r in rows if r.lang_pred == "und"]
    assert sorted(und) == [2, 3, 4, 6]
    assert all(r.lang_pred == "xx" for r in rows if r.doc_id not in und)
    assert op7_language.identify(odd.limit(0)).count() == 0
    unknown = odd.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in op7_language.identify(unknown).collect()} == {"und"}


def test_more_languages_than_landmarks(spark):
    """Each of 200 languages has three letters of its own; all are learned, also one with a single text."""
    rng = random.Random(4)
    rows, letters = [], lambda k: "".join(chr(0x4E00 + 3 * k + i) for i in range(3))
    for k in range(200):
        for _ in range(1 if k == 7 else 6):
            rows.append(("".join(rng.choice(letters(k)) for _ in range(30)), f"l{k}"))
    frame = spark.createDataFrame(rows, "text string, lang string")
    model = op7_language.fit(frame, "text", "lang")
    assert model.languages == sorted({lang for _, lang in rows})
    found = op7_language.add_language(frame, model, "text", "guess", "sure").collect()
    assert np.mean([r.guess == r.lang for r in found]) >= 0.98


def test_kernel_and_regression_by_hand():
    """The kernel is set arithmetic; with every row a landmark the weights solve the kernel regression directly."""
    rng = np.random.default_rng(2)
    sets = rng.random((24, 60)) < 0.3
    members = [set(np.flatnonzero(r)) for r in sets]
    plain = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in members] for a in members])
    assert np.allclose(op7_language.kernel(sets, sets), plain, atol=1e-5)
    labels = ["a"] * 12 + ["b"] * 12
    model = op7_language.Model.fit(sets, labels)
    target = np.where(np.array(labels)[:, None] == np.array(["a", "b"]), 1.0, -1.0)
    centre = np.eye(24) - 1 / 24
    dual = np.linalg.solve(centre @ plain @ centre + op7_language.RIDGE * 24 * np.eye(24), centre @ target)
    direct = centre @ plain @ centre @ dual + target.mean(axis=0)
    assert np.allclose(model.decide(sets), direct, atol=1e-2)


def test_presence_by_hand():
    import pyarrow as pa

    texts = ["AB c1", "", None, "ab  c"]
    sets = op7_language.presence(pa.array(texts))
    def slot(gram):
        code = int.from_bytes(gram.encode(), "big")
        return ((code + (len(gram) << 27)) * 2654435761 % (1 << 32)) >> (32 - op7_language.SLOTS.bit_length() + 1)

    def grams(text):
        return {slot(text[k : k + n]) for n in (1, 2, 3) for k in range(len(text) - n + 1)}

    assert set(np.flatnonzero(sets[0])) == grams("ab c ") and set(np.flatnonzero(sets[3])) == grams("ab c")
    assert not sets[1].any() and not sets[2].any()


def test_toxicity_of_held_out_texts(spark):
    """The tables repeat a lexicon that is easy to learn; precision matters most."""
    rows = {r.doc_id: r for r in op8_toxicity.op8_toxicity(spark, MIDDLE).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    held = [(labels[d], r.predicted) for d, r in rows.items() if r.held_out and d in labels]
    hit = sum(t and p for t, p in held)
    assert hit >= 0.7 * sum(t for t, _ in held) and hit >= 0.95 * sum(p for _, p in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 0, "x"), (5, 1, "y"), (6, None, "z"), (None, 1, "z"), (1, 0, "q")], "doc_id long, toxic int, text string")
    assert op8_toxicity.score(odd, labels).count() == len(ODD)
    assert op8_toxicity.score(odd.limit(0), labels).count() == 0
    none = op8_toxicity.score(odd, labels.limit(0)).collect()
    assert len(none) == len(ODD) and all(r.score == 0 and r.predicted == 0 for r in none)
    kept = op8_toxicity.reject(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count()


def plain_links(rows):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    group, links = list(range(len(rows))), [0] * len(rows)
    linked = []
    for i, j in itertools.combinations(ok, 2):
        a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
        if len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.9:
            links[i] += 1
            links[j] += 1
            linked.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in linked:
            if group[i] != group[j]:
                group[i] = group[j] = min(group[i], group[j])
                changed = True
    least: dict = {}
    for (ident, _), g in zip(rows, group):
        least[g] = min(ident, least.get(g, ident))
    return sorted((ident, n, least[g]) for (ident, _), n, g in zip(rows, links, group))


@pytest.mark.parametrize("block, leaf", [(4096, 256), (16, 4)])
def test_embeddings_against_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(op9_embeddings, "BLOCK", block)
    monkeypatch.setattr(op9_embeddings, "LEAF", leaf)
    rng = np.random.default_rng(2)
    rows: list = []
    for _ in range(8):
        centre = rng.normal(size=12)
        for _ in range(rng.integers(1, 20)):
            rows.append((centre + rng.normal(size=12) * rng.choice([0.05, 0.3, 0.5])).tolist())
    rows += [rows[0]] * 9 + [[2.0 * x for x in rows[3]]] + [None, [], [0.0] * 12, [float("nan")] * 12, [1.0, None, *[0.0] * 10]]
    rows += [[float("inf")] * 12, [1.0, 2.0], [1.0, 2.0], [1.0, 2.1], [1e300] * 12, [1e-200] * 12]
    order = rng.permutation(len(rows))
    rows = [(int(i) * 3, rows[k]) for i, k in enumerate(order)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = op9_embeddings.near_duplicates(frame).collect()
    scaled = [(i, None if v is None else [x if x is None or abs(x) in (0, float("inf")) or x != x else x / max(map(abs, (y for y in v if y))) for x in v]) for i, v in rows]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == plain_links(scaled)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_embeddings_odd_rows(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted(map(str, op9_embeddings.near_duplicates(frame).collect()))
    assert len(found) == 4 and sum("n_links=2" in r for r in found) == 3
    assert op9_embeddings.near_duplicates(frame.limit(0)).count() == 0
    assert op9_embeddings.near_duplicates(frame.where("vec_id is null")).collect()[0].n_links == 0


def test_embeddings_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert len(rows) == op9_embeddings.op9_embeddings(spark, SMALL).count()
