"""Whitening, hard negatives and language identification: brute force, exactness, edge rows, held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import hard_negatives, language, queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<double>, label int, id string, score string"


def vector_rows(spark, rows):
    """(vec_id, vector, label) rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, v, l, "x", "y") for i, v, l in rows], VECTORS)


def fit_vectors(rows):
    lengths = Counter(len(v) for _, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    width = max(lengths, key=lambda d: (lengths[d], d))
    return [(i, v, l) for i, v, l in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]


NASTY = [(500, None, 1), (None, [0.5, 0.25, -1.0], 1), (501, [0.1, None, 0.2], 2), (502, [0.1, float("nan"), 0.2], 2),
         (503, [float("inf"), 0.0, 0.0], 2), (504, [], 3), (505, [1.0], 3), (1, [0.3, 0.2, 0.1], 1), (1, [0.3, 0.2, 0.1], 1),
         (506, [0.1, 0.2, 0.3], None)]


def some_vectors(n, width, labels, seed, digits=2):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0.1, 0.4), digits) for _ in range(width)], rng.randrange(labels)) for i in range(n)]


# ---------------------------------------------------------------------------- whitening
def test_whitening_equals_a_dense_computation(spark):
    rows = some_vectors(200, 3, 4, 1, digits=6) + NASTY
    df = vector_rows(spark, rows).repartition(5)
    model = whitening.fit(df)
    kept = fit_vectors(rows)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in kept])
    n, sums = len(x), x.sum(axis=0)
    assert (model.width, model.n, model.sums) == (3, n, sums.tolist())
    z = x - sums / n
    assert np.allclose(model.vectors * model.values @ model.vectors.T, z.T @ z / n, rtol=1e-12)
    got = whitening.whiten(df, model, most=2)
    assert got.columns == ["vec_id", "component", "deviation", "whitened"]
    got = got.collect()
    want = z @ model.vectors[:, :2] / np.sqrt(model.values[:2])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    expected = sorted((i is None, i or 0, c + 1, int(d), round(float(w[c]), 9)) for (i, _, _), d, w in zip(kept, deviation, want) for c in range(2))
    assert sorted((r[0] is None, r[0] or 0, r[1], r[2], round(r[3], 9)) for r in got) == expected
    assert whitening.identity_error(df, model) < 1e-12
    assert list(model.values) == sorted(model.values, reverse=True)


def test_sums_are_exact_for_any_size(spark):
    """Values far from each other: squares beyond 64 bits are still summed exactly."""
    rows = [(i, [v, float(i)], 0) for i, v in enumerate([2.0 ** 50, -(2.0 ** 49), 3.0, 0.5, 2.0 ** 50])]
    df = vector_rows(spark, rows).repartition(3)
    model = whitening.fit(df)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows]
    assert model.sums == [sum(c) for c in zip(*x)]
    near = [int(c) for c in model.centre()[0]]
    squares = whitening.square_sums(df, model.centre()[0])
    assert squares[0, 0] == sum((r[0] - near[0]) ** 2 for r in x)
    assert squares[0, 1] == sum((r[0] - near[0] + r[1] - near[1]) ** 2 for r in x)
    assert {r["deviation"] for r in whitening.whiten(df, model).collect()} == {None}  # beyond a long


def test_whitening_without_variance_or_rows(spark):
    flat = vector_rows(spark, [(1, [0.5, 1.0], 0)] * 4)
    model = whitening.fit(flat)
    assert model.n == 4 and len(model.values) == 0 and whitening.whiten(flat, model).count() == 0
    line = vector_rows(spark, [(i, [i / 4, i / 2, 0.0], 0) for i in range(8)])
    model = whitening.fit(line)  # one direction has all the variance; the others cannot be scaled
    assert len(model.values) == 1 and whitening.identity_error(line, model) < 1e-12
    assert whitening.fit(vector_rows(spark, [])) is None
    assert whitening.fit(vector_rows(spark, [(1, None, 0), (2, [None], 0), (3, [], 0)])) is None


def test_op11_contract(spark):
    rows = queries.op11_whitening(spark, SF).collect()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    z = (x * n - sums).astype(float) / n
    values, parts = np.linalg.eigh(z.T @ z / n)
    want = {(r["vec_id"], c + 1): abs(w) for r, row in zip(vectors, z @ parts[:, ::-1] / np.sqrt(values[::-1])) for c, w in enumerate(row[:32])}
    deviation = {r["vec_id"]: d for r, d in zip(vectors, ((x * n - sums) ** 2).sum(axis=1))}
    assert len(rows) == 32 * n
    for r in rows:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] < 1e-9
        assert abs(abs(r["whitened"]) - want[r["vec_id"], r["component"]]) < 1e-6
        assert r["explained"] == pytest.approx(values[-r["component"]] / values.sum(), rel=1e-9)


# ---------------------------------------------------------------------------- hard negatives
def mined_brute(rows, anchor, positives=5, negatives=10, low=30, high=90):
    width = len(fit_vectors(rows)[0][1])
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in fit_vectors(rows) if l is not None and all(abs(x) < hard_negatives.limit_of(width) for x in v)]
    key = lambda e: (-e[0], e[1] is None, e[1] or 0)
    out = []
    for at, (a, q, label) in enumerate(kept):
        if a is None or not anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(q, v)), i, l) for n, (i, v, l) in enumerate(kept) if n != at]
        for p in sorted((e for e in scored if e[2] == label), key=key)[:positives]:
            fit = [e for e in sorted((e for e in scored if e[2] != label), key=key) if low * p[0] <= 100 * e[0] <= high * p[0]]
            out += [(a, p[1], r, e[1], p[0], e[0]) for r, e in enumerate(fit[:negatives], 1)]
    return Counter(out)


@pytest.mark.parametrize("n,width,labels,digits,block,seed", [(150, 3, 3, 1, 4, 1), (120, 4, 2, 0, 1000, 2), (200, 2, 5, 2, 7, 3), (60, 3, 40, 1, 5, 4)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, n, width, labels, digits, block, seed):
    """Many ties (coarse vectors), few or many positives, anchors in blocks of several sizes, repeats and unfit rows."""
    monkeypatch.setattr(hard_negatives, "ANCHORS", block)
    rows = some_vectors(n, width, labels, seed, digits)
    rows += rows[:9] + [(i, v, (l + 1) % labels) for i, v, l in rows[10:20]]  # copies, and ids with a second label
    if width == 3:
        rows += NASTY
    rows += [(900, [2.0 ** 40] * width, 1)]  # no 64-bit product
    got = hard_negatives.mine(vector_rows(spark, rows).repartition(4), F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, got.collect())) == mined_brute(rows, lambda i: i % 10 == 0)


def test_large_components_are_multiplied_exactly(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(1 << 20)), float(rng.randrange(1 << 20)) + rng.random()], i % 3) for i in range(60)]
    got = hard_negatives.mine(vector_rows(spark, rows), F.col("vec_id") % 7 == 0)
    assert Counter(map(tuple, got.collect())) == mined_brute(rows, lambda i: i % 7 == 0)


def test_best_keeps_ties_by_id_across_many_blocks():
    rng = random.Random(3)
    best, everything = hard_negatives.Best(4, 3), []
    for _ in range(50):
        scores, ids = np.array([[rng.randrange(6) for _ in range(8)] for _ in range(4)]), np.array([rng.randrange(500) for _ in range(8)])
        everything += [(g, -int(scores[g, r]), int(ids[r])) for g in range(4) for r in range(8)]
        g, r = np.nonzero(best.ahead(scores, ids, slice(None)))
        best.add(g, scores[g, r], ids[r])
        if rng.random() < 0.4:
            best.settle()
    best.settle()
    want = [e for g in range(4) for e in sorted(e for e in everything if e[0] == g)[:3]]
    assert list(zip(best.group, -best.score, best.id)) == want


def test_hard_negatives_of_nothing(spark):
    for rows in ([], [(1, [0.5], 1)], [(10, None, 1)], [(10, [0.5], 1), (20, [0.5], 2)]):
        got = hard_negatives.mine(vector_rows(spark, rows), F.col("vec_id") % 10 == 0)
        assert got.columns == [c.split()[0] for c in hard_negatives.COLUMNS.split(", ")] and got.count() == 0


# ---------------------------------------------------------------------------- language identification
def subwords_brute(text):
    """Every 2- to 4-gram of the text with all but letters and marks as blanks that has no blank inside, ends aside."""
    import unicodedata
    shown = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in f" {text.lower()} ")
    return Counter(shown[i:i + n] for n in (2, 3, 4) for i in range(len(shown) - n + 1)
                   if shown[i:i + n].strip() and " " not in shown[i + 1:i + n - 1])


@pytest.mark.parametrize("text", ["Ein Haus, zwei Häuser!", "a", "x" * 9, "naïve  3d-Maße\n\tʼtis", "日本語 テスト", "  ab  "])
def test_subwords_are_the_grams_of_words(monkeypatch, text):
    found = Counter(np.concatenate(list(language.subwords(text))).tolist())
    want = subwords_brute(text)
    assert sum(found.values()) == sum(want.values()) and len(found) <= len(want)
    assert sorted(found.values()) == sorted(want.values()) or len(found) < len(want)  # fewer only where hashes meet
    monkeypatch.setattr(language, "SLICE", 3)
    assert Counter(np.concatenate(list(language.subwords(text))).tolist()) == found


def test_score_is_the_softmax_of_the_mean_embedding():
    rng = np.random.default_rng(1)
    embed, out, bias = rng.standard_normal((1 << language.BITS, 16)), rng.standard_normal((16, 3)), rng.standard_normal(3)
    model = language.Model(["a", "b", "c"], embed @ out, bias, 2.0)
    text = "Der Zug fährt um halb neun. " * 50
    z = embed[np.concatenate(list(language.subwords(text)))].mean(axis=0) @ out + bias
    want = np.exp(z / 2) / np.exp(z / 2).sum()
    assert model.scores(text) == pytest.approx(want)


def test_gradient_descent_and_calibration():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 300)
    hashes = np.concatenate([np.sort(rng.choice(40, 8, replace=False)) + 100 * k for k in y])
    model = language.fit(["a", "b", "c"], np.arange(0, 2401, 8), hashes, np.full(2400, 0.125, np.float32), y, np.arange(300))
    right = [int((model.logits[hashes[8 * i:8 * i + 8]].mean(axis=0) + model.bias).argmax()) == y[i] for i in range(300)]
    assert np.mean(right) == 1.0 and 0.5 < model.accept_at < 1.0
    z = rng.standard_normal((4000, 3)) * 4  # answers as sure as a third of the scores says
    p = np.exp(z / 3) / np.exp(z / 3).sum(axis=1, keepdims=True)
    drawn = (p.cumsum(axis=1) > rng.random((4000, 1))).argmax(axis=1)
    temperature, at = language.calibrated(z, drawn)
    assert 2.5 < temperature < 3.5
    top = p.max(axis=1)
    assert (p.argmax(axis=1) == drawn)[top >= at].mean() > 0.97 and at > 0.8


def test_language_rows_without_words_or_labels(spark):
    rows = [(i, "le chat est sur la table et il dort" if i % 2 else "the cat is on the table and it sleeps", "fr" if i % 2 else "en") for i in range(40)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "123 ... !!", "en"), (103, "the dog sleeps", None), (103, "the dog sleeps", None),
             (104, "la table " * 200_000, "fr")]
    df = spark.createDataFrame([(*r, "old", 7) for r in rows], "doc_id int, text string, lang string, lang_pred string, score int")
    told = language.identify(df, language.train(df))
    assert told.columns == ["doc_id", "text", "lang", "lang_pred", "score", "accepted"]
    got = {}
    for r in told.collect():
        got.setdefault(r["doc_id"], set()).add((r["lang_pred"], round(r["score"], 9), r["accepted"]))
    assert got[100] == got[101] == got[102] == {("und", 0.0, False)}
    assert [x[0] for x in got[103]] == ["en"] and [x[0] for x in got[104]] == ["fr"] and len(got[103]) == 1
    none = language.train(df.where("lang is null"))
    assert {(r["lang_pred"], r["score"]) for r in language.identify(df, none).collect()} == {("und", 0.0)}
    assert language.identify(df.limit(0), language.train(df.limit(0))).count() == 0


def test_training_sample_is_bounded_and_even(spark):
    rows = [("copy", "en")] * 300 + [(f"text {i}", "en") for i in range(3000)] + [(f"texte {i}", "fr") for i in range(50)] + [(f"x {i}", f"l{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "text string, lang string")
    languages, sample = language.training_rows(df, most=400, languages=2)
    got = Counter((r["lang"], r["text"]) for r in sample.collect())
    assert languages == ["en", "fr"] and max(got.values()) == 1
    by = Counter(lang for lang, _ in got)
    assert by["fr"] == 50 and 120 < by["en"] < 280
    assert got == Counter((r["lang"], r["text"]) for r in language.training_rows(df.repartition(7), most=400, languages=2)[1].collect())


def test_op12_on_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_language(spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held)
