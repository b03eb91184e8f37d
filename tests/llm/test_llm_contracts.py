"""Clashing names, repeats and bounds of the pipeline's operators; the toxicity model against a plain computation."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from rillflow.llm import exact_dedup, mixing, toxicity

CLASH = ["_h", "_src", "_class", "_bucket", "_rank", "_os", "_row", "_copy", "_t", "_id", "_dig", "_salt", "_kid", "a`b c"]


def clashing(spark, rows):
    """(doc_id, text, source) rows with columns named like the operators' own, their values telling the row."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return df.select("*", *[F.concat(F.lit(f"{c}="), F.coalesce("text", F.lit("none"))).alias(c) for c in CLASH])


ROWS = [(1, "one two", "a"), (2, "one  two", "a"), (3, None, None), (None, "x y z", "b"), (None, "x y z", "b"), (4, "", "b"), (4, "", "b"), (5, "q " * 300, "c")]


def test_columns_of_any_name_pass_through(spark):
    docs = clashing(spark, ROWS)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, *mixing.ADDED]
    def told(r):
        return all(r[c] == f"{c}={r['text'] if r['text'] is not None else 'none'}" for c in CLASH)
    rows = mixed.collect()
    assert len(rows) == len(ROWS) and all(map(told, rows))
    out = mixing.emit(mixed)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == sum(r["copies"] for r in rows) and all(map(told, got))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and all(map(told, kept.collect()))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.where("text is not null").collect()) == [(0, "x y z"), (1, "one two"), (5, "q " * 300)]


def test_a_hot_text_with_null_ids_is_one_class(spark):
    docs = spark.createDataFrame([(None, "hot  text")] * 400 + [(7, "hot text")] * 300 + [(i, f"t {i}") for i in range(500)], "doc_id bigint, text string")
    got = Counter((r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.dedup_classes(docs.repartition(6)).where("group_size > 1").collect())
    assert got == {(7, 700, False): 400, (7, 700, True): 300}
    none = exact_dedup.dedup_classes(docs.where("doc_id is null")).collect()
    assert {(r["keep_id"], r["group_size"], r["kept"]) for r in none} == {(None, 400, True)}


def test_pipeline_stages_on_odd_rows(spark):
    """Each stage on nulls, empties, repeats and clashing columns, and on no rows at all."""
    docs = clashing(spark, ROWS)
    for name, stage in corpus_pipeline.STAGES[1:]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, "")
            assert out.count() >= 0 and (name == "bpe" or out.columns == docs.columns), name
    copies = corpus_pipeline.exact_copies(spark, docs, "")
    assert copies.count() == 4 + 0  # one two, nothing, x y z, q


# ---------------------------------------------------------------------------- toxicity
def grams(text):
    shown = "".join(c if ord(c) > 32 else " " for c in f" {(text or '').lower()} ")
    return {shown[i:i + n] for n in toxicity.ORDERS for i in range(len(shown) - n + 1)}


def test_toxicity_equals_a_plain_computation(spark):
    rng = np.random.default_rng(5)
    calm, rude = ["river", "stone", "quiet", "green", "walk"], ["idiot", "trash", "awful"]
    texts = [(i, " ".join(rng.choice(calm + (rude if i % 3 == 0 else []), 12))) for i in range(240)]
    docs = spark.createDataFrame(texts + texts[:50], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    sample = [(t, int(i % 3 == 0)) for i, t in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    toxic = sum(y for _, y in sample)
    seen = [Counter(g for t, y in sample if y == k for g in grams(t)) for k in (0, 1)]
    s = toxicity.SMOOTH
    ratio = {g: math.log((seen[1][g] + s) / (toxic + 2 * s)) - math.log((seen[0][g] + s) / (len(sample) - toxic + 2 * s)) for g in {*seen[0], *seen[1]}}
    z = {g: abs(r) / math.sqrt(1 / (seen[1][g] + s) + 1 / (seen[0][g] + s)) for g, r in ratio.items()}
    used = {g: ratio[g] for g in ratio if z[g] > toxicity.MIN_Z}
    assert 0 < len(used) <= toxicity.MAX_FEATURES and len(model.hashes) == len(used)
    order = sorted(used)
    x = np.array([[used[g] * (g in grams(t)) for g in order] for t, _ in sample])
    y = np.array([k for _, k in sample], float)
    w, b, size, size_b = np.zeros(len(order)), 0.0, np.full(len(order), 1e-8), 1e-8
    for _ in range(400):  # the same adaptive gradient steps, on a dense matrix
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        step = x.T @ error + 3e-4 * w
        size, size_b = size + step * step, size_b + error.sum() ** 2
        w, b = w - 0.1 * step / np.sqrt(size), b - 0.1 * error.sum() / np.sqrt(size_b)
    for i, t in texts:
        plain = 1 / (1 + math.exp(-(b + sum(wi * used[g] for wi, g in zip(w, order) if g in grams(t)))))
        assert abs(got[i] - plain) < 1e-6


def test_toxicity_sample_is_bounded_in_rows(spark):
    one, two = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs = spark.createDataFrame([(one, f"text {i % 3}") for i in range(500)] + [(two, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(one, 1), (two, 0)], "doc_id bigint, toxic int")
    assert sorted((r["text"], r["toxic"]) for r in toxicity.training_rows(docs, labels).collect()) == [("other", 0), ("text 0", 1)]
