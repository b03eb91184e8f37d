"""Toxicity by a linear classifier over character n-grams, features scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed 4- to 6-gram of the lower-cased text. Its log-count ratio r compares the shares
of toxic and other training texts that hold it. Features whose ratio stands out by ``MIN_Z`` standard errors stay, at
most ``MAX_FEATURES`` of them; a logistic regression is fitted on presence times r. Counting runs on Spark; the fit is
on a bounded sample of labelled rows. Scoring is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

#: Bounds of the training sample, by class; taken in the order of a hash of the id.
MAX_TOXIC, MAX_OTHER = 10_000, 20_000
ORDERS, BITS, SMOOTH, MIN_Z, MAX_FEATURES = (4, 5, 6), 20, 0.3, 3.0, 4096
REJECT_AT = 0.7
#: Characters of one text looked at together.
SLICE = 1 << 20


def hashed_grams(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes (below 2 ** BITS) of the n-grams of an array of code points, one array per order."""
    codes = codes.astype(np.uint64)
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, max(ORDERS) + 1):
        if len(codes) < n:
            return
        h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1:]
        if n in ORDERS:
            yield ((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)).astype(np.int64)


def present(text: str | None, table: np.ndarray | None = None) -> np.ndarray:
    """Distinct n-gram hashes of a text, or with ``table`` the distinct table entries of 0 or more at them."""
    codes = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes < 33, np.uint32(32), codes)
    found = []
    for at in range(0, len(codes), SLICE):
        for h in hashed_grams(codes[at:at + SLICE + max(ORDERS) - 1]):
            if table is not None:
                h = table[h]
                h = h[h >= 0]
            found.append(np.unique(h))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """Score of a text: sigmoid of ``bias`` plus the weights of the features present."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.full(1 << BITS, -1, np.int16)
        out[self.hashes] = np.arange(len(self.hashes))
        return out

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[features].sum(), -500, 500))))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> DataFrame:
    """(text, toxic, weight) of the training sample: labelled rows whose crc32(id as text) mod 3 is not 1.

    Null labels teach nothing; an id labelled more than once counts as toxic if any label says so; an id with several rows
    of ``docs`` counts once, with its first text in code-point order. So the sample has at most MAX_TOXIC + MAX_OTHER rows,
    however often ids repeat. Its ids, a proven bound, are broadcast and other texts stay where they are. ``weight`` undoes
    the sampling.
    """
    label = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .where(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) != 1)
             .groupBy(F.col(id_col).alias("_id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic")))
    total = {r["toxic"]: r["count"] for r in label.groupBy("toxic").count().collect()}  # two rows
    picked = None
    for kind, most in ((1, MAX_TOXIC), (0, MAX_OTHER)):
        n = total.get(kind, 0)
        some = label.where(F.col("toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(most)
        some = some.withColumn("weight", F.lit(max(n / most, 1.0)))
        picked = some if picked is None else picked.union(some)
    texts = docs.select(F.col(id_col).alias("_did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(picked), F.col("_did") == F.col("_id"))
    return sample.groupBy("_did", "toxic", "weight").agg(F.min("text").alias("text")).select("text", "toxic", "weight")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits the classifier. Without rows of both classes: no features, the score is the smoothed share of toxic rows."""
    ship(docs.sparkSession)
    rows = cut(training_rows(docs, labels, id_col, text_col, label_col), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                seen[toxic, present(text.as_py())] += 1
        h = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(seen[1, h]), pa.array(seen[0, h])], names=["h", "t", "o"])

    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    none = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((toxic + 1) / (other + 1))))
    if not toxic or not other:
        return none
    counts = rows.select("text", "toxic").mapInArrow(count, "h bigint, t int, o int").groupBy("h").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    ratio = F.log((F.col("t") + SMOOTH) / (toxic + 2 * SMOOTH)) - F.log((F.col("o") + SMOOTH) / (other + 2 * SMOOTH))
    z = F.abs(ratio) / F.sqrt(1 / (F.col("t") + SMOOTH) + 1 / (F.col("o") + SMOOTH))
    best = (counts.select("h", ratio.alias("r"), z.alias("z")).where(F.col("z") > MIN_Z)
            .orderBy(F.desc("z"), "h").limit(MAX_FEATURES).collect())
    if not best:
        return none
    hashes, ratios = np.array([b["h"] for b in best]), np.array([b["r"] for b in best])
    table = Model(hashes, ratios, 0.0).table()

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [present(text.as_py(), table).tolist() for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)],
                                             names=["features", "toxic", "weight"])

    # at most MAX_TOXIC + MAX_OTHER labelled ids with at most MAX_FEATURES each
    sample = rows.mapInArrow(featurize, "features array<int>, toxic int, weight double").toArrow()
    lists = sample["features"].combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    weights, bias = fit(np.asarray(lists.flatten()), np.repeat(np.arange(len(sizes)), sizes), ratios,
                        np.asarray(sample["toxic"]).astype(float), np.asarray(sample["weight"]))
    return Model(hashes, weights * ratios, bias)


def fit(features: np.ndarray, row: np.ndarray, ratios: np.ndarray, toxic: np.ndarray, weight: np.ndarray,
        rounds: int = 400, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio: full-batch adaptive gradient steps with weight decay."""
    x, share = ratios[features], weight / weight.sum()
    w, b = np.zeros(len(ratios)), 0.0
    size, size_b = np.full(len(ratios), 1e-8), 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(row, weights=w[features] * x, minlength=len(toxic)), -500, 500)))
        error = (p - toxic) * share
        step = np.bincount(features, weights=error[row] * x, minlength=len(ratios)) + decay * w
        size, size_b = size + step * step, size_b + error.sum() ** 2
        w, b = w - 0.1 * step / np.sqrt(size), b - 0.1 * error.sum() / np.sqrt(size_b)
    return w, float(b)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the model's probability of toxic for each whole text; null counts as empty. No shuffle.

    Only the text enters the score. Repeated rows score alike; no rows give no rows; a column named ``out`` is replaced.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.table()
        for texts in batches:
            yield pd.Series([model.score(present(t, table)) for t in texts], dtype=float)

    return docs.withColumn(out, scored(F.col(text_col)))
