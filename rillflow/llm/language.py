"""Language identification by averaged hashed subword embeddings with a linear softmax.

A text's subwords are the 2- to 4-grams of its lower-cased words, a blank marking both ends of a word. Each is hashed to
one of 2 ** BITS embeddings; the text is the mean of its subwords' embeddings, and a linear softmax over it gives every
language's probability. Embeddings and softmax are trained by stochastic gradient descent in numpy on a bounded sample
of labelled rows. A part of the sample is kept back to calibrate: a temperature that makes probabilities honest, and the
probability below which an answer is not accepted. Identifying is a map over whole texts.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

#: Bounds of the training sample: rows in all, and languages (the most frequent ones).
MAX_ROWS, MAX_LANGUAGES = 4_000, 256
ORDERS, BITS, WIDTH = (2, 3, 4), 14, 16
#: Passes over the sample; a small sample is passed over until it has given so many steps.
EPOCHS, STEPS, BATCH, RATE = 12, 800, 32, 40.0
#: One of so many sampled rows calibrates; accepted answers are to be right this often.
CALIBRATE, RIGHT = 5, 0.99
NONE = "und"
#: Characters of one text looked at together.
SLICE = 1 << 20
SEED = 20240607


@functools.cache
def _letters() -> np.ndarray:
    """Which code points belong to words: letters, and the marks that go with them (2)."""
    kinds = {"L": 1, "M": 2}
    return np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)


def subwords(text: str | None) -> Iterator[np.ndarray]:
    """Hashes (below 2 ** BITS) of all subwords of a whole text, in pieces; nothing for a text without letters."""
    if not text:
        return
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not (letter == 1).any():
        return
    codes = np.where(letter > 0, codes, np.uint32(32)).astype(np.uint64)
    longest = max(ORDERS)
    for at in range(0, len(codes), SLICE):
        part = codes[at:at + SLICE + longest - 1]
        blank = part == 32
        h = part * np.uint64(0x9E3779B97F4A7C15)
        inner = np.zeros(len(part), bool)  # a blank inside the gram, both ends aside
        for n in range(2, longest + 1):
            if len(part) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + part[n - 1:]
            if n > 2:
                inner = inner[:-1] | blank[n - 2:len(part) - 1]
            else:
                inner = inner[:-1]
            if n in ORDERS:
                starts = min(len(h), SLICE)  # later grams belong to the next piece
                ok = ~inner[:starts] & ~(blank[:starts] & blank[n - 1:][:starts]) if n == 2 else ~inner[:starts]
                yield ((h[:starts][ok] * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """``logits``: every hashed subword's share in every language's score, (2 ** BITS, languages)."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    accept_at: float = 0.0

    def scores(self, text: str | None) -> np.ndarray | None:
        """Probabilities of the languages, None for a text without letters or a model without languages."""
        total, n = np.zeros(len(self.languages)), 0
        for h in subwords(text):
            total += self.logits[h].sum(axis=0, dtype=np.float64)
            n += len(h)
        return _softmax((total / n + self.bias) / self.temperature) if n and len(self.languages) else None


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def training_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MAX_ROWS,
                  languages: int = MAX_LANGUAGES) -> tuple[list[str], DataFrame]:
    """(languages, (text, lang) sample): the most frequent languages share ``most`` rows evenly, taken in the order of
    a hash of text and language.

    Rows with a null language or text are left out. A language with fewer rows than its share gives all. Rows are
    counted per language first, so a threshold on the hash picks about the share without gathering a language in one
    task. Texts that repeat are taken once, so a group of copies cannot fill the sample; the limit makes the bound exact."""
    named = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    counts = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return [], named.limit(0)
    share = most // len(counts)
    rate = F.lit(0.0)
    for r in counts:
        rate = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, share / r["n"]))).otherwise(rate)
    hashed = named.withColumn("h", F.xxhash64(F.lit(SEED), F.col("lang"), F.col("text")))
    picked = hashed.where(F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30)) < rate).dropDuplicates(["h"])
    return sorted(r["lang"] for r in counts), picked.orderBy("h").limit(most).select("text", "lang")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the model on labelled rows of ``docs``; a model without languages where there are none.

    Only texts and languages are read. The sample's subword counts come to
    the driver: at most MAX_ROWS rows of at most 2 ** BITS entries."""
    ship(docs.sparkSession)
    languages, rows = training_rows(docs, text_col, lang_col)
    number = {l: i for i, l in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                pieces = list(subwords(text.as_py()))
                if pieces and sum(map(len, pieces)):
                    h, n = np.unique(np.concatenate(pieces), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([h.astype(np.int32)]), pa.array([(n / n.sum()).astype(np.float32)]),
                                                      pa.array([number[lang.as_py()]], pa.int32())], names=["h", "w", "lang"])

    sample = cut(rows, "language-sample").mapInArrow(count, "h array<int>, w array<float>, lang int").toArrow()
    if not sample.num_rows:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    h, w, y = (sample[c].combine_chunks() for c in ("h", "w", "lang"))
    order = np.random.default_rng(SEED).permutation(_sorted_rows(h, w, y))
    return fit(languages, np.asarray(h.offsets), np.asarray(h.values), np.asarray(w.values), np.asarray(y), order)


def _sorted_rows(h: pa.Array, w: pa.Array, y: pa.Array) -> np.ndarray:
    """Row numbers in an order that their contents alone decide, whatever order the tasks gave them in."""
    keys = [(int(y[i].as_py()), h[i].values.to_numpy().tobytes(), w[i].values.to_numpy().tobytes()) for i in range(len(y))]
    return np.array(sorted(range(len(keys)), key=keys.__getitem__))


def fit(languages: list[str], offsets: np.ndarray, hashes: np.ndarray, shares: np.ndarray, y: np.ndarray,
        order: np.ndarray) -> Model:
    """Gradient descent in small batches over rows of (hashes, shares) between ``offsets``, then calibration."""
    rng = np.random.default_rng(SEED)
    n_buckets, k = 1 << BITS, len(languages)
    held = order[::CALIBRATE] if len(order) >= 10 * CALIBRATE else order
    learn = np.setdiff1d(order, held, assume_unique=True) if len(held) < len(order) else order
    embed = (rng.standard_normal((n_buckets, WIDTH)) / np.sqrt(WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, k), np.float32), np.zeros(k, np.float32)

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), n_buckets), np.float32)
        for i, r in enumerate(rows):
            x[i, hashes[offsets[r]:offsets[r + 1]]] = shares[offsets[r]:offsets[r + 1]]
        return x

    batches = -(-len(learn) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches))
    steps, step = epochs * batches, 0
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            rows = learn[at:at + BATCH]
            x = dense(rows)
            mean = x @ embed
            error = _softmax(mean @ out + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            rate = RATE * (1 - step / steps)
            back = error @ out.T
            out -= rate / WIDTH * (mean.T @ error)
            bias -= rate / 100 * error.sum(axis=0)
            embed -= rate * (x.T @ back)
            step += 1
    model = Model(languages, embed @ out, bias.astype(np.float64))
    z = np.concatenate([dense(held[at:at + BATCH]) @ model.logits for at in range(0, len(held), BATCH)]) + model.bias
    model.temperature, model.accept_at = calibrated(z.astype(np.float64), y[held])
    return model


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(temperature of the least log loss, lowest top probability at which accepted answers are right ``RIGHT`` of the time).

    The loss is taken against targets a little below certainty, one row more than there are going elsewhere, so that a
    part without errors does not call for endless confidence."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(50), 121))
    k, doubt = z.shape[1], 1 / (len(y) + 2)
    target = np.full(z.shape, doubt / max(k - 1, 1))
    target[np.arange(len(y)), y] = 1 - doubt
    loss = [-(target * np.log(np.maximum(_softmax(z / t), 1e-300))).sum(axis=1).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= RIGHT)
    return temperature, float(top[order][good[-1]]) if len(good) else 1.0


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language; "und" for a text that is null or has no letter, and where no
    language was learned), ``score`` (its calibrated probability; 0 for "und") and ``accepted`` (the score reaches
    the calibrated threshold). A map without shuffle over whole texts, a slice of each at a time; of languages that tie
    the first in code-point order. Columns of ``docs`` with these names are replaced; no rows give no rows."""
    ship(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [model.scores(t) for t in texts]
            best = [None if p is None else int(p.argmax()) for p in found]
            score = [0.0 if p is None else float(p[b]) for p, b in zip(found, best)]
            yield pd.DataFrame({"lang_pred": [NONE if b is None else model.languages[b] for b in best], "score": score,
                                "accepted": [b is not None and s >= model.accept_at for b, s in zip(best, score)]})

    added = ["lang_pred", "score", "accepted"]
    held = docs.select(*[c for c in docs.columns if c not in added], told(F.col(text_col)).alias("__told"))
    return held.select(*[F.col(c) for c in held.columns[:-1]], *[F.col(f"__told.{c}").alias(c) for c in added])
