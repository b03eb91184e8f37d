"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label. A positive's negatives are the best rows of other labels whose
score lies in a window below the positive's score. The windows of one anchor overlap; their upper limits split the
scores into disjoint slots:

    slot s holds the scores at or below the limit of positive s and above the limit of positive s + 1

Combiners in the tasks keep the best ``negatives`` rows of each slot. What lies below a positive's upper limit is the
union of its own slot and all later ones, so a merge from the last slot to the first answers every window; the lower
limit cuts the end of the merged list.

Anchors are a stated query set: they go over all rows in blocks of bounded size, a broadcast block and two maps over the
rows at a time. Rows never move; a task sends at most ``positives + 1`` rows, then ``negatives`` rows a slot, of each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.session import empty_frame, scratch_path

from .common import cut, ship
from .vectors import dense

SCALE = 256
#: Anchors of one block, and bytes of their vectors: what is broadcast at once.
ANCHORS, BLOCK_BYTES = 2048, 8 << 20
#: Rows that a task compares with a block at once, and candidates of all anchors it keeps before it sorts them.
ROWS, CANDIDATES = 1024, 1 << 18
NO_ID = np.iinfo(np.int64).max
COLUMNS = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def limit_of(width: int) -> float:
    """Components below this give inner products that a long holds, whatever the vectors of that width."""
    return float(np.floor(np.sqrt(2.0 ** 62 / max(width, 1))) / SCALE - 1)


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of two blocks of whole vectors: in doubles where these hold every partial sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a @ b.T


class Best:
    """The best ``most`` (score, id) of each of ``n`` groups, by falling score, then rising id, in bounded memory."""

    def __init__(self, n: int, most: int):
        self.most, self.n = most, n
        self.group, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: The last place so far of each group that is full: what comes behind it needs no keeping.
        self.last, self.last_id = np.full(n, np.iinfo(np.int64).min), np.full(n, NO_ID)

    def ahead(self, scores: np.ndarray, ids: np.ndarray, groups: slice) -> np.ndarray:
        """Which entries of a (groups, rows) block come before their group's last place."""
        last = self.last[groups, None]
        if scores.dtype != np.int64:
            last = last.astype(np.float64)
        return (scores > last) | ((scores == last) & (ids[None, :] < self.last_id[groups, None]))

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.group = np.concatenate([self.group, group])
        self.score = np.concatenate([self.score, score.astype(np.int64)])
        self.id = np.concatenate([self.id, ids])
        if len(self.group) > max(CANDIDATES, 2 * self.n * self.most):
            self.settle()

    def settle(self) -> None:
        order = np.lexsort((self.id, -self.score, self.group))
        group = self.group[order]
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        order, group, place = order[place < self.most], group[place < self.most], place[place < self.most]
        self.group, self.score, self.id = group, self.score[order], self.id[order]
        full = place == self.most - 1
        self.last[group[full]], self.last_id[group[full]] = self.score[full], self.id[full]


def _rows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, whole vectors) of a batch's fit rows, some at a time; a null id is ``NO_ID``."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        fit, v = dense(part.column(2), width, limit_of(width))
        labels = part.column(1).take(pa.array(fit))
        keep = np.asarray(labels.is_valid())
        ids = part.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)[fit[keep]]
        yield ids, labels.drop_null().to_numpy(zero_copy_only=False), whole(v[keep])


def _blocks(anchors: DataFrame, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The anchors in blocks that the driver holds one at a time, a partition of the written anchors after another."""
    most = max(1, min(ANCHORS, BLOCK_BYTES // (8 * width)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, q in _rows(batch, width):
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([ids.astype("<i8").tobytes()]), pa.array([labels.astype("<i8").tobytes()]),
                                                      pa.array([q.astype("<i8").tobytes()])], names=["i", "l", "q"])

    held, n = [], 0
    for row in anchors.mapInArrow(pack, "i binary, l binary, q binary").toLocalIterator():
        part = [np.frombuffer(bytes(x), "<i8").astype(np.int64) for x in row]
        part[2] = part[2].reshape(-1, width)
        while len(part[0]):
            take = min(most - n, len(part[0]))
            held.append([x[:take] for x in part])
            part, n = [x[take:] for x in part], n + take
            if n == most:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _best(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The best rows of every group: the tasks' winners, cut again before and after they are shuffled."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("place", place).where(F.col("place") <= most)


def _positives(rows: DataFrame, block, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of each anchor's positives, best first, as matrices; missing ones have the lowest score."""
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(block)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, q = shared.value
        best = Best(len(ids), most + 1)
        for batch in batches:
            for row_ids, row_labels, v in _rows(batch, width):
                for label in np.unique(row_labels):
                    mine, same = np.flatnonzero(labels == label), np.flatnonzero(row_labels == label)
                    if not len(mine):
                        continue
                    scores = products(q[mine], v[same])
                    a, r = np.nonzero(best.ahead(scores, row_ids[same], mine))
                    best.add(mine[a], scores[a, r], row_ids[same][r])
                best.settle()
        best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(best.group), pa.array(best.score), pa.array(best.id)], names=["a", "score", "id"])

    # at most (most + 1) rows an anchor of one block
    found = _best(rows.mapInArrow(near, "a bigint, score bigint, id bigint"), ["a"], most + 1).select("a", "place", "score", "id").toArrow()
    shared.unpersist()
    ids, _, q = block
    score = np.full((len(ids), most + 1), np.iinfo(np.int64).min)
    other = np.full((len(ids), most + 1), NO_ID)
    a, place = found["a"].to_numpy(), found["place"].to_numpy() - 1
    score[a, place], other[a, place] = found["score"].to_numpy(), found["id"].to_numpy()
    # an anchor is among the rows: one row of its id and of its score with itself is the anchor, not another row
    own = (other == ids[:, None]) & (score == np.einsum("ij,ij->i", q, q)[:, None])
    drop = np.where(own.any(axis=1), own.argmax(axis=1), most)
    keep = np.arange(most + 1)[None, :] != drop[:, None]
    return score[keep].reshape(-1, most), other[keep].reshape(-1, most)


def _slots(rows: DataFrame, block, width: int, high: np.ndarray, low: np.ndarray, most: int) -> DataFrame:
    """(a, slot, place, score, id): the best rows of other labels in every slot of every anchor of the block."""
    shared = rows.sparkSession.sparkContext.broadcast((*block, high, low))
    slots = high.shape[1]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, labels, q, upper, lower = shared.value
        lowest = np.iinfo(np.int64).min
        below = np.concatenate([upper[:, 1:], np.full((len(upper), 1), lowest)], axis=1)
        best = [Best(len(labels), most) for _ in range(slots)]
        for batch in batches:
            for row_ids, row_labels, v in _rows(batch, width):
                scores = products(q, v)
                differs = labels[:, None] != row_labels[None, :]
                for s in range(slots):
                    least = np.maximum(below[:, s] + 1, lower[:, s])[:, None]
                    inside = (scores <= upper[:, s, None]) & (scores >= least) & differs
                    inside &= best[s].ahead(scores, row_ids, slice(None))
                    a, r = np.nonzero(inside)
                    if len(a):
                        best[s].add(a, scores[a, r], row_ids[r])
                        best[s].settle()
        for s in range(slots):
            best[s].settle()
            yield pa.RecordBatch.from_arrays([pa.array(best[s].group), pa.array(np.full(len(best[s].group), s + 1, np.int32)),
                                              pa.array(best[s].score), pa.array(best[s].id)], names=["a", "slot", "score", "id"])

    return _best(rows.mapInArrow(fill, "a bigint, slot int, score bigint, id bigint"), ["a", "slot"], most)


def _merged(slots: DataFrame, n_slots: int, most: int) -> DataFrame:
    """(a, slot, rank, score, id): for every slot the best rows of it and all later ones, merged from the last one on.

    An anchor's slots are one row of at most slots times ``most`` entries."""
    entry = F.struct(F.negative("score").alias("down"), F.col("id"))
    held = slots.groupBy("a").agg(F.collect_list(F.struct("slot", entry.alias("e"))).alias("all"))

    def later(acc, s):
        own = F.transform(F.filter(F.col("all"), lambda x: x["slot"] == s), lambda x: x["e"])
        run = F.slice(F.array_sort(F.concat(acc["run"], own)), 1, most)
        return F.struct(run.alias("run"), F.concat(acc["done"], F.array(F.struct(s.alias("slot"), run.alias("run")))).alias("done"))

    run = "array<struct<down:bigint,id:bigint>>"
    start = F.struct(F.array().cast(run).alias("run"), F.array().cast(f"array<struct<slot:int,run:{run}>>").alias("done"))
    runs = F.aggregate(F.sequence(F.lit(n_slots), F.lit(1), F.lit(-1)), start, later, lambda acc: acc["done"])
    each = held.select("a", F.explode(runs).alias("w")).select("a", F.col("w.slot").alias("slot"), F.posexplode("w.run").alias("at", "e"))
    return each.select("a", "slot", (F.col("at") + 1).alias("rank"), F.negative("e.down").alias("score"), F.col("e.id").alias("id"))


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``anchors`` holds.

    Scores are inner products of floor(256 x) components. Higher scores come first, ties by smaller id (null last).
    ``positives``: the best other rows of the anchor's label; ``negatives``: the best rows of other labels with
    low * positive <= 100 * negative <= high * positive. ``label_col`` is a whole number. Rows with a null label, a null
    vector, a null or non-finite component, a component too large for 64-bit products, or another vector length than most
    take no part. Rows that repeat are rows of their own, an anchor's copy is another row, and repeated anchors are
    each answered; a positive without negatives gives no row; no anchors or no rows give none. Other columns are ignored.
    """
    from .whitening import width_of

    spark = rows.sparkSession
    ship(spark)
    width = width_of(rows, vector_col)
    if not width:
        return empty_frame(spark, COLUMNS)
    plain = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("v"), anchors.alias("asked"))
    chosen = cut(plain.where("asked").select("id", "label", "v"), "negatives-anchors")
    every = plain.select("id", "label", "v")
    path = scratch_path(spark, "negatives")
    written = False
    for block in _blocks(chosen, width):
        score, other = _positives(every, block, width, positives)
        exists = score > np.iinfo(np.int64).min
        whole_score = np.where(exists, score, -1)
        # floor and ceiling in whole numbers; a negative positive's window is empty, as low * p > high * p
        upper = np.where(whole_score >= 0, _part(whole_score, high), np.iinfo(np.int64).min + 1)
        lower = np.where(whole_score >= 0, -_part(-whole_score, low), np.iinfo(np.int64).max)
        found = _merged(_slots(every, block, width, upper, lower, negatives), positives, negatives)
        a, s = np.nonzero(exists & (score >= 0))
        asked = spark.createDataFrame(pa.table({"a": pa.array(a), "slot": pa.array(s + 1, pa.int32()), "anchor_id": pa.array(block[0][a]),
                                                "positive_id": pa.array(other[a, s], mask=other[a, s] == NO_ID),
                                                "positive_score": pa.array(score[a, s]), "least": pa.array(lower[a, s])}))
        out = found.join(asked, ["a", "slot"]).where("score >= least").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            F.when(F.col("id") != F.lit(int(NO_ID)), F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out.write.mode("append").parquet(path)
        written = True
    return spark.read.schema(COLUMNS).parquet(path) if written else empty_frame(spark, COLUMNS)


def _part(scores: np.ndarray, percent: int) -> np.ndarray:
    """floor(percent * score / 100) without leaving 64 bits."""
    return scores // 100 * percent + scores % 100 * percent // 100
