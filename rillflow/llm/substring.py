"""Substring dedup on the De Bruijn graph of word k-mers.

The edges of the graph are windows of ``K`` words. Only edges that two documents share matter, so they are found in
steps that each shuffle little: a window's minimizer (the smallest hash of its 5-word pieces) stands for the run of
neighbouring windows that have it; runs whose minimizer other documents have too are candidates. A run is a piece of
path without a branch: pieces that a smaller document has whole are placed at their first source coordinate (document,
position) in one step, and only the first of equal pieces are taken apart into edges, which are placed alike. Neighbours whose
source coordinates advance together compact to one span. Joins on source coordinates fetch a digest of each span's words
in its source, and only spans whose own words have the same digest are removed.

Hot keys: what one task finds shared it settles itself and sends at most a few witnesses, so a minimizer or an edge that a
third of all documents hold reaches its key's task with a few rows per sending task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

#: Words in a window; words in a minimizer's piece; rows a task settles together.
K, PIECE, BLOCK = 13, 5, 2_000_000
#: Bits of first window * 16 + windows (a text has less than 2 ** 31 bytes); a tag has the 28 bits above and fits with a flag.
_AT_BITS = 34
#: Stands for a null id: later than any other.
NO_ID = (1 << 63) - 1
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


#: Polynomial word hashing modulo 2 ** 64: a random value per byte, powers of an odd base by position.
_STRETCH, _LONG = 1 << 20, 64
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_VALUES = np.random.default_rng(20240607).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95 | 2
_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for positions within a stretch of text."""
    if not _POWERS:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(_STRETCH + 1, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def words_of(text: str) -> list[bytes]:
    """Maximal runs outside the six ASCII blanks (bytes.split splits at just these)."""
    return text.encode("utf-8", "surrogatepass").split()


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``data``, in order; words over ``_LONG`` bytes by xxh3."""
    out = []
    while len(data) > _STRETCH:
        codes = np.frombuffer(data[:_STRETCH], np.uint8)
        blanks = np.flatnonzero((codes == 32) | (codes - np.uint8(9) < 5))
        if not len(blanks):  # one word longer than a stretch, hashed alone
            blank = _BLANK.search(data, _STRETCH)
            end = blank.start() if blank else len(data)
            out.append(np.array([xxhash.xxh3_64_intdigest(data[:end])], np.uint64))
            data = data[end + 1:]
            continue
        out.append(word_hashes(data[:blanks[-1]]))
        data = data[blanks[-1] + 1:]
    codes = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[False], (codes != 32) & (codes - np.uint8(9) >= 5), [False]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[codes] * up[:len(codes)])])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(32))) * _B + (ends - starts).astype(np.uint64)
    for i in np.flatnonzero(ends - starts > _LONG):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]])
    return np.concatenate([*out, h]) if out else h


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    out = words[:n].copy()
    for i in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _A + words[i:i + n]
    return (out ^ (out >> np.uint64(32))) * _B


def minimizer_runs(words: np.ndarray, k: int, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, windows) of each run of neighbouring windows with one minimizer."""
    pieces = window_hashes(words, piece)
    span = k - piece + 1
    at = np.lib.stride_tricks.sliding_window_view(pieces, span).argmin(axis=1) + np.arange(len(pieces) - span + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return pieces[at[first]], first, np.diff(np.append(first, len(at)))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a.astype(np.uint64) * _A) ^ b.astype(np.uint64)
    return (h ^ (h >> np.uint64(31))) * _B


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by the keys, and for each sorted row the index of the first with its first key."""
    order = np.lexsort(keys[::-1])
    k = keys[0][order]
    new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return order, np.repeat(new, np.diff(np.append(new, len(k))))


def _turned(doc: np.ndarray) -> np.ndarray:
    """Ids with their high 40 bits turned to the front: in a row, an id's significant bytes then lie next to the hash behind
    it and the position behind that, which packs a shuffled row into fewer bytes. ``_id_of`` turns them back."""
    d = doc.astype(np.uint64)
    return ((d << np.uint64(40)) | (d >> np.uint64(24))).view(np.int64)


def _id_of(turned: str) -> Column:
    return F.shiftleft(turned, 24).bitwiseOR(F.shiftrightunsigned(turned, 40))


def _shared_runs(docs: DataFrame, k: int, piece: int, block: int) -> DataFrame:
    """(doc, tag, runs): the candidate runs of each text, packed as first window * 16 + windows; rows carry the tag above that,
    where it takes no room if it is 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def settle():
            m, doc, at = (np.concatenate(x) for x in zip(*held))
            order, head = _groups(m, doc, at)
            last = np.append(np.flatnonzero(np.diff(head)), len(m) - 1)
            tail = np.repeat(last, np.diff(np.append(np.unique(head), len(m))))
            settled = (doc[order[head]] != doc[order[tail]]) & (tail - head > 2)
            first = np.flatnonzero(settled & (np.arange(len(m)) == head))
            ends = order[np.concatenate([first, tail[first]])]  # the smallest and the largest document bear witness
            known = np.zeros(len(m), bool)
            known[order] = settled  # rows leave in the order of documents, which packs better
            key = np.where(known, _mix(doc, at), m)
            return pa.RecordBatch.from_arrays(
                [pa.array(_turned(np.concatenate([doc, doc[ends]]))), pa.array(np.concatenate([key, m[ends]]).view(np.int64)),
                 pa.array(np.concatenate([at * 2 + known, np.full(len(ends), -2)]))], names=["turned", "k", "at"])

        for batch in batches:
            for doc, text, tag in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = word_hashes(text.as_py().encode("utf-8", "surrogatepass"))
                if len(words) < k:
                    continue
                m, first, size = minimizer_runs(words, k, piece)
                held.append((m, np.full(len(m), doc, np.int64), (tag << _AT_BITS) + first * 16 + size))
                rows += len(m)
                if rows >= block:
                    yield settle()
                    held, rows = [], 0
        if held:
            yield settle()

    runs = docs.select("doc", "text", "tag").mapInArrow(run, "turned bigint, k bigint, at bigint").repartition("k")
    runs = runs.select("k", _id_of("turned").alias("doc"), F.shiftright("at", 1).alias("at"), (F.col("at") % 2 != 0).alias("known"))
    same = Window.partitionBy("k", "known")
    dealt = runs.select("doc", "at", "known", (F.min("doc").over(same) < F.max("doc").over(same)).alias("shared"))
    dealt = dealt.where("at >= 0 and (known or shared)").select("doc", F.shiftright("at", _AT_BITS).cast("int").alias("tag"),
                                                                F.col("at").bitwiseAND(F.lit((1 << _AT_BITS) - 1)).alias("at"))
    return dealt.groupBy("doc", "tag").agg(F.collect_set("at").alias("runs"))  # rows equal in id and text have theirs in common


def _occurrences(docs: DataFrame, k: int, block: int, pieces: bool) -> DataFrame:
    """Occurrences (turned id, key, at = pos * 16 + n, tag) of the documents' candidate runs: of whole runs as ``pieces`` of a path, else of
    their single edges (n = 1). (sdoc, stag, spos) is where the task itself has the same in a smaller document; ``key``
    deals the others by what they hold."""
    names = ["turned", "key", "at", "tag", "sdoc", "stag", "spos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def settle():
            h, doc, tag, pos, n = (np.concatenate(x) for x in zip(*held))
            order, head = _groups(h, doc, tag, pos)
            source = np.empty(len(h), np.int64)
            source[order] = order[head]
            done = doc[source] < doc
            key = np.where(done, _mix(doc, pos), h)
            known = [pa.array(x[source], mask=~done) for x in (doc, tag, pos)]
            at = pos.astype(np.int64) * 16 + n
            return pa.RecordBatch.from_arrays([pa.array(_turned(doc)), pa.array(key.view(np.int64)), pa.array(at), pa.array(tag), *known], names=names)

        for batch in batches:
            for doc, text, tag, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3)):
                words = word_hashes(text.as_py().encode("utf-8", "surrogatepass"))
                if len(words) < k:
                    continue
                edges = window_hashes(words, k)
                at = np.unique(np.asarray(runs.values))
                pos, n = at >> 4, at & 15
                if not pieces:
                    n = np.minimum(n, np.maximum(len(edges) - pos, 0))
                    pos = np.repeat(pos, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    n = np.ones(len(pos), np.int64)
                ok = pos + n <= len(edges)  # runs of another text with this one's id and tag may not exist here
                pos, n = pos[ok], n[ok]
                h = edges[pos]
                if pieces:  # a run is shorter than a window, so its first and last window hold all its words
                    h = _mix(_mix(h, edges[pos + n - 1]), n)
                held.append((h, np.full(len(pos), doc, np.int64), np.full(len(pos), tag, np.int32),
                             pos.astype(np.int32), n.astype(np.int32)))
                rows += len(pos)
                if rows >= block:
                    yield settle()
                    held, rows = [], 0
        if held:
            yield settle()

    return docs.select("doc", "text", "tag", "runs").mapInArrow(
        run, "turned bigint, key bigint, at bigint, tag int, sdoc bigint, stag int, spos int")


def _placed(occurrences: DataFrame) -> DataFrame:
    """Occurrences with the first document, text and position (sdoc, stag, spos) that holds the same."""
    first = Window.partitionBy("key").orderBy("doc", "tag", "pos")
    source = [F.coalesce(F.col(s), F.first(c).over(first)).alias(s) for s, c in (("sdoc", "doc"), ("stag", "tag"), ("spos", "pos"))]
    dealt = occurrences.repartition("key").select(
        "key", _id_of("turned").alias("doc"), "tag", F.shiftright("at", 4).cast("int").alias("pos"), (F.col("at") % 16).cast("int").alias("n"),
        "sdoc", "stag", "spos")
    return dealt.select("doc", "tag", "pos", "n", *source)


def _digest(words: list[bytes], start: int, windows: int, k: int) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words[start:start + windows + k - 1]))


def _spans(placed: DataFrame) -> DataFrame:
    """(doc, tag, start, windows, sdoc, stag, sstart): neighbours whose source coordinates advance together are one path."""
    order = Window.partitionBy("doc", "tag").orderBy("pos")
    step = F.col("pos") - F.lag("pos").over(order)
    goes_on = ((step <= F.lag("n").over(order)) & (F.col("spos") - F.lag("spos").over(order) == step)
               & (F.col("sdoc") == F.lag("sdoc").over(order)) & (F.col("stag") == F.lag("stag").over(order)))
    path = F.sum(F.when(goes_on, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("path", path).groupBy("doc", "tag", "path", "sdoc", "stag")
            .agg(F.min("pos").alias("start"), (F.max(F.col("pos") + F.col("n")) - F.min("pos")).alias("windows"), F.min("spos").alias("sstart"))
            .select("doc", "tag", "start", "windows", "sdoc", "stag", "sstart"))


def _source_digests(docs: DataFrame, k: int) -> DataFrame:
    """(sdoc, stag, sstart, windows, digest) of the source spans asked for in ``asked`` (one row per text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, raw, tag, asked = (c[i].as_py() for c in batch.columns)
                words = words_of(raw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(asked), pa.int64()), pa.array([tag] * len(asked), pa.int32()),
                     pa.array([s["sstart"] for s in asked], pa.int32()), pa.array([s["windows"] for s in asked], pa.int32()),
                     pa.array([_digest(words, s["sstart"], s["windows"], k) for s in asked], pa.binary())],
                    names=["sdoc", "stag", "sstart", "windows", "digest"])

    return docs.select("doc", "text", "tag", "asked").mapInArrow(
        run, "sdoc bigint, stag int, sstart int, windows int, digest binary").distinct()


def _kept(docs: DataFrame, k: int) -> DataFrame:
    """(doc, n_words, n_removed, kept) of documents with their spans."""
    names = ["doc", "n_words", "n_removed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                part = batch.slice(at, 256)
                for doc, raw, spans in zip(*(c.to_pylist() for c in part.columns)):
                    words = words_of(raw)
                    gone = np.zeros(len(words), bool)
                    for s in spans or ():
                        if _digest(words, s["start"], s["windows"], k) == s["digest"]:
                            gone[s["start"]:s["start"] + s["windows"] + k - 1] = True
                    left = [words[i] for i in np.flatnonzero(~gone)]
                    rows.append((doc, len(words), int(gone.sum()), b" ".join(left).decode("utf-8", "surrogatepass")))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return docs.select("doc", "text", "spans").mapInArrow(run, "doc bigint, n_words bigint, n_removed bigint, kept string")


def _by_text(docs: DataFrame, more: DataFrame, how: str) -> DataFrame:
    return docs.join(more, ["doc", "tag"], how)


def repeated_spans(docs: DataFrame, k: int = K, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """(doc, tag, start, windows, sdoc, stag, sstart) over prepared documents (doc, text, tag): maximal spans of windows
    that start in a document with a smaller id too, with where they start there."""
    runs = _shared_runs(docs, k, piece, block)
    pieces = _placed(_occurrences(_by_text(docs, runs, "inner"), k, block, pieces=True))
    # pieces that no smaller document has whole may still hold edges that one has
    # (a first piece's source lies in its own document, not behind it; asked so that both readers of the exchange share it)
    first = pieces.where("sdoc = doc and (stag <> tag or spos <= pos)").groupBy("doc", "tag").agg(F.collect_set((F.col("pos").cast("long") * 16 + F.col("n"))).alias("runs"))
    edges = _placed(_occurrences(_by_text(docs, first, "inner"), k, block, pieces=False))
    return _spans(pieces.where("sdoc < doc").union(edges.where("sdoc < doc")).repartition("doc", "tag"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, piece: int = PIECE,
                   block: int = BLOCK) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept`` (kept words joined by one space).

    A word goes when a window of ``k`` words that covers it also starts in a document with a smaller id; windows are
    judged on the input. Null text has no words; texts under ``k`` words lose none. A null id counts as larger
    than any other, so such rows lose what others have and take nothing from each other. Rows that repeat an id are
    one document's: they never take words from each other, and each is judged on its own text. No rows give no rows;
    further columns are ignored, whatever their names. Edges are told apart by 64-bit hashes, spans removed only when
    a 128-bit digest of their words equals their source's.
    """
    ship(docs.sparkSession)
    ids: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    plain = docs.select(ids.alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = plain.select("doc", "text", _tag(plain).alias("tag"))
    spans = repeated_spans(rows, k, piece, block)
    asked = (spans.select(F.col("sdoc").alias("doc"), F.col("stag").alias("tag"), "sstart", "windows").distinct().groupBy("doc", "tag")
             .agg(F.collect_list(F.struct("sstart", "windows")).alias("asked")))
    source = _source_digests(_by_text(rows, asked, "inner"), k)
    checked = (spans.join(source, ["sdoc", "stag", "sstart", "windows"]).groupBy("doc", "tag")
               .agg(F.collect_list(F.struct("start", "windows", "digest")).alias("spans")))
    out = _kept(_by_text(rows, checked, "left"), k)
    kind = docs.schema[id_col].dataType.simpleString()
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(id_col), "n_words", "n_removed", "kept")


def _tag(rows: DataFrame) -> Column:
    """Tells texts of one id (null ids are one too) apart, so that what is asked of one is not dealt to all; 0 (1 for ids
    below 0), which takes no room in shuffles, if no id of the table occurs twice."""
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return F.shiftrightunsigned("doc", 63).cast("int")  # no literal: one drops out of join keys, and both sides are dealt out anew
    return F.shiftrightunsigned(F.xxhash64("text"), _AT_BITS + 2).cast("int")
