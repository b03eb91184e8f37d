"""Near-duplicate components by a Jaccard join over word shingles, with signatures of parts of the sets.

A document's set holds the hashes of its distinct shingles; equal sets are one class from the start. Sizes are dealt into
classes so that linked sets are in one class or in neighbouring ones. Each size class has its own scheme, which deals all
tokens into more parts than linked sets of its sizes can have different tokens, so linked sets are equal in a part. A set
that can differ from others by h tokens sends hashes of its first h + 1 parts that are not empty, under the scheme of its class and
the next. The few sets that have fewer such parts send pairs of an empty part and a token besides. What shares a signature is a bucket;
buckets of the same members are one.

* Members of a bucket are compared with its hub first: the member that shares most signatures with others, which is the
  middle of what is copied from it. Buckets inside one component are done with.
* Members of buckets up to ``SMALL`` that are still in different components are paired. A pair must pass sizes and sketches,
  a bit for the parity of the tokens that fall on it: sets differ by as many tokens at least as their sketches by bits.
* Larger buckets are dealt anew by the edits from the centre of their group, the tokens over half of the group hold. With r tokens
  removed and a added, weight g = den * r + num * a, sets x and y are linked exactly if (num + den) * shared edits >=
  g(x) + g(y) - (den - num) * |centre|. So linked sets share an edit or are linked to the member nearest to the centre, and a prefix of
  their edits, rarest first, finds them. An edit from a centre is shared by about half of its group at most, so
  groups shrink with each deal until none is over ``SMALL``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, Scratch, components, cut, ship
from .substring import NO_ID, window_hashes, word_hashes

#: Size up to which the members of a bucket are paired.
SMALL = 64
#: Members, about, whose tokens name a group's centre. Any centre gives the same links; a poor one only halves groups less well.
CENTRE = 16
#: Sets a task remembers in order to send a repeated set's signatures once.
REMEMBERED = 1_000_000
#: Bits of the map that says which rows' texts may be needed: 8 MB at any size of the input.
MAP_BITS = 1 << 26
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes (as int64): A-Z lower-cased; fewer than ``k`` words are one shingle; no words, none."""
    data = text.encode("utf-8", "surrogatepass").lower()
    words = word_hashes(data)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(data.split()), seed=len(words))] if len(words) else [], np.uint64).view(np.int64)
    return np.unique(window_hashes(words, k).view(np.int64))


def class_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _needed(n, num: int, den: int):
    """Tokens that sets of ``n`` share at least with any set they are linked to."""
    return (num * n + den - 1) // den


@cache
def _tops(num: int, den: int) -> list[int]:
    """Largest size of each size class: sets of one class link to those of the class itself and its neighbours only."""
    tops = [1]
    while tops[-1] < 1 << 40:
        tops.append(max(tops[-1] + 1, tops[-1] * den // num))
    return tops


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _A
    return (h ^ (h >> np.uint64(29))) * _B


def signatures(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes (as int64) of which linked sets that are not equal share one at least."""
    n, out = len(tokens), []
    if not n or num >= den:
        return np.zeros(0, np.int64)
    tops = _tops(num, den)
    own = bisect_left(tops, n)
    mixed = _mixed(tokens.view(np.uint64))
    for at in (own, own + 1):
        largest = min(tops[at], n * den // num)  # partner
        errors = (den - num) * (n + largest) // (den + num)
        if not errors or at > own and largest <= tops[own]:
            continue
        most = (den - num) * 2 * tops[at] // (den + num)
        parts = most + 2 + most // 8
        part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums, full = np.add.reduceat(mixed[order], first), part[first]
        scheme = _mixed(np.array([at], np.uint64))
        out.append(_mixed(sums[:errors + 1] ^ _mixed(full[:errors + 1].astype(np.uint64) + scheme)))
        if len(full) <= errors:
            # linked to one of its kind without an equal part that is not empty, it has parts - errors empty ones in common with it
            empty = np.setdiff1d(np.arange(parts), full)
            empty = empty[:len(empty) - (parts - errors) + 1].astype(np.uint64)
            prefix = mixed[:n - _needed(n, num, den) + 1]
            out.append(_mixed((_mixed(empty + scheme)[:, None] + prefix[None, :]).ravel()))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """A bit per token about, at least 64, as int64: the parity of the tokens that fall on it. Halves of a sketch, one on the other, are the next smaller one."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64
    h = tokens.view(np.uint64)
    odd = np.bincount(((h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _narrow(docs: DataFrame, k: int) -> DataFrame:
    """(id, row, n, c, sketch): set size, class key (equal sets have equal keys) and sketch of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), k) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([class_key(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.list_(pa.int64()))],
                                             names=["id", "row", "n", "c", "sketch"])

    return docs.select("id", "row", "text").mapInArrow(run, "id bigint, row bigint, n bigint, c bigint, sketch array<bigint>")


def _buckets(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(bucket, x, times): classes that share signatures. Signatures of the same classes are one bucket, ``times`` is their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sent, keys = [], []
            for text in batch.column(0):
                s = shingle_set(text.as_py(), k)
                c = class_key(s)
                if not len(s) or c in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(c)
                sent.append(signatures(s, num, den))
                keys.append(np.full(len(sent[-1]), c, np.int64))
            if sent:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sent)), pa.array(np.concatenate(keys))], names=["sig", "x"])

    same = Window.partitionBy("sig")
    sent = docs.select("text").mapInArrow(run, "sig bigint, x bigint").repartition("sig")
    shared = sent.select("sig", "x", (F.min("x").over(same) < F.max("x").over(same)).alias("shared")).where("shared").dropDuplicates(["sig", "x"])
    named = shared.select("x", F.xxhash64(F.expr("bit_xor(xxhash64(x))").over(same), F.count(F.lit(1)).over(same)).alias("bucket"))
    return named.groupBy("bucket", "x").agg(F.count(F.lit(1)).alias("times"))


def _texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, text) of the ``rows`` asked for, once each, and of few others: a map of ``MAP_BITS`` bits drops most of the rest before
    texts are shuffled. The more rows are asked for, the less it drops."""
    at = F.pmod(F.xxhash64("row"), F.lit(MAP_BITS)) + 1
    maps = (rows.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = docs.join(F.broadcast(maps), F.bitmap_bucket_number(at) == F.col("part")).where(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1)
    return marked.select("row", "text").dropDuplicates(["row"])


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(x, tokens): whole sets of the ``wanted`` classes (x). ``classes`` names one ``row`` of each class, whose text is fetched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(text.as_py(), k) for text in batch.column(1)], pa.list_(pa.int64()))],
                                             names=["x", "tokens"])

    rows = classes.join(wanted, F.col("c") == F.col("x"), "left_semi").select("row", F.col("c").alias("x"))
    return _texts(docs, rows).join(rows, "row").select("x", "text").mapInArrow(run, "x bigint, tokens array<bigint>")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("x")).union(pairs.select(F.col("b").alias("x"))).distinct()


def _of(sets: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """The sets of the documents in ``pairs``: joins then deal out these alone, and hot ones can be split."""
    return sets.join(_ends(pairs), "x", "left_semi").select("x", *columns)


def _apart(left: str, right: str) -> Column:
    """Tokens that one of two sets has and the other has not, at least, by their sketches."""
    l, r = F.col(left), F.col(right)
    half = lambda s: F.zip_with(F.slice(s, F.lit(1), (F.size(s) / 2).cast("int")), F.slice(s, (F.size(s) / 2).cast("int") + 1, (F.size(s) / 2).cast("int")),
                                lambda p, q: p.bitwiseXOR(q))
    bits = lambda p, q: F.aggregate(F.zip_with(p, q, lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), lambda v, w: v + w)
    return (F.when(F.size(l) == F.size(r), bits(l, r)).when(F.size(l) == 2 * F.size(r), bits(half(l), r))
            .when(2 * F.size(l) == F.size(r), bits(l, half(r))).otherwise(F.lit(0)))


def _may_link(left: str, right: str, num: int, den: int) -> Column:
    """Whether sizes ``n`` and sketches of two sets allow a link."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    return ((den * F.least(n, m) >= num * F.greatest(n, m))
            & ((num + den) * _apart(f"{left}.sketch", f"{right}.sketch") <= (den - num) * (n + m)))


def _likely(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, ..) whose sizes and sketches allow a link."""
    own = _of(classes.withColumnRenamed("c", "x"), pairs, ["n", "sketch"])
    columns = pairs.columns
    for side in ("a", "b"):
        pairs = pairs.join(own.select(F.col("x").alias(side), F.struct("n", "sketch").alias(f"_{side}")), side)
    return pairs.where(_may_link("_a", "_b", num, den)).select(*columns)


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    sets = _of(sets, pairs, ["tokens"])
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("x").alias(side), F.col("tokens").alias(f"{side}t")), side)
    shared = F.size(F.array_intersect("at", "bt"))
    return pairs.where((num + den) * shared >= num * (F.size("at") + F.size("bt"))).select("a", "b")


def _edits_from_centre(members: DataFrame, sets: DataFrame, level: int, num: int, den: int, keep: Scratch) -> DataFrame:
    """Of all members (hub, x) of a group the signed ``edits`` from the group's centre, the tokens that over half of it hold, by
    ``CENTRE`` members about; their weight ``g`` and the ``slack`` of the centre; also ``nearest``, the member with the smallest g, and ``g0``, that g."""
    own = keep.cut(sets.join(members.select("x").distinct(), "x", "left_semi"), "jaccard-own")
    size = keep.cut(members.groupBy("hub").agg(F.count(F.lit(1)).alias("size")), "jaccard-group-sizes")
    asked = members.join(size, "hub").where((F.col("size") <= CENTRE) | (F.pmod(F.xxhash64("x", F.lit(level)), F.col("size")) < CENTRE))
    asked = keep.cut(asked.select("hub", "x"), "jaccard-asked")
    common = asked.join(own, "x").select("hub", F.explode("tokens").alias("t")).groupBy("hub", "t").agg(F.count(F.lit(1)).alias("many"))
    voices = asked.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    centres = common.join(voices, "hub").where("2 * many > size").groupBy("hub").agg(F.collect_list("t").alias("centre"))
    both = members.join(own, "x").join(keep.cut(centres, "jaccard-centres"), "hub", "left")
    centre = F.coalesce("centre", F.array().cast("array<bigint>"))
    gone, new = F.array_except(centre, "tokens"), F.array_except("tokens", centre)
    both = both.select("hub", "x", (F.lit(den - num) * F.size(centre)).alias("slack"), gone.alias("gone"), new.alias("new"))
    edits = F.concat(F.transform("gone", lambda t: F.xxhash64(t, F.lit(1))), F.transform("new", lambda t: F.xxhash64(t, F.lit(2))))
    both = keep.cut(both.select("hub", "x", "slack", (den * F.size("gone") + num * F.size("new")).alias("g"), edits.alias("edits")), "jaccard-edits")
    first = both.groupBy("hub").agg(F.min(F.struct("g", "x")).alias("m")).select("hub", F.col("m.x").alias("nearest"), F.col("m.g").alias("g0"))
    return both.join(first, "hub").select("hub", "x", "g", "slack", "edits", "nearest", "g0")


def _edit_buckets(edits: DataFrame, num: int, den: int, keep: Scratch) -> DataFrame:
    """(bucket, hub, x, g, slack, rest): members of a group by the prefixes of their edits that others of it, of another component, share;
    ``rest`` is the number of such edits from this one on, a bound on those shared with a document whose first common edit this is."""
    each = edits.select("hub", "x", "label", F.explode("edits").alias("edit"))
    shared = each.groupBy("hub", "edit").agg(F.count(F.lit(1)).alias("many"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    shared = keep.cut(shared.where("lo < hi").select("hub", "edit", "many"), "jaccard-shared-edits")
    lists = each.drop("label").join(shared, ["hub", "edit"]).groupBy("hub", "x").agg(F.array_sort(F.collect_set(F.struct("many", "edit"))).alias("own"))
    lists = lists.join(edits.select("hub", "x", "g", "slack", "g0"), ["hub", "x"])
    # pairs with g + g <= slack are linked through the nearest; others share an edit, and so many at least
    least = F.greatest(F.ceil((F.col("g") + F.col("g0") - F.col("slack")) / F.lit(num + den)), F.lit(1))
    prefix = F.slice("own", F.lit(1), F.greatest(F.size("own") - least + 1, F.lit(0)).cast("int"))  # behind the edits that nobody in another component has
    rows = lists.select("hub", "x", "g", "slack", F.size("own").alias("many"), F.posexplode(prefix).alias("i", "s"))
    rows = keep.cut(rows.select(F.xxhash64("hub", "s.edit").alias("bucket"), "hub", "x", "g", "slack", (F.col("many") - F.col("i")).alias("rest")), "jaccard-edit-buckets")
    # a document stays in a bucket if, by the least weight and the most edits left there, it may be linked to one in it
    best = rows.groupBy("bucket").agg(F.min("g").alias("g1"), F.max("rest").alias("rest1"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return rows.join(best, "bucket").where((num + den) * F.least("rest", "rest1") >= F.col("g") + F.col("g1") - F.col("slack")).select(*rows.columns)


def _linked_by_edits(pairs: DataFrame, edits: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (hub, a, b) that reach the threshold, as (a, b)."""
    for side in ("a", "b"):
        own = edits.select("hub", F.col("x").alias(side), F.col("g").alias(f"{side}g"), F.col("edits").alias(f"{side}e"), "slack")
        pairs = pairs.join(own if side == "a" else own.drop("slack"), ["hub", side])
    shared = F.size(F.array_intersect("ae", "be"))
    return pairs.where((num + den) * shared >= F.col("ag") + F.col("bg") - F.col("slack")).select("a", "b")


def _pairs(members: DataFrame, carry: list[str], condition: Column) -> DataFrame:
    """Distinct (a, b) of one bucket, a < b, in different components so far and fit by ``condition`` on l and r."""
    left, right = members.alias("l"), members.alias("r")
    on = F.expr("l.bucket = r.bucket and l.x < r.x and l.label <> r.label") & condition
    return left.join(right, on).select(*[F.col(f"l.{c}").alias(c) for c in carry], F.col("l.x").alias("a"), F.col("r.x").alias("b")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, F.col("x") == F.col("node"), "left").select(*rows.columns, F.coalesce("component", "x").alias("label"))


def _still_open(rows: DataFrame, keep: Scratch) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that span components: of small buckets, and of larger ones."""
    sized = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    rows = rows.join(keep.cut(sized.where("lo < hi").select("bucket", "size"), "jaccard-sizes"), "bucket")
    return rows.where(F.col("size") <= SMALL), rows.where(F.col("size") > SMALL)


def _links(docs: DataFrame, buckets: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b) links whose components are those of all links between different sets."""
    keep = Scratch()
    sized = keep.cut(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "jaccard-bucket-sizes")
    weights = keep.cut(buckets.join(sized, "bucket").groupBy("x").agg(F.sum(F.col("times") * F.col("size")).alias("weight")), "jaccard-weights")
    hubs = buckets.join(weights, "x").groupBy("bucket").agg(F.max(F.struct("weight", "x")).alias("m"))
    hubs = keep.cut(hubs.select("bucket", F.col("m.x").alias("hub")), "jaccard-hubs")
    members = keep.cut(buckets.select("bucket", "x").join(hubs, "bucket"), "jaccard-members")
    pairs = keep.cut(members.where("x <> hub").select(F.least("x", "hub").alias("a"), F.greatest("x", "hub").alias("b")).distinct(), "jaccard-pairs")
    likely = keep.cut(_likely(pairs, classes, num, den), "jaccard-likely")
    sets = keep.cut(_sets(docs, classes, _ends(likely), k), "jaccard-sets")
    links = keep.cut(_linked(likely, sets, num, den), "jaccard-links")

    few, many = _still_open(keep.cut(_labelled(members, keep.cut(components(links), "jaccard-labels")), "jaccard-open"), keep)
    own = classes.select(F.col("c").alias("x"), "n", "sketch")
    few = keep.cut(few.select("bucket", "x", "label").join(own, "x"), "jaccard-few")
    pairs = keep.cut(_pairs(few, [], _may_link("l", "r", num, den)), "jaccard-pairs")
    groups = keep.cut(many.select("bucket", "hub", "x"), "jaccard-many")
    sets = keep.cut(_sets(docs, classes, _ends(pairs).union(groups.select("x")).distinct(), k), "jaccard-sets")
    links = keep.cut(links.union(_linked(pairs, sets, num, den)), "jaccard-links")
    keep.free(links, sets, groups)
    level, groups = 0, groups.select("hub", "x")
    while not groups.isEmpty():
        compared = keep.cut(groups.distinct(), "jaccard-groups")
        edits = keep.cut(_edits_from_centre(compared, sets, level, num, den, keep), "jaccard-edits")
        found = edits.where("g + g0 <= slack and x <> nearest").select(F.col("nearest").alias("a"), F.col("x").alias("b"))
        links = keep.cut(links.union(found), "jaccard-links")
        labels = keep.cut(components(links), "jaccard-labels")
        spans = (_labelled(edits.select("hub", "x"), labels).groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo < hi").select("hub"))
        near = keep.cut(_labelled(edits.join(spans, "hub"), labels), "jaccard-near")
        by_edit = keep.cut(_labelled(_edit_buckets(near, num, den, keep), labels), "jaccard-edit-buckets")
        few, many = _still_open(by_edit, keep)
        fit = F.expr(f"{num + den} * least(l.rest, r.rest) >= l.g + r.g - l.slack")
        pairs = keep.cut(_likely(keep.cut(_pairs(few, ["hub"], fit), "jaccard-pairs"), classes, num, den), "jaccard-likely")
        links = keep.cut(links.union(_linked_by_edits(pairs, near, num, den)), "jaccard-links")
        # buckets of the same members are one group
        named = many.groupBy("bucket").agg(F.xxhash64(F.expr("bit_xor(xxhash64(x))"), F.count(F.lit(1))).alias("group"))
        groups = keep.cut(many.select("bucket", "x").join(named, "bucket").select(F.col("group").alias("hub"), "x"), "jaccard-many")
        keep.free(links, sets, groups)
        level += 1
    return links


def _row(ids: Column, text: Column) -> Column:
    """Names a row by its id and text: rows equal in both are one, other rows of a repeated id (null too) are not."""
    return F.xxhash64(ids, F.coalesce(text, F.lit("")))


def _smallest_ids(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, component): smallest id of each class's component. The classes of one component are dealt into ``SALTS`` parts, so
    a component of any share of them does not meet in one task."""
    linked = classes.join(labels, F.col("c") == F.col("node")).select("c", "x", F.col("component").alias("label"), F.pmod("c", F.lit(SALTS)).alias("salt"))
    parts = cut(linked.groupBy("label", "salt").agg(F.min("x").alias("m")), "jaccard-parts")
    least = parts.groupBy("label").agg(F.min("m").alias("component"))
    found = linked.join(parts.join(least, "label").select("label", "salt", "component"), ["label", "salt"])
    return classes.join(found.select("c", "component"), "c", "left").select("c", F.coalesce("component", "x").alias("component"))


def _judged(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """(id, row, n, component) of each row; null ids are ``NO_ID``, rows with empty sets have no component. Classes are the
    nodes of the links, so different texts of one id are nodes of their own; ids come in when components are final."""
    ship(docs.sparkSession)
    ids: Column = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    plain = docs.select(ids.alias("id"), _row(ids, F.col(text_col)).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    narrow = cut(_narrow(plain, k), "jaccard-narrow")
    classes = cut(narrow.where("n > 0").groupBy("c").agg(F.min("id").alias("x"), F.min("row").alias("row"), F.max("n").alias("n"),
                                                         F.max("sketch").alias("sketch")), "jaccard-classes")
    keep = Scratch()
    buckets = keep.cut(_buckets(plain, k, num, den), "jaccard-buckets")
    found = cut(_smallest_ids(classes.select("c", "x"), components(_links(plain, buckets, classes.drop("x"), k, num, den))), "jaccard-components")
    keep.free()
    return narrow.join(found, "c", "left").select("id", "row", "n", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``: smallest id reachable by links, its own included.

    Rows link when den * intersection >= num * union of their shingle sets (``k`` words each). Null texts and texts without
    words have empty sets and are linked with nothing, not with each other. Rows that repeat an id are rows of their own
    with one id. A null id counts as larger than any other; a component of null ids only has a null ``component_id``.
    No rows give no rows; further columns are ignored, whatever their names. Shingles and sets are told apart by 64-bit
    hashes.
    """
    rows = _judged(docs, id_col, text_col, k, num, den)
    kind = docs.schema[id_col].dataType.simpleString()
    own = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).cast(kind)
    return rows.select(own("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.when(F.col("n") > 0, own("component")).otherwise(own("id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns; rows with empty sets stay.
    Rows of a repeated id (null too) are judged one by one, each by its own text."""
    rows = _judged(docs, id_col, text_col, k, num, den)
    gone = rows.where("n > 0 and id <> component").select(F.col("id").alias("_gone"), F.col("row").alias("_row")).distinct()
    gone = cut(gone, "jaccard-gone")  # a table of known size: small ones are broadcast, others joined by shuffle
    ids: Column = F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID))
    return docs.join(gone, (ids == gone["_gone"]) & (_row(ids, docs[text_col]) == gone["_row"]), "left_anti")
