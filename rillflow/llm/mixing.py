"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; every document of a source expects target / source size copies.
Expected copies are prefix-summed within the source, one random offset per source is added, and a document is
emitted once per integer boundary its interval crosses. The prefix sum runs in three levels of bounded windows
(size classes of a source, hash buckets of a class, rows of a bucket), so a source that holds most rows is spread
over many tasks. Documents are ordered by size within a source: neighbours are alike in size, which keeps the
words taken close to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, exactly

#: Fixed by the contract: weights of the sources in code-point order, repeating; the share of all words to take;
#: the most copies of one document, also of a source's size.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Expected copies are summed as whole multiples of 1 / UNIT, so the order of summation cannot change a result.
UNIT = 1 << 24
BUCKETS = 256
#: Columns that ``mix`` adds.
ADDED = ("copies", "size", "source_size", "target")
SEED = 20240607


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> adds ``target``: ``share`` of all words dealt by weight, at most ``most`` times a
    source's size; what exceeds that goes to the others by weight until none is above.

    Sources sorted by cap / weight reach their caps in that order, so the common level is found in one pass. One row
    per source passes the two windows. A source without words has target 0.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    s = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    s = s.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    whole = Window.partitionBy(F.lit(1))
    order = [F.col("_cap") / F.col("_w"), F.asc_nulls_last("source")]
    before = Window.partitionBy(F.lit(1)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(F.lit(1)).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    goal = F.lit(float(share)) * F.sum("source_size").over(whole)
    s = s.withColumn("_level", (goal - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest))
    # the level rises with each source that is capped and falls from the first that is not
    target = F.least(F.col("_cap"), F.max("_level").over(whole) * F.col("_w"))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, wide: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``copies`` (0 or more), ``size``, ``source_size``, ``target``.

    ``wide`` keeps the columns of ``docs``, else only the id. Null text has size 0; null is a source of its own,
    sorted last; documents without words take part and cost nothing. Rows that repeat are separate documents.
    The draw depends on seed, ids and texts alone, so reruns agree; documents alike in size are ordered by a hash of
    id and text, then by id. Whole texts are counted, however long. An empty table gives no rows. Columns of ``docs``
    named like the added ones are replaced, all others keep their names and values. Rows equal in id and text (and null
    ids with one text) stand in one bucket: a third of all rows of that kind is one task's work, which the window sorts
    and spills; distinct ids are spread.
    """
    plain = docs.select(*[exactly(c) for c in docs.columns if c not in ADDED])
    # the caller's columns travel as one struct, so that no name of theirs meets one of these
    sized = plain.select(
        F.struct(*[exactly(c) for c in (plain.columns if wide else [id_col])]).alias("_row"), F.col(id_col).alias("_id"), F.col(source_col).alias("_src"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_h"))
    sized = (sized.withColumn("_class", F.floor(F.log2(F.col("size") + 1) * 128).cast("int"))
             .withColumn("_bucket", F.pmod(F.shiftrightunsigned("_h", 20), F.lit(BUCKETS)).cast("int")))
    buckets = cut(sized.groupBy("_src", "_class", "_bucket").agg(F.count(F.lit(1)).alias("_rows"), F.sum("size").alias("_size")),
                  "mix-buckets")
    sizes = buckets.groupBy(F.col("_src").alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = targets.select(F.col("source").alias("_s"), "source_size", "target", F.round(rate * UNIT).cast("long").alias("_e"),
                           F.pmod(F.xxhash64(F.lit(seed), F.lit("offset"), F.col("source")), F.lit(UNIT)).alias("_u"))

    def sum_before(by: list[str], order: str) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_rows").over(w), F.lit(0))

    classes = buckets.groupBy("_src", "_class").agg(F.sum("_rows").alias("_rows"))
    classes = classes.withColumn("_off1", sum_before(["_src"], "_class")).drop("_rows")
    level2 = buckets.withColumn("_off2", sum_before(["_src", "_class"], "_bucket"))
    level2 = level2.join(classes.select(F.col("_src").alias("_s2"), F.col("_class").alias("_c2"), "_off1"),
                         F.col("_src").eqNullSafe(F.col("_s2")) & (F.col("_class") == F.col("_c2")))
    # every document of a source expects the same copies, so sums of expected copies are row counts times the rate
    offsets = cut(level2.join(rates, F.col("_src").eqNullSafe(F.col("_s"))).select(
        F.col("_src").alias("_os"), F.col("_class").alias("_oc"), F.col("_bucket").alias("_ob"),
        ((F.col("_off1") + F.col("_off2")) * F.col("_e")).alias("_before"), "_e", "_u", "source_size", "target"), "mix-offsets")
    inside = Window.partitionBy("_src", "_class", "_bucket").orderBy("size", "_h", "_id")
    ranked = sized.withColumn("_rank", F.row_number().over(inside))
    placed = ranked.join(offsets, F.col("_src").eqNullSafe(F.col("_os")) & (F.col("_class") == F.col("_oc"))
                         & (F.col("_bucket") == F.col("_ob")))
    end = F.col("_before") + F.col("_rank") * F.col("_e") + F.col("_u")
    unit = UNIT.bit_length() - 1
    copies = F.shiftright(end, unit) - F.shiftright(end - F.col("_e"), unit)  # whole-number floors, exact for any sum
    return placed.select("_row.*", copies.cast("long").alias("copies"), "size", "source_size", "target")


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy, without the columns that ``mix`` adds; other columns keep their names, whatever these are."""
    rest = F.struct(*[exactly(c) for c in mixed.columns if c not in ADDED])
    return mixed.select(F.explode(F.array_repeat(rest, F.col("copies").cast("int"))).alias("_row")).select("_row.*")
