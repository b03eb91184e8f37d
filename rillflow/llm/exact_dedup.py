"""Exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when identical after each run of ASCII blanks becomes one space. Rows are combined in three
steps, each comparing the full normalised text: within a scan task (the partial aggregate keyed by digest,
salt and text), per salted digest group (its shuffle), and over the salt winners of a digest. Only hot digests,
those with over 1/``HOT_SHARE`` of all rows, are salted; there are at most ``HOT_SHARE`` of them, so the list
that marks them has a fixed bound and is broadcast. Other digests meet in one group at once, so a text is
shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, SALTS, cut, exactly

#: A digest is hot from this share of all rows on (one in so many); also the bound on hot digests.
HOT_SHARE = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256_digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def dedup_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest,
                  salts: int = SALTS) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    * null text counts as empty; empty texts are equal to each other
    * the smallest id of a class stays; rows that repeat both id and text are one document and all say ``kept``
    * a null id never beats another id; in a class of null ids only, ``keep_id`` is null and ``kept`` is true
    * an empty table gives no rows; further columns of ``docs`` are ignored, whatever their names
    * ``digest`` may collide: equality is always decided on the text, the digest only deals out the rows
    """
    base = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_norm"))
    keyed = base.withColumn("_dig", digest(F.col("_norm")))
    narrow = cut(keyed.select("_id", "_dig", F.sha2("_norm", 256).alias("_sha")), "dedup-digests")
    counts = narrow.groupBy("_dig").count()
    least = max(narrow.count() / HOT_SHARE, 1.0)
    hot = cut(counts.where(F.col("count") > least).select("_dig", F.lit(True).alias("_hot")), "dedup-hot")  # HOT_SHARE rows at most

    def salted(df: DataFrame) -> DataFrame:
        # any number deals out a hot digest: what its winners say is given to every salt, so null and repeated ids spread too
        salt = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0).cast("long"))
        return df.join(F.broadcast(hot), "_dig", "left").withColumn("_salt", salt)

    won = (salted(keyed).groupBy("_dig", "_salt", "_hot", "_norm")
           .agg(F.min("_id").alias("_m"), F.count(F.lit(1)).alias("_n"))
           .withColumn("_sha", F.sha2("_norm", 256)))
    cold = won.where("_hot is null").select("_dig", "_salt", "_sha", F.col("_m").alias("keep_id"), F.col("_n").alias("group_size"))
    salt_winners = cut(won.where("_hot"), "dedup-salt-winners")  # at most HOT_SHARE * salts rows beyond collisions
    over = (salt_winners.groupBy("_dig", "_norm")
            .agg(F.min("_m").alias("keep_id"), F.sum("_n").alias("group_size")))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    warm = over.select("_dig", F.explode(every).alias("_salt"), F.sha2("_norm", 256).alias("_sha"), "keep_id", "group_size")
    classes = cold.union(warm)
    rows = salted(narrow)
    return rows.join(classes, ["_dig", "_salt", "_sha"]).select(
        F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no row with a smaller id has, with all their columns.

    Rows that repeat id and text go with their first: one row stays. Null texts count as empty, a null id stays where its
    text has no other; of equal texts with ids that tie one row stays; whole texts are compared. An empty table gives no
    rows. Columns of any name are kept as they are.
    """
    kept = dedup_classes(docs, id_col, text_col).where("kept")
    ids = kept.groupBy(F.col(id_col).alias("_kid"), F.col("text_sha256").alias("_ksha")).agg(F.count(F.lit(1)).alias("_rows"))
    ids = cut(ids, "dedup-kept")
    sha = F.sha2(normalised(docs[text_col]), 256)

    def rows(which: DataFrame) -> DataFrame:
        return docs.join(which, docs[id_col].eqNullSafe(which["_kid"]) & (sha == which["_ksha"]), "left_semi")

    once, again = rows(ids.where("_rows = 1")), rows(ids.where("_rows > 1"))
    row = F.struct(*[exactly(c) for c in docs.columns])
    first = again.select(row.alias("_row"), F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_t"))
    return once.union(first.dropDuplicates(["_id", "_t"]).select("_row.*"))
