"""Helpers shared by the operators: word pattern, lineage cuts, skew-safe class minima, components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.session import checkpoint_root, scratch_path

#: A word is a maximal run of characters outside the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Parts that the rows of one key are dealt into before they are combined.
SALTS = 64


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors' Python workers, once per context, as a zip on Spark's file server."""
    sc = spark.sparkContext
    if getattr(sc, "_rillflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="rillflow-py-"), "rillflow.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._rillflow_shipped = True


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends in files all executors see."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written by ``cut`` that are deleted together, once what was derived from them is itself a table."""

    def __init__(self) -> None:
        self._tables: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def free(self, *but: DataFrame) -> None:
        """Deletes all tables but the named ones, which stay for the next time."""
        kept = [(df, path) for df, path in self._tables if any(df is b for b in but)]
        for df, path in self._tables:
            if not any(df is b for b in but):
                where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
        self._tables = kept


def reliable(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder; the files go when the frame is no longer referenced."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exactly(name: str) -> Column:
    """The column of just this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def class_minimum(rows: DataFrame, keys: list[str], id_col: str, out: str = "class_min",
                  salts: int = SALTS) -> DataFrame:
    """Each row of ``rows`` with the smallest id of its key class and the class size.

    A key may hold any share of the rows: rows are combined per (key, salt) first, the salt winners per key
    next, and rows find their class again through (key, salt), so no task sees more than a salt's share.
    Null keys form one class; the smallest id ignores null ids. Adds ``out`` and ``<out>_size``.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
    locally = salted.groupBy(*keys, "_salt").agg(F.min(id_col).alias("_m"), F.count(F.lit(1)).alias("_n"))
    globally = locally.groupBy(*keys).agg(F.min("_m").alias(out), F.sum("_n").alias(f"{out}_size"))
    g = globally.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], out, f"{out}_size")
    on = [locally[k].eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    winners = locally.join(g, _all(on)).select(
        *[locally[k].alias(f"_w{i}") for i, k in enumerate(keys)], F.col("_salt").alias("_ws"), out, f"{out}_size")
    on = [salted[k].eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(keys)]
    joined = salted.join(winners, _all([*on, salted["_salt"] == F.col("_ws")]))
    return joined.select(*[salted[c] for c in rows.columns], out, f"{out}_size")


def _all(conditions: list[Column]) -> Column:
    first, *rest = conditions
    for c in rest:
        first = first & c
    return first


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is its smallest reachable node.

    Large-star/small-star contraction: each round replaces links by links to smaller neighbours until
    every node points at its component's minimum; hubs are combined by partial minima, never collected.
    """
    edges = reliable(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = reliable(small.select("e.u", "e.v").where("u <> v").distinct())
        edges, was = after, seen
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == was:
            break
    else:
        raise RuntimeError("component contraction did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
