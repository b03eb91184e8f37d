"""Session construction and shared-folder resolution.

The confs set here are the ones the library's semantics depend on:

* ``spark.sql.session.timeZone=UTC``: readings are naive wall-clock times, and date
  normalisation renders UTC.
* ``spark.sql.mapKeyDedupPolicy=LAST_WIN``: a header that repeats a column name keeps
  the last cell, as a Python dict built left to right does.
* ``spark.sql.variant.allowDuplicateKeys=true``: duplicate JSON object keys keep the last
  value instead of failing the parse.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

REQUIRED_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

TUNING_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # many small whole-file JSON documents: pack them into fewer scan tasks
    "spark.sql.files.openCostInBytes": str(1 << 20),
    # exploding documents multiplies rows after a shuffle of compact records; keep more
    # post-shuffle partitions than byte size alone would suggest
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 10),
    # explicit file lists up to this length are stat-ed by the driver; longer lists still
    # get a parallel listing job (the default threshold of 32 paths launches one per batch)
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1024",
}

# Spark lists a folder's subfolders with a task each, up to 10,000 of them; a task costs far more than a listing, so
# they are dealt to a few tasks a core, no fewer than LEAST_LISTING_TASKS. A session's own setting stays.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
SPARKS_LISTING_TASKS = "10000"
LISTING_TASKS_A_CORE, LEAST_LISTING_TASKS = 4, 64


def apply_confs(spark: SparkSession) -> SparkSession:
    """Set the semantic confs, and the bound on listing tasks, on an existing session (runtime-settable SQL confs)."""
    for key, value in REQUIRED_CONFS.items():
        spark.conf.set(key, value)
    if spark.conf.get(LISTING_TASKS) == SPARKS_LISTING_TASKS:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(LISTING_TASKS, str(max(LEAST_LISTING_TASKS, LISTING_TASKS_A_CORE * cores)))
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "rillflow",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    confs = {**REQUIRED_CONFS, **TUNING_CONFS,
             "spark.sql.shuffle.partitions": str(shuffle_partitions),
             "spark.ui.enabled": "false",
             "spark.driver.memory": "8g"}
    confs.update(extra or {})
    for key, value in confs.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_confs(spark)


def empty_frame(spark: SparkSession, ddl: str):
    """An empty frame of a DDL schema, built on the JVM (no Python worker round trip)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(ddl)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def literal_rows(spark: SparkSession, ddl: str, rows: list[tuple]):
    """A small frame of literal rows, built on the JVM (no Python worker round trip)."""
    from functools import reduce
    from pyspark.sql import functions as F
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(ddl)
    frames = [spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
              for row in rows]
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else empty_frame(spark, ddl)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Taken from ``spark.checkpoint.dir`` as the cluster names it. Only when the session has
    none (local tests) a folder is chosen here and registered with the context; on a cluster that is an error, as
    executors share no local folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.get("RILLFLOW_CHECKPOINT_DIR") or f"/tmp/rillflow-checkpoints-{os.getpid()}"
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"
