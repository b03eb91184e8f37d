"""Keyed, repeatable record stores.

A store is a folder of Parquet versions ``id, run_id, source_file, ingested_at, saved_at, payload_json`` in one partition
per write, bucketed by ``id``. Readers see the newest version of every id:

* insert mode (K5): a write holds only ids that no earlier write holds; inside a batch the first record of an id wins;
* upsert mode (K6/K7): a write holds every id of its batch; the latest write wins, inside a batch the last record.

**Writes repeat safely.** A write is known by a key (its run id and save time unless the caller names one) and has a
number, one above the highest so far. Both are partition columns, and a write replaces its own partition: a job that is
run again, or was cut off between its data and its log row, finds its partition by the key, takes the same number and
leaves the same rows and counts. Which version is newest is decided by write numbers, not by clocks, so a backfill with
an older save time still supersedes what it follows.

**Versions of an id lie together.** The folder is read as a bucketed table: finding the newest version, probing which ids
are stored and counting them need no shuffle of what is stored. A write shuffles its batch once, to the buckets; the
probe, the choice inside the batch and the write happen in that one stage, and its counts are metrics observed there, so
nothing that was written is read again. The number of buckets is set when a store is made (about a gigabyte a bucket).

Every write leaves one row ``run_id, saved_at, written, new_ids`` in ``<store>/_log``; the store's id count is the sum
of ``new_ids``.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions.identity import PAYLOAD_LIMIT, record_identity_from_json, stable_json, truncate_payload
from rillflow.session import empty_frame, literal_rows
from rillflow.sources.files import path_exists

STORE_COLUMNS = ["id", "run_id", "source_file", "ingested_at", "saved_at", "payload_json"]
ORDER_COLUMNS = ["write_no", "write_key", "_file_ord", "_rec_ord"]
DATA_SCHEMA = ("id string, run_id string, source_file string, ingested_at timestamp_ntz, saved_at timestamp_ntz, "
               "payload_json string, _file_ord string, _rec_ord bigint")
STORE_SCHEMA = f"{DATA_SCHEMA}, write_no bigint, write_key string"
LOG_SCHEMA = "run_id string, saved_at timestamp_ntz, written bigint, new_ids bigint, write_no bigint, write_key string"
BUCKETS = 16


def to_store_rows(records: DataFrame, run_id: str, saved_at: dt.datetime, truncate: int | None = None) -> DataFrame:
    """Records -> store rows; ``_file_ord, _rec_ord`` order the records inside the batch (file, then record)."""
    canon = records.withColumn("_canon", F.to_json("payload"))
    payload = truncate_payload(F.col("_canon"), truncate) if truncate else F.col("_canon")
    return canon.select(
        record_identity_from_json(stable_json(F.col("payload"), F.col("_canon")), F.col("_source_file")).alias("id"),
        F.lit(run_id).alias("run_id"),
        F.coalesce(F.col("_source_file"), F.lit("")).alias("source_file"),
        F.col("_ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        F.lit(saved_at).cast("timestamp_ntz").alias("saved_at"),
        payload.alias("payload_json"),
        F.col("_file_ord").cast("string").alias("_file_ord"),
        F.col("_rec_ord").cast("long").alias("_rec_ord"))


# ---------------------------------------------------------------- the folder as a bucketed table
def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hpath)


def _glob(spark: SparkSession, path: str, pattern: str) -> list[str]:
    fs, at = _hadoop(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, pattern)) or []
    return [st.getPath().toUri().getPath() for st in found]


def _buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a store was made with, None where there is no store."""
    marks = _glob(spark, path, "_store/buckets-*")
    return int(marks[0].rsplit("-", 1)[1]) if marks else None


def create(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Makes an empty store; an existing one stays as it is."""
    if _buckets(spark, path) is None:
        fs, at = _hadoop(spark, path)
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, f"_store/buckets-{buckets}"), False).close()


def _table(spark: SparkSession, path: str, sync: bool = True) -> str | None:
    """The session's table over a store folder, with the partitions that are there now (``sync``; a write adds its own and
    needs no others); None where there is no store."""
    n = _buckets(spark, path)
    if n is None:
        return None
    at = _hadoop(spark, path)[1].toString()
    name = f"rillflow_store_{hashlib.sha256(f'{at}|{n}'.encode()).hexdigest()[:24]}"
    location = at.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({STORE_SCHEMA}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
              f"PARTITIONED BY (write_no, write_key) CLUSTERED BY (id) INTO {n} BUCKETS LOCATION '{location}'")
    if sync:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
    return name


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a store; their rows of one id lie in one bucket."""
    name = _table(spark, path)
    return spark.table(name) if name else empty_frame(spark, STORE_SCHEMA)


def _writes(spark: SparkSession, path: str) -> dict[str, int]:
    """key -> number of the writes that left rows (one folder each)."""
    found = (p.rsplit("/", 2)[1:] for p in _glob(spark, path, "write_no=*/write_key=*"))
    return {key.split("=", 1)[1]: int(no.split("=", 1)[1]) for no, key in found}


def _write_of(spark: SparkSession, path: str, run_id: str, saved_at: dt.datetime, key: str | None) -> tuple[int, str]:
    """(number, key) of a write: those it has if it left rows before, else the next number."""
    text = key if key is not None else f"{run_id}\n{saved_at.isoformat()}"
    hashed = hashlib.sha256(text.encode()).hexdigest()[:24]
    writes = _writes(spark, path)
    return writes.get(hashed, 1 + max(writes.values(), default=0)), hashed


# ---------------------------------------------------------------- reading
def latest(versions: DataFrame) -> DataFrame:
    """The newest version of every id. Rows of an id lie together in a store, so this sorts but does not shuffle."""
    newest = Window.partitionBy("id").orderBy(*[F.desc(c) for c in ORDER_COLUMNS])
    return versions.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") == 1).drop("_place")


def current(spark: SparkSession, path: str, saved_since: dt.datetime | None = None) -> DataFrame:
    """The store as of now: the newest version of every id, optionally only those saved since a time.

    With ``saved_since`` only writes from the first one on that holds such a version are read (whole partitions are left
    out): an id whose newest version is older than that write was last saved before the time.
    """
    versions = read_versions(spark, path)
    if saved_since is None:
        return latest(versions)
    recent = F.col("saved_at") >= F.lit(saved_since).cast("timestamp_ntz")
    first = versions.where(recent).agg(F.min("write_no")).first()[0]  # one value, from footers of constant columns
    return latest(versions.where(F.col("write_no") >= F.lit(first).cast("long"))).where(recent)


def _earlier(spark: SparkSession, path: str, no: int, key: str) -> DataFrame:
    versions = read_versions(spark, path)
    return versions.where((F.col("write_no") < no) | ((F.col("write_no") == no) & (F.col("write_key") < key)))


# ---------------------------------------------------------------- writing
def _placed(spark: SparkSession, path: str, rows: DataFrame, no: int, key: str) -> DataFrame:
    """The batch's rows, dealt to the store's buckets: its one shuffle."""
    rows = rows.withColumns({"write_no": F.lit(no).cast("long"), "write_key": F.lit(key)})
    return rows.repartition(_buckets(spark, path), "id")


def _put(spark: SparkSession, path: str, rows: DataFrame) -> None:
    rows.select(*[c.split()[0] for c in STORE_SCHEMA.split(", ")]).write.mode("overwrite").insertInto(_table(spark, path, sync=False))


def _log(spark: SparkSession, path: str, run_id: str, saved_at: dt.datetime, written: int, new_ids: int, no: int, key: str) -> None:
    (literal_rows(spark, LOG_SCHEMA, [(run_id, saved_at, written, new_ids, no, key)]).coalesce(1)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("write_no", "write_key").parquet(f"{path}/_log"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, f"{path}/_log"):
        return empty_frame(spark, LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/_log")


def insert_absent(spark: SparkSession, path: str, records: DataFrame, run_id: str, saved_at: dt.datetime,
                  key: str | None = None, buckets: int = BUCKETS) -> dict:
    """K5 + J4: keep the records whose id no earlier write holds; the first record of an id in the batch wins.

    Returns ``{status, inserted, duplicates, total}`` (G10), the same ones when the write is repeated.
    """
    create(spark, path, buckets)
    no, key = _write_of(spark, path, run_id, saved_at, key)
    came, kept = Observation(), Observation()
    rows = _placed(spark, path, to_store_rows(records, run_id, saved_at), no, key).observe(came, F.count(F.lit(1)).alias("n"))
    absent = rows.join(_earlier(spark, path, no, key).select("id"), "id", "left_anti")
    first = Window.partitionBy("id").orderBy("_file_ord", "_rec_ord")
    chosen = absent.withColumn("_place", F.row_number().over(first)).where(F.col("_place") == 1)
    _put(spark, path, chosen.observe(kept, F.count(F.lit(1)).alias("n")))
    total, inserted = int(came.get["n"]), int(kept.get["n"])
    _log(spark, path, run_id, saved_at, inserted, inserted, no, key)
    return {"status": "ok", "inserted": inserted, "duplicates": total - inserted, "total": total}


def upsert(spark: SparkSession, path: str, records: DataFrame, run_id: str, saved_at: dt.datetime,
           truncate: int | None = None, key: str | None = None, buckets: int = BUCKETS) -> dict:
    """K6 (+K7 with ``truncate``): every id of the batch gets a new version, its last record in the batch.

    Returns ``{status, written, table_count}`` (G9, G10): records written, ids in the store; the same ones when the write
    is repeated.
    """
    create(spark, path, buckets)
    no, key = _write_of(spark, path, run_id, saved_at, key)
    came, kept = Observation(), Observation()
    rows = _placed(spark, path, to_store_rows(records, run_id, saved_at, truncate), no, key)
    rows = rows.observe(came, F.count(F.lit(1)).alias("n"))
    last = Window.partitionBy("id").orderBy(F.desc("_file_ord"), F.desc("_rec_ord"))
    chosen = rows.withColumn("_place", F.row_number().over(last)).where(F.col("_place") == 1)
    known = _earlier(spark, path, no, key).select("id").distinct().withColumn("_known", F.lit(True))
    marked = chosen.join(known, "id", "left").observe(kept, F.count_if(F.col("_known").isNull()).alias("n"))
    _put(spark, path, marked)
    written = int(came.get["n"])
    _log(spark, path, run_id, saved_at, written, int(kept.get["n"]), no, key)
    return {"status": "ok", "written": written, "table_count": table_count(spark, path)}


def upsert_truncated(spark: SparkSession, path: str, records: DataFrame, run_id: str, saved_at: dt.datetime,
                     key: str | None = None) -> dict:
    """K7: upsert keeping at most 30,000 characters of payload (may leave invalid JSON)."""
    return upsert(spark, path, records, run_id, saved_at, truncate=PAYLOAD_LIMIT, key=key)


# ---------------------------------------------------------------- counts and upkeep
def table_count(spark: SparkSession, path: str) -> int:
    """Ids in the store, the sum of ``new_ids`` over the write log.

    A write replaces its rows first and its log row second; where a write left rows but no log row (its job ended between
    the two and was not run again), ids are counted over the versions instead.
    """
    log = read_log(spark, path)
    got = log.agg(F.coalesce(F.sum("new_ids"), F.lit(0)).alias("n"), F.collect_set("write_key").alias("keys")).first()
    if set(_writes(spark, path)) <= set(got["keys"]):  # one key per write
        return int(got["n"])
    return exact_table_count(spark, path)


def exact_table_count(spark: SparkSession, path: str) -> int:
    """Distinct ids over all versions: a scan of ids without shuffle, used when the write log is incomplete."""
    return read_versions(spark, path).select("id").distinct().count()


def write_stats(spark: SparkSession, path: str, run_id: str, saved_at: dt.datetime) -> DataFrame:
    """G9 + G10 as a frame: rows written by one run and the store's id count (from the write log)."""
    log = read_log(spark, path)
    mine = (F.col("run_id") == run_id) & (F.col("saved_at") == F.lit(saved_at).cast("timestamp_ntz"))
    return log.agg(F.coalesce(F.sum(F.when(mine, F.col("written"))), F.lit(0)).cast("long").alias("written"),
                   F.coalesce(F.sum("new_ids"), F.lit(0)).cast("long").alias("table_count"))


def compact(spark: SparkSession, path: str, new_path: str, buckets: int | None = None) -> str:
    """Write the current view to a new store (one version per id, one write) and return its folder."""
    if _buckets(spark, new_path) is not None:
        raise ValueError(f"{new_path} holds a store already")
    create(spark, new_path, buckets or _buckets(spark, path) or BUCKETS)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    no, key = _write_of(spark, new_path, "compact", now, None)
    kept = Observation()
    newest = latest(read_versions(spark, path)).drop("write_no", "write_key")
    _put(spark, new_path, _placed(spark, new_path, newest, no, key).observe(kept, F.count(F.lit(1)).alias("n")))
    _log(spark, new_path, "compact", now, int(kept.get["n"]), int(kept.get["n"]), no, key)
    return new_path
