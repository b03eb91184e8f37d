"""Incremental ingest of newly arriving JSON files into the keyed store.

A file-source stream (``text`` with ``wholetext``: one row per new file) feeds
``foreachBatch``, which runs the same batch operators (parse, normalise, dedup) and the
store upsert. Progress (which files were taken) lives in the stream's checkpoint, so a
restarted query resumes where it stopped; ``trigger(availableNow=True)`` drains what is
present and stops.

A micro-batch retried after its store write (but before the stream committed it) writes under the same key, the
stream's checkpoint and the batch's number, and so replaces what it wrote before.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators import store as S
from rillflow.operators.clean import normalize_dates
from rillflow.session import apply_confs
from rillflow.sources.documents import normalize_records


def _batch_documents(batch: DataFrame) -> DataFrame:
    return batch.select(F.col("name"), F.col("source"), F.col("source").alias("_file_ord"), F.col("text"),
                        F.try_parse_json(F.col("text")).alias("doc"))


def ingest_new_files(spark: SparkSession, folder: str, store_path: str, checkpoint: str | None = None,
                     run_prefix: str = "stream", max_files_per_batch: int = 1000) -> None:
    """Upsert every not-yet-seen ``*.json`` file of ``folder`` into the store, then stop."""
    apply_confs(spark)
    # progress lives beside the store, by inbox, so that a restarted process goes on where the last one stopped
    checkpoint = checkpoint or f"{store_path.rstrip('/')}/_ingest/{hashlib.sha1(folder.encode()).hexdigest()}"
    stream = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
              .option("maxFilesPerTrigger", max_files_per_batch).load(folder)
              .select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_path").alias("source"),
                      F.col("value").alias("text")))

    def write(batch: DataFrame, epoch: int) -> None:
        run_id = f"{run_prefix}-{epoch}"
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        records = normalize_dates(normalize_records(_batch_documents(batch), run_id, ingested_at=F.lit(now).cast("timestamp"),
                                                   distinct=True))
        S.upsert(batch.sparkSession, store_path, records, run_id, now, key=f"{checkpoint}\n{run_id}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
