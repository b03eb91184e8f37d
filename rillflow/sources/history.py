"""History readings: from the keyed store (S7, S9) or from JSON files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.variant import elements, is_object
from rillflow.operators import store as S
from rillflow.operators.flatten import READINGS_SCHEMA, flatten_readings
from rillflow.sources.documents import scan_json_documents
from rillflow.sources.files import MODE_LOCAL_DIR, Files, path_exists
from rillflow.session import empty_frame


def history_records_from_store(spark: SparkSession, path: str, as_of: dt.datetime, lookback_days: int) -> DataFrame:
    """S7 + S9: stored payloads saved within ``lookback_days`` of ``as_of``, decoded.

    Payloads that do not decode to a JSON object are skipped row by row.
    """
    cutoff = as_of - dt.timedelta(days=lookback_days)
    rows = S.current(spark, path, saved_since=cutoff).select("payload_json", "saved_at", "run_id", "source_file")
    payload = F.try_parse_json(F.col("payload_json"))
    decoded = rows.select(payload.alias("payload"), "saved_at", "run_id", "source_file")
    decoded = decoded.where(is_object(F.col("payload")))
    return decoded.select(
        "payload", F.col("source_file").alias("_source_file"), F.col("run_id").alias("_run_id"),
        F.lit("").alias("_file_ord"), F.lit(0).cast("long").alias("_rec_ord"))


def history_from_store(spark: SparkSession, path: str, as_of: dt.datetime, lookback_days: int) -> DataFrame:
    return flatten_readings(history_records_from_store(spark, path, as_of, lookback_days))


def history_from_file(spark: SparkSession, source: str) -> DataFrame:
    """Readings from a history file holding one meter document or a list of them.

    ``source`` may also name a folder of such files. Missing source -> empty readings;
    a file that is not JSON contributes nothing; list elements that are not objects are
    ignored. Readings are tagged with the file name.
    """
    if not path_exists(spark, source):
        return empty_frame(spark, READINGS_SCHEMA)
    docs = scan_json_documents(spark, Files(MODE_LOCAL_DIR, folder=source, glob="*", recursive=True))
    recs = docs.select("name", F.posexplode(elements(F.col("doc"))).alias("_rec_ord", "payload"))
    recs = recs.where(is_object(F.col("payload"))).select(
        "payload", F.col("name").alias("_source_file"), F.lit(None).cast("string").alias("_run_id"),
        F.lit("").alias("_file_ord"), F.col("_rec_ord").cast("long"))
    return flatten_readings(recs)
