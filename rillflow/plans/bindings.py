"""Stand-in inputs built from the driver's test tables.

These only put test-table rows into the schemas the library expects; every step of a
query's work runs in the library code that consumes them.

Binding of ``events(event_id, ts, user_id, event_type, value, props)`` to readings:
``contador = device = <key column> as text``, ``alias = event_type``, ``timestamp = ts``,
``value_l = value``, record ordinal = ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.sources.files import MODE_LOCAL_DIR, Files, place_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_readings(spark: SparkSession, sf_dir: str, key: str = "user_id", before: str | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if before:
        ev = ev.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))
    k = F.col(key).cast("string")
    return ev.select(
        k.alias("contador"), k.alias("device"), F.col("event_type").alias("alias"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"), F.col("value").alias("value_l"),
        F.lit("events.parquet").alias("source_file"), F.lit(None).cast("string").alias("_run_id"),
        F.lit("").alias("_file_ord"), F.col("event_id").cast("long").alias("_rec_ord"), F.lit(0).alias("_body_pos"))


# ------------------------------------------------------------------ header/body documents
# The export header of the meter documents (the sample export's column names).
DOC_HEADER = ("Detalhes", "Nome", "Data e hora", "Valor (l)", "Leitura (l)")
DOC_CHUNK_ROWS = 256  # body rows per stand-in document (bounds every document's size)
_WRITTEN: dict[tuple, str] = {}


def doc_key(ts_col="ts", id_col="event_id"):
    return F.concat(F.date_format(ts_col, "yyyyMMdd"), F.lit("_"), F.floor(F.col(id_col) / DOC_CHUNK_ROWS).cast("string"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, text``: events packed into header/body JSON documents of at most 256 rows,
    never spanning two days. Cells are text as in a spreadsheet export: day-first times
    and comma decimals."""
    ev = table(spark, sf_dir, "events")
    row = F.array(F.col("user_id").cast("string"), F.col("event_type"),
                  F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSSSSS"),
                  F.translate(F.col("value").cast("string"), ".", ","), F.col("event_id").cast("string"))
    grouped = ev.groupBy(doc_key().alias("doc")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", row.alias("r")))).alias("rows"))
    body = F.transform("rows", lambda x: x["r"])
    text = F.to_json(F.struct(F.array(*[F.lit(h) for h in DOC_HEADER]).alias("header"), body.alias("body")))
    return grouped.select("doc", text.alias("text"))


def corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One broken export per day (cut off mid-document)."""
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("d")).distinct()
    return days.select(F.concat("d", F.lit("_bad")).alias("doc"),
                       F.concat(F.lit('{"header": ["Detalhes", "Nome"], "body": [["'), "d", F.lit('"')).alias("text"))


def write_event_documents(spark: SparkSession, sf_dir: str) -> str:
    """Write one file per document (good and broken) under the shared scratch folder; once per session."""
    from rillflow.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = scratch_path(spark, "meter-docs")
        docs = event_documents(spark, sf_dir).unionByName(corrupt_documents(spark, sf_dir))
        docs.repartition("doc").write.partitionBy("doc").text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def document_files(folder: str) -> Files:
    """The files of a written document folder, named ``meter_<doc>.json``."""
    def named(path):
        return F.concat(F.lit("meter_"), F.regexp_extract(path, r"doc=([^/]+)/", 1), F.lit(".json"))

    return Files(MODE_LOCAL_DIR, folder=folder, glob="*.txt", recursive=True, named=named)


# ------------------------------------------------------------------ records
def event_records(spark: SparkSession, sf_dir: str, fields=("event_id", "event_type", "user_id"),
                  source: DataFrame | None = None) -> DataFrame:
    """Records ``payload, _source_file, _ingested_at, _run_id, _file_ord, _rec_ord`` from events:
    the payload is a JSON object of ``fields``; the source file is the event's day file."""
    ev = source if source is not None else table(spark, sf_dir, "events")
    payload = F.to_variant_object(F.struct(*[F.col(f) for f in fields]))
    return ev.select(payload.alias("payload"),
                     F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd"), F.lit(".json")).alias("_source_file"),
                     F.lit("2024-02-01 00:00:00").cast("timestamp").alias("_ingested_at"),
                     F.lit("run-1").alias("_run_id"), F.lit("").alias("_file_ord"),
                     F.col("event_id").cast("long").alias("_rec_ord"))


def event_document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in-memory JSON document per event, shaped by event type:
    view -> the ``props`` object; click -> ``[props, value]``; purchase -> the bare value;
    signup -> ``[]``; error -> ``null``."""
    ev = table(spark, sf_dir, "events")
    t = F.col("event_type")
    text = (F.when(t == "view", F.col("props"))
            .when(t == "click", F.concat(F.lit("["), F.col("props"), F.lit(","), F.col("value").cast("string"), F.lit("]")))
            .when(t == "purchase", F.col("value").cast("string"))
            .when(t == "signup", F.lit("[]"))
            .otherwise(F.lit("null")))
    return ev.select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("name"),
                     place_key(F.col("event_id")).alias("_file_ord"), F.try_parse_json(text).alias("doc"),
                     text.alias("text"))


def derived_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n, pos``: a file name per event, ``src_<yyyyMMdd>_<id>.json``; view events carry no date."""
    ev = table(spark, sf_dir, "events")
    n = F.when(F.col("event_type") == "view", F.concat(F.lit("src_view_"), F.col("event_id").cast("string"), F.lit(".json"))) \
        .otherwise(F.concat(F.lit("src_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), F.col("event_id").cast("string"),
                            F.lit(".json")))
    return ev.select(n.alias("n"), F.col("event_id").cast("long").alias("pos"))
