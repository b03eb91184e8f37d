"""File sinks (K1-K4). Every writer goes through Spark's commit protocol."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from rillflow.sources.documents import known_keys, schema_union


# Timestamps keep their microseconds (Spark's default text formats stop at milliseconds).
TIMESTAMP_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_json(df: DataFrame, path: str) -> str:
    """K1: records as JSON Lines (one object per line), VARIANT payloads inline."""
    df.write.mode("overwrite").options(**TIMESTAMP_TEXT).json(path)
    return path


def read_json(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**TIMESTAMP_TEXT).json(path)


def _flat_for_csv(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """K2: records as CSV with a header; nested cells are written as JSON text. Quotes are doubled, as RFC 4180 has it."""
    _flat_for_csv(df).write.mode("overwrite").option("header", True).option("escape", '"').options(**TIMESTAMP_TEXT).csv(path)
    return path


def record_lines(records: DataFrame, keys: list[str]) -> DataFrame:
    """K1: one flat JSON object per record: every key of the batch (null where a record lacks it) and the stamps."""
    null = F.parse_json(F.lit("null"))
    blank = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]).cast("array<string>"), F.array_repeat(null, len(keys)))
    stamps = F.create_map(F.lit("_source_file"), F.col("_source_file").cast("variant"),
                          F.lit("_ingested_at"), F.date_format("_ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").cast("variant"),
                          F.lit("_run_id"), F.coalesce(F.col("_run_id").cast("variant"), null))
    cells = F.map_concat(blank, F.col("payload").try_cast("map<string,variant>"), stamps)
    return records.select(F.to_json(F.to_variant_object(cells)).alias("value"))


def write_records_json(records: DataFrame, path: str, keys: list[str] | None = None) -> str:
    """K1: the batch's records as JSON Lines, one flat object each. Keys keep their case; objects are written as text, so
    keys that differ in case alone stay apart."""
    record_lines(records, known_keys(records) if keys is None else keys).write.mode("overwrite").text(path)
    return path


def write_records_csv(records: DataFrame, path: str, keys: list[str] | None = None) -> str:
    """K2: the batch's records as CSV with a header: a column per key of the batch, then the stamps. Texts are written
    bare, lists and objects as JSON, nulls empty."""
    wide = schema_union(records, keys).drop("_file_ord", "_rec_ord")

    def cell(c):
        kind = F.schema_of_variant(c)
        return (F.when(kind == F.lit("VOID"), F.lit(None).cast("string"))
                .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(c)).otherwise(c.cast("string")))

    shown = []
    for f in wide.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        shown.append(cell(c).alias(f.name) if isinstance(f.dataType, VariantType) else c)
    wide.select(*shown).write.mode("overwrite").option("header", True).option("escape", '"').options(**TIMESTAMP_TEXT).csv(path)
    return path


def write_report(summary: DataFrame, details: DataFrame, no_history: DataFrame, path: str) -> str:
    """K3: the anomaly report as a folder: ``summary`` (one JSON line), ``details`` (ranked JSON
    lines, largest deviation first) and ``without_history`` (by meter).

    The reference nests both lists inside one JSON document; here they stay separate
    line-oriented outputs so no list is gathered into a single row or task.
    """
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    det = details.orderBy(F.desc("abs_delta_count"), "contador")
    det.write.mode("overwrite").json(f"{path}/details")
    no_history.orderBy("contador").write.mode("overwrite").json(f"{path}/without_history")
    return path


def record_dicts(records: DataFrame) -> list[dict]:
    """A few records (a sample) as plain dictionaries: the payload's keys and the stamps."""
    rows = records.select(F.to_json("payload").alias("p"), "_source_file", F.col("_ingested_at").cast("string").alias("_ingested_at"),
                          "_run_id").collect()
    return [{**json.loads(r["p"]), "_source_file": r["_source_file"], "_ingested_at": r["_ingested_at"], "_run_id": r["_run_id"]} for r in rows]


def write_result(spark, result: dict, path: str) -> str:
    """K4: a run's result record as one JSON object, in a folder of its own."""
    text = json.dumps(result, ensure_ascii=False, default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path


def append_run_log(run_log: DataFrame, path: str) -> str:
    """K4: append one run's result rows to the run-log table."""
    run_log.write.mode("append").parquet(path)
    return path
