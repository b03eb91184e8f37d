"""Record cleaning: exact dedup (W4), date-column normalisation (F4), null-timestamp drop (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.temporal import normalize_date_text
from rillflow.functions.variant import is_numeric_type, variant_type

# Top-level record keys treated as dates.
DATE_KEYS = ("timestamp", "time", "datetime", "datahora", "date")

PROVENANCE = ("_source_file", "_ingested_at", "_run_id", "_file_ord")


def dedup_exact(records: DataFrame) -> DataFrame:
    """Keep the first of identical records (identical payload and provenance).

    Provenance is stamped per file before the key is taken, so only repeats within one
    file collapse. Expressed as a grouped ``min`` of the record ordinal: the partial
    aggregate runs before the shuffle, so a record repeated millions of times costs one
    row per map task, not one per copy. VARIANT cannot be a grouping key; its canonical
    JSON text (sorted keys) is, and is parsed back afterwards.
    """
    keyed = records.withColumn("_canon", F.to_json("payload"))
    kept = keyed.groupBy(*PROVENANCE, "_canon").agg(F.min("_rec_ord").alias("_rec_ord"))
    return kept.select(F.parse_json("_canon").alias("payload"), *PROVENANCE, "_rec_ord")


def _normalized_variant(kind, v):
    text = (F.when(kind == F.lit("STRING"), normalize_date_text(v.cast("string")))
            .when(is_numeric_type(kind),
                  F.date_format(F.timestamp_micros(F.floor(v.try_cast("decimal(38,0)") / 1000).try_cast("long")),
                                "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return F.coalesce(text.cast("variant"), F.parse_json(F.lit("null")))


def normalize_dates(records: DataFrame, keys=DATE_KEYS) -> DataFrame:
    """F4 on records: date keys present in a payload become UTC ``yyyy-MM-ddTHH:mm:ssZ`` or null.

    Parsed per value (month first, day first when that is invalid).
    """
    # the date keys a record holds, few or none, are looked up first; only records with one are taken apart, and only
    # these cells are parsed
    found = F.array(*[F.struct(F.lit(k).alias("k"), F.try_variant_get("payload", f"$.{k}", "variant").alias("v")) for k in keys])
    held = F.filter(found, lambda x: x["v"].isNotNull())
    staged = records.withColumn("__dates", F.transform(held, lambda x: F.struct(x["k"].alias("k"), x["v"].alias("v"), variant_type(x["v"]).alias("t"))))
    dates = F.map_from_entries(F.transform("__dates", lambda x: F.struct(x["k"], _normalized_variant(x["t"], x["v"]))))
    rewritten = F.map_concat(F.col("payload").try_cast("map<string,variant>"), dates)  # the later map wins
    payload = F.when(F.size("__dates") > 0, F.to_variant_object(rewritten)).otherwise(F.col("payload"))
    return staged.withColumn("payload", payload).drop("__dates")


def light_clean(records: DataFrame) -> DataFrame:
    """Dedup, then date normalisation (the dedup key sees the dates as written).

    For records whose documents are at hand, ``normalize_records(.., distinct=True)`` has done the first half already.
    """
    return normalize_dates(dedup_exact(records))


def readings_clean(readings: DataFrame) -> DataFrame:
    """P5: readings whose timestamp did not parse are dropped."""
    return readings.where(F.col("timestamp").isNotNull())
