"""Whole-file JSON documents (S1), bad-file isolation (S6), records (P1, P2) and key union.

One file holds one JSON document. Files are read with the text source in ``wholetext``
mode (one row per file) and parsed into a VARIANT on the executors; the parse never
throws, a bad document becomes NULL and is routed to the quarantine frame.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.identity import without_keys
from rillflow.functions.variant import elements, is_object
from rillflow.session import empty_frame
from rillflow.sources.files import Files, existing, glob_escaped, metadata_path, qualified

# The stamps of a record; they replace keys of the same names inside its payload.
STAMP_KEYS = ("_source_file", "_ingested_at", "_run_id")


def _key(path):
    """Full path text without the two spellings of a local root."""
    return F.regexp_replace(path, r"^file:/+", "file:/")


def _folder_texts(spark: SparkSession, files: Files) -> DataFrame:
    """Files of a folder: the conditions are filters on the scan's metadata, so other files are not opened."""
    raw = files.reader(spark, "text").option("wholetext", True).load(glob_escaped(files.folder))
    raw = files.kept(raw, files.named(metadata_path()), metadata_path())
    return raw.select(files.named(metadata_path()).alias("name"), metadata_path().alias("source"),
                      metadata_path().alias("_file_ord"), F.col("value").alias("text"))


def _listed_texts(spark: SparkSession, files: Files) -> DataFrame:
    """Files named one by one, each read once however often and however it is written; those that are missing have no text.

    The list is the text of an option: its entries are joined to what was read as the broadcast side, whose size is
    that text's."""
    listing = files.listing(spark)
    there = existing(spark, list(files.sources))
    keyed = listing.withColumn("_key", _key(qualified(spark, F.col("source"))))
    if not there:
        return listing.select("name", "source", "_file_ord", F.lit(None).cast("string").alias("text"))
    once = {r["_key"]: r["source"] for r in keyed.where(F.col("source").isin(sorted(there))).collect()}
    raw = (spark.read.format("text").option("wholetext", True).load([glob_escaped(p) for p in sorted(once.values())])
           .select(_key(metadata_path()).alias("_key"), F.col("value").alias("text")))
    read = raw.join(F.broadcast(keyed.where(F.col("source").isin(sorted(there)))), "_key").select("name", "source", "_file_ord", "text")
    missing = listing.where(~F.col("source").isin(sorted(there)))
    return read.unionByName(missing.select("name", "source", "_file_ord", F.lit(None).cast("string").alias("text")))


def scan_json_documents(spark: SparkSession, files: Files) -> DataFrame:
    """``name, source, _file_ord, text, doc``, one row per file.

    ``doc`` is the parsed VARIANT, or NULL when the text is not one JSON document (or a named file is missing, then
    ``text`` is NULL too). A folder's files are read where the scan lists them: no join, no shuffle, no list on the
    driver beyond Spark's own.
    """
    if files.folder is None and not files.sources:
        return empty_frame(spark, "name string, source string, _file_ord string, text string, doc variant")
    out = _listed_texts(spark, files) if files.folder is None else _folder_texts(spark, files)
    return out.select("name", "source", "_file_ord", "text", F.try_parse_json(F.col("text")).alias("doc"))


def file_parse_status(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good documents, quarantined files, one-row counts ``files_ok, files_error``).

    ``normalize_records`` already skips unparsed documents, so feeding it ``documents``
    directly avoids a second parse that a filter on ``doc`` would cause.
    """
    ok = F.col("doc").isNotNull()
    good = documents.where(ok)
    bad = documents.where(~ok).select("name", "source", "_file_ord",
                                      F.when(F.col("text").isNull(), F.lit("missing file"))
                                      .otherwise(F.lit("invalid JSON document")).alias("error"))
    counts = documents.agg(F.count_if(ok).alias("files_ok"), F.count_if(~ok).alias("files_error"))
    return good, bad, counts


def first_of_equals(items):
    """W4 inside a document: array of elements -> array of (place, element) with the first of equal ones.

    Equal means equal canonical JSON. A map of the reversed texts keeps, for each text, the place met last, which is the
    first one (``spark.sql.mapKeyDedupPolicy=LAST_WIN``); it holds one document's texts at a time.
    """
    texts = F.transform(items, lambda x: F.to_json(x))
    places = F.sequence(F.lit(0), F.size(items) - 1)
    first = F.array_sort(F.map_values(F.map_from_arrays(F.reverse(texts), F.reverse(places))))
    # an element alone repeats nothing and is not spelled out; no sequence runs over an empty array
    kept = F.when(F.size(items) == 1, F.array(F.lit(0))).when(F.size(items) > 1, first)
    return F.transform(kept, lambda i: F.struct(i.alias("pos"), F.get(items, i).alias("item")))


def normalize_records(documents: DataFrame, run_id: str | None, ingested_at=None, distinct: bool = False) -> DataFrame:
    """P1 + P2, with ``distinct`` also W4: documents -> records stamped with provenance.

    Repeats are told from one another by payload and provenance, and provenance is stamped per document, so records that
    repeat do so inside one document: ``distinct`` keeps the first of them before the document is taken apart, without
    any shuffle.

    A list yields one record per element, an object one record, anything else one record
    ``{"value": x}``; list elements that are not objects are wrapped the same way. The stamps replace keys of the
    same names that a payload brings along.
    Output: ``payload variant, _source_file, _ingested_at, _run_id, _file_ord, _rec_ord``.
    """
    # a document that did not parse yields no records (no filter on ``doc``: a pushed-down
    # filter would parse every document twice)
    items = elements(F.col("doc"))
    if distinct:
        exploded = documents.select("name", "_file_ord", items.alias("_items")).select(
            "name", "_file_ord", F.explode(first_of_equals(F.col("_items"))).alias("_r")).select(
            "name", "_file_ord", F.col("_r.pos").alias("_rec_ord"), F.col("_r.item").alias("item"))
    else:
        exploded = documents.select("name", "_file_ord", F.posexplode(items).alias("_rec_ord", "item"))
    stamped = reduce(or_, [F.try_variant_get("item", f"$.{k}", "variant").isNotNull() for k in STAMP_KEYS])
    wrapped = F.when(is_object(F.col("item")), without_keys(F.col("item"), STAMP_KEYS, stamped)).otherwise(
        F.to_variant_object(F.struct(F.col("item").alias("value"))))
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    return exploded.select(
        wrapped.alias("payload"),
        F.col("name").alias("_source_file"),
        stamp.alias("_ingested_at"),
        F.lit(run_id).cast("string").alias("_run_id"),
        F.col("_file_ord"),
        F.col("_rec_ord").cast("int").alias("_rec_ord"),
    )


def record_keys(records: DataFrame) -> DataFrame:
    """The union of top-level keys over all records, one row per key."""
    keys = F.map_keys(F.col("payload").try_cast("map<string,variant>"))
    return records.select(F.explode(keys).alias("key")).distinct()


def known_keys(records: DataFrame) -> list[str]:
    """The key union as a list: the schema of the flat outputs, which a driver has to hold as it holds any schema."""
    return sorted(r.key for r in record_keys(records).collect())


def safe_names(keys: list[str]) -> list[str]:
    """Column names for keys, in order: names that differ in case alone, or equal a stamp, get a number."""
    taken, names = {c.lower() for c in (*STAMP_KEYS, "_file_ord", "_rec_ord")}, []
    for key in keys:
        name, n = key, 1
        while name.lower() in taken:
            n += 1
            name = f"{key}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def schema_union(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One column per record key (missing -> null), provenance kept.

    ``keys`` defaults to the discovered key set (a distributed distinct). Values stay VARIANT; the payload is
    taken apart once. Names are those of ``safe_names``.
    """
    keys = known_keys(records) if keys is None else keys
    rest = ["_source_file", "_ingested_at", "_run_id", "_file_ord", "_rec_ord"]
    cells = records.select(F.col("payload").try_cast("map<string,variant>").alias("_cells"), *rest)
    cols = [F.try_element_at("_cells", F.lit(k)).alias(n) for k, n in zip(keys, safe_names(keys))]
    return cells.select(*cols, *rest)
