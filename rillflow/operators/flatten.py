"""Header x body matrix documents -> typed meter readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.numeric import with_litres
from rillflow.functions.temporal import with_timestamp_variant
from rillflow.functions.variant import (ALIAS_KEYS, DEVICE_KEYS, TIME_KEYS, VALUE_KEYS, meter_key, strip_text,
                                        truthy_sql, variant_text)

READINGS_SCHEMA = ("contador string, device string, alias string, timestamp timestamp_ntz, value_l double, "
                   "source_file string, _run_id string, _file_ord string, _rec_ord bigint, _body_pos int")
READING_COLUMNS = ["contador", "device", "alias", "timestamp", "value_l", "source_file", "_run_id",
                   "_file_ord", "_rec_ord", "_body_pos"]


# The fields a row is read for, with the names that a header may give them.
FIELDS = (DEVICE_KEYS, ALIAS_KEYS, TIME_KEYS, VALUE_KEYS)


def _texts(keys: Sequence[str]) -> str:
    return "array(" + ", ".join("'" + k.replace("\\", "\\\\").replace("'", "\\'") + "'" for k in keys) + ")"


# Lambdas are written as SQL text: one expression each, where the Column functions make a call to the JVM per node.
def _places(names: str, fields: Sequence[Sequence[str]]) -> Column:
    """For every field, for every one of its names that the header holds, in order of preference: the name's places in
    the header, the last one first."""
    wanted = f"array({', '.join(_texts(keys) for keys in fields)})"
    places = f"reverse(filter(sequence(0, size({names}) - 1), i -> get({names}, i) = k))"
    return F.expr(f"transform({wanted}, keys -> filter(transform(keys, k -> {places}), p -> size(p) > 0))")


def _cell(cells: str, places: str) -> str:
    """The cell under a header name: its last place that the row reaches, null without one."""
    return f"get({cells}, get(filter({places}, i -> i < size({cells})), 0))"


def _picked_rows(body: str, fields: str, last: str) -> Column:
    """Body rows -> array of ``_body_pos``, the first truthy cell of every field, the raw cells of ``last``; rows that are
    not lists are dropped.

    Where each field's names stand in the header is known once per document, so a row is read at a few places and never
    made into a map. Higher-order functions run interpreted, without common-subexpression elimination, so what is used
    twice (a row's cells, a cell and its type) is bound by a ``transform`` level of its own.
    """
    rows = f"filter(transform({body}, (row, pos) -> struct(pos, try_cast(row AS array<variant>) AS c)), x -> x.c IS NOT NULL)"
    typed = f"transform(transform(choices, p -> {_cell('x.c', 'p')}), v -> struct(v, schema_of_variant(v) AS t))"
    found = f"transform({fields}, choices -> get(filter({typed}, y -> {truthy_sql('y.t', 'y.v')}), 0).v)"
    raw = f"transform({last}, field -> {_cell('x.c', 'get(field, 0)')})"
    return F.expr(f"transform({rows}, x -> struct(x.pos AS _body_pos, {found} AS _found, {raw} AS _raw))")


def flatten_readings(records: DataFrame, source_tag: str = "") -> DataFrame:
    """One reading per body row of every record holding a list ``header`` and a list ``body``.

    * a body row that is not a list is skipped;
    * header names are stripped; a row is zipped with the header up to the shorter length,
      and a repeated header name keeps the last cell;
    * device / alias / time / litres come from the first *truthy* cell of their alias
      lists (numeric 0 and "" fall through to the next name);
    * the meter (``contador``) is the device, else the alias; rows with neither are dropped.

    Rows are exploded in place (no shuffle); the output schema is fixed, so an empty
    input gives an empty frame of the same schema. The cell picking runs inside the
    generator's input (``transform`` over the body, then ``inline``): later filters on
    the picked cells cannot be pushed back into it and multiply the expression tree.
    """
    header = F.try_variant_get(F.col("payload"), "$.header", "array<string>")
    body = F.try_variant_get(F.col("payload"), "$.body", "array<variant>")
    src = F.coalesce(F.col("_source_file"), F.lit(source_tag)) if "_source_file" in records.columns else F.lit(source_tag)
    run = F.col("_run_id") if "_run_id" in records.columns else F.lit(None).cast("string")
    # no filter on the payload here: a filter would be pushed down through every
    # projection that built the payload, copying those expressions into it; a record
    # without a list header and body simply explodes into no rows
    docs = records.select(
        F.transform(header, lambda h: F.coalesce(strip_text(h), F.lit("None"))).alias("_names"), body.alias("_body"),
        src.alias("source_file"), run.alias("_run_id"),
        F.col("_file_ord").cast("string").alias("_file_ord"), F.col("_rec_ord").cast("long").alias("_rec_ord"))
    docs = docs.withColumns({"_fields": _places("_names", FIELDS), "_last": _places("_names", (TIME_KEYS[-1:], VALUE_KEYS[-1:]))})
    rows = F.when(F.col("_names").isNotNull(), _picked_rows("_body", "_fields", "_last"))
    picked = docs.select("source_file", "_run_id", "_file_ord", "_rec_ord", F.inline(rows))
    # device and alias chains end in an empty text, the time and litres chains in the raw value of their last name
    cell = lambda i, raw=None: F.get("_found", F.lit(i)) if raw is None else F.coalesce(
        F.get("_found", F.lit(i)), F.get("_raw", F.lit(raw)))
    picked = picked.select("source_file", "_run_id", "_file_ord", "_rec_ord", "_body_pos", cell(0).alias("_dev"), cell(1).alias("_ali"),
                           cell(2, 0).alias("_time"), cell(3, 1).alias("_val"))
    typed = picked.select(
        strip_text(F.coalesce(variant_text(F.col("_dev")), F.lit(""))).alias("device"),
        strip_text(F.coalesce(variant_text(F.col("_ali")), F.lit(""))).alias("alias"),
        "_time", "_val", "source_file", "_run_id", "_file_ord", "_rec_ord",
        F.col("_body_pos").cast("int").alias("_body_pos"))
    typed = with_timestamp_variant(typed, F.col("_time"), "timestamp")
    typed = with_litres(typed, F.col("_val"), "value_l")
    out = typed.withColumn("contador", meter_key(F.col("device"), F.col("alias"))).where(F.col("contador") != "")
    return out.select(*READING_COLUMNS)
