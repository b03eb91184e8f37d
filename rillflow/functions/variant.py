"""VARIANT helpers: type tests, Python-style truthiness, first-truthy alias resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header names accepted for each reading field, in order of preference.
DEVICE_KEYS = ("Device", "device", "Contador", "contador", "Detalhes", "detalhes")
ALIAS_KEYS = ("Alias", "alias", "Nome", "nome")
TIME_KEYS = ("Date/Time", "timestamp", "Timestamp", "datahora", "Data e hora", "data e hora")
VALUE_KEYS = ("Valor (l)", "valor_l", "value_l", "Value (l)", "Value", "value")


def variant_type(v: Column) -> Column:
    """Type name of a VARIANT value (STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, ARRAY<..>, OBJECT<..>)."""
    return F.schema_of_variant(v)


def is_numeric_type(kind: Column) -> Column:
    return kind.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE") | kind.startswith("DECIMAL")


def is_object(v: Column) -> Column:
    """Whether a VARIANT holds an object. The cast looks at the top level alone; a type name spells out every level."""
    return v.try_cast("map<string,variant>").isNotNull()


def elements(v: Column) -> Column:
    """The elements of a list, any other value as the only element; null for no value."""
    return F.when(v.isNotNull(), F.coalesce(v.try_cast("array<variant>"), F.array(v)))


def truthy_sql(kind: str, v: str) -> str:
    """Python truthiness of a JSON value held in a VARIANT, as SQL text: ``v`` and its type name ``kind`` are names in it.

    Falsy: missing, JSON null, numeric zero, false, "", empty list, empty object.
    The string "0" is truthy. Decided on the VARIANT type, never on its text; text, the usual type, is looked at first.
    """
    numeric = f"({kind} IN ('TINYINT', 'SMALLINT', 'INT', 'BIGINT', 'FLOAT', 'DOUBLE') OR startswith({kind}, 'DECIMAL'))"
    return (f"CASE WHEN {kind} = 'STRING' THEN CAST({v} AS STRING) <> '' WHEN {kind} IS NULL OR {kind} = 'VOID' THEN false "
            f"WHEN {numeric} THEN coalesce(try_cast({v} AS DOUBLE) <> 0.0D, true) "
            f"WHEN {kind} = 'BOOLEAN' THEN coalesce(try_cast({v} AS BOOLEAN), false) "
            f"WHEN startswith({kind}, 'ARRAY') THEN size(try_cast({v} AS array<variant>)) <> 0 "
            f"WHEN startswith({kind}, 'OBJECT') THEN to_json({v}) <> '{{}}' ELSE true END")


def variant_text(v: Column) -> Column:
    """`str(x)` of a JSON scalar: strings as they are, booleans as True/False, numbers as written.

    Arrays and objects render as JSON (Python would print its repr).
    """
    kind = variant_type(v)
    return (F.when(kind == F.lit("BOOLEAN"), F.when(v.try_cast("boolean"), F.lit("True")).otherwise(F.lit("False")))
            .otherwise(v.cast("string")))


# The characters Python's str.strip() removes (str.isspace() is true).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
                 "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_text(c: Column) -> Column:
    """Python str.strip(): white space off both ends (a plain trim, no regular expression)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def meter_key(device: Column, alias: Column) -> Column:
    """the meter is the device, else the alias; empty when both are empty."""
    return F.when(device != F.lit(""), device).otherwise(alias)
