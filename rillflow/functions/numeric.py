"""Numeric scalar functions (F2 litres parsing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.variant import is_numeric_type, strip_text, variant_type

# Text Python's float() accepts: digits with single underscores between them, optional
# fraction and exponent, or the words inf / infinity / nan. Spark's own cast is wider
# (it also takes "1.0d", "1f"), so the text is checked before casting.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_TEXT = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
FLOAT_WORD = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def _not_nan(c: Column) -> Column:
    # NaN is the missing-value marker of the reference frame; Spark keeps it distinct
    return F.nanvl(c, F.lit(None).cast("double"))


def parse_litres_text(text: Column) -> Column:
    """Litres written as text -> double (null when it is not a number).

    Strip, drop non-breaking and plain spaces; a comma without a point is the decimal
    separator; with both present every comma is dropped.
    """
    t = F.translate(strip_text(text), "\u00a0 ", "")
    has_comma = F.instr(t, ",") > 0
    has_point = F.instr(t, ".") > 0
    t = (F.when(has_comma & ~has_point, F.translate(t, ",", "."))
         .when(has_comma & has_point, F.translate(t, ",", ""))
         .otherwise(t))
    valid = t.rlike(FLOAT_TEXT) | t.rlike(FLOAT_WORD)
    return _not_nan(F.when(valid, F.translate(t, "_", "").try_cast("double")))


def parse_litres(value: Column) -> Column:
    """Litres from a VARIANT cell: numbers and booleans pass through, text is parsed."""
    kind = variant_type(value)
    return (F.when(is_numeric_type(kind) | (kind == F.lit("BOOLEAN")), _not_nan(value.try_cast("double")))
            .when(kind == F.lit("STRING"), parse_litres_text(value.cast("string"))))


def with_litres(df: DataFrame, v: Column, out: str) -> DataFrame:
    """``df`` plus ``out`` = ``parse_litres(v)``, with the cleaned text projected once."""
    staged = df.withColumn("__lv_k", variant_type(v)).withColumn("__lv_v", v)
    text = F.when(F.col("__lv_k") == F.lit("STRING"), F.col("__lv_v").cast("string"))
    staged = staged.withColumn("__lv_t", F.translate(strip_text(text), "\u00a0 ", ""))
    t = F.col("__lv_t")
    has_comma = F.instr(t, ",") > 0
    has_point = F.instr(t, ".") > 0
    staged = staged.withColumn("__lv_t", F.when(has_comma & ~has_point, F.translate(t, ",", "."))
                               .when(has_comma & has_point, F.translate(t, ",", "")).otherwise(t))
    t = F.col("__lv_t")
    from_text = F.when(t.rlike(FLOAT_TEXT) | t.rlike(FLOAT_WORD), F.translate(t, "_", "").try_cast("double"))
    kind = F.col("__lv_k")
    result = F.when(is_numeric_type(kind) | (kind == F.lit("BOOLEAN")), F.col("__lv_v").try_cast("double")) \
        .otherwise(from_text)
    return staged.withColumn(out, _not_nan(result)).drop("__lv_k", "__lv_v", "__lv_t")
