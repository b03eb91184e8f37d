"""Date and time scalar functions.

A layout is one regular expression whose replacement spells the fields in ISO order for Spark's own cast; a row costs
one replacement for the usual layout, and generated code stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.variant import is_numeric_type, strip_text, variant_type

# English month abbreviations, in calendar order.
MONTH_ABBREVIATIONS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_TIME = r"(?:[ T](\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?))?"
# 22/10/2025, 22-10-2025, 22.10.2025 with an optional H:mm[:ss[.f]] part
NUMERIC_DMY = rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}){_TIME}$"
# 2 Oct 2025, 2 October 2025
NAMED_MONTH = rf"(?i)^(\d{{1,2}})[ -]([a-z]{{3}})[a-z]*\.?[ -](\d{{4}}){_TIME}$"
# 2025/10/22
YEAR_FIRST_SLASH = rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){_TIME}$"
# ISO 8601 family (zones allowed): handed to Spark's own cast
ISO_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}(?:$|[ T])"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
FILE_DATE = r"(20\d{6})"
# The fields of a numeric date as ``year-month-day clock``, day first and month first.
_DAY_FIRST, _MONTH_FIRST = "$3-$2-$1 $4", "$3-$1-$2 $4"


def _respelled(t: Column, pattern: str, order: str) -> Column:
    """``t`` with the fields of a layout in ISO order; a text of another layout stays as it is."""
    return F.regexp_replace(t, F.lit(pattern), F.lit(order))


def _parsed(t: Column, numeric: Column, day_first: bool) -> Column:
    """Naive timestamp from a stripped text and ``numeric``, the text with a numeric date in ISO order.

    Spark's own cast reads what the layouts leave: an impossible date gives null. Later layouts are looked at only when
    the earlier ones gave nothing."""
    iso = F.when(t.rlike(ISO_PREFIX), t.try_cast("timestamp").cast("timestamp_ntz"))
    swapped = _respelled(t, NUMERIC_DMY, _MONTH_FIRST if day_first else _DAY_FIRST)
    dmy = F.when(numeric != t, F.coalesce(numeric.try_cast("timestamp_ntz"), swapped.try_cast("timestamp_ntz")))
    month = F.instr(F.lit("".join(MONTH_ABBREVIATIONS)), F.lower(F.regexp_extract(t, NAMED_MONTH, 2)))
    by_name = F.when(t.rlike(NAMED_MONTH) & (month % 3 == 1), F.concat(
        F.regexp_extract(t, NAMED_MONTH, 3), F.lit("-"), ((month + 2) / 3).cast("int").cast("string"), F.lit("-"),
        F.regexp_extract(t, NAMED_MONTH, 1), F.lit(" "), F.regexp_extract(t, NAMED_MONTH, 4)).try_cast("timestamp_ntz"))
    ymd = F.when(t.rlike(YEAR_FIRST_SLASH), _respelled(t, YEAR_FIRST_SLASH, "$1-$2-$3 $4").try_cast("timestamp_ntz"))
    return F.coalesce(iso, dmy, by_name, ymd)


def _numeric(t: Column, day_first: bool) -> Column:
    return _respelled(t, NUMERIC_DMY, _DAY_FIRST if day_first else _MONTH_FIRST)


def parse_timestamp_text(text: Column, day_first: bool = True) -> Column:
    """Naive timestamp from reading text; null when no layout matches or the date is invalid.

    ``day_first``: 02/01/2025 is 2 January, and a value invalid that way is read month
    first (10/22/2025 -> 22 October). Without it the order is reversed. ISO text is
    read as written; a zone offset is converted to UTC.

    The stripped text and its respelling are bound once, as elements of one-entry arrays, so the form may stand inside
    other lambdas. On frames ``with_timestamp`` projects them as columns.
    """
    spelled = F.transform(F.array(strip_text(text)), lambda t: F.struct(t.alias("t"), _numeric(t, day_first).alias("n")))
    return F.get(F.transform(spelled, lambda x: _parsed(x["t"], x["n"], day_first)), F.lit(0))


def with_timestamp(df: DataFrame, text: Column, out: str, day_first: bool = True) -> DataFrame:
    """``df`` plus column ``out`` = ``parse_timestamp_text(text)``.

    Spark does not share a subexpression that only occurs inside conditional branches, so the stripped text and its
    respelling are projected as columns first and referenced.
    """
    staged = df.withColumn("__ts_t", strip_text(text))
    staged = staged.withColumn("__ts_n", _numeric(F.col("__ts_t"), day_first))
    return staged.withColumn(out, _parsed(F.col("__ts_t"), F.col("__ts_n"), day_first)).drop("__ts_t", "__ts_n")


def with_timestamp_variant(df: DataFrame, v: Column, out: str, day_first: bool = True) -> DataFrame:
    """``df`` plus ``out`` = ``parse_timestamp_variant(v)``, computed in stages."""
    staged = df.withColumn("__tv_k", variant_type(v)).withColumn("__tv_v", v)
    text = F.when(F.col("__tv_k") == F.lit("STRING"), F.col("__tv_v").cast("string"))
    staged = with_timestamp(staged, text, "__tv_s", day_first)
    nanos = F.col("__tv_v").try_cast("decimal(38,0)")
    from_number = F.timestamp_micros(F.floor(nanos / F.lit(1000)).try_cast("long")).cast("timestamp_ntz")
    result = F.coalesce(F.col("__tv_s"), F.when(is_numeric_type(F.col("__tv_k")), from_number))
    return staged.withColumn(out, result).drop("__tv_k", "__tv_v", "__tv_s")


def parse_timestamp_variant(v: Column, day_first: bool = True) -> Column:
    """Reading time from a VARIANT cell: text is parsed; a bare number counts nanoseconds since the epoch."""
    kind = variant_type(v)
    nanos = v.try_cast("decimal(38,0)")
    from_number = F.timestamp_micros(F.floor(nanos / F.lit(1000)).try_cast("long")).cast("timestamp_ntz")
    return (F.when(kind == F.lit("STRING"), parse_timestamp_text(v.cast("string"), day_first))
            .when(is_numeric_type(kind), from_number))


def normalize_date_text(text: Column) -> Column:
    """any parseable date text -> UTC ``yyyy-MM-ddTHH:mm:ssZ`` (month first), else null."""
    return F.date_format(parse_timestamp_text(text, day_first=False), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_from_name(name: Column) -> Column:
    """the first ``20yyMMdd`` run in a file name as a date; null when absent or not a date."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, FILE_DATE, 1), F.lit("")), "yyyyMMdd")


def utc_datetime(text: Column, now: Column | None = None) -> Column:
    """ISO date or date and time (``Z`` or an offset allowed) -> naive UTC; empty or anything else -> ``now``."""
    parsed = F.when(F.trim(text).rlike(ISO_TEXT), F.trim(text).try_cast("timestamp"))
    fallback = now if now is not None else F.current_timestamp()
    return F.coalesce(parsed, fallback).cast("timestamp_ntz")


def day_floor(ts: Column) -> Column:
    """midnight of the timestamp's day, kept naive."""
    return F.date_trunc("day", ts).cast("timestamp_ntz")
