"""Property test: the litres text guard accepts exactly what Python's float() accepts."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillflow.functions import parse_litres_text

ALPHABET = "0123456789+-._eEdfxinaINF"


def _python(text):
    t = text.strip().replace(" ", "").replace(" ", "")
    if not t:
        return None
    try:
        v = float(t)
    except ValueError:
        return None
    return None if math.isnan(v) else v


NEAR_NUMBERS = st.from_regex(r"[ ]?[+-]?[0-9_]{0,4}(\.[0-9_]{0,3})?([eE][+-]?[0-9_]{0,2})?[df]?[ ]?", fullmatch=True)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.text(alphabet=ALPHABET, min_size=0, max_size=8), NEAR_NUMBERS),
                min_size=400, max_size=400))
def test_guard_matches_python_float(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.v for r in df.select("i", parse_litres_text(F.col("t")).alias("v")).orderBy("i").collect()]
    want = [_python(t) for t in texts]
    mismatches = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not mismatches, mismatches[:10]


DATES = st.datetimes(min_value=__import__("datetime").datetime(1990, 1, 1),
                     max_value=__import__("datetime").datetime(2060, 12, 31)).map(lambda d: d.replace(microsecond=0))


def _expected(d, month_first_text):
    import datetime as dt
    if not month_first_text:
        return d
    try:  # read day first: the day is the written month, the month the written day
        return dt.datetime(d.year, d.day, d.month, d.hour, d.minute, d.second)
    except ValueError:
        return d


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(DATES, st.booleans(), st.sampled_from(["/", "-", "."]), st.booleans()),
                min_size=300, max_size=300))
def test_day_first_matches_brute_force(spark, cases):
    from rillflow.functions import parse_timestamp_text
    rows = []
    for i, (d, month_first, sep, pad) in enumerate(cases):
        a, b = (d.month, d.day) if month_first else (d.day, d.month)
        fmt = (lambda x: f"{x:02d}") if pad else str
        rows.append((i, f"{fmt(a)}{sep}{fmt(b)}{sep}{d.year} {d.hour}:{d.minute:02d}:{d.second:02d}"))
    df = spark.createDataFrame(rows, "i int, t string")
    got = [r.v for r in df.select("i", parse_timestamp_text(F.col("t")).alias("v")).orderBy("i").collect()]
    want = [_expected(d, mf) for d, mf, _s, _p in cases]
    bad = [(r[1], g, w) for r, g, w in zip(rows, got, want) if g != w]
    assert not bad, bad[:5]
