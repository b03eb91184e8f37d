"""Quirk tables for the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rillflow import functions as RF


def _col(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def _eval(df, expr):
    return [r[1] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_parse_litres_text(spark):
    cases = {
        "1 200 000": 1200000.0, "1,5": 1.5, "1,234.5": 1234.5, "1.234,56": 1.23456, "1,234,567": None,
        "": None, "abc": None, "1.0d": None, "1f": None, " 12 ": 12.0, "1 000": 1000.0, "1_000": 1000.0,
        "1__0": None, "-2.5e1": -25.0, "inf": float("inf"), ".5": 0.5, "5.": 5.0, "0x1p3": None, "NaN": None,
    }
    got = _eval(_col(spark, list(cases)), RF.parse_litres_text(F.col("v")))
    assert got == list(cases.values())


def test_parse_litres_variant(spark):
    cases = {'"1,5"': 1.5, "true": 1.0, "3": 3.0, "2.50": 2.5, '[1]': None, '{"a":1}': None, "null": None}
    df = _col(spark, list(cases)).withColumn("v", F.parse_json("v"))
    assert _eval(df, RF.parse_litres(F.col("v"))) == list(cases.values())


def test_truthiness(spark):
    cases = {"0": False, "0.0": False, '"0"': True, '""': False, "false": False, "true": True, "[]": False,
             "{}": False, "null": False, "1.5": True, '"x"': True, "[0]": True}
    df = _col(spark, list(cases)).withColumn("v", F.parse_json("v"))
    assert _eval(df.withColumn("k", F.schema_of_variant("v")), F.expr(RF.truthy_sql("k", "v"))) == list(cases.values())


def test_day_first_timestamps(spark):
    cases = {
        "22/10/2025 00:15": dt.datetime(2025, 10, 22, 0, 15), "22/10/2025": dt.datetime(2025, 10, 22),
        "2/1/2025 3:05": dt.datetime(2025, 1, 2, 3, 5), "10/22/2025 01:00": dt.datetime(2025, 10, 22, 1, 0),
        "25": None, "2025-10-02": dt.datetime(2025, 10, 2), "22-10-2025 13:05:09": dt.datetime(2025, 10, 22, 13, 5, 9),
        "22.10.2025 7:05": dt.datetime(2025, 10, 22, 7, 5), "2 Oct 2025": dt.datetime(2025, 10, 2),
        "2025-10-02T10:00:00+02:00": dt.datetime(2025, 10, 2, 8, 0), "31/02/2025": None, "garbage": None,
        "2025/10/22 10:30": dt.datetime(2025, 10, 22, 10, 30), "22/10/2025 00:15:30.5": dt.datetime(2025, 10, 22, 0, 15, 30, 500000),
    }
    got = _eval(_col(spark, list(cases)), RF.parse_timestamp_text(F.col("v")))
    assert got == list(cases.values())


def test_month_first_normalisation(spark):
    cases = {"02/01/2025": "2025-02-01T00:00:00Z", "22/10/2025": "2025-10-22T00:00:00Z",
             "2025-10-02 10:00:00+01:00": "2025-10-02T09:00:00Z", "x": None}
    got = _eval(_col(spark, list(cases)), RF.normalize_date_text(F.col("v")))
    assert got == list(cases.values())


def test_date_from_name(spark):
    cases = {"x_20251022.json": dt.date(2025, 10, 22), "x.json": None, "x_20259999.json": None,
             "a20240101b20250101": dt.date(2024, 1, 1), "2025102299.json": dt.date(2025, 10, 22)}
    assert _eval(_col(spark, list(cases)), RF.date_from_name(F.col("v"))) == list(cases.values())


def test_utc_datetime(spark):
    df = _col(spark, ["2025-10-22T10:00:00Z", "2025-10-22T10:00:00+02:00", "2025-10-22 10:00:00", "", "bad"])
    now = F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz")
    got = _eval(df, RF.utc_datetime(F.col("v"), now))
    assert got == [dt.datetime(2025, 10, 22, 10), dt.datetime(2025, 10, 22, 8), dt.datetime(2025, 10, 22, 10),
                   dt.datetime(2030, 1, 1), dt.datetime(2030, 1, 1)]


def test_identity_ignores_key_order_and_stamps(spark):
    df = spark.createDataFrame([(0, '{"a":1,"b":[1,2]}', "f.json"), (1, '{"b":[1,2],"a":1}', "f.json"),
                                (2, '{"a":1,"b":[1,2]}', "g.json")], "i int, p string, s string")
    got = _eval(df, RF.record_identity(F.parse_json("p"), F.col("s")))
    assert got[0] == got[1] and got[0] != got[2] and len(got[0]) == 64


def test_sha256_matches_known_digest(spark):
    df = _col(spark, ["a"])
    assert _eval(df, RF.content_hash(F.col("v"))) == ["ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"]


def test_identity_from_json_matches(spark):
    df = spark.createDataFrame([(0, '{"b":"x\\"y","a":[1,{"z":null}]}', 'f "1".json'), (1, '{}', "")],
                               "i int, p string, s string")
    a = _eval(df, RF.record_identity(F.parse_json("p"), F.col("s")))
    b = _eval(df, RF.record_identity_from_json(F.to_json(F.parse_json("p")), F.col("s")))
    assert a == b
