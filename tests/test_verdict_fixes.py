"""Inputs that once lost files, aborted a run or gave wrong rows."""

import csv
import datetime as dt
import json
import os

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillflow import sinks
from rillflow.functions.temporal import parse_timestamp_variant, utc_datetime
from rillflow.operators import anomaly as A
from rillflow.operators.clean import normalize_dates
from rillflow.sources import documents as D
from rillflow.sources import files as FL

NAMES = ["leituras 22 out.json", "a%20b.json", "b[1].json", "c{x}.json", "é+ü.json", "plain.json"]


@pytest.fixture()
def inbox(tmp_path):
    for name in NAMES:
        (tmp_path / name).write_text(json.dumps({"from": name}))
    return tmp_path


def _read(spark, files):
    return sorted(r["name"] for r in D.scan_json_documents(spark, files).where("doc is not null").collect())


def test_no_file_name_is_lost(spark, inbox):
    assert _read(spark, FL.discover(spark, directory=str(inbox))) == sorted(NAMES)
    given = ",".join(str(inbox / n) for n in NAMES)
    assert _read(spark, FL.discover(spark, sources=given)) == sorted(NAMES)
    assert _read(spark, FL.discover(spark, base=f"file://{inbox}", names=",".join(NAMES))) == sorted(NAMES)


def test_relative_paths_and_missing_files(spark, inbox):
    relative = os.path.relpath(inbox / "plain.json")
    docs = D.scan_json_documents(spark, FL.discover(spark, sources=f"{relative},./{relative},nowhere.json"))
    assert sorted((r["name"], r["text"] is None) for r in docs.collect()) == [
        ("nowhere.json", True), ("plain.json", False), ("plain.json", False)]


@pytest.mark.parametrize("key", ["timestamp", "time", "datetime", "datahora", "date"])
def test_dates_are_normalised_under_each_key(spark, key):
    records = spark.range(1).select(F.parse_json(F.lit(json.dumps({key: "22/10/2025 01:00", "n": 1}))).alias("payload"))
    payload = json.loads(normalize_dates(records).select(F.to_json("payload")).first()[0])
    assert payload == {key: "2025-10-22T01:00:00Z", "n": 1}


def test_huge_numbers_do_not_abort(spark):
    cells = spark.createDataFrame([("99999999999999999999999999",), ("1e300",), ("1700000000000000000",)], "t string")
    got = cells.select(parse_timestamp_variant(F.parse_json("t")).alias("ts")).collect()
    assert [r["ts"] for r in got] == [None, None, dt.datetime(2023, 11, 14, 22, 13, 20)]


def test_litre_sum_keeps_extreme_and_long_values(spark):
    rows = [(1e30,), (0.1,), (0.2,), (None,), (1.23456789,)]
    total = lambda r: spark.createDataFrame(r, "v double").agg(A.joined_parts(*A.litre_parts(F.col("v")))).first()[0]
    assert total(rows) == 1e30
    assert total(rows[1:]) == pytest.approx(1.53456789, abs=1e-12)
    assert total([(0.1,)] * 10) == 1.0 and total([(None,)]) is None
    assert total([(float("inf"),), (1.0,)]) == float("inf")


def test_csv_reads_back_with_a_standard_reader(spark, tmp_path):
    rows = [(1, 'say "hi", then\\'), (2, '{"a": "b,c"}'), (3, "plain")]
    sinks.write_csv(spark.createDataFrame(rows, "id int, text string").coalesce(1), str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("part-*"))
    with open(part, newline="") as f:
        assert [(int(r["id"]), r["text"]) for r in csv.DictReader(f)] == rows


@pytest.mark.parametrize("text,kept", [("2025-10-22T01:02:03Z", True), ("2025-10-22", True), ("2025-10-22 01:02:03+02:00", True),
                                       ("12:30", False), ("2024", False), ("2025-10", False), ("", False)])
def test_only_iso_texts_are_ingest_times(spark, text, kept):
    now = F.lit("2000-01-01 00:00:00").cast("timestamp")
    got = spark.range(1).select(utc_datetime(F.lit(text), now).alias("t")).first()["t"]
    assert (got != dt.datetime(2000, 1, 1)) == kept


def test_mean_litres_are_taken_of_exact_sums(spark):
    """Two days of 74.855 on average: the exact decimal mean rounds half to even, whatever doubles would give."""
    daily = spark.createDataFrame([("75", 1, Decimal("149.21"), None), ("75", 2, Decimal("0.50"), None),
                                   ("9", 1, Decimal("1.000000"), 1e30), ("9", 2, None, 1e30)],
                                  "contador string, day int, water_exact decimal(38,6), water_rest double")
    stats = {r["contador"]: r["w"] for r in A.history_stats(daily.withColumn("history_count", F.lit(1))).select(
        "contador", F.bround("history_avg_water_l", 2).alias("w")).collect()}
    assert stats == {"75": 74.86, "9": 1e30}
