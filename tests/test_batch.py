"""End-to-end batch runs on the sample export and the worked anomaly case (FIXTURES.md §1, §4)."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from rillflow import sinks as K
from rillflow.plans.batch import BatchOptions, run_batch
from rillflow.sources import documents as D
from rillflow.sources import files as FL
from rillflow.operators.clean import light_clean
from rillflow.operators.flatten import flatten_readings
from rillflow.operators import anomaly as A

from fixtures import sample_document, worked_batch_document, worked_history_documents, write_json


def _tmp():
    return tempfile.mkdtemp(prefix="rillflow-test-", dir="/tmp")


def test_sample_export_flattens(spark):
    folder = _tmp()
    write_json(folder, "test_anomaly_over.json", sample_document())
    files = FL.discover(spark, directory=folder)
    recs = light_clean(D.normalize_records(D.scan_json_documents(spark, files), "r1"))
    readings = flatten_readings(recs)
    dated = A.with_day(readings)
    stats = A.day_stats(dated).collect()
    assert [(str(r.day.date()), r.readings, r.counters) for r in stats] == [("2025-10-22", 180, 3)]
    per = {r.contador: (r.n, r.litres) for r in readings.groupBy("contador").agg(
        F.count("*").alias("n"), F.sum("value_l").alias("litres")).collect()}
    assert per == {"C16SE010255": (80, 10400.0), "C16SC003896": (76, 8740.0), "97WWK12134": (24, 192.0)}


def test_worked_anomaly_case(spark):
    folder, hist = _tmp(), _tmp()
    write_json(folder, "batch_20251022.json", worked_batch_document())
    write_json(hist, "history.json", worked_history_documents())
    res = run_batch(spark, BatchOptions(directory=folder, history_file=f"{hist}/history.json", run_id="t1",
                                        as_of=dt.datetime(2025, 10, 23), write_stores=False))
    s = res.report.summary.first().asDict()
    assert s["status"] == "ok" and s["current_day"] == "2025-10-22" and s["current_day_partial"] is False
    assert s["compared_history_days"] == ["2025-10-21", "2025-10-20"]
    assert (s["current_counters"], s["history_counters"], s["history_readings"]) == (4, 4, 368)
    assert (s["expected_readings_total"], s["current_readings_total"]) == (160.0, 185)
    assert (s["below_threshold_counters"], s["above_threshold_counters"], s["anomalous_counters"],
            s["counters_without_history"]) == (1, 1, 2, 1)
    det = res.report.details.orderBy(F.desc("abs_delta_count"), "contador").collect()
    assert [(d.contador, d.anomaly_direction, d.delta_count, d.delta_percentage) for d in det] == [
        ("C16SE010255", "above_expected", 40.0, 100.0), ("C16SC003896", "below_expected", -20.0, 20.8)]
    assert [(d.expected_water_l, d.current_water_sum_l) for d in det] == [(5200.0, 10400.0), (11040.0, 8740.0)]
    nh = res.report.no_history.collect()
    assert [(r.contador, r.current_count, r.flag) for r in nh] == [("NEWMETER01", 5, "no_history_in_store")]
    assert res.file_counts == {"files_ok": 1, "files_error": 0}
    assert {k: res.result[k] for k in ("status", "mode", "files_selected", "records")} == {
        "status": "ok", "mode": "LOCAL_JSON_DIR", "files_selected": 1, "records": 1}
    assert all(v["status"] == "disabled" for v in res.stores.values())


def test_store_history_across_runs(spark):
    """Day 1..2 stored by earlier runs become the history of the day-3 run (store read, S7)."""
    store, out = _tmp() + "/store", _tmp()
    hist_docs = worked_history_documents()
    for i, doc in enumerate(hist_docs):
        folder = _tmp()
        write_json(folder, f"day_{i}.json", doc)
        run_batch(spark, BatchOptions(directory=folder, store_path=store, run_id=f"h{i}",
                                      as_of=dt.datetime(2025, 10, 21 + i)))
    folder = _tmp()
    write_json(folder, "batch.json", worked_batch_document())
    res = run_batch(spark, BatchOptions(directory=folder, store_path=store, run_id="t3", output_dir=out,
                                        as_of=dt.datetime(2025, 10, 23)))
    s = res.report.summary.first()
    assert (s.status, s.anomalous_counters, s.counters_without_history) == ("ok", 2, 1)
    assert res.stores["upsert"]["written"] == 1 and res.stores["upsert"]["table_count"] == 3
    record = spark.read.json(f"{out}/result").first()
    assert record["run_id"] == "t3" and record["started_at_utc"].startswith("2025-10-23T00:00:00")
    assert record["stores"]["upsert"]["written"] == 1 and record["anomalies"]["anomalous_counters"] == 2
    assert record["sample"][0]["_source_file"] == "batch.json" and record["output"]["csv_path"].endswith("records_csv")
    lines = [r.value for r in spark.read.text(f"{out}/records_json").collect()]
    assert len(lines) == 1 and json.loads(lines[0])["_run_id"] == "t3" and "header" in json.loads(lines[0])
    back = spark.read.json(f"{out}/anomaly_report/details").orderBy(F.desc("abs_delta_count")).collect()
    assert [r.contador for r in back] == ["C16SE010255", "C16SC003896"]


def test_bad_and_missing_files_are_isolated(spark):
    folder = _tmp()
    write_json(folder, "good_20251022.json", sample_document())
    with open(f"{folder}/bad_20251022.json", "w") as fh:
        fh.write('{"header": [')
    srcs = f"{folder}/good_20251022.json, {folder}/bad_20251022.json ,, {folder}/missing.json"
    files = FL.discover(spark, sources=srcs)
    good, bad, counts = D.file_parse_status(D.scan_json_documents(spark, files))
    assert counts.first().asDict() == {"files_ok": 1, "files_error": 2}
    assert sorted((r.name, r.error) for r in bad.collect()) == [("bad_20251022.json", "invalid JSON document"),
                                                               ("missing.json", "missing file")]


def test_dry_run_and_no_files(spark):
    empty = _tmp()
    res = run_batch(spark, BatchOptions(directory=empty))
    assert res.status == "error" and "No JSON files" in res.error
    assert res.result["files_listed"] == 0 and res.result["hint"] and res.result["performance"]["phase_seconds"]
    folder = _tmp()
    write_json(folder, "x.json", sample_document())
    res_store = _tmp() + "/s"
    res = run_batch(spark, BatchOptions(directory=folder, store_path=res_store, write_stores=False))
    assert res.stores["upsert"]["status"] == "skipped"
    s = res.report.summary.first()
    assert s.status == "skipped" and s.reason.startswith("No history found")
    rows = [(r.part, r.step) for r in res.profile.orderBy(F.col("step_no").asc_nulls_last(), "part").collect()]
    assert rows[0] == (0, "Pipeline started") and rows[-1] == (0, "Overall pipeline")
    assert [s for part, s in rows if part == 0][1:-1] == list(res.phase_seconds)
    assert (1, "... [upsert] skipped") in rows and any(s.startswith("... [anomaly] history read") for _, s in rows)
    assert not os.path.exists(res_store)


def test_run_log_appends(spark):
    folder, log = _tmp(), _tmp() + "/runlog"
    write_json(folder, "x.json", sample_document())
    for rid in ("a", "b"):
        run_batch(spark, BatchOptions(directory=folder, run_id=rid, run_log_path=log))
    back = spark.read.parquet(log)
    assert sorted(r.run_id for r in back.select("run_id").distinct().collect()) == ["a", "b"]
    steps = [r.step for r in back.where("run_id = 'a'").orderBy("step_no").collect()]
    assert steps[:3] == ["file_discovery", "download_and_normalize", "transform"]


def test_insert_store_through_batches(spark):
    folder, store = _tmp(), _tmp() + "/ins"
    write_json(folder, "x.json", sample_document())
    first = run_batch(spark, BatchOptions(directory=folder, insert_store_path=store, run_id="a"))
    again = run_batch(spark, BatchOptions(directory=folder, insert_store_path=store, run_id="b"))
    assert (first.stores["insert"]["inserted"], first.stores["insert"]["duplicates"]) == (1, 0)
    assert (again.stores["insert"]["inserted"], again.stores["insert"]["duplicates"]) == (0, 1)


def test_command_line_entry(spark):
    from rillflow.__main__ import main
    folder = _tmp()
    write_json(folder, "x.json", sample_document())
    out = main(["--directory", folder, "--run-id", "cli", "--dry-run", "--as-of", "2025-10-23T00:00:00"])
    assert out["status"] == "ok" and out["files_selected"] == 1 and out["anomalies"]["status"] == "skipped"


def test_a_failed_run_leaves_its_result(spark):
    folder, out, log = _tmp(), _tmp(), _tmp() + "/log"
    write_json(folder, "x.json", sample_document())
    with open(f"{out}/anomaly_report", "w") as fh:
        fh.write("in the way")
    res = run_batch(spark, BatchOptions(directory=folder, output_dir=out, run_log_path=log, run_id="f"))
    assert res.status == "error" and res.result["files_ok"] == 1 and res.error == res.result["error"]
    record = spark.read.json(f"{out}/result").first()
    assert record["status"] == "error" and record["run_id"] == "f" and record["records"] == 1
    assert "failed" in {r.step for r in spark.read.parquet(log).collect()}


def test_repeats_inside_a_document(spark):
    folder = _tmp()
    write_json(folder, "a.json", [{"a": 1}, 5, {"a": 1}, {"b": [1, {"c": 2}]}, 5, {"b": [1, {"c": 2}]}, {"value": 5}])
    write_json(folder, "b.json", [{"a": 1}])
    write_json(folder, "c.json", [])
    docs = D.scan_json_documents(spark, FL.discover(spark, directory=folder))
    one = D.normalize_records(docs, "r", ingested_at=F.lit("2025-01-01").cast("timestamp"), distinct=True)
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    got = sorted((r._source_file, r._rec_ord) for r in one.select("_source_file", "_rec_ord").collect())
    # a bare 5 and {"value": 5} are one record as a record, but two elements of the document
    assert got == [("a.json", 0), ("a.json", 1), ("a.json", 3), ("a.json", 6), ("b.json", 0)]


def test_flat_records_keep_cases_apart_and_stamps_win(spark):
    folder, out = _tmp(), _tmp()
    rows = [{"Date": "x", "date": "22/10/2025", "_run_id": "own", "n": [1, {"q": 'say "hi", now'}]}, {"n": None, "a`b": True, "_File_ord": 3}]
    write_json(folder, "a.json", rows)
    recs = D.normalize_records(D.scan_json_documents(spark, FL.discover(spark, directory=folder)), "r1",
                               ingested_at=F.lit("2025-01-01").cast("timestamp"), distinct=True)
    K.write_records_json(recs, f"{out}/j")
    K.write_records_csv(recs, f"{out}/c")
    lines = sorted((json.loads(r.value) for r in spark.read.text(f"{out}/j").collect()), key=lambda x: x["Date"] is None)
    assert [set(x) for x in lines] == [{"Date", "date", "n", "a`b", "_File_ord", "_source_file", "_ingested_at", "_run_id"}] * 2
    assert lines[0]["_run_id"] == "r1" and lines[0]["Date"] == "x" and lines[1]["a`b"] is True and lines[1]["n"] is None
    back = spark.read.option("header", True).option("escape", '"').csv(f"{out}/c")
    assert back.columns == ["Date", "_File_ord_2", "a`b", "date_2", "n", "_source_file", "_ingested_at", "_run_id"]
    cells = sorted((tuple(r) for r in back.collect()), key=lambda r: r[0] is None)
    assert cells[0][4] == '[1,{"q":"say \\"hi\\", now"}]' and cells[0][3] == "22/10/2025" and cells[1][1:3] == ("3", "true")
