"""Edge rows of FIXTURES.md §5: header/body matrix, falsy aliases, dedup, thresholds,
partial days, stores, status rules."""

import datetime as dt
import json
import tempfile

from pyspark.sql import functions as F

from rillflow.operators import anomaly as A
from rillflow.functions.identity import record_identity
from rillflow.operators import store as S
from rillflow.operators.anomaly_report import build_report
from rillflow.operators.clean import dedup_exact
from rillflow.operators.flatten import READINGS_SCHEMA, flatten_readings


def _records(spark, docs, source="f.json"):
    rows = [(json.dumps(d), source, i) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "j string, _source_file string, _rec_ord long")
    return df.select(F.parse_json("j").alias("payload"), "_source_file", F.lit("r").alias("_run_id"),
                     F.lit(dt.datetime(2025, 1, 1)).cast("timestamp").alias("_ingested_at"),
                     F.lit(0).alias("_file_ord"), "_rec_ord")


def _flat(spark, docs):
    return [r.asDict() for r in flatten_readings(_records(spark, docs)).orderBy("_rec_ord", "_body_pos").collect()]


def test_matrix_edges(spark):
    doc = {"header": [" Device ", "Valor (l)", "Data e hora", "Device"],
           "body": [["a", "1", "22/10/2025 01:00", "b"],   # duplicate header: last wins -> b
                    ["c", "2"],                            # short row: missing cells null
                    ["d", "3", "22/10/2025", "e", "extra"],  # long row: extra ignored
                    "not a row",                           # dropped
                    ["", "4", "22/10/2025", ""]]}          # no device, no alias: dropped
    out = _flat(spark, [doc])
    assert [(r["contador"], r["value_l"], r["_body_pos"]) for r in out] == [("b", 1.0, 0), ("c", 2.0, 1), ("e", 3.0, 2)]
    assert out[1]["timestamp"] is None and out[0]["timestamp"] == dt.datetime(2025, 10, 22, 1, 0)


def test_alias_only_and_missing_lists(spark):
    docs = [{"header": ["Nome", "value"], "body": [["m1", 5]]},
            {"header": "x", "body": [["a"]]}, {"body": [["a"]]}, {"header": ["Device"], "body": "rows"}]
    out = _flat(spark, docs)
    assert [(r["contador"], r["device"], r["alias"], r["value_l"]) for r in out] == [("m1", "", "m1", 5.0)]


def test_falsy_aliases(spark):
    doc = {"header": ["Device", "Valor (l)", "value_l"], "body": [["a", 0, None], ["b", "0", None], ["c", 0, 7]]}
    out = _flat(spark, [doc])
    assert [r["value_l"] for r in out] == [None, 0.0, 7.0]
    doc2 = {"header": ["Device", "value"], "body": [["a", 0]]}
    assert [r["value_l"] for r in _flat(spark, [doc2])] == [0.0]


def test_dedup_scope(spark):
    same = {"a": 1, "b": [1, 2]}
    recs = _records(spark, [same, {"b": [1, 2], "a": 1}, {"a": 2}])
    other = _records(spark, [same], source="g.json")
    out = dedup_exact(recs.unionByName(other.withColumn("_file_ord", F.lit(1))))
    got = sorted((r._source_file, r._rec_ord) for r in out.collect())
    assert got == [("f.json", 0), ("f.json", 2), ("g.json", 0)]
    body_dup = {"header": ["Device"], "body": [["x"], ["x"]]}
    assert len(_flat(spark, [body_dup])) == 2


def _readings(spark, rows):
    data = [(c, c, "", ts, v, "f", None, 0, i, 0) for i, (c, ts, v) in enumerate(rows)]
    return spark.createDataFrame(data, READINGS_SCHEMA)


def test_threshold_is_strict(spark):
    day = dt.datetime(2025, 10, 22)
    cur = [("m", day, 1.0)] * 76
    hist = [("m", day - dt.timedelta(days=1), 1.0)] * 95 + [("m", day - dt.timedelta(days=2), 1.0)] * 95
    rep = build_report(_readings(spark, cur), _readings(spark, hist))
    row = rep.comparison.first()
    assert row.expected_count == 95.0 and row.current_count == 76 and not row.is_low_anomaly


def test_partial_day_fallback(spark):
    days = [dt.datetime(2024, 1, d) for d in (27, 28, 29, 30)]
    rows = []
    for d, per in zip(days, (66, 67, 66, 18)):
        rows += [("m1", d, 1.0)] * per
    stats = A.day_stats(A.with_day(_readings(spark, rows)))
    sel = A.select_current_day(stats).first()
    assert sel.current_day == dt.datetime(2024, 1, 29) and sel.current_day_partial is True
    assert sel.current_day_selected_from == "2024-01-30"
    one = A.select_current_day(A.day_stats(A.with_day(_readings(spark, rows[-18:])))).first()
    assert one.current_day == dt.datetime(2024, 1, 30) and one.current_day_partial is False


def test_status_rules(spark):
    day = dt.datetime(2025, 10, 22)
    empty = _readings(spark, [])
    assert build_report(empty, empty).summary.first().reason == "No meter readings found in the current batch."
    no_ts = _readings(spark, [("m", None, 1.0)])
    assert build_report(no_ts, empty).summary.first().reason == "Current batch has no parseable timestamps."
    cur = _readings(spark, [("m", day, 1.0)])
    s = build_report(cur, empty).summary.first()
    assert s.reason.startswith("No history found") and s.current_readings == 1 and s.current_day is None
    s = build_report(cur, no_ts).summary.first()
    assert s.reason == "Historical store rows have no parseable timestamps."
    old = _readings(spark, [("m", day - dt.timedelta(days=9), 1.0)])
    s = build_report(cur, old).summary.first()
    assert s.reason == "No historical rows available in the 2 day window before 2025-10-22."
    assert s.current_day == "2025-10-22"


def test_store_modes(spark):
    path_i = tempfile.mkdtemp(dir="/tmp") + "/ins"
    path_u = tempfile.mkdtemp(dir="/tmp") + "/ups"
    recs = _records(spark, [{"a": 1}, {"a": 1}, {"a": 2}])
    t1 = dt.datetime(2025, 1, 1)
    r = S.insert_absent(spark, path_i, recs, "r1", t1)
    assert (r["inserted"], r["duplicates"], r["total"]) == (2, 1, 3)
    rerun = _records(spark, [{"a": 1}]).withColumn("_run_id", F.lit("other"))
    r2 = S.insert_absent(spark, path_i, rerun, "r2", dt.datetime(2025, 1, 2))
    assert (r2["inserted"], r2["duplicates"]) == (0, 1)
    u = S.upsert(spark, path_u, recs, "r1", t1)
    assert (u["written"], u["table_count"]) == (3, 2)
    cur = S.current(spark, path_u).orderBy("_rec_ord").collect()
    assert [c._rec_ord for c in cur] == [1, 2]  # last record of a repeated id wins
    assert S.insert_absent(spark, path_i, recs, "r1", t1) == r and S.upsert(spark, path_u, recs, "r1", t1) == u  # run again
    assert S.read_versions(spark, path_i).count() == S.read_versions(spark, path_u).count() == 2
    assert S.write_stats(spark, path_u, "r1", t1).first().asDict() == {"written": 3, "table_count": 2}


def test_table_count_survives_missing_log_row(spark):
    path = tempfile.mkdtemp(dir="/tmp") + "/ups"
    recs = _records(spark, [{"a": 1}, {"a": 2}])
    S.upsert(spark, path, recs, "r1", dt.datetime(2025, 1, 1))
    # a write whose job died after the data commit, before its log row
    t2 = dt.datetime(2025, 1, 2)
    no, key = S._write_of(spark, path, "r2", t2, None)
    S._put(spark, path, S._placed(spark, path, S.to_store_rows(_records(spark, [{"a": 3}]), "r2", t2), no, key))
    assert S.table_count(spark, path) == 3 == S.exact_table_count(spark, path)
    assert S.upsert(spark, path, _records(spark, [{"a": 3}]), "r2", t2) == {"status": "ok", "written": 1, "table_count": 3}
    assert S.read_log(spark, path).count() == 2 and S.read_versions(spark, path).count() == 3


def test_newest_version_by_write_not_by_clock(spark):
    path = tempfile.mkdtemp(dir="/tmp") + "/it's a store"
    late, early = dt.datetime(2025, 3, 1), dt.datetime(2025, 1, 1)
    S.upsert(spark, path, _records(spark, [{"a": 1}, {"a": 2}]), "r1", late, buckets=3)
    S.upsert(spark, path, _records(spark, [{"a": 2}, {"a": 3}]), "fill", early)
    got = {r.payload_json: r.run_id for r in S.current(spark, path).collect()}
    assert got == {'{"a":1}': "r1", '{"a":2}': "fill", '{"a":3}': "fill"}
    since = S.current(spark, path, saved_since=dt.datetime(2025, 2, 1))
    assert [r.payload_json for r in since.collect()] == ['{"a":1}']
    assert S.current(spark, path, saved_since=dt.datetime(2026, 1, 1)).count() == 0
    assert S.current(spark, path + "-none").count() == 0 == S.table_count(spark, path + "-none")


def test_stored_versions_are_not_shuffled(spark):
    path = tempfile.mkdtemp(dir="/tmp") + "/s"
    S.upsert(spark, path, _records(spark, [{"a": 1}, {"a": 2}]), "r1", dt.datetime(2025, 1, 1))
    plan = S.current(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan and "SortAggregate" not in plan
    ids = S.read_versions(spark, path).select("id").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in ids


def test_volatile_keys_are_no_part_of_the_identity(spark):
    t = dt.datetime(2025, 1, 1)
    plain, stamped = {"a": {"_run_id": "kept"}}, {"a": {"_run_id": "kept"}, "_run_id": "x", "_saved_at": 1, "_last_run_id": None}
    ids = [r.id for r in S.to_store_rows(_records(spark, [plain, stamped, {"a": {}}]), "r", t).orderBy("_rec_ord").collect()]
    assert ids[0] == ids[1] != ids[2]
    direct = [r.id for r in _records(spark, [plain, stamped, {"a": {}}]).orderBy("_rec_ord").select(
        record_identity(F.col("payload"), F.col("_source_file")).alias("id")).collect()]
    assert direct == ids


def test_phase_profile_split_ranges(spark):
    from rillflow.operators.report import phase_profile
    rows = [("a", i, f"s{i}", 0.25 * (i % 7)) for i in range(50)] + [("b", 3, "x", 1.5), ("b", 1, "y", 2.0)]
    log = spark.createDataFrame(rows, "run_id string, step_no int, step string, seconds double")
    got = {(r.run_id, r.step_no): r.cumulative_seconds for r in phase_profile(log, step_range=8).collect()}
    acc = {}
    for run, step, _n, sec in sorted(rows, key=lambda x: (x[0], x[1])):
        acc[run] = acc.get(run, 0.0) + sec
        assert abs(got[(run, step)] - round(acc[run], 2)) < 1e-9


def test_compact_keeps_current_view(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    path = base + "/ups"
    S.upsert(spark, path, _records(spark, [{"a": 1}, {"a": 2}]), "r1", dt.datetime(2025, 1, 1))
    S.upsert(spark, path, _records(spark, [{"a": 2}, {"a": 3}]), "r2", dt.datetime(2025, 1, 2))
    new = S.compact(spark, path, base + "/compacted")
    cols = ["id", "run_id", "payload_json"]
    before = sorted(tuple(r) for r in S.current(spark, path).select(*cols).collect())
    after = sorted(tuple(r) for r in S.current(spark, new).select(*cols).collect())
    assert before == after and len(after) == 3
    assert S.read_versions(spark, new).count() == 3 and S.table_count(spark, new) == 3
