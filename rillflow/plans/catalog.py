"""Driver query catalogue: ``name -> (spark, sf_dir) -> DataFrame`` and DuckDB oracle SQL.

Each query runs the library's operators on a stand-in input bound from the test tables
(``rillflow.plans.bindings``) and projects report columns under the same names the
oracle SQL uses. Dates are rendered as ``yyyy-MM-dd`` text on both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators import anomaly as A
from rillflow.operators import report as R
from rillflow.operators.anomaly_report import build_report
from rillflow.plans import bindings as B
from rillflow.plans.batch import BatchOptions, run_batch
from rillflow.plans.sql import anomaly_ctes, r
from rillflow import functions as RF
from rillflow import sinks as K
from rillflow.operators import clean as C
from rillflow.operators import store as S
from rillflow.operators.flatten import flatten_readings
from rillflow.session import scratch_path
from rillflow.sources import documents as D
from rillflow.sources import files as FL
from rillflow.sources.history import history_from_file, history_from_store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _report(spark, sf_dir, key="user_id", before=None, lookback=2):
    readings = B.events_as_readings(spark, sf_dir, key, before)
    return build_report(readings, readings, A.AnomalyParams.of(lookback), run_id=None)


# ------------------------------------------------------------------ anomaly core
ANOMALY = anomaly_ctes()


@register("day_stats", ANOMALY + "SELECT strftime(day, '%Y-%m-%d') AS day, readings, counters, avg_per_counter FROM ds")
def q_day_stats(spark, sf_dir):
    return _report(spark, sf_dir).day_stats.select(_day("day").alias("day"), "readings", "counters", "avg_per_counter")


_SEL_SQL = ("SELECT strftime(current_day, '%Y-%m-%d') AS current_day, current_day_partial, current_day_selected_from, "
            "strftime(latest_day, '%Y-%m-%d') AS latest_day, latest_avg, baseline_avg, n_days FROM sel")


def _sel(rep):
    s = rep.selection
    return s.select(_day("current_day").alias("current_day"), "current_day_partial", "current_day_selected_from",
                    _day("latest_day").alias("latest_day"), "latest_avg", "baseline_avg", "n_days")


@register("current_day_select", ANOMALY + _SEL_SQL)
def q_current_day_select(spark, sf_dir):
    return _sel(_report(spark, sf_dir))


@register("current_day_select_partial", anomaly_ctes(key="event_type", before="2024-01-30 06:00:00") + _SEL_SQL)
def q_current_day_select_partial(spark, sf_dir):
    """W2 fallback case: meters by event type, batch cut at 2024-01-30 06:00 (a partial last day)."""
    return _sel(_report(spark, sf_dir, key="event_type", before="2024-01-30 06:00:00"))


@register("current_counts", ANOMALY + f"SELECT contador, device, alias, current_count, "
          f"{r('current_water_sum_l')} AS current_water_sum_l FROM cc")
def q_current_counts(spark, sf_dir):
    cc = _report(spark, sf_dir).current_counts
    return cc.select("contador", "device", "alias", "current_count",
                     F.bround("current_water_sum_l", 2).alias("current_water_sum_l"))


@register("history_window", ANOMALY + "SELECT contador, ord AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, "
          "value_l FROM hw")
def q_history_window(spark, sf_dir):
    hw = _report(spark, sf_dir).history_window
    return hw.select("contador", F.col("_rec_ord").alias("event_id"),
                     F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value_l")


@register("history_daily", ANOMALY + f"SELECT contador, strftime(day, '%Y-%m-%d') AS day, history_count, "
          f"{r('history_water_l')} AS history_water_l FROM hd")
def q_history_daily(spark, sf_dir):
    hd = _report(spark, sf_dir).history_daily
    return hd.select("contador", _day("day").alias("day"), "history_count",
                     F.bround("history_water_l", 2).cast("double").alias("history_water_l"))


@register("history_recent_topn", anomaly_ctes(topn=1) + "SELECT contador, strftime(day, '%Y-%m-%d') AS day, "
          "history_count FROM hr")
def q_history_recent_topn(spark, sf_dir):
    """W3 with N=1: each meter's most recent day inside the 2-day window."""
    rep = _report(spark, sf_dir)
    recent = A.history_recent(rep.history_daily, 1)
    return recent.select("contador", _day("day").alias("day"), "history_count")


@register("history_stats", ANOMALY + f"SELECT contador, history_avg, history_median, history_min, history_max, "
          f"history_days, {r('history_avg_water_l')} AS history_avg_water_l FROM hs")
def q_history_stats(spark, sf_dir):
    hs = _report(spark, sf_dir).history_stats
    return hs.select("contador", "history_avg", "history_median", "history_min", "history_max", "history_days",
                     F.bround("history_avg_water_l", 2).alias("history_avg_water_l"))


@register("anomaly_comparison", ANOMALY + "SELECT contador, current_count, expected_count, has_history, count_ratio, "
          f"{r('expected_water_l')} AS expected_water_l FROM fl2")
def q_anomaly_comparison(spark, sf_dir):
    c = _report(spark, sf_dir).comparison
    return c.select("contador", "current_count", "expected_count", "has_history", "count_ratio",
                    F.bround("expected_water_l", 2).alias("expected_water_l"))


@register("anomaly_flags", ANOMALY + "SELECT contador, is_low_anomaly, is_high_anomaly, is_anomaly FROM fl2")
def q_anomaly_flags(spark, sf_dir):
    return _report(spark, sf_dir).comparison.select("contador", "is_low_anomaly", "is_high_anomaly", "is_anomaly")


@register("anomaly_details", ANOMALY + "SELECT * FROM det")
def q_anomaly_details(spark, sf_dir):
    return _report(spark, sf_dir).details


@register("no_history", ANOMALY + "SELECT * FROM nh")
def q_no_history(spark, sf_dir):
    return _report(spark, sf_dir).no_history


@register("no_history_preview", ANOMALY + """
SELECT (SELECT COUNT(*) FROM nh) AS without_history,
       COALESCE((SELECT string_agg(contador, ', ' ORDER BY contador) FROM (SELECT contador FROM nh ORDER BY contador LIMIT 10)), '')
       || CASE WHEN (SELECT COUNT(*) FROM nh) > 10 THEN '...' ELSE '' END AS preview""")
def q_no_history_preview(spark, sf_dir):
    return R.no_history_preview(_report(spark, sf_dir).no_history)


@register("compared_days", ANOMALY + "SELECT compared_history_days FROM cd")
def q_compared_days(spark, sf_dir):
    days = _report(spark, sf_dir).compared_days
    return days.select(F.array_join("compared_history_days", ", ").alias("compared_history_days"))


_TOP10_SQL = ANOMALY + f""",
top AS (SELECT * FROM det ORDER BY abs_delta_count DESC, contador ASC LIMIT 10),
t1 AS (
  SELECT contador, abs_delta_count, expected_water_l, current_water_sum_l AS current_water_l,
         {r('current_water_sum_l - expected_water_l')} AS delta_water_l,
         CAST(round_even(CAST(expected_count_n AS DECIMAL(38,10)), 0) AS BIGINT) AS expected_n,
         CAST(current_count_n AS BIGINT) AS current_n, anomaly_direction
  FROM top),
t2 AS (
  SELECT *, current_n - expected_n AS delta_n,
    CASE WHEN expected_water_l > 0 THEN {r('abs(delta_water_l) / expected_water_l * 100', 1)}
         WHEN current_water_l = 0 THEN 0.0 ELSE 100.0 END AS delta_water_pct
  FROM t1),
t3 AS (
  SELECT *, CASE WHEN expected_n > 0 THEN {r('abs(delta_n) / expected_n * 100', 1)}
                 WHEN current_n = 0 THEN 0.0 ELSE 100.0 END AS delta_n_pct
  FROM t2)
SELECT contador, expected_water_l, current_water_l, delta_water_l, delta_water_pct, expected_n, current_n, delta_n,
       delta_n_pct,
       CASE WHEN delta_water_pct = 0.0 THEN 'expected' ELSE anomaly_direction END AS water_label,
       CASE WHEN delta_n_pct = 0.0 THEN 'expected' ELSE anomaly_direction END AS n_label,
       ROW_NUMBER() OVER (ORDER BY abs_delta_count DESC, contador ASC) AS rank
FROM t3"""


@register("anomaly_top10", _TOP10_SQL)
def q_anomaly_top10(spark, sf_dir):
    return R.top_anomalies(_report(spark, sf_dir).details)


_SUMMARY_SQL = ANOMALY + f""",
tot AS (
  SELECT COUNT(*) AS current_counters,
         CAST(round_even(COALESCE(SUM(CAST(expected_count AS DECIMAL(30,10))), 0), 2) AS DOUBLE) AS expected_readings_total,
         CAST(COALESCE(SUM(current_count), 0) AS BIGINT) AS current_readings_total,
         COUNT(*) FILTER (WHERE is_low_anomaly) AS below_threshold_counters,
         COUNT(*) FILTER (WHERE is_high_anomaly) AS above_threshold_counters,
         COUNT(*) FILTER (WHERE is_anomaly) AS anomalous_counters,
         COUNT(*) FILTER (WHERE NOT has_history) AS counters_without_history
  FROM fl2),
n AS (
  SELECT (SELECT COUNT(*) FROM r) AS n_ts, (SELECT COUNT(*) FROM cur) AS n_day, (SELECT COUNT(*) FROM hw) AS n_win,
         (SELECT COUNT(*) FROM hs) AS history_counters)
SELECT CASE WHEN n_win > 0 THEN 'ok' ELSE 'skipped' END AS status,
       strftime((SELECT current_day FROM sel), '%Y-%m-%d') AS current_day,
       (SELECT current_day_selected_from FROM sel) AS current_day_selected_from,
       (SELECT current_day_partial FROM sel) AS current_day_partial,
       (SELECT compared_history_days FROM cd) AS compared_history_days,
       n_day AS current_readings, tot.current_counters, n_win AS history_readings, history_counters,
       expected_readings_total, current_readings_total, below_threshold_counters, above_threshold_counters,
       anomalous_counters, counters_without_history
FROM tot, n"""


@register("anomaly_summary", _SUMMARY_SQL)
def q_anomaly_summary(spark, sf_dir):
    s = _report(spark, sf_dir).summary
    return s.select("status", "current_day", "current_day_selected_from", "current_day_partial",
                    F.array_join("compared_history_days", ", ").alias("compared_history_days"),
                    "current_readings", "current_counters", "history_readings", "history_counters",
                    "expected_readings_total", "current_readings_total", "below_threshold_counters",
                    "above_threshold_counters", "anomalous_counters", "counters_without_history")


# ------------------------------------------------------------------ documents and records


_DOC_KEY_SQL = "strftime(ts, '%Y%m%d') || '_' || CAST(event_id // 256 AS VARCHAR)"


def _scanned(spark, sf_dir):
    folder = B.write_event_documents(spark, sf_dir)
    return D.scan_json_documents(spark, B.document_files(folder))


@register("scan_json_documents", f"""
SELECT 'meter_' || {_DOC_KEY_SQL} || '.json' AS name, COUNT(*) AS body_rows FROM events GROUP BY 1
UNION ALL
SELECT DISTINCT 'meter_' || strftime(ts, '%Y%m%d') || '_bad.json' AS name, CAST(NULL AS BIGINT) AS body_rows FROM events""")
def q_scan_json_documents(spark, sf_dir):
    """Every written file read whole and parsed; broken files give a null document."""
    docs = _scanned(spark, sf_dir)
    body = F.try_variant_get(F.col("doc"), "$.body", "array<variant>")
    return docs.select("name", F.size(body).cast("long").alias("body_rows")).select(
        "name", F.when(F.col("body_rows") >= 0, F.col("body_rows")).alias("body_rows"))


@register("file_parse_status", f"""
SELECT (SELECT COUNT(DISTINCT {_DOC_KEY_SQL}) FROM events) AS files_ok,
       (SELECT COUNT(DISTINCT strftime(ts, '%Y%m%d')) FROM events) AS files_error""")
def q_file_parse_status(spark, sf_dir):
    """Good / broken file counts of a folder holding one broken export per day."""
    _good, _bad, counts = D.file_parse_status(_scanned(spark, sf_dir))
    return counts


_FLAT_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS contador, CAST(user_id AS VARCHAR) AS device, event_type AS alias,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value AS value_l,
       'meter_' || {_DOC_KEY_SQL} || '.json' AS source_file,
       CAST(ROW_NUMBER() OVER (PARTITION BY {_DOC_KEY_SQL} ORDER BY event_id) - 1 AS INTEGER) AS _body_pos
FROM events"""


def _flat_docs(spark, sf_dir):
    records = C.normalize_dates(D.normalize_records(_scanned(spark, sf_dir), run_id="run-1", distinct=True))
    return flatten_readings(records)


@register("flatten_readings", _FLAT_SQL)
def q_flatten_readings(spark, sf_dir):
    """A1/A2: header x body documents (written from events) -> readings, after dedup."""
    r = _flat_docs(spark, sf_dir)
    return r.select("contador", "device", "alias",
                    F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value_l",
                    "source_file", "_body_pos")


@register("history_from_file", ANOMALY + "SELECT * FROM det")
def q_history_from_file(spark, sf_dir):
    """History read from the document folder (broken files skipped) drives the anomaly details."""
    folder = B.write_event_documents(spark, sf_dir)
    current = B.events_as_readings(spark, sf_dir)
    hist = history_from_file(spark, folder)
    return build_report(current, hist, A.AnomalyParams.of(2)).details


_NORM_SQL = """
SELECT 'e' || CAST(event_id AS VARCHAR) AS _source_file, 0 AS _rec_ord, 'k' AS keys,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS value
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT 'e' || CAST(event_id AS VARCHAR), CASE WHEN event_type = 'click' THEN 1 ELSE 0 END, 'value', NULL,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END
FROM events WHERE event_type IN ('click', 'purchase', 'error')"""


def _norm_records(spark, sf_dir):
    return D.normalize_records(B.event_document_texts(spark, sf_dir), run_id="run-1")


@register("normalize_records", _NORM_SQL)
def q_normalize_records(spark, sf_dir):
    """Object -> 1 record, list -> 1 per element (scalars wrapped), scalar -> {value}, [] -> none."""
    recs = _norm_records(spark, sf_dir)
    keys = F.array_join(F.array_sort(F.map_keys(F.col("payload").try_cast("map<string,variant>"))), ",")
    return recs.select("_source_file", F.col("_rec_ord").cast("int").alias("_rec_ord"), keys.alias("keys"),
                       F.try_variant_get("payload", "$.k", "bigint").alias("k"),
                       F.try_variant_get("payload", "$.value", "double").alias("value"))


@register("schema_union", _NORM_SQL.replace("'k' AS keys,", "").replace("'value', NULL,", "NULL,"))
def q_schema_union(spark, sf_dir):
    """One column per key seen in any record, missing keys null."""
    wide = D.schema_union(_norm_records(spark, sf_dir))
    return wide.select("_source_file", F.col("_rec_ord").cast("int").alias("_rec_ord"),
                       F.col("k").try_cast("bigint").alias("k"), F.col("value").try_cast("double").alias("value"))


# ------------------------------------------------------------------ parsing
@register("parse_litres", f"""
SELECT event_id, event_type,
  CASE event_type WHEN 'purchase' THEN {r('value * 1000')} WHEN 'signup' THEN NULL ELSE value END AS litres
FROM events""")
def q_parse_litres(spark, sf_dir):
    """F2 on export-style text: comma decimals, padded, thousands separators, NBSP, unparseable."""
    ev = B.table(spark, sf_dir, "events")
    t = F.col("event_type")
    plain = F.col("value").cast("string")
    text = (F.when(t == "view", F.translate(plain, ".", ","))
            .when(t == "click", F.concat(F.lit("  "), plain, F.lit(" ")))
            .when(t == "purchase", F.format_number(F.col("value") * 1000, 2))
            .when(t == "signup", F.lit("n/a"))
            .otherwise(F.concat(F.lit(" "), plain)))
    return ev.select("event_id", "event_type", RF.parse_litres_text(text).alias("litres"))


@register("parse_timestamps", """
SELECT event_id, strftime(CASE event_type
    WHEN 'click' THEN date_trunc('minute', ts)
    WHEN 'signup' THEN CASE WHEN day(ts) <= 12
        THEN make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), second(ts))
        ELSE date_trunc('second', ts) END
    ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS ts
FROM events""")
def q_parse_timestamps(spark, sf_dir):
    """F3 (day first): d/M/y, d/M/y H:mm, ISO, M/d/y (read day first when both fit), d MMM y."""
    ev = B.table(spark, sf_dir, "events")
    t = F.col("event_type")
    text = (F.when(t == "view", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
            .when(t == "click", F.date_format("ts", "d/M/yyyy H:mm"))
            .when(t == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(t == "signup", F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
            .otherwise(F.date_format("ts", "d MMM yyyy HH:mm:ss")))
    parsed = RF.with_timestamp(ev.select("event_id", text.alias("text")), F.col("text"), "parsed")
    return parsed.select("event_id", F.date_format("parsed", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("readings_clean", """
SELECT CAST(user_id AS VARCHAR) AS contador, event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM events WHERE event_type <> 'error'""")
def q_readings_clean(spark, sf_dir):
    """P5: readings whose time text does not parse (error events log 'n/a') are dropped."""
    ev = B.table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    readings = RF.with_timestamp(ev.select(F.col("user_id").cast("string").alias("contador"), "event_id",
                                           text.alias("text")), F.col("text"), "timestamp")
    kept = C.readings_clean(readings)
    return kept.select("contador", "event_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("normalize_dates", """
SELECT event_id, CASE event_type
    WHEN 'view' THEN strftime(date_trunc('second', ts) - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 'purchase' THEN CASE WHEN day(ts) <= 12
        THEN strftime(make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), second(ts)), '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END
    WHEN 'error' THEN NULL
    ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') END AS timestamp
FROM events""")
def q_normalize_dates(spark, sf_dir):
    """F4 on records: zoned ISO -> UTC, M/d/y, d/M/y (month first when both fit), naive ISO, garbage -> null."""
    ev = B.table(spark, sf_dir, "events")
    t = F.col("event_type")
    text = (F.when(t == "view", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
            .when(t == "click", F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
            .when(t == "purchase", F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
            .when(t == "signup", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.lit("garbage")))
    recs = ev.withColumn("text", text).withColumn("timestamp", F.col("text"))
    recs = B.event_records(spark, sf_dir, fields=("event_id", "timestamp"), source=recs)
    out = C.normalize_dates(recs)
    return out.select(F.try_variant_get("payload", "$.event_id", "bigint").alias("event_id"),
                      F.try_variant_get("payload", "$.timestamp", "string").alias("timestamp"))


@register("ingested_at_utc", """
SELECT event_id, strftime(CASE event_type
    WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
    WHEN 'signup' THEN TIMESTAMP '2024-02-01 00:00:00'
    WHEN 'error' THEN TIMESTAMP '2024-02-01 00:00:00'
    ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM events""")
def q_ingested_at_utc(spark, sf_dir):
    """ISO with Z, with +02:00, naive; empty and invalid fall back to the run's now."""
    ev = B.table(spark, sf_dir, "events")
    t = F.col("event_type")
    text = (F.when(t == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(t == "click", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
            .when(t == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(t == "signup", F.lit(""))
            .otherwise(F.lit("bad")))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return ev.select("event_id", F.date_format(RF.utc_datetime(text, now), "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


# ------------------------------------------------------------------ files
_NAME_SQL = ("CASE WHEN event_type = 'view' THEN 'src_view_' || CAST(event_id AS VARCHAR) || '.json' "
             "ELSE 'src_' || strftime(ts, '%Y%m%d') || '_' || CAST(event_id AS VARCHAR) || '.json' END")
_BASE = "/data/meters"


def _file_list(spark, sf_dir):
    """S5 cascade: no explicit sources and no folder given, so the named list wins."""
    files = FL.list_candidate_files(spark, sources="", directory=None, base=_BASE, names=B.derived_file_names(spark, sf_dir))
    return files.withColumn("_file_ord", F.col("_file_ord").cast("int"))


@register("list_candidate_files", f"""
SELECT {_NAME_SQL} AS name, '{_BASE}/' || {_NAME_SQL} AS source, 'REPO_JSON_FILES' AS mode,
       CAST(ROW_NUMBER() OVER (ORDER BY event_id) - 1 AS INTEGER) AS _file_ord
FROM events""")
def q_list_candidate_files(spark, sf_dir):
    return _file_list(spark, sf_dir)


@register("file_date_window", f"""
SELECT {_NAME_SQL} AS name FROM events
WHERE event_type = 'view' OR CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'""")
def q_file_date_window(spark, sf_dir):
    """P3 + F1: end date 2024-01-20, 5 days back, names without a date always kept."""
    return FL.apply_date_window(_file_list(spark, sf_dir), "2024-01-20", 5).select("name")


@register("file_limit", f"SELECT {_NAME_SQL} AS name FROM events ORDER BY event_id LIMIT 100")
def q_file_limit(spark, sf_dir):
    """O1: the first 100 files in list order."""
    return FL.limit_files(_file_list(spark, sf_dir), 100).select("name")


@register("file_sample", f"SELECT name FROM (SELECT {_NAME_SQL} AS name, event_id FROM events) "
          "ORDER BY md5(name || '7'), event_id LIMIT 30")
def q_file_sample(spark, sf_dir):
    """O2: exact-size sample (30) of a named list, reproducible md5 order with seed 7."""
    return FL.sample_files(_file_list(spark, sf_dir), 30, seed=7).select("name")


_DOC_NAMES_SQL = f"""(SELECT DISTINCT 'meter_' || {_DOC_KEY_SQL} || '.json' AS name, CAST(ts AS DATE) AS day FROM events
  UNION SELECT DISTINCT 'meter_' || strftime(ts, '%Y%m%d') || '_bad.json', CAST(ts AS DATE) FROM events)"""


@register("list_folder_files", f"""
SELECT name, 'LOCAL_JSON_DIR' AS mode FROM {_DOC_NAMES_SQL} WHERE day BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'""")
def q_list_folder_files(spark, sf_dir):
    """S2 + P3: a folder's files, the date window applied while the folder is listed."""
    files = B.document_files(B.write_event_documents(spark, sf_dir))
    return FL.apply_date_window(files, "2024-01-20", 5).listing(spark).select("name", "mode")


@register("scan_folder_window", f"""
SELECT name, body_rows FROM (
  SELECT 'meter_' || {_DOC_KEY_SQL} || '.json' AS name, CAST(ts AS DATE) AS day, COUNT(*) AS body_rows FROM events GROUP BY 1, 2
  UNION ALL
  SELECT DISTINCT 'meter_' || strftime(ts, '%Y%m%d') || '_bad.json', CAST(ts AS DATE), CAST(NULL AS BIGINT) FROM events)
WHERE day BETWEEN DATE '2024-01-15' AND DATE '2024-01-20' ORDER BY name LIMIT 12""")
def q_scan_folder_window(spark, sf_dir):
    """S1 + S2 + P3 + O1: the first 12 files of the date window, scanned; files outside it are not opened."""
    files = B.document_files(B.write_event_documents(spark, sf_dir))
    chosen = FL.limit_files(FL.apply_date_window(files, "2024-01-20", 5), 12, spark)
    docs = D.scan_json_documents(spark, chosen)
    body = F.size(F.try_variant_get(F.col("doc"), "$.body", "array<variant>")).cast("long")
    return docs.select("name", body.alias("n")).select("name", F.when(F.col("n") >= 0, F.col("n")).alias("body_rows"))


@register("explicit_sources", """
SELECT event_id, 0 AS pos, event_type || '_' || CAST(event_id AS VARCHAR) || '.json' AS name,
       '/in/' || event_type || '_' || CAST(event_id AS VARCHAR) || '.json' AS source FROM events
UNION ALL
SELECT event_id, 1, CAST(user_id AS VARCHAR) || '.json', 's3://bucket/' || event_type || '/' || CAST(user_id AS VARCHAR) || '.json' FROM events
WHERE event_type <> 'error'""")
def q_explicit_sources(spark, sf_dir):
    """S3 on a column: comma-separated sources with blanks and empty entries, split and named."""
    ev = B.table(spark, sf_dir, "events")
    one = F.concat(F.lit("  /in/"), F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".json"))
    two = F.when(F.col("event_type") != "error", F.concat(F.lit("s3://bucket/"), F.col("event_type"), F.lit("/"),
                                                          F.col("user_id").cast("string"), F.lit(".json "))).otherwise(F.lit(" "))
    text = F.concat(one, F.lit(" , ,"), two, F.lit(","))
    split = ev.select("event_id", F.posexplode(FL.split_sources(text)).alias("pos", "s"))
    return split.select("event_id", "pos", "s.name", "s.source")


@register("batch_sample", "SELECT event_id, event_type, user_id FROM events ORDER BY event_id LIMIT 5")
def q_batch_sample(spark, sf_dir):
    """First 5 records of the batch."""
    s = R.batch_sample(B.event_records(spark, sf_dir))
    return s.select(F.try_variant_get("payload", "$.event_id", "bigint").alias("event_id"),
                    F.try_variant_get("payload", "$.event_type", "string").alias("event_type"),
                    F.try_variant_get("payload", "$.user_id", "bigint").alias("user_id"))


# ------------------------------------------------------------------ dedup and identity
@register("dedup_exact", """
SELECT event_id, 'events.json' AS _source_file, event_id * 2 AS _rec_ord FROM events
UNION ALL
SELECT event_id, 'redelivered.json', event_id FROM events""")
def q_dedup_exact(spark, sf_dir):
    """Every event twice in one file plus once in a re-delivered file -> one per file."""
    ev = B.table(spark, sf_dir, "events")
    base = B.event_records(spark, sf_dir, fields=("event_id", "event_type", "user_id", "value"), source=ev)
    a = base.withColumn("_source_file", F.lit("events.json")).withColumn("_rec_ord", F.col("_rec_ord") * 2)
    b = a.withColumn("_rec_ord", F.col("_rec_ord") + 1)
    c = base.withColumn("_source_file", F.lit("redelivered.json")).withColumn("_file_ord", F.lit("1"))
    out = C.dedup_exact(a.unionByName(b).unionByName(c))
    return out.select(F.try_variant_get("payload", "$.event_id", "bigint").alias("event_id"), "_source_file",
                      "_rec_ord")


@register("dedup_in_documents", """
SELECT event_id, 'e' || CAST(event_id AS VARCHAR) AS _source_file, r AS _rec_ord
FROM events, (SELECT unnest([0, 2]) AS r) WHERE r = 0 OR event_type <> 'error'
UNION ALL
SELECT event_id, 'redelivered_' || CAST(event_id AS VARCHAR), 0 FROM events""")
def q_dedup_in_documents(spark, sf_dir):
    """W4 inside a document: every event's file holds it twice, then a second record twice (errors: the first again); a
    re-delivered file holds it once. The first of equal records stays, with its place in the file."""
    ev = B.table(spark, sf_dir, "events")
    one = F.to_json(F.struct("event_id", "event_type", "value"))
    two = F.when(F.col("event_type") == "error", one).otherwise(F.to_json(F.struct("event_id", "user_id")))
    text = F.concat(F.lit("["), F.concat_ws(",", one, one, two, two, one), F.lit("]"))
    eid = F.col("event_id").cast("string")
    docs = ev.select(F.concat(F.lit("e"), eid).alias("name"), F.lit("").alias("_file_ord"), F.try_parse_json(text).alias("doc"))
    again = ev.select(F.concat(F.lit("redelivered_"), eid).alias("name"), F.lit("").alias("_file_ord"),
                      F.try_parse_json(one).alias("doc"))
    recs = D.normalize_records(docs.unionByName(again), run_id="run-1", distinct=True)
    return recs.select(F.try_variant_get("payload", "$.event_id", "bigint").alias("event_id"), "_source_file", "_rec_ord")


_ID_JSON = ("'{\"_source_file\":\"events_' || strftime(ts, '%Y%m%d') || '.json\",\"payload\":{\"event_id\":' || "
            "CAST(event_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || "
            "CAST(user_id AS VARCHAR) || '}}'")


@register("record_identity", f"SELECT event_id, sha256({_ID_JSON}) AS id FROM events")
def q_record_identity(spark, sf_dir):
    """SHA-256 of the canonical JSON of (payload, source file); stamps excluded."""
    recs = B.event_records(spark, sf_dir)
    return recs.select(F.try_variant_get("payload", "$.event_id", "bigint").alias("event_id"),
                       RF.record_identity(F.col("payload"), F.col("_source_file")).alias("id"))


# ------------------------------------------------------------------ stores
T1 = _dt.datetime(2024, 1, 21)
T2 = _dt.datetime(2024, 1, 31)


def _batches(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events")
    b1 = B.event_records(spark, sf_dir, source=ev.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    b2 = B.event_records(spark, sf_dir, source=ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")))
    return b1, b2


def _store_view(spark, path):
    cur = S.current(spark, path)
    return cur.select("id", "run_id", "source_file", F.date_format("saved_at", "yyyy-MM-dd HH:mm:ss").alias("saved_at"))


@register("store_insert_absent", f"""
SELECT sha256({_ID_JSON}) AS id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'r1' ELSE 'r2' END AS run_id,
       'events_' || strftime(ts, '%Y%m%d') || '.json' AS source_file,
       CASE WHEN ts < TIMESTAMP '2024-01-20' THEN '2024-01-21 00:00:00' ELSE '2024-01-31 00:00:00' END AS saved_at
FROM events""")
def q_store_insert_absent(spark, sf_dir):
    """Two overlapping batches into an insert-only store: the first write of an id wins."""
    path = scratch_path(spark, "store-insert")
    b1, b2 = _batches(spark, sf_dir)
    S.insert_absent(spark, path, b1, "r1", T1)
    S.insert_absent(spark, path, b2, "r2", T2)
    return _store_view(spark, path)


@register("store_upsert", f"""
SELECT sha256({_ID_JSON}) AS id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'r1' ELSE 'r2' END AS run_id,
       'events_' || strftime(ts, '%Y%m%d') || '.json' AS source_file,
       CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '2024-01-21 00:00:00' ELSE '2024-01-31 00:00:00' END AS saved_at
FROM events""")
def q_store_upsert(spark, sf_dir):
    """The same two batches into an upsert store: the last write of an id wins."""
    path = scratch_path(spark, "store-upsert")
    b1, b2 = _batches(spark, sf_dir)
    S.upsert(spark, path, b1, "r1", T1)
    S.upsert(spark, path, b2, "r2", T2)
    return _store_view(spark, path)


@register("store_write_stats", """
SELECT COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-20') AS inserted,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20') AS duplicates,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS total,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS written,
       COUNT(*) AS table_count
FROM events""")
def q_store_write_stats(spark, sf_dir):
    """Counts reported by the second write into each store."""
    b1, b2 = _batches(spark, sf_dir)
    ins, ups = scratch_path(spark, "stats-insert"), scratch_path(spark, "stats-upsert")
    S.insert_absent(spark, ins, b1, "r1", T1)
    i2 = S.insert_absent(spark, ins, b2, "r2", T2)
    S.upsert(spark, ups, b1, "r1", T1)
    u2 = S.upsert(spark, ups, b2, "r2", T2)
    stats = S.write_stats(spark, ups, "r2", T2)
    return stats.select(F.lit(i2["inserted"]).cast("long").alias("inserted"),
                        F.lit(i2["duplicates"]).cast("long").alias("duplicates"),
                        F.lit(i2["total"]).cast("long").alias("total"), "written", "table_count")


@register("store_rewrite_stats", """
SELECT COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-20') AS inserted,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20') AS duplicates,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS total,
       COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS written,
       COUNT(*) AS table_count, COUNT(*) AS insert_count,
       COUNT(*) + COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-20') AS upsert_versions
FROM events""")
def q_store_rewrite_stats(spark, sf_dir):
    """K5/K6/G9/G10 when jobs are run again: every write twice, the first one once more after the second; a repeated
    write replaces itself, so counts and rows are those of single writes."""
    b1, b2 = _batches(spark, sf_dir)
    ins, ups = scratch_path(spark, "rewrite-insert"), scratch_path(spark, "rewrite-upsert")
    i2 = u2 = None
    for batch, run, at in ((b1, "r1", T1), (b1, "r1", T1), (b2, "r2", T2), (b1, "r1", T1), (b2, "r2", T2)):
        i2 = S.insert_absent(spark, ins, batch, run, at)
        u2 = S.upsert(spark, ups, batch, run, at)
    rows = S.read_versions(spark, ups).agg(F.count(F.lit(1)).alias("upsert_versions"))
    return rows.select(*[F.lit(i2[c]).cast("long").alias(c) for c in ("inserted", "duplicates", "total")],
                       F.lit(u2["written"]).cast("long").alias("written"), F.lit(u2["table_count"]).cast("long").alias("table_count"),
                       F.lit(S.table_count(spark, ins)).cast("long").alias("insert_count"), "upsert_versions")


@register("store_backfill", f"""
SELECT sha256({_ID_JSON}) AS id, CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'r1' ELSE 'r2' END AS run_id,
       CASE WHEN ts < TIMESTAMP '2024-01-20' THEN '2024-01-21 00:00:00' ELSE '2024-01-31 00:00:00' END AS saved_at,
       ts >= TIMESTAMP '2024-01-20' AS recent
FROM events""")
def q_store_backfill(spark, sf_dir):
    """The later batch is saved first, then an overlapping older one is filled in under an older save time: the
    last write wins whatever its clock, and a read of what was saved since a time leaves the filled-in ids out."""
    path = scratch_path(spark, "store-backfill")
    b1, b2 = _batches(spark, sf_dir)
    S.upsert(spark, path, b2, "r2", T2)
    S.upsert(spark, path, b1, "r1", T1)
    since = S.current(spark, path, saved_since=_dt.datetime(2024, 1, 30)).select("id", F.lit(True).alias("_recent"))
    now = _store_view(spark, path).select("id", "run_id", "saved_at")
    return now.join(since, "id", "left").select("id", "run_id", "saved_at", F.col("_recent").isNotNull().alias("recent"))


def _doc_records(spark, sf_dir, where):
    folder = B.write_event_documents(spark, sf_dir)
    files = B.document_files(folder)
    docs = D.scan_json_documents(spark, files)
    return D.normalize_records(docs.where(where), run_id=None, ingested_at=F.lit(T1).cast("timestamp"))


@register("history_scan", """
SELECT CAST(user_id AS VARCHAR) AS contador, strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS readings
FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2""")
def q_history_scan(spark, sf_dir):
    """Meter documents upserted in two runs; the history read keeps ids saved within
    2 days of 2024-02-01 (only the second run's), decodes and flattens them."""
    path = scratch_path(spark, "store-history")
    day = F.regexp_extract("name", r"meter_(\d{8})_", 1)
    S.upsert(spark, path, _doc_records(spark, sf_dir, day <= "20240120"), "r1", T1)
    S.upsert(spark, path, _doc_records(spark, sf_dir, day >= "20240115"), "r2", T2)
    hist = history_from_store(spark, path, as_of=_dt.datetime(2024, 2, 1), lookback_days=2)
    return hist.groupBy("contador", F.date_format("timestamp", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("readings"))


@register("payload_truncate", """
SELECT doc_id, least(length(to_json({'doc_id': doc_id, 'text': text})), 30000) AS payload_chars,
       length(to_json({'doc_id': doc_id, 'text': text})) > 30000 AS truncated
FROM documents""")
def q_payload_truncate(spark, sf_dir):
    """Documents stored with payloads cut at 30,000 characters."""
    docs = B.table(spark, sf_dir, "documents")
    recs = docs.select(F.to_variant_object(F.struct("doc_id", "text")).alias("payload"),
                       F.lit("documents.parquet").alias("_source_file"),
                       F.lit(T1).cast("timestamp").alias("_ingested_at"), F.lit("r1").alias("_run_id"),
                       F.lit("").alias("_file_ord"), F.col("doc_id").cast("long").alias("_rec_ord"))
    path = scratch_path(spark, "store-truncate")
    S.upsert_truncated(spark, path, recs, "r1", T1)
    full = recs.select(RF.record_identity(F.col("payload"), F.col("_source_file")).alias("id"),
                       F.try_variant_get("payload", "$.doc_id", "bigint").alias("doc_id"),
                       F.length(F.to_json("payload")).alias("_full"))
    stored = S.current(spark, path).select("id", F.length("payload_json").alias("payload_chars"))
    return full.join(stored, "id").select("doc_id", F.col("payload_chars").cast("long").alias("payload_chars"),
                                          (F.col("_full") > 30000).alias("truncated"))


# ------------------------------------------------------------------ sinks
@register("sink_json_roundtrip", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value FROM events""")
def q_sink_json_roundtrip(spark, sf_dir):
    """K1: events written as JSON Lines and read back with the same schema."""
    ev = B.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = K.write_json(ev, scratch_path(spark, "sink-json"))
    back = K.read_json(spark, path, ev.schema)
    return back.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id",
                       "event_type", "value")


@register("sink_csv_roundtrip", """
SELECT event_id, user_id, value, event_type || ',' || CAST(user_id AS VARCHAR) AS tags FROM events""")
def q_sink_csv_roundtrip(spark, sf_dir):
    """K2: CSV with a header; the nested ``tags`` array travels as JSON text and is parsed back."""
    ev = B.table(spark, sf_dir, "events")
    df = ev.select("event_id", "user_id", "value", F.array("event_type", F.col("user_id").cast("string")).alias("tags"))
    path = K.write_csv(df, scratch_path(spark, "sink-csv"))
    back = (spark.read.option("header", True).option("escape", '"')
            .schema("event_id bigint, user_id bigint, value double, tags string").csv(path))
    return back.select("event_id", "user_id", "value",
                       F.array_join(F.from_json("tags", "array<string>"), ",").alias("tags"))


@register("phase_profile", f"""
SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_id AS step_no, event_type AS step,
       {r("SUM(CAST(value AS DECIMAL(24,6))) OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")} AS cumulative_seconds
FROM events""")
def q_phase_profile(spark, sf_dir):
    """Events as run logs (run = day, step = event, seconds = value): running totals."""
    ev = B.table(spark, sf_dir, "events")
    log = ev.select(F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("event_id").alias("step_no"),
                    F.col("event_type").alias("step"), F.col("value").alias("seconds"))
    return R.phase_profile(log)


_RECORD_SQL = ("SELECT _source_file, 'run-1' AS _run_id, k, value, '_ingested_at,_run_id,_source_file,k,value' AS keys FROM ("
               + _NORM_SQL + ")")


def _stamped_records(spark, sf_dir):
    return D.normalize_records(B.event_document_texts(spark, sf_dir), run_id="run-1", ingested_at=F.lit(T1).cast("timestamp"))


@register("records_json_roundtrip", _RECORD_SQL)
def q_records_json_roundtrip(spark, sf_dir):
    """K1 + P2 + P4: the batch's records as flat JSON Lines, every object with every key of the batch, read back."""
    path = K.write_records_json(_stamped_records(spark, sf_dir), scratch_path(spark, "records-json"))
    back = spark.read.text(path).select(F.parse_json("value").alias("v"))
    keys = F.array_join(F.map_keys(F.col("v").cast("map<string,variant>")), ",")
    return back.select(F.variant_get("v", "$._source_file", "string").alias("_source_file"), F.variant_get("v", "$._run_id", "string").alias("_run_id"),
                       F.variant_get("v", "$.k", "bigint").alias("k"), F.variant_get("v", "$.value", "double").alias("value"), keys.alias("keys"))


@register("records_csv_roundtrip", _RECORD_SQL.replace("_ingested_at,_run_id,_source_file,k,value", "k,value,_source_file,_ingested_at,_run_id"))
def q_records_csv_roundtrip(spark, sf_dir):
    """K2 + P4: the same records as CSV, a column per key of the batch, read back by header."""
    path = K.write_records_csv(_stamped_records(spark, sf_dir), scratch_path(spark, "records-csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.select("_source_file", "_run_id", F.col("k").cast("bigint").alias("k"), F.col("value").cast("double").alias("value"),
                       F.lit(",".join(back.columns)).alias("keys"))


@register("report_files", ANOMALY + "SELECT * FROM det")
def q_report_files(spark, sf_dir):
    """K3: the anomaly report's folder, its details read back."""
    rep = _report(spark, sf_dir)
    path = K.write_report(rep.summary, rep.details, rep.no_history, scratch_path(spark, "report"))
    return spark.read.schema(rep.details.schema).json(f"{path}/details")


def _phase_log(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events")
    return ev.select(F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("event_id").alias("step_no"),
                     F.col("event_type").alias("step"), F.col("value").alias("seconds"))


@register("phase_totals", f"""
SELECT CASE grouping_id(run_id, step) WHEN 0 THEN 'step' WHEN 1 THEN 'run' ELSE 'all' END AS level, run_id, step, COUNT(*) AS steps,
       {r("SUM(CAST(value AS DECIMAL(24,6)))")} AS seconds
FROM (SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_type AS step, value FROM events)
GROUP BY GROUPING SETS ((run_id, step), (run_id), ())""")
def q_phase_totals(spark, sf_dir):
    """Totals of every run's steps, every run, and all runs, in one aggregate."""
    return R.phase_totals(_phase_log(spark, sf_dir))


@register("phase_profile_rows", f"""
WITH l AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_id AS step_no, event_type AS step, CAST(value AS DECIMAL(24,6)) AS s FROM events),
c AS (SELECT run_id, step_no, step, {r("SUM(s) OVER (PARTITION BY run_id ORDER BY step_no)")} AS cumulative_seconds FROM l)
SELECT run_id, -1 AS step_no, 0 AS part, 'Pipeline started' AS step, 0.0 AS cumulative_seconds FROM l GROUP BY run_id
UNION ALL SELECT run_id, step_no, 0, step, cumulative_seconds FROM c
UNION ALL SELECT run_id, step_no, 1, 'saved ' || CAST(step_no AS VARCHAR), cumulative_seconds FROM c WHERE step = 'purchase'
UNION ALL SELECT run_id, NULL, 0, 'Overall pipeline', {r("SUM(s)")} FROM l GROUP BY run_id""")
def q_phase_profile_rows(spark, sf_dir):
    """Start row, steps, a note behind each store step (purchases), and the overall row of every run."""
    log = _phase_log(spark, sf_dir)
    notes = log.where(F.col("step") == "purchase").select("run_id", "step_no", F.concat(F.lit("saved "), F.col("step_no").cast("string")).alias("step"))
    return R.profile_rows(log, notes)


# ------------------------------------------------------------------ whole runs
def _run(spark, sf_dir, **options):
    folder = B.write_event_documents(spark, sf_dir)
    out, store = scratch_path(spark, "run-out"), scratch_path(spark, "run-store")
    run_batch(spark, BatchOptions(files=B.document_files(folder), run_id="run-1", as_of=_dt.datetime(2024, 2, 1), output_dir=out,
                                  store_path=store, **options))
    result = spark.read.text(f"{out}/result").select(F.parse_json("value").alias("v"))
    return result, store, out


_FILES_SQL = f"""
       (SELECT COUNT(DISTINCT {_DOC_KEY_SQL}) FROM events) AS files_ok,
       (SELECT COUNT(DISTINCT strftime(ts, '%Y%m%d')) FROM events) AS files_error"""


def _fields(result, *specs):
    return result.select(*[F.variant_get("v", path, kind).alias(name) for name, path, kind in specs])


@register("run_result", _SUMMARY_SQL.replace("SELECT CASE WHEN n_win > 0", f"""SELECT 'ok' AS run_status, 'LOCAL_JSON_DIR' AS mode, {_FILES_SQL},
       (SELECT COUNT(DISTINCT {_DOC_KEY_SQL}) FROM events) AS records, (SELECT COUNT(DISTINCT {_DOC_KEY_SQL}) FROM events) AS written,
       (SELECT COUNT(DISTINCT {_DOC_KEY_SQL}) FROM events) AS table_count, (SELECT COUNT(*) FROM det) AS report_rows, CASE WHEN n_win > 0"""))
def q_run_result(spark, sf_dir):
    """K4: a whole run over the document folder (its history read from the same files), told from the result record it
    leaves: counts of files, records and stored ids, and the anomaly block."""
    folder = B.write_event_documents(spark, sf_dir)
    result, _store, out = _run(spark, sf_dir, history_file=folder)
    a = "$.anomalies."
    row = _fields(result, ("run_status", "$.status", "string"), ("mode", "$.mode", "string"), *[(c, f"$.{c}", "bigint") for c in ("files_ok", "files_error", "records")],
                  ("written", "$.stores.upsert.written", "bigint"), ("table_count", "$.stores.upsert.table_count", "bigint"),
                  *[(c, a + c, t) for c, t in (("status", "string"), ("current_day", "string"), ("current_day_selected_from", "string"), ("current_day_partial", "boolean"),
                                               ("current_readings", "bigint"), ("current_counters", "bigint"), ("history_readings", "bigint"), ("history_counters", "bigint"),
                                               ("expected_readings_total", "double"), ("current_readings_total", "bigint"), ("below_threshold_counters", "bigint"),
                                               ("above_threshold_counters", "bigint"), ("anomalous_counters", "bigint"), ("counters_without_history", "bigint"))],
                  ("_days", a + "compared_history_days", "array<string>"))
    rows = spark.read.schema("contador string").json(f"{out}/anomaly_report/details").agg(F.count(F.lit(1))).scalar()
    return row.withColumns({"compared_history_days": F.array_join("_days", ", "), "report_rows": rows}).drop("_days")


@register("dry_run", f"""SELECT 'ok' AS run_status, 'skipped' AS store_status, 'dry run' AS reason, CAST(0 AS BIGINT) AS stored, {_FILES_SQL}""")
def q_dry_run(spark, sf_dir):
    """K8: the same run with store writes switched off: everything is read and reported, nothing is stored."""
    result, store, _out = _run(spark, sf_dir, write_stores=False)
    row = _fields(result, ("run_status", "$.status", "string"), ("store_status", "$.stores.upsert.status", "string"), ("reason", "$.stores.upsert.reason", "string"),
                  ("files_ok", "$.files_ok", "bigint"), ("files_error", "$.files_error", "bigint"))
    return row.withColumn("stored", S.read_versions(spark, store).agg(F.count(F.lit(1))).scalar())


@register("run_without_files", f"""SELECT 'error' AS run_status, 'No JSON files found to process for start_date=2030-01-01 and days_back=3. '
       || 'Adjust the date window or set days_back=0 to disable date filtering.' AS error, COUNT(*) AS files_listed, CAST(0 AS BIGINT) AS files_selected
FROM {_DOC_NAMES_SQL}""")
def q_run_without_files(spark, sf_dir):
    """K4 on failure: a date window without files ends the run with an error, and its result record says why."""
    result, _store, _out = _run(spark, sf_dir, start_date="2030-01-01", days_back=3)
    return _fields(result, ("run_status", "$.status", "string"), ("error", "$.error", "string"), ("files_listed", "$.files_listed", "bigint"),
                   ("files_selected", "$.files_selected", "bigint"))
