"""The anomaly report of one batch: all intermediate frames plus the one-row summary.

The summary is a single row assembled from one-row global aggregates attached as scalar
subqueries; its ``status`` follows the order of the skip rules (no readings, no
timestamps, no history, no history timestamps, nothing in the window, ok).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.operators import anomaly as A

# Status texts of the report.
REASON_NO_READINGS = "No meter readings found in the current batch."
REASON_NO_TIMESTAMPS = "Current batch has no parseable timestamps."
REASON_NO_HISTORY = "No history found in the store for the last {n} day(s)."
REASON_NO_HISTORY_TIMESTAMPS = "Historical store rows have no parseable timestamps."
REASON_EMPTY_WINDOW = "No historical rows available in the {n} day window before {day}."
SOURCE_LABEL = "store"
BASIS = "current day vs average of previous {n} day(s)"


@dataclass
class AnomalyReport:
    params: A.AnomalyParams
    current: DataFrame          # dated current readings
    day_stats: DataFrame
    selection: DataFrame        # one row
    current_day_readings: DataFrame
    current_counts: DataFrame
    history: DataFrame          # dated history readings
    history_window: DataFrame
    history_daily: DataFrame
    history_recent: DataFrame
    history_stats: DataFrame
    comparison: DataFrame
    details: DataFrame
    no_history: DataFrame
    compared_days: DataFrame    # one row
    summary: DataFrame          # one row
    summarize: Callable[[DataFrame], DataFrame] | None = None

    def over(self, comparison: DataFrame) -> "AnomalyReport":
        """The same report read from a comparison that has been written: its tables then cost a scan of that."""
        return replace(self, comparison=comparison, details=A.anomaly_details(comparison), no_history=A.no_history(comparison),
                       summary=self.summarize(comparison))


def build_report(current_readings: DataFrame, history_readings: DataFrame,
                 params: A.AnomalyParams = A.AnomalyParams(), run_id: str | None = None) -> AnomalyReport:
    cur = A.with_day(current_readings)
    stats = A.day_stats(cur)
    sel = A.select_current_day(stats, params)
    cur_day = A.on_current_day(cur, sel)
    counts = A.current_counts(cur_day)
    hist = A.with_day(history_readings)
    window = A.history_window(hist, sel, params)
    daily = A.history_daily(window)
    recent = A.history_recent(daily, params.lookback_days)
    hstats = A.history_stats(recent)
    comp = A.compare(counts, hstats, params)
    days = A.compared_days(recent)
    def summarize(comparison: DataFrame) -> DataFrame:
        return _summary(current_readings, sel, history_readings, hstats, comparison, days, params, run_id)

    return AnomalyReport(params, cur, stats, sel, cur_day, counts, hist, window, daily, recent, hstats, comp,
                         A.anomaly_details(comp), A.no_history(comp), days, summarize(comp), summarize)


def _side_counts(flat: DataFrame, lo, hi) -> DataFrame:
    """One pass over a side's readings: all, with a timestamp, and inside ``[lo, hi)``."""
    ts = F.col("timestamp")
    return flat.agg(F.struct(
        F.count(F.lit(1)).alias("all"), F.count_if(ts.isNotNull()).alias("dated"),
        F.count_if((ts >= lo) & (ts < hi)).alias("inside")).alias("c"))


def _summary(flat, sel, hflat, hstats, comp, days, params, run_id) -> DataFrame:
    n = params.lookback_days
    base = comp.transform(A.comparison_totals)
    cd = A.current_day_value(sel)
    cur_c = _side_counts(flat, cd, cd + F.expr("INTERVAL 1 DAYS")).scalar()
    hist_c = _side_counts(hflat, cd - F.expr(f"INTERVAL {int(n)} DAYS"), cd).scalar()
    day_txt = F.date_format(cd, "yyyy-MM-dd")
    row = base.select(
        "*",
        cur_c["all"].alias("_n_flat"), cur_c["dated"].alias("_n_ts"), cur_c["inside"].alias("_n_day"),
        hist_c["all"].alias("_n_hflat"), hist_c["dated"].alias("_n_hts"), hist_c["inside"].alias("_n_win"),
        hstats.agg(F.count(F.lit(1))).scalar().alias("history_counters"),
        day_txt.alias("_day"),
        sel.select("current_day_selected_from").scalar().alias("_from"),
        sel.select("current_day_partial").scalar().alias("_partial"),
        days.select("compared_history_days").scalar().alias("_days"),
    )
    status_no = (F.when(F.col("_n_flat") == 0, 1).when(F.col("_n_ts") == 0, 2).when(F.col("_n_hflat") == 0, 4)
                 .when(F.col("_n_hts") == 0, 5).when(F.col("_n_win") == 0, 6).otherwise(7))
    row = row.withColumn("_s", status_no)
    s = F.col("_s")
    ok = s == 7
    reason = (F.when(s == 1, F.lit(REASON_NO_READINGS)).when(s == 2, F.lit(REASON_NO_TIMESTAMPS))
              .when(s == 4, F.lit(REASON_NO_HISTORY.format(n=n))).when(s == 5, F.lit(REASON_NO_HISTORY_TIMESTAMPS))
              .when(s == 6, F.concat(F.lit(REASON_EMPTY_WINDOW.split("{day}")[0].format(n=n)), F.col("_day"),
                                     F.lit(REASON_EMPTY_WINDOW.split("{day}")[1]))))
    return row.select(
        F.when(ok, F.lit("ok")).otherwise(F.lit("skipped")).alias("status"),
        reason.alias("reason"),
        F.when(ok, F.lit(SOURCE_LABEL)).alias("source"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(n).cast("long").alias("lookback_days"),
        F.lit(params.low_ratio).alias("threshold_ratio"),
        F.lit(params.high_ratio).alias("upper_threshold_ratio"),
        F.when(s >= 6, F.col("_day")).alias("current_day"),
        F.when(ok, F.col("_from")).alias("current_day_selected_from"),
        F.when(ok, F.col("_partial")).alias("current_day_partial"),
        F.when(ok, F.coalesce(F.col("_days"), F.array().cast("array<string>"))).alias("compared_history_days"),
        F.when(ok, F.lit(BASIS.format(n=n))).alias("comparison_basis"),
        F.when(s >= 6, F.col("_n_day")).when(s >= 4, F.col("_n_ts")).alias("current_readings"),
        F.when(s >= 4, F.col("current_counters")).alias("current_counters"),
        F.when(ok, F.col("_n_win")).alias("history_readings"),
        F.when(ok, F.col("history_counters")).alias("history_counters"),
        F.when(ok, F.col("expected_readings_total")).alias("expected_readings_total"),
        F.when(ok, F.col("current_readings_total")).alias("current_readings_total"),
        F.when(ok, F.col("below_threshold_counters")).alias("below_threshold_counters"),
        F.when(ok, F.col("above_threshold_counters")).alias("above_threshold_counters"),
        F.when(ok, F.col("anomalous_counters")).alias("anomalous_counters"),
        F.when(ok, F.col("counters_without_history")).alias("counters_without_history"),
    )
