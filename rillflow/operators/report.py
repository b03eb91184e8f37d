"""Report tables: top anomalies (O4, O5), no-history preview (O6), batch sample (O7),
cumulative phase profile (W5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Report sizes and labels.
TOP_N = 10
PREVIEW_N = 10
SAMPLE_N = 5
LABEL_ABOVE = "above_expected"
LABEL_BELOW = "below_expected"
LABEL_EXPECTED = "expected"
# Labels of a profile's first and last row.
LABEL_STARTED = "Pipeline started"
LABEL_OVERALL = "Overall pipeline"


def _pct_or_flag(delta: Column, expected: Column, current: Column) -> Column:
    return (F.when(expected > 0, F.bround(F.abs(delta) / expected * 100, 1))
            .when(current == 0, F.lit(0.0)).otherwise(F.lit(100.0)))


def top_anomalies(details: DataFrame, n: int = TOP_N) -> DataFrame:
    """O4 + O5: the ``n`` largest deviations with litre and count deltas and labels.

    ``orderBy(..).limit(n)`` plans as a distributed top-k (TakeOrderedAndProject); only
    ``n`` rows reach the final window that numbers them.
    """
    top = details.orderBy(F.desc("abs_delta_count"), F.asc("contador")).limit(n)
    exp_w = F.col("expected_water_l")
    cur_w = F.col("current_water_sum_l")
    exp_n = F.bround(F.col("expected_count_n"), 0).cast("long")
    cur_n = F.col("current_count_n").cast("long")
    d_w = F.bround(cur_w - exp_w, 2)
    d_n = cur_n - exp_n
    label = F.when(F.col("anomaly_direction") == LABEL_ABOVE, F.lit(LABEL_ABOVE)).otherwise(F.lit(LABEL_BELOW))
    out = top.select(
        "contador", "abs_delta_count", exp_w.alias("expected_water_l"), cur_w.alias("current_water_l"),
        d_w.alias("delta_water_l"), _pct_or_flag(d_w, exp_w, cur_w).alias("delta_water_pct"),
        exp_n.alias("expected_n"), cur_n.alias("current_n"), d_n.alias("delta_n"),
        _pct_or_flag(d_n, exp_n, cur_n).alias("delta_n_pct"), label.alias("_label"))
    out = out.select(
        "*",
        F.when(F.col("delta_water_pct") == 0.0, F.lit(LABEL_EXPECTED)).otherwise(F.col("_label")).alias("water_label"),
        F.when(F.col("delta_n_pct") == 0.0, F.lit(LABEL_EXPECTED)).otherwise(F.col("_label")).alias("n_label"))
    w = Window.orderBy(F.desc("abs_delta_count"), F.asc("contador"))  # at most n rows
    return out.withColumn("rank", F.row_number().over(w).cast("long")).drop("_label", "abs_delta_count")


def no_history_preview(no_history: DataFrame, n: int = PREVIEW_N) -> DataFrame:
    """One row — how many meters lack history and the first ``n`` names (``...`` when more).

    The first ``n`` names come from a distributed top-k; only they are collected.
    """
    first = no_history.select("contador").orderBy("contador").limit(n)
    names = first.agg(F.concat_ws(", ", F.sort_array(F.collect_list("contador"))).alias("names"))
    total = no_history.agg(F.count(F.lit(1)).alias("without_history"))
    return total.select(
        "without_history",
        F.concat(F.coalesce(names.select("names").scalar(), F.lit("")),
                 F.when(F.col("without_history") > n, F.lit("...")).otherwise(F.lit(""))).alias("preview"))


def batch_sample(records: DataFrame, n: int = SAMPLE_N) -> DataFrame:
    """The first ``n`` records of the batch in file / record order."""
    return records.orderBy("_file_ord", "_rec_ord").limit(n)


# Step numbers per range when a run's running total is split (see ``phase_profile``).
STEP_RANGE = 1 << 16


def phase_profile(run_log: DataFrame, step_range: int = STEP_RANGE) -> DataFrame:
    """Cumulative seconds per run in step order.

    ``run_log``: ``run_id, step_no, step, seconds``. Seconds are summed as decimals so
    the running total is exact; each row shows it rounded to 2 decimals.

    A run is split into step-number ranges so no window partition holds more than one
    range: each range's total is aggregated, the totals of earlier ranges of the same run
    become an offset (a window over one row per range), and the in-range running sum is
    added to it.
    """
    secs = F.col("seconds").cast("decimal(24,6)")
    ranged = run_log.withColumn("_rng", F.floor(F.col("step_no") / F.lit(step_range)).cast("long"))
    totals = ranged.groupBy("run_id", "_rng").agg(F.sum(secs).alias("_tot"))
    before = Window.partitionBy("run_id").orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("run_id", "_rng", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy("run_id", "_rng").orderBy("step_no").rowsBetween(Window.unboundedPreceding,
                                                                                  Window.currentRow)
    running = ranged.withColumn("_run", F.sum(secs).over(within)).join(offsets, ["run_id", "_rng"])
    return running.select("run_id", "step_no", "step",
                          F.bround(F.col("_off") + F.col("_run"), 2).cast("double").alias("cumulative_seconds"))


def phase_totals(run_log: DataFrame) -> DataFrame:
    """Total seconds at three levels in one grouping-sets aggregate: ``level`` is ``step`` (a run's step), ``run`` (a
    run, all its steps) or ``all`` (every run); ``steps`` counts the log rows. Seconds are summed as decimals."""
    level = F.element_at(F.array(F.lit("step"), F.lit("run"), F.lit("run"), F.lit("all")), F.grouping_id().cast("int") + 1)
    sums = run_log.groupingSets([["run_id", "step"], ["run_id"], []], "run_id", "step").agg(
        level.alias("level"), F.count(F.lit(1)).alias("steps"),
        F.bround(F.sum(F.col("seconds").cast("decimal(24,6)")), 2).cast("double").alias("seconds"))
    return sums.select("level", "run_id", "step", "steps", "seconds")


def profile_rows(run_log: DataFrame, notes: DataFrame | None = None, step_range: int = STEP_RANGE) -> DataFrame:
    """The whole profile of every run: a start row at 0, every step with its running total, the ``notes`` behind their
    steps, and a last row with the run's total.

    ``notes``: ``run_id, step_no, step`` (a store's counts, the time spent on reading history); a note shows the total of
    the step it stands behind. Columns ``run_id, step_no, part, step, cumulative_seconds``; rows are ordered by run,
    step_no, part; the start row has step_no -1, the last row none.
    """
    steps = phase_profile(run_log, step_range).select("run_id", "step_no", F.lit(0).alias("part"), "step", "cumulative_seconds")
    runs = phase_totals(run_log).where(F.col("level") == "run")
    kind = dict(run_log.dtypes)["step_no"]
    ends = [runs.select("run_id", F.lit(-1).cast(kind).alias("step_no"), F.lit(0).alias("part"), F.lit(LABEL_STARTED).alias("step"),
                        F.lit(0.0).alias("cumulative_seconds")),
            runs.select("run_id", F.lit(None).cast(kind).alias("step_no"), F.lit(0).alias("part"), F.lit(LABEL_OVERALL).alias("step"),
                        F.col("seconds").alias("cumulative_seconds"))]
    out = ends[0].unionByName(steps).unionByName(ends[1])
    if notes is not None:
        at = steps.select("run_id", "step_no", "cumulative_seconds")
        out = out.unionByName(notes.join(at, ["run_id", "step_no"]).select("run_id", "step_no", F.lit(1).alias("part"), "step",
                                                                           "cumulative_seconds"))
    return out
