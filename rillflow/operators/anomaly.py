"""Per-meter reading-count anomalies against recent daily history.

Plan shape (see README "Plans"):

* ``day_stats``: one partial+final aggregate per day over the batch (days are few).
* ``select_current_day``: one aggregate over ``day_stats`` -> a one-row frame. Its input
  has one row per calendar day of the batch, so collecting those rows into one array is
  bounded by the calendar, not by the data.
* ``current_counts`` / ``history_daily``: grouped by meter (and day); all aggregates are
  partial (count, sum, min), so hot meters are combined map-side before the shuffle.
* ``history_stats``: groups of at most ``lookback`` rows per meter.
* ``compare``: equi left join on ``contador`` of two frames already partitioned by it.
* The selected day enters the readings filters as a scalar subquery: computed once,
  then a literal in a per-row predicate (no join at all).

Litre sums are exact decimal sums (``decimal(28,6)`` inputs) carried as decimals through every aggregate and cast to
double last; so results do not depend on partitioning or summation order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.temporal import day_floor

# Defaults and rule constants of the comparison.
DEFAULT_LOOKBACK_DAYS = 2
DEFAULT_LOW_RATIO = 0.8
DEFAULT_HIGH_RATIO = 1.2
PARTIAL_DAY_FACTOR = 0.5       # latest day is partial when its average is below half the baseline
BASELINE_MIN_DAYS = 2          # the baseline uses min(max(lookback, 2), 5) previous days
BASELINE_MAX_DAYS = 5
NO_HISTORY_FLAG = "no_history_in_store"
LITRES = "decimal(28,6)"


@dataclass(frozen=True)
class AnomalyParams:
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    low_ratio: float = DEFAULT_LOW_RATIO
    high_ratio: float = DEFAULT_HIGH_RATIO

    @classmethod
    def of(cls, lookback_days=None, low_ratio=None, high_ratio=None) -> "AnomalyParams":
        """Zero or missing options fall back to the defaults (``x or default``)."""
        return cls(int(lookback_days or DEFAULT_LOOKBACK_DAYS), float(low_ratio or DEFAULT_LOW_RATIO),
                   float(high_ratio or DEFAULT_HIGH_RATIO))

    @property
    def baseline_days(self) -> int:
        return min(max(self.lookback_days, BASELINE_MIN_DAYS), BASELINE_MAX_DAYS)


def litre_parts(c: Column) -> tuple[Column, Column]:
    """Sum of litres in two parts, (exact decimal sum, sum of the rest as double); a part without rows is null.

    Litres with at most 6 decimals and 22 whole digits are summed exactly as decimals, whatever the order; others (more
    digits, 1e30, infinities) as doubles beside them, so no cell can stop a run or lose digits.
    """
    d = c.try_cast(LITRES)
    exact = d.isNotNull() & (d.cast("double") == c)
    return F.sum(F.when(exact, d)), F.sum(F.when(~exact, c))


def joined_parts(whole: Column, rest: Column) -> Column:
    """The two parts as one double, cast last; null when both are null."""
    return F.coalesce(whole.cast("double") + rest, whole.cast("double"), rest)


def with_day(readings: DataFrame) -> DataFrame:
    """Readings with a parseable timestamp (P5) and their day."""
    return readings.where(F.col("timestamp").isNotNull()).withColumn("day", day_floor(F.col("timestamp")))


# ---------------------------------------------------------------- current side
def day_stats(dated: DataFrame) -> DataFrame:
    """G1 + G2: ``day, readings, counters, avg_per_counter``."""
    agg = dated.groupBy("day").agg(F.count(F.lit(1)).alias("readings"),
                                   F.countDistinct("contador").alias("counters"))
    return agg.withColumn("avg_per_counter", F.col("readings") / F.nullif(F.col("counters"), F.lit(0)))


def _array_median(arr: Column) -> Column:
    s = F.array_sort(arr)
    n = F.size(s)
    mid = F.floor((n + 1) / 2).cast("int")
    odd = F.try_element_at(s, mid)
    even = (F.try_element_at(s, F.greatest(n / 2, F.lit(1)).cast("int")) +
            F.try_element_at(s, (n / 2 + 1).cast("int"))) / 2
    return F.when(n == 0, F.lit(None).cast("double")).when(n % 2 == 1, odd).otherwise(even)


def select_current_day(stats: DataFrame, params: AnomalyParams = AnomalyParams()) -> DataFrame:
    """W1 + W2 + G3: the day to analyse, as one row.

    The latest day is used unless it looks partial: with at least two days, when its
    average readings per meter is below half the median of the averages of the previous
    ``min(max(lookback, 2), 5)`` days, the latest earlier day whose average reaches half
    that median is used instead.
    Columns: ``current_day, current_day_partial, current_day_selected_from, latest_day,
    latest_avg, baseline_avg, n_days``.
    """
    k = params.baseline_days
    by_day = stats.agg(F.sort_array(F.collect_list(F.struct("day", "avg_per_counter")), asc=False).alias("_d"))
    latest = F.try_element_at(F.col("_d"), F.lit(1))
    prev = F.slice("_d", 2, k)
    baseline = _array_median(F.transform(prev, lambda x: x["avg_per_counter"]))
    one = by_day.select(
        latest["day"].alias("latest_day"), latest["avg_per_counter"].alias("latest_avg"),
        F.size("_d").alias("n_days"), baseline.alias("baseline_avg"), "_d")
    older = F.filter(F.slice("_d", 2, F.greatest(F.size("_d") - 1, F.lit(1))),
                     lambda x: x["avg_per_counter"] >= F.col("baseline_avg") * PARTIAL_DAY_FACTOR)
    fallback = F.try_element_at(older, F.lit(1))["day"]
    partial = ((F.col("n_days") >= 2) & (F.coalesce(F.col("baseline_avg"), F.lit(0.0)) > 0)
               & (F.coalesce(F.col("latest_avg"), F.lit(0.0)) < F.col("baseline_avg") * PARTIAL_DAY_FACTOR)
               & fallback.isNotNull())
    return one.select(
        F.when(partial, fallback).otherwise(F.col("latest_day")).alias("current_day"),
        F.coalesce(partial, F.lit(False)).alias("current_day_partial"),
        F.date_format("latest_day", "yyyy-MM-dd").alias("current_day_selected_from"),
        "latest_day", "latest_avg", "baseline_avg", F.col("n_days").cast("long").alias("n_days"))


def current_day_value(selection: DataFrame) -> Column:
    """The selected day as a scalar subquery (evaluated once, then a literal in the filter)."""
    return selection.select("current_day").scalar()


def on_current_day(dated: DataFrame, selection: DataFrame) -> DataFrame:
    """P10: readings of the selected day.

    Written as a range on the raw timestamp (``day == d`` <=> ``d <= timestamp < d + 1``),
    a predicate a columnar source can use for min/max pruning.
    """
    cd = current_day_value(selection)
    ts = F.col("timestamp")
    return dated.where((ts >= cd) & (ts < cd + F.expr("INTERVAL 1 DAYS")))


# Low bits of a record ordinal that share a number with the body position (31 bits) when first readings are looked for.
_ORDINAL_BITS = 31


def current_counts(day_readings: DataFrame) -> DataFrame:
    """Per meter ``device, alias`` of its first reading, ``current_count`` and litres (0 if none).

    Readings are combined per (meter, device, alias, file) first, where the first place is the least of one 64-bit number
    (record and row): a hash aggregate, as buffers of fixed width allow. What is left, a row per meter, name and file, is
    summed per meter, and its first row in file order gives the names.
    """
    low = F.col("_rec_ord").bitwiseAND(F.lit((1 << _ORDINAL_BITS) - 1).cast("long"))
    place = F.shiftleft(low, _ORDINAL_BITS) + F.col("_body_pos")
    exact, rest = litre_parts(F.col("value_l"))
    named = ["contador", "device", "alias", "_file_ord"]
    parts = day_readings.groupBy(*named, F.shiftright("_rec_ord", _ORDINAL_BITS).alias("_high")).agg(
        F.min(place).alias("_place"), F.count(F.lit(1)).alias("_n"), exact.alias("_exact"), rest.alias("_rest"))
    first = Window.partitionBy("contador").orderBy("_file_ord", "_high", "_place")
    names = parts.withColumn("_at", F.row_number().over(first)).where(F.col("_at") == 1).select("contador", "device", "alias")
    agg = parts.groupBy("contador").agg(
        F.sum("_n").alias("current_count"),
        F.coalesce(joined_parts(F.sum("_exact"), F.sum("_rest")), F.lit(0.0)).alias("current_water_sum_l"))
    return names.join(agg, "contador").select("contador", "device", "alias", "current_count", "current_water_sum_l")


# ---------------------------------------------------------------- history side
def history_window(history_dated: DataFrame, selection: DataFrame, params: AnomalyParams = AnomalyParams()) -> DataFrame:
    """P9 + J3: history readings with ``current_day - lookback <= day < current_day``."""
    cd = current_day_value(selection)
    start = cd - F.expr(f"INTERVAL {int(params.lookback_days)} DAYS")
    ts = F.col("timestamp")  # day >= start <=> ts >= start, and day < cd <=> ts < cd (days are midnights)
    return history_dated.where((ts >= start) & (ts < cd))


def history_daily(window: DataFrame) -> DataFrame:
    """Per meter and day ``history_count`` and litres (missing litres count as 0).

    ``history_water_l`` is the day's total as double; ``water_exact`` and ``water_rest`` carry its two parts to the next
    aggregate, so that a mean over days is taken of exact decimals.
    """
    whole, rest = litre_parts(F.coalesce(F.col("value_l"), F.lit(0.0)))
    daily = window.groupBy("contador", "day").agg(
        F.count(F.lit(1)).alias("history_count"), whole.alias("water_exact"), rest.alias("water_rest"))
    return daily.withColumn("history_water_l", joined_parts(F.col("water_exact"), F.col("water_rest")))


def history_recent(daily: DataFrame, n_days: int) -> DataFrame:
    """The ``n_days`` most recent days of each meter.

    Input rows are unique per (meter, day) and already limited to the window, so a
    meter's window partition holds at most as many rows as the window has days.
    """
    w = Window.partitionBy("contador").orderBy(F.desc("day"))
    return daily.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n_days).drop("_rn")


def history_stats(recent: DataFrame) -> DataFrame:
    """Per meter mean / median / min / max of daily counts, days, mean daily litres.

    Rows are unique per (meter, day) here, so the number of distinct days is a count. Mean litres are the exact decimal
    sum over the number of days, rounded once to double at the end; days with parts that no decimal holds add theirs.
    """
    days = F.count(F.lit(1))
    exact = (F.sum("water_exact") / days).cast("double")
    return recent.groupBy("contador").agg(
        F.avg("history_count").alias("history_avg"),
        F.median("history_count").alias("history_median"),
        F.min("history_count").alias("history_min"),
        F.max("history_count").alias("history_max"),
        F.count("day").alias("history_days"),
        joined_parts(exact, F.sum("water_rest") / days).alias("history_avg_water_l"))


def compared_days(recent: DataFrame) -> DataFrame:
    """Distinct compared days, newest first, as ``yyyy-MM-dd`` text (one row)."""
    days = recent.select(F.date_format("day", "yyyy-MM-dd").alias("d")).distinct()
    return days.agg(F.sort_array(F.collect_list("d"), asc=False).alias("compared_history_days"))


# ---------------------------------------------------------------- comparison
def compare(counts: DataFrame, stats: DataFrame, params: AnomalyParams = AnomalyParams()) -> DataFrame:
    """J1 + F11 + F12 + P11 + P12: current counters left-joined with history statistics.

    Meters seen only in history are not part of the result (left join from today).
    """
    j = counts.join(stats, "contador", "left")
    expected = F.coalesce(F.col("history_avg"), F.lit(0.0))
    has = F.col("history_avg").isNotNull()
    cur = F.coalesce(F.col("current_count"), F.lit(0)).cast("long")
    low = has & (expected > 0) & (cur < expected * F.lit(params.low_ratio))
    high = has & (expected > 0) & (cur > expected * F.lit(params.high_ratio))
    return j.select(
        "contador", "device", "alias", cur.alias("current_count"),
        F.coalesce(F.col("current_water_sum_l"), F.lit(0.0)).alias("current_water_sum_l"),
        "history_avg", "history_median", "history_min", "history_max", "history_days", "history_avg_water_l",
        has.alias("has_history"), expected.alias("expected_count"),
        F.coalesce(F.col("history_avg_water_l"), F.lit(0.0)).alias("expected_water_l"),
        F.when(expected > 0, cur / expected).alias("count_ratio"),
        low.alias("is_low_anomaly"), high.alias("is_high_anomaly"), (low | high).alias("is_anomaly"))


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.bround(part / whole * 100, 1)).otherwise(F.lit(0.0))


def anomaly_details(comparison: DataFrame) -> DataFrame:
    """P13 + P14: one row per anomalous meter with the report fields.

    Deltas are taken from the *rounded* expected count; ``abs_delta_count`` (unrounded)
    is kept for ranking: order by it descending, then by ``contador`` (see ``ranked``).
    Rounding is half-to-even (``bround``).
    """
    f = comparison.where(F.col("is_anomaly"))
    exp = F.bround(F.col("expected_count"), 2)
    cur = F.col("current_count")
    delta = F.bround(cur - exp, 2)
    missing = F.bround(F.greatest(F.lit(0.0), exp - cur), 2)
    excess = F.bround(F.greatest(F.lit(0.0), cur - exp), 2)
    direction = F.when(F.col("is_high_anomaly"), F.lit("above_expected")).otherwise(F.lit("below_expected"))
    return f.select(
        "contador", "device", "alias",
        cur.alias("current_count"), cur.alias("current_count_n"),
        F.bround("current_water_sum_l", 2).alias("current_water_sum_l"),
        exp.alias("expected_count"), exp.alias("expected_count_n"),
        F.bround("expected_water_l", 2).alias("expected_water_l"),
        delta.alias("delta_count"), _pct(F.abs(delta), exp).alias("delta_percentage"),
        direction.alias("anomaly_direction"),
        missing.alias("missing_count"), excess.alias("excess_count"),
        _pct(missing, exp).alias("lost_percentage"), _pct(excess, exp).alias("excess_percentage"),
        exp.alias("expected_total_count"), missing.alias("missing_total_count"),
        _pct(missing, exp).alias("lost_total_percentage"),
        excess.alias("excess_total_count"), _pct(excess, exp).alias("excess_total_percentage"),
        F.bround(F.coalesce("history_avg", F.lit(0.0)), 2).alias("history_avg"),
        F.bround(F.coalesce("history_median", F.lit(0.0)), 2).alias("history_median"),
        F.coalesce("history_min", F.lit(0)).cast("long").alias("history_min"),
        F.coalesce("history_max", F.lit(0)).cast("long").alias("history_max"),
        F.coalesce("history_days", F.lit(0)).cast("long").alias("history_days"),
        F.lit(False).alias("history_missing"), missing.alias("missing_readings"),
        F.abs(cur - F.col("expected_count")).alias("abs_delta_count"))


def ranked(details: DataFrame) -> DataFrame:
    """O3: report order — largest unrounded deviation first, ties by meter."""
    return details.orderBy(F.desc("abs_delta_count"), F.asc("contador"))


def no_history(comparison: DataFrame) -> DataFrame:
    """J2 + P15: current meters without history in the window."""
    return comparison.where(~F.col("has_history")).select(
        "contador", "device", "alias", F.col("current_count").cast("long").alias("current_count"),
        F.lit(True).alias("history_missing"), F.lit(NO_HISTORY_FLAG).alias("flag"))


def comparison_totals(comparison: DataFrame) -> DataFrame:
    """One row of batch totals over the comparison."""
    return comparison.agg(
        F.count(F.lit(1)).alias("current_counters"),
        F.bround(F.coalesce(F.sum(F.col("expected_count").cast("decimal(30,10)")), F.lit(0)), 2)
        .cast("double").alias("expected_readings_total"),
        F.coalesce(F.sum("current_count"), F.lit(0)).cast("long").alias("current_readings_total"),
        F.count_if("is_low_anomaly").alias("below_threshold_counters"),
        F.count_if("is_high_anomaly").alias("above_threshold_counters"),
        F.count_if("is_anomaly").alias("anomalous_counters"),
        F.count_if(~F.col("has_history")).alias("counters_without_history"))
