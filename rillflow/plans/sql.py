"""DuckDB oracle SQL for the driver's side-by-side check (text only; never executed by Spark)."""

from __future__ import annotations


def r(expr: str, digits: int = 2) -> str:
    """Half-to-even rounding on the shortest decimal form, as Spark's ``bround`` does."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def anomaly_ctes(key: str = "user_id", before: str | None = None, lookback: int = 2, topn: int | None = None,
                 low: float = 0.8, high: float = 1.2) -> str:
    k = min(max(lookback, 2), 5)
    topn = lookback if topn is None else topn
    cut = f" AND ts < TIMESTAMP '{before}'" if before else ""
    return f"""
WITH r AS (
  SELECT CAST({key} AS VARCHAR) AS contador, CAST({key} AS VARCHAR) AS device, event_type AS alias,
         ts, value AS value_l, event_id AS ord, date_trunc('day', ts) AS day
  FROM events WHERE ts IS NOT NULL{cut}),
ds AS (
  SELECT day, COUNT(*) AS readings, COUNT(DISTINCT contador) AS counters,
         CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT contador) AS avg_per_counter
  FROM r GROUP BY day),
dr AS (SELECT *, ROW_NUMBER() OVER (ORDER BY day DESC) AS rn FROM ds),
s0 AS (
  SELECT (SELECT day FROM dr WHERE rn = 1) AS latest_day,
         (SELECT avg_per_counter FROM dr WHERE rn = 1) AS latest_avg,
         (SELECT COUNT(*) FROM ds) AS n_days,
         (SELECT CAST(median(avg_per_counter) AS DOUBLE) FROM dr WHERE rn BETWEEN 2 AND {1 + k}) AS baseline_avg),
s1 AS (
  SELECT s0.*, (SELECT MAX(day) FROM dr WHERE rn >= 2 AND avg_per_counter >= s0.baseline_avg * 0.5) AS fallback_day
  FROM s0),
s2 AS (
  SELECT *, COALESCE(n_days >= 2 AND COALESCE(baseline_avg, 0) > 0 AND COALESCE(latest_avg, 0) < baseline_avg * 0.5
                     AND fallback_day IS NOT NULL, false) AS partial
  FROM s1),
sel AS (
  SELECT CASE WHEN partial THEN fallback_day ELSE latest_day END AS current_day, partial AS current_day_partial,
         strftime(latest_day, '%Y-%m-%d') AS current_day_selected_from, latest_day, latest_avg, baseline_avg, n_days
  FROM s2),
cur AS (SELECT r.* FROM r WHERE r.day = (SELECT current_day FROM sel)),
cc AS (
  SELECT contador, arg_min(device, ord) AS device, arg_min(alias, ord) AS alias, COUNT(*) AS current_count,
         CAST(COALESCE(SUM(CAST(value_l AS DECIMAL(28,6))), 0) AS DOUBLE) AS current_water_sum_l
  FROM cur GROUP BY contador),
hw AS (
  SELECT r.* FROM r
  WHERE r.day >= (SELECT current_day FROM sel) - INTERVAL {int(lookback)} DAY AND r.day < (SELECT current_day FROM sel)),
hd AS (
  SELECT contador, day, COUNT(*) AS history_count,
         COALESCE(SUM(CAST(COALESCE(value_l, 0) AS DECIMAL(28,6))), 0) AS history_water_l
  FROM hw GROUP BY contador, day),
hr AS (
  SELECT contador, day, history_count, history_water_l FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY contador ORDER BY day DESC) AS rn FROM hd) WHERE rn <= {int(topn)}),
hs AS (
  SELECT contador, AVG(history_count) AS history_avg, CAST(median(history_count) AS DOUBLE) AS history_median,
         MIN(history_count) AS history_min, MAX(history_count) AS history_max, COUNT(day) AS history_days,
         CAST(AVG(history_water_l) AS DOUBLE) AS history_avg_water_l
  FROM hr GROUP BY contador),
cmp AS (
  SELECT cc.contador, cc.device, cc.alias, cc.current_count, cc.current_water_sum_l,
         hs.history_avg, hs.history_median, hs.history_min, hs.history_max, hs.history_days, hs.history_avg_water_l,
         hs.history_avg IS NOT NULL AS has_history,
         COALESCE(hs.history_avg, 0.0) AS expected_count,
         COALESCE(hs.history_avg_water_l, 0.0) AS expected_water_l,
         CASE WHEN COALESCE(hs.history_avg, 0.0) > 0 THEN cc.current_count / COALESCE(hs.history_avg, 0.0) END AS count_ratio
  FROM cc LEFT JOIN hs USING (contador)),
fl AS (
  SELECT *,
    COALESCE(has_history AND expected_count > 0 AND current_count < expected_count * CAST({low} AS DOUBLE), false) AS is_low_anomaly,
    COALESCE(has_history AND expected_count > 0 AND current_count > expected_count * CAST({high} AS DOUBLE), false) AS is_high_anomaly
  FROM cmp),
fl2 AS (SELECT *, is_low_anomaly OR is_high_anomaly AS is_anomaly FROM fl),
det0 AS (
  SELECT *, {r('expected_count')} AS exp_r FROM fl2 WHERE is_anomaly),
det1 AS (
  SELECT *, {r('current_count - exp_r')} AS d_r,
         {r('greatest(0.0, exp_r - current_count)')} AS m_r,
         {r('greatest(0.0, current_count - exp_r)')} AS x_r
  FROM det0),
det AS (
  SELECT contador, device, alias, current_count, current_count AS current_count_n,
    {r('current_water_sum_l')} AS current_water_sum_l,
    exp_r AS expected_count, exp_r AS expected_count_n,
    {r('expected_water_l')} AS expected_water_l,
    d_r AS delta_count,
    CASE WHEN exp_r <> 0 THEN {r('abs(d_r) / exp_r * 100', 1)} ELSE 0.0 END AS delta_percentage,
    CASE WHEN is_high_anomaly THEN 'above_expected' ELSE 'below_expected' END AS anomaly_direction,
    m_r AS missing_count, x_r AS excess_count,
    CASE WHEN exp_r <> 0 THEN {r('m_r / exp_r * 100', 1)} ELSE 0.0 END AS lost_percentage,
    CASE WHEN exp_r <> 0 THEN {r('x_r / exp_r * 100', 1)} ELSE 0.0 END AS excess_percentage,
    exp_r AS expected_total_count, m_r AS missing_total_count,
    CASE WHEN exp_r <> 0 THEN {r('m_r / exp_r * 100', 1)} ELSE 0.0 END AS lost_total_percentage,
    x_r AS excess_total_count,
    CASE WHEN exp_r <> 0 THEN {r('x_r / exp_r * 100', 1)} ELSE 0.0 END AS excess_total_percentage,
    {r('COALESCE(history_avg, 0.0)')} AS history_avg,
    {r('COALESCE(history_median, 0.0)')} AS history_median,
    CAST(COALESCE(history_min, 0) AS BIGINT) AS history_min,
    CAST(COALESCE(history_max, 0) AS BIGINT) AS history_max,
    CAST(COALESCE(history_days, 0) AS BIGINT) AS history_days,
    false AS history_missing, m_r AS missing_readings,
    abs(current_count - expected_count) AS abs_delta_count
  FROM det1),
nh AS (
  SELECT contador, device, alias, CAST(current_count AS BIGINT) AS current_count, true AS history_missing,
         'no_history_in_store' AS flag
  FROM fl2 WHERE NOT has_history),
cd AS (
  SELECT string_agg(d, ', ' ORDER BY d DESC) AS compared_history_days
  FROM (SELECT DISTINCT strftime(day, '%Y-%m-%d') AS d FROM hr))
"""
