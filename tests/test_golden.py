
import pytest
from pyspark.sql import functions as F

from rillflow.operators import anomaly as A
from rillflow.operators.anomaly_report import build_report
from rillflow.plans import bindings as B

SF = "/root/testdata/sf0.01"

# key, cutoff, current_day, meters, low, high, without history, current total, litres
ANCHORS = [
    ("user_id", None, "2024-01-30", 133, 49, 44, 1, 329, 15092.71),
    ("user_id", "2024-01-30 06:00:00", "2024-01-30", 71, 54, 3, 1, 91, 4025.77),
    ("user_id", "2024-01-30 03:00:00", "2024-01-29", 135, 56, 53, 1, 345, 18886.10),
    ("event_type", "2024-01-30 06:00:00", "2024-01-29", 5, 0, 1, 0, 345, 18886.10),
    ("event_type", None, "2024-01-30", 5, 0, 0, 0, 329, 15092.71),
]


@pytest.mark.parametrize("key,cut,day,meters,low,high,nohist,total,litres", ANCHORS)
def test_anchor(spark, key, cut, day, meters, low, high, nohist, total, litres):
    readings = B.events_as_readings(spark, SF, key, cut)
    rep = build_report(readings, readings, A.AnomalyParams.of(2))
    s = rep.summary.first()
    got_litres = rep.comparison.agg(F.sum(F.col("current_water_sum_l").cast("decimal(28,2)"))).first()[0]
    assert (s.current_day, s.current_counters, s.below_threshold_counters, s.above_threshold_counters,
            s.counters_without_history, s.current_readings_total) == (day, meters, low, high, nohist, total)
    assert float(got_litres) == litres
