"""Plan-shape guards for the scale properties (checked on the physical plans)."""

import pytest

from rillflow.plans import bindings as B
from rillflow.sources import documents as D
from rillflow.sources import files as FL

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
CROSS_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _subtrees(plan, marker):
    """Lines of every subtree whose root line contains ``marker``."""
    lines = plan.split("\n")
    out = []
    for i, line in enumerate(lines):
        if marker in line:
            depth = len(line) - len(line.lstrip(" :+-|"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-|")) <= depth:
                    break
                sub.append(nxt)
            out.append(sub)
    return out


@pytest.fixture(scope="module")
def plans(gate):
    return gate[1]


def test_no_python_evaluation_or_cross_joins(plans):
    for name, plan in plans.items():
        assert not any(n in plan for n in PYTHON_NODES), name
        assert not any(n in plan for n in CROSS_NODES), name


def test_document_contents_are_never_broadcast(plans):
    for name in ("scan_json_documents", "scan_folder_window"):
        assert "Exchange" not in plans[name] and "Join" not in plans[name], name
    for name in ("scan_json_documents", "flatten_readings", "history_from_file"):
        for sub in _subtrees(plans[name], "BroadcastExchange"):
            assert not any("FileScan text" in line for line in sub), name


def test_current_day_filter_reaches_the_scan(plans):
    scans = [line for line in plans["anomaly_details"].split("\n") if "FileScan parquet" in line]
    assert any("Subquery" in line and "DataFilters" in line for line in scans)


def _files_read(df):
    """Files that the scans of an executed plan opened."""
    df.collect()
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numFiles").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found)


def test_files_outside_the_window_are_not_opened(spark):
    files = B.document_files(B.write_event_documents(spark, SF))
    every = files.listing(spark).count()
    window = FL.apply_date_window(files, "2024-01-20", 5)
    inside = window.listing(spark).count()
    assert 0 < inside < every
    # without the adaptive plan around it, the scan's metrics are at hand
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _files_read(D.scan_json_documents(spark, files).select("name")) == every
        assert _files_read(D.scan_json_documents(spark, window).select("name")) == inside
        assert _files_read(D.scan_json_documents(spark, FL.limit_files(window, 3, spark)).select("name")) == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lists_pass_no_window(plans):
    for name in ("list_candidate_files", "file_date_window", "file_limit", "file_sample", "list_folder_files"):
        assert "Window" not in plans[name], name


def test_first_readings_and_newest_versions_are_not_sort_aggregated(plans):
    for name in ("current_counts", "store_upsert", "store_insert_absent", "store_backfill", "history_scan", "dedup_in_documents"):
        assert "SortAggregate" not in plans[name], name
    assert "Exchange" not in plans["dedup_in_documents"] and "Exchange" not in plans["store_upsert"]
