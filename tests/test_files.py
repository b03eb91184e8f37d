"""File selection rules: source cascade (S2-S5), date window bounds (P3), limit (O1), sample (O2)."""

import tempfile

from rillflow.sources import files as FL

from fixtures import sample_document, write_json


def _names(df):
    return [r.name for r in df.orderBy("_file_ord").collect()]


def test_cascade_priority(spark):
    folder = tempfile.mkdtemp(dir="/tmp")
    for n in ("b.json", "a.json", "c.txt"):
        write_json(folder, n, sample_document())
    explicit = FL.list_candidate_files(spark, sources=f" {folder}/b.json ,,", directory=folder, base="/x", names="n1")
    assert [(r.name, r.mode) for r in explicit.collect()] == [("b.json", FL.MODE_EXPLICIT)]
    listed = FL.list_candidate_files(spark, sources=" , ", directory=folder, base="/x", names="n1")
    assert _names(listed) == ["a.json", "b.json"] and {r.mode for r in listed.collect()} == {FL.MODE_LOCAL_DIR}
    named = FL.list_candidate_files(spark, directory=folder + "/missing", base="/x/", names="z.json, y.json")
    assert [(r.name, r.source) for r in named.orderBy("_file_ord").collect()] == [("z.json", "/x/z.json"),
                                                                                  ("y.json", "/x/y.json")]
    assert FL.list_candidate_files(spark).count() == 0


def test_date_window_bounds(spark):
    names = "x_20251017.json,x_20251018.json,x_20251022.json,x_20251023.json,x.json,x_20259999.json"
    files = FL.list_candidate_files(spark, base="/b", names=names)
    kept = _names(FL.apply_date_window(files, "2025-10-22", 4))
    assert kept == ["x_20251018.json", "x_20251022.json", "x.json", "x_20259999.json"]
    assert len(_names(FL.apply_date_window(files, "2025-10-22", 0))) == 6


def test_limit_and_sample(spark):
    names = ",".join(f"f{i:03d}.json" for i in range(100))
    files = FL.list_candidate_files(spark, base="/b", names=names)
    assert _names(FL.limit_files(files, 3)) == ["f000.json", "f001.json", "f002.json"]
    assert FL.limit_files(files, 0).count() == 100
    assert FL.sample_files(files, 0).count() == FL.sample_files(files, None).count() == 100
    assert FL.sample_files(files, 7, seed=1).count() == 7
    assert FL.sample_files(files, -1).count() == 100                          # negative disables
    assert FL.sample_files(files, 500).count() == 100                         # fewer files than the size
    a = set(_names(FL.sample_files(files, 10, seed=3)))
    assert a == set(_names(FL.sample_files(files, 10, seed=3))) and len(a) == 10
    folder = tempfile.mkdtemp(dir="/tmp")
    for i in range(40):
        write_json(folder, f"d{i}.json", {})
    listed = FL.list_candidate_files(spark, directory=folder)
    assert FL.sample_files(listed, 5).count() == 40                           # only named lists are sampled


def test_many_folders_are_listed_by_a_bounded_number_of_tasks(spark):
    """A folder per document: every file is found, and a listing does not start a task for each folder."""
    import os
    from rillflow.session import LEAST_LISTING_TASKS, LISTING_TASKS, LISTING_TASKS_A_CORE, apply_confs
    root, threshold = tempfile.mkdtemp(dir="/tmp"), "spark.sql.sources.parallelPartitionDiscovery.threshold"
    bound = max(LEAST_LISTING_TASKS, LISTING_TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    for i in range(bound + 40):
        os.mkdir(f"{root}/doc={i}")
        write_json(f"{root}/doc={i}", "part.json", sample_document())
    before, group = spark.conf.get(threshold), "bounded-listing"
    spark.conf.set(threshold, "8")
    spark.conf.unset(LISTING_TASKS)
    apply_confs(spark)
    spark.sparkContext.setJobGroup(group, group)
    try:
        files = FL.Files(FL.MODE_LOCAL_DIR, folder=root, recursive=True)
        found = files.reader(spark, "binaryFile").load(root)  # lists the folder, reads nothing
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        tasks = [s.numTasks for s in stages]
        assert tasks and max(tasks) <= bound
        assert found.select("path").distinct().count() == bound + 40
        spark.conf.set(LISTING_TASKS, "7")  # a session's own setting stays
        assert apply_confs(spark).conf.get(LISTING_TASKS) == "7"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(threshold, before)
        spark.conf.unset(LISTING_TASKS)
        apply_confs(spark)
