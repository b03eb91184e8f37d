"""One batch run end to end: discover -> scan -> normalise -> clean -> flatten -> report
-> file outputs -> stores -> run log.

Options are an argument (no global state). Phases are timed on the driver; the frames
that several later steps reuse (clean records, current readings) are cut from their
lineage with ``checkpoint()`` into the cluster's shared checkpoint folder, so a lost
executor does not force a re-scan of the inputs.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rillflow import sinks as K
from rillflow.operators import anomaly as A
from rillflow.operators import report as R
from rillflow.operators import store as S
from rillflow.operators.anomaly_report import AnomalyReport, build_report
from rillflow.operators.clean import normalize_dates
from rillflow.operators.flatten import READINGS_SCHEMA, flatten_readings
from rillflow.session import apply_confs, checkpoint_root, empty_frame, literal_rows
from rillflow.sources import documents as D
from rillflow.sources import files as FL
from rillflow.sources.history import history_from_file, history_from_store

RUN_LOG_SCHEMA = "run_id string, step_no int, step string, seconds double"
NOTE_SCHEMA = "run_id string, step_no int, step string"
HINT = "Name files with sources, a folder with directory, or names under base."


@dataclass
class BatchOptions:
    sources: str = ""                      # S3: explicit comma-separated files
    directory: str | None = None           # S2: folder of *.json
    base: str = ""                         # S4: base folder of named files
    names: str = ""                        # S4: comma-separated names
    files: FL.Files | None = None          # files described by the caller, in place of S2-S4
    start_date: str | None = None          # P3: window end (inclusive); default: the day of the run, UTC
    days_back: int = 0                     # P3: 0 disables the window
    max_files: int = 0                     # O1
    sample_size: int | None = None         # O2 (named lists only; None or 0: all files)
    sample_seed: int = 0
    lookback_days: int | None = 2
    low_ratio: float | None = 0.8
    high_ratio: float | None = 1.2
    history_file: str | None = None        # S8: overrides the store history
    store_path: str | None = None          # K6 store, also the S7 history source
    insert_store_path: str | None = None   # K5
    truncated_store_path: str | None = None  # K7
    output_dir: str | None = None          # K1-K3
    run_log_path: str | None = None        # K4
    write_stores: bool = True              # K8: False = dry run
    run_id: str | None = None
    as_of: dt.datetime | None = None       # "now" for history cutoffs and save times


@dataclass
class BatchResult:
    status: str
    run_id: str
    files: DataFrame | None = None
    quarantine: DataFrame | None = None
    file_counts: dict = field(default_factory=dict)
    records: DataFrame | None = None
    readings: DataFrame | None = None
    report: AnomalyReport | None = None
    stores: dict = field(default_factory=dict)
    run_log: DataFrame | None = None
    profile: DataFrame | None = None
    error: str | None = None
    phase_seconds: dict = field(default_factory=dict)
    result: dict = field(default_factory=dict)   # K4: run result, on every outcome


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _observed(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


class _Run:
    """One run's clock, counts and result record."""

    def __init__(self, spark: SparkSession, opts: BatchOptions):
        self.spark, self.opts = spark, opts
        self.now = opts.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.run_id = opts.run_id or self.now.strftime("%Y%m%dT%H%M%SZ")
        self.phases: dict[str, float] = {}
        self.notes: list[tuple[str, int, str]] = []
        self.facts: dict = {}
        self.started = self.clock = time.perf_counter()

    def close(self, name: str) -> None:
        at = time.perf_counter()
        self.phases[name] = round(at - self.clock, 4)
        self.clock = at

    def note(self, text: str) -> None:
        """A line behind the phase that was closed last."""
        self.notes.append((self.run_id, len(self.phases) - 1, text))

    def finish(self, status: str, **rest) -> dict:
        """The result record; written to ``<out>/result`` where outputs are."""
        result = {"status": status, "run_id": self.run_id, "started_at_utc": self.now.isoformat() + "+00:00", **self.facts, **rest,
                  "elapsed_seconds": round(time.perf_counter() - self.started, 2), "performance": {"phase_seconds": self.phases}}
        if self.opts.output_dir:
            K.write_result(self.spark, result, f"{self.opts.output_dir}/result")
        return result

    def log(self) -> DataFrame:
        rows = [(self.run_id, i, step, float(sec)) for i, (step, sec) in enumerate(self.phases.items())]
        log = literal_rows(self.spark, RUN_LOG_SCHEMA, rows)
        if self.opts.run_log_path:
            K.append_run_log(log, self.opts.run_log_path)
        return log

    def profile(self, log: DataFrame) -> DataFrame:
        return R.profile_rows(log, literal_rows(self.spark, NOTE_SCHEMA, self.notes) if self.notes else None)


def run_batch(spark: SparkSession, opts: BatchOptions) -> BatchResult:
    """One batch from files to stores. Whatever happens, the run leaves a result record (K4) and its log rows: a run that
    fails, or finds no files, has status ``error`` with the reason."""
    apply_confs(spark)
    run = _Run(spark, opts)
    try:
        return _run_batch(spark, opts, run)
    except Exception as e:  # noqa: BLE001  the outcome of a failed run is its result record
        reason = str(e) if isinstance(e, NoFiles) else f"{type(e).__name__}: {str(e)[:2000]}"
        run.phases.setdefault("failed", round(time.perf_counter() - run.clock, 4))
        result = run.finish("error", error=reason, hint=HINT)
        log = run.log()
        return BatchResult("error", run.run_id, error=reason, phase_seconds=run.phases, result=result, run_log=log,
                           profile=run.profile(log))


class NoFiles(ValueError):
    """No file is left to process."""


def _select_files(spark: SparkSession, opts: BatchOptions, run: _Run) -> FL.Files:
    files = opts.files or FL.discover(spark, opts.sources, opts.directory, opts.base, opts.names)
    run.facts.update(mode=files.mode, files_listed=files.listing(spark).count())
    window_end = opts.start_date or run.now.date().isoformat()
    chosen = FL.apply_date_window(files, window_end, opts.days_back)
    chosen = FL.sample_files(chosen, opts.sample_size, opts.sample_seed, spark)
    chosen = FL.limit_files(chosen, opts.max_files, spark)
    narrowed = chosen is not files
    run.facts["files_selected"] = chosen.listing(spark).count() if narrowed else run.facts["files_listed"]
    run.close("file_discovery")
    if not run.facts["files_selected"]:
        if opts.days_back > 0:
            raise NoFiles(f"No JSON files found to process for start_date={window_end} and days_back={opts.days_back}. "
                          "Adjust the date window or set days_back=0 to disable date filtering.")
        raise NoFiles("No JSON files found to process.")
    return chosen


def _run_batch(spark: SparkSession, opts: BatchOptions, run: _Run) -> BatchResult:
    files = _select_files(spark, opts, run)
    now, run_id = run.now, run.run_id

    ok = F.col("doc").isNotNull()
    docs, seen = _observed(D.scan_json_documents(spark, files), files_ok=F.count_if(ok), files_error=F.count_if(~ok))
    docs = _cut(docs)  # each file is read and parsed once, and counted as it is
    file_counts = {k: int(v) for k, v in seen.get.items()}
    run.facts.update(file_counts)
    _good, quarantine, _counts = D.file_parse_status(docs)
    records = D.normalize_records(docs, run_id, ingested_at=F.lit(now).cast("timestamp"), distinct=True)
    run.close("download_and_normalize")

    clean, seen = _observed(normalize_dates(records), records=F.count(F.lit(1)))
    clean = _cut(clean)
    run.facts["records"] = int(seen.get["records"])
    run.close("transform")

    params = A.AnomalyParams.of(opts.lookback_days, opts.low_ratio, opts.high_ratio)
    current = _cut(flatten_readings(clean))
    before_history = time.perf_counter()
    if opts.history_file:
        history = history_from_file(spark, opts.history_file)
    elif opts.store_path:
        history = history_from_store(spark, opts.store_path, now, params.lookback_days)
    else:
        history = empty_frame(spark, READINGS_SCHEMA)
    history = _cut(history)
    history_seconds = round(time.perf_counter() - before_history, 4)
    report = build_report(current, history, params, run_id)
    report.comparison = _cut(report.comparison)  # summary, details and previews read it again
    report = report.over(report.comparison)
    summary = report.summary.first()
    anomalies = {**summary.asDict(), "history_load_seconds": history_seconds}
    run.facts["anomalies"] = anomalies
    run.close("anomaly_report")
    if opts.history_file or opts.store_path:
        run.note(f"... [anomaly] history read: {history_seconds:.2f}s")

    output = {}
    if opts.output_dir:
        K.write_report(report.summary, report.details, report.no_history, f"{opts.output_dir}/anomaly_report")
        keys = D.known_keys(clean)
        output = {"anomaly_report_path": f"{opts.output_dir}/anomaly_report",
                  "json_path": K.write_records_json(clean, f"{opts.output_dir}/records_json", keys),
                  "csv_path": K.write_records_csv(clean, f"{opts.output_dir}/records_csv", keys),
                  "result_path": f"{opts.output_dir}/result"}
    run.facts["output"] = output
    run.close("save_outputs")

    stores = {}
    targets = [("insert", opts.insert_store_path, S.insert_absent), ("upsert", opts.store_path, S.upsert),
               ("upsert_truncated", opts.truncated_store_path, S.upsert_truncated)]
    for label, path, writer in targets:
        if not path:
            stores[label] = {"enabled": False, "status": "disabled"}
        elif not opts.write_stores:
            stores[label] = {"enabled": False, "status": "skipped", "reason": "dry run"}
        else:
            try:
                stores[label] = {"enabled": True, **writer(spark, path, clean, run_id, now)}
            except Exception as e:  # noqa: BLE001  one store's failure is its status; the run goes on
                stores[label] = {"enabled": True, "status": "error", "error": f"{type(e).__name__}: {str(e)[:500]}"}
        run.close(f"save_{label}")
        if path:
            run.note(_store_note(label, stores[label]))
    run.facts["stores"] = stores
    run.facts["sample"] = K.record_dicts(R.batch_sample(clean))

    result = run.finish("ok")
    log = run.log()
    return BatchResult("ok", run_id, files.listing(spark), quarantine, file_counts, clean, current, report, stores, log,
                       run.profile(log), None, run.phases, result)


def _store_note(label: str, outcome: dict) -> str:
    """A store's line in the profile."""
    if outcome["status"] == "skipped":
        return f"... [{label}] skipped"
    if outcome["status"] != "ok":
        return f"... [{label}] error: {outcome.get('error', 'unknown')}"
    if "inserted" in outcome:
        return f"... [{label}] inserted {outcome['inserted']}, skipped {outcome['duplicates']}"
    return f"... [{label}] written {outcome['written']}, rows in table {outcome['table_count']}"
