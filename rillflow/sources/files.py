"""File discovery (S2-S5), the file-name date window (P3), prefix limit (O1) and sampling (O2).

``Files`` describes what a run reads without holding it: a folder with a name pattern, or the paths that an option text
names, and conditions on names and paths. Nothing is listed when it is made. A scan turns the conditions into filters on
``_metadata``, which Spark applies while it lists: a file outside the date window is never opened, and no list passes the
driver. The order of a folder's files is the order of their paths, so the order key ``_file_ord`` is the path itself; for
named files it is the place in the list, as text of fixed width.

The same conditions also work on plain frames ``name, source, mode, _file_ord`` (lists that are tables).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.temporal import date_from_name
from rillflow.session import empty_frame

FILE_SCHEMA = "name string, source string, mode string, _file_ord string"

# Discovery modes in priority order.
MODE_EXPLICIT = "JSON_FILE_URLS"
MODE_LOCAL_DIR = "LOCAL_JSON_DIR"
MODE_KNOWN_NAMES = "REPO_JSON_FILES"
# Most nested "folder/.." steps of a given path that are resolved.
MAX_UPWARD = 8
SAMPLED_MODES = (MODE_KNOWN_NAMES,)
ORDER_DIGITS = 19


def basename(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def place_key(pos: Column) -> Column:
    """A place in a list as text that sorts like the number."""
    return F.lpad(pos.cast("string"), ORDER_DIGITS, "0")


def metadata_path() -> Column:
    """The path of the file a row is read from, as it is written (the scan reports it URL-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


@dataclass(frozen=True)
class Files:
    """Files of one discovery mode: those of ``folder`` that match ``glob`` (below it too if ``recursive``), or the listed
    ``sources``. ``conditions`` map (name, path) to predicates; ``named`` maps a folder's paths to file names."""

    mode: str
    folder: str | None = None
    glob: str = "*.json"
    recursive: bool = False
    sources: tuple[str, ...] = ()
    conditions: tuple[Callable[[Column, Column], Column], ...] = ()
    named: Callable[[Column], Column] = basename

    def reader(self, spark: SparkSession, fmt: str):
        return (spark.read.format(fmt).option("pathGlobFilter", self.glob)
                .option("recursiveFileLookup", str(self.recursive).lower()))

    def kept(self, frame: DataFrame, name: Column, path: Column) -> DataFrame:
        for condition in self.conditions:
            frame = frame.where(condition(name, path))
        return frame

    def listing(self, spark: SparkSession) -> DataFrame:
        """``name, source, mode, _file_ord`` of the files (metadata only: no file is opened)."""
        if self.folder is None:
            rows = [(s.rsplit("/", 1)[-1], s, self.mode, f"{i:0{ORDER_DIGITS}d}") for i, s in enumerate(self.sources)]
            frame = spark.createDataFrame(rows, FILE_SCHEMA) if rows else empty_frame(spark, FILE_SCHEMA)
            return self.kept(frame, F.col("name"), F.col("source"))
        found = self.reader(spark, "binaryFile").load(glob_escaped(self.folder))
        found = self.kept(found, self.named(metadata_path()), metadata_path())
        return found.select(self.named(F.col("path")).alias("name"), F.col("path").alias("source"),
                            F.lit(self.mode).alias("mode"), F.col("path").alias("_file_ord"))

    def where(self, condition: Callable[[Column, Column], Column]) -> "Files":
        return replace(self, conditions=(*self.conditions, condition))


def listed(sources: list[str], mode: str) -> Files:
    return Files(mode, sources=tuple(sources))


def split_sources(text: Column) -> Column:
    """S3 on a column: comma-separated sources -> array of ``name, source``; trimmed, blanks dropped, name = last segment."""
    items = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda s: F.trim(s)), lambda s: s != "")
    return F.transform(items, lambda s: F.struct(basename(s).alias("name"), s.alias("source")))


def explicit_sources(sources: str | None) -> Files:
    """S3: the files that an option text names, comma-separated; trimmed, blanks dropped, name = last path segment."""
    return listed([s.strip() for s in (sources or "").split(",") if s.strip()], MODE_EXPLICIT)


def directory_sources(directory: str | None) -> Files:
    """``*.json`` directly in a folder, by path."""
    return Files(MODE_LOCAL_DIR, folder=(directory or "").strip())


def named_sources(base: str, names: "str | DataFrame") -> "Files | DataFrame":
    """Names under a base folder, given as comma-separated text or as a table ``n, pos``."""
    root = base.rstrip("/")
    if isinstance(names, DataFrame):
        items = names.select("pos", F.trim("n").alias("n")).where(F.col("n") != "")
        return items.select(basename(F.col("n")).alias("name"), F.concat_ws("/", F.lit(root), "n").alias("source"),
                            F.lit(MODE_KNOWN_NAMES).alias("mode"), place_key(F.col("pos")).alias("_file_ord"))
    return listed([f"{root}/{n.strip()}" for n in (names or "").split(",") if n.strip()], MODE_KNOWN_NAMES)


def _holds_files(spark: SparkSession, files: Files) -> bool:
    """Whether a folder is there and has a file of the pattern: looked up until the first one is met."""
    if not files.folder:
        return False
    fs, jvm = _file_system(spark, files.folder), spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(files.folder)
    if not fs.exists(folder) or not fs.getFileStatus(folder).isDirectory():
        return False
    accepts = jvm.org.apache.hadoop.fs.GlobFilter(files.glob)
    found = fs.listStatusIterator(folder)
    while found.hasNext():
        status = found.next()
        if status.isFile() and accepts.accept(status.getPath()):
            return True
    return False


def discover(spark: SparkSession, sources: str = "", directory: str | None = None, base: str = "",
             names: "str | DataFrame" = "") -> "Files | DataFrame":
    """The first of explicit sources, folder and named list that has any file."""
    explicit, folder = explicit_sources(sources), directory_sources(directory)
    if explicit.sources:
        return explicit
    return folder if _holds_files(spark, folder) else named_sources(base, names)


def list_candidate_files(spark: SparkSession, sources: str = "", directory: str | None = None,
                         base: str = "", names: "str | DataFrame" = "") -> DataFrame:
    """S5 as a frame: ``name, source, mode, _file_ord``."""
    found = discover(spark, sources, directory, base, names)
    return found if isinstance(found, DataFrame) else found.listing(spark)


def _where(files: "Files | DataFrame", condition: Callable[[Column, Column], Column]) -> "Files | DataFrame":
    return files.where(condition(F.col("name"), F.col("source"))) if isinstance(files, DataFrame) else files.where(condition)


def apply_date_window(files: "Files | DataFrame", end_date: str | dt.date, days_back: int) -> "Files | DataFrame":
    """Keep a file when its name has no date, or the date is in [end - days_back, end]."""
    if days_back <= 0:
        return files
    end = str(end_date)

    def inside(name: Column, _path: Column) -> Column:
        d = date_from_name(name)
        last = F.lit(end).cast("date")
        return d.isNull() | d.between(F.date_sub(last, days_back), last)

    return _where(files, inside)


def limit_files(files: "Files | DataFrame", max_files: int, spark: SparkSession | None = None) -> "Files | DataFrame":
    """O1: the first ``max_files`` files in list order (0 or less keeps all).

    For a folder the last path that counts is looked up (a distributed top-k over the listing, one value comes back) and
    becomes a condition; a named list is cut where it is."""
    if max_files <= 0:
        return files
    if isinstance(files, DataFrame):
        return files.orderBy("_file_ord").limit(max_files)
    first = files.listing(spark).orderBy("_file_ord").limit(max_files)
    if files.folder is None:
        return replace(files, sources=tuple(r["source"] for r in first.orderBy("_file_ord").collect()), conditions=())
    last = first.agg(F.max("_file_ord")).first()[0]
    return files.where(lambda _name, path: path <= F.lit(last)) if last is not None else files


def sample_files(files: "Files | DataFrame", sample_size: int | None, seed: int = 0,
                 spark: SparkSession | None = None) -> "Files | DataFrame":
    """O2: an exact-size random sample without replacement (only for sampled modes).

    None, 0 or a negative size keeps all files. The order is md5(name || seed), so the
    same sample is taken each time it is evaluated.
    """
    size = int(sample_size or 0)
    if size <= 0:
        return files
    key = F.md5(F.concat(F.col("name"), F.lit(str(seed))))
    if isinstance(files, DataFrame):
        sampled = files.where(F.col("mode").isin(*SAMPLED_MODES))
        rest = files.where(~F.col("mode").isin(*SAMPLED_MODES))
        return rest.unionByName(sampled.orderBy(key, "_file_ord").limit(size))
    if files.mode not in SAMPLED_MODES:
        return files
    picked = files.listing(spark).orderBy(key, "_file_ord").limit(size).orderBy("_file_ord").collect()
    return replace(files, sources=tuple(r["source"] for r in picked), conditions=())


def qualified(spark: SparkSession, source):
    """A source column as a full path: scheme and working folder of the default file system added where missing."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
    root = fs.getUri().toString().rstrip("/")
    here = fs.getWorkingDirectory().toUri().getPath().rstrip("/")
    full = (F.when(source.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:/"), source)
            .when(source.startswith("/"), F.concat(F.lit(root), source))
            .otherwise(F.concat(F.lit(f"{root}{here}/"), source)))
    full = F.regexp_replace(full, r"/(?:\./)+", "/")
    for _ in range(MAX_UPWARD):  # innermost "folder/.." first
        full = F.regexp_replace(full, r"/(?!\.\./)[^/:]+/\.\.(?=/)", "")
    return full


def glob_escaped(path: str) -> str:
    """A path that a reader takes as written: its glob characters are escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_file_system(spark, path).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)))


def existing(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the named paths that exist, looked up side by side."""
    with ThreadPoolExecutor(16) as pool:
        return {p for p, there in zip(paths, pool.map(lambda p: path_exists(spark, p), paths)) if there}
