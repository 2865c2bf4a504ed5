"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job of this package assumes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows with whole texts: a batch of the default 10,000 would weigh tens of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


#: Spark's switch: shuffle files of a query go when it ends, not when the driver happens to collect garbage.
BRIEF_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Per application: its own folder where none is configured, and what it wrote.
_own_folder: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor must be able to reach.

    Only a local master, whose tasks share the driver's disk, may leave it unset.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _own_folder:
            _own_folder[app] = tempfile.mkdtemp(prefix="eventloom-")
        base = _own_folder[app]
    path = f"{base.rstrip('/')}/eventloom-{label}-{uuid.uuid4().hex}"
    _written.setdefault(app, []).append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def finished_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` that a job has written to the end."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if files.exists(hadoop.Path(s.getPath(), "_SUCCESS"))]


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application wrote to its scratch folders, once results that read it are
    written themselves; returns the number of folders."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_folder(spark, path)
    return len(paths)


def release(*frames: DataFrame) -> None:
    """Delete the folders of frames from ``cut_lineage`` that nothing will read again."""
    for df in frames:
        path = getattr(df, "_scratch_folder", None)
        if path is not None:
            written = _written.get(df.sparkSession.sparkContext.applicationId, [])
            if path in written:
                written.remove(path)
                delete_folder(df.sparkSession, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are built and run in here delete their shuffle files at their end.

    For frames that run once; Spark would compute them again for a second run.
    """
    before = spark.conf.get(BRIEF_SHUFFLES, "false")
    spark.conf.set(BRIEF_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(BRIEF_SHUFFLES, before)


def cut_lineage(df: DataFrame, label: str = "cut", by: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the scratch folder and continue from the written table.

    Operators that read their input several times start from it, and a lost executor re-reads
    files instead of replaying the whole plan. ``by``, the last column, makes folders of rows read apart.
    Nothing reads the shuffle files of the write again, so they go with it.
    """
    path = scratch_path(df.sparkSession, label)
    with brief_shuffles(df.sparkSession):
        df.write.parquet(path, partitionBy=by)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch_folder = path
    return written
