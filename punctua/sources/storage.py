"""Paths: the shared scratch folder and existence checks that work on any Hadoop file system."""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_roots: dict[str, str] = {}
_cleanup_lock = threading.Lock()
_cleanup_users: list[None] = []
_setting_before: list[str | None] = [None]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in a folder that every executor reaches: the one that
    ``spark.checkpoint.dir`` names, else the context's checkpoint folder, else one below the
    warehouse, which a cluster shares too. Never a machine-local temporary folder.

    All paths of an application lie in one folder of its own, which is removed when it ends; a
    ``Scratch`` removes what it made as soon as its job is done.
    """
    application = spark.sparkContext.applicationId
    root = _roots.get(application)
    if root is None:
        base = spark.conf.get(CHECKPOINT_SETTING, None)
        if not base:
            own = spark.sparkContext._jsc.sc().getCheckpointDir()
            base = own.get() if own.isDefined() else f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        folder = _hadoop_path(spark, base)
        qualified = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
        root = _roots[application] = f"{qualified.rstrip('/')}/punctua-{application}"
        atexit.register(_remove_at_exit, folder.getFileSystem(spark._jsc.hadoopConfiguration()), _hadoop_path(spark, root))
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    folder = _hadoop_path(spark, path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _remove_at_exit(file_system, root) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        file_system.delete(root, True)


class Scratch:
    """Scratch paths of one job, deleted when the job ends, also when it fails.

    Use it where everything that reads the paths has run before the block ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: list[str] = []
        self._lock = threading.Lock()

    def path(self, label: str) -> str:
        found = scratch_path(self.spark, label)
        with self._lock:
            self._paths.append(found)
        return found

    def staged(self, df: DataFrame, label: str) -> DataFrame:
        return _written(df, self.path(label))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self._paths:
            remove(self.spark, path)


@contextlib.contextmanager
def _shuffles_end_with_the_job(spark: SparkSession):
    """Jobs started inside remove their shuffle files when they end, not when the driver happens to
    collect garbage: what they wrote is all that is read of them later. Threads may share it."""
    with _cleanup_lock:
        if not _cleanup_users:
            _setting_before[0] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleanup_users.append(None)
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleanup_users.pop()
            if not _cleanup_users and _setting_before[0] is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            elif not _cleanup_users:
                spark.conf.set(SHUFFLE_CLEANUP, _setting_before[0])


def _written(df: DataFrame, path: str) -> DataFrame:
    with _shuffles_end_with_the_job(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the scratch folder and read it back: reused without recomputation,
    and safe when executors are lost. It stays until the application ends."""
    return _written(df, scratch_path(df.sparkSession, label))


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is no such path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # An existing path without any data file has no schema to infer.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder itself holds a data file; stops at the first."""
    folder = _hadoop_path(spark, path)
    file_system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(folder):
        return False
    names = file_system.listStatusIterator(folder)
    while names.hasNext():
        if not names.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files under ``path`` (metadata only)."""
    table = read_if_present(spark, path)
    return sorted(table.inputFiles()) if table is not None else []
