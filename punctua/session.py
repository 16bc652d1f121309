"""Runtime settings the wide jobs of this library benefit from, and its code on the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # HotSpot never compiles a method above 8000 bytes of bytecode. Whole-stage code for 47 typed
    # columns and 26 rules exceeds that and would run interpreted; with this limit Spark evaluates
    # such a stage through many small compiled methods instead (measured: 2 to 4 times faster).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task with rows of a few months writes their files side by side, without sorting its rows by month.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}
_shipped: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; everything else stays as the session has it."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, once per application. The driver serves the
    archive; where the package is installed on all machines anyway, nothing changes."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        folder = tempfile.mkdtemp(prefix="punctua-")  # the driver's own; executors fetch it by Spark
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = os.path.join(folder, "package")
        shutil.copytree(package, os.path.join(target, "punctua"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "punctua"), "zip", target))
        _shipped.add(application)
    return spark
