"""Steps of a job that need not be repeated after a failure."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession


def identity(spark: SparkSession, paths: list[str]) -> str | None:
    """A digest of the names, sizes and times of all files under ``paths``; None where there is no file.

    Spark names its files anew in every write, so an unchanged identity means unchanged rows. Metadata
    only: one entry per file of a month.
    """
    digest, files = hashlib.sha256(), 0
    for root in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            continue
        found, listing = [], system.listFiles(path, True)
        while listing.hasNext():
            status = listing.next()
            file = status.getPath()
            if not file.getName().startswith(("_", ".")):
                found.append(f"{file.toString()}:{status.getLen()}:{status.getModificationTime()}")
        files += len(found)
        digest.update("\n".join([root, *sorted(found)]).encode())
    return digest.hexdigest() if files else None


class Steps:
    """Runs steps and records each, once it is done, with the identity of what it read and wrote.

    A step is left out when its record names the inputs as they are now and the outputs are still
    those it wrote. A record is one small file; one that is cut short counts as none.
    """

    def __init__(self, spark: SparkSession, folder: str, fresh: bool = False):
        self.spark, self.folder, self.fresh = spark, folder, fresh

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.json")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _record(self, name: str) -> dict:
        path, system = self._path(name)
        if not system.exists(path):
            return {}
        stream = system.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return {}

    def run(self, name: str, inputs: list[str], outputs: list[str], job: Callable[[], object]) -> bool:
        """Do ``job`` unless it is done already; says whether it was done now."""
        before = identity(self.spark, inputs)
        record = {} if self.fresh else self._record(name)
        if before is not None and record.get("inputs") == before and record.get("outputs") == identity(self.spark, outputs) is not None:
            return False
        job()
        # The identity from before the job: inputs that changed meanwhile make the step run again.
        path, system = self._path(name)
        stream = system.create(path, True)
        try:
            stream.write(bytearray(json.dumps({"inputs": before, "outputs": identity(self.spark, outputs)}).encode()))
        finally:
            stream.close()
        return True
