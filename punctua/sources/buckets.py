"""Keyed tables dealt into buckets, of which a merge rewrites only those that hold incoming keys.

A row lies in the bucket of its key's hash. A merge reads and writes the touched buckets in a new version
folder and then publishes that version by one empty file, the marker; of every bucket the newest
published version is in force. A merge that fails before its marker has changed nothing, and the files of
untouched buckets stay as they are. The version before is kept for those who are reading it.

    root/merges/<version>                       markers
    root/rows/version=<version>/bucket=<b>      rows
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.sources.storage import Scratch, remove
from punctua.sources.tables import evolve, upsert

BUCKETS = 64


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in system.globStatus(path) or []]


def _leaves(spark: SparkSession, root: str) -> dict[int, list[tuple[int, str]]]:
    """The published ``(version, folder)`` of every bucket, oldest first. Names only."""
    published = {int(path.rsplit("/", 1)[1]) for path in _listed(spark, f"{root}/merges/*")}
    found: dict[int, list[tuple[int, str]]] = {}
    for path in _listed(spark, f"{root}/rows/version=*/bucket=*"):
        version, bucket = (int(part.split("=")[1]) for part in path.rsplit("/", 2)[1:])
        if version in published:
            found.setdefault(bucket, []).append((version, path))
    return {bucket: sorted(paths) for bucket, paths in found.items()}


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    # Buckets merged before a column was added lack it.
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as it is in force, or None before the first merge."""
    leaves = _leaves(spark, root)
    return _read(spark, [paths[-1][1] for _, paths in sorted(leaves.items())]) if leaves else None


def merge_buckets(
    spark: SparkSession, root: str, incoming: DataFrame, keys: list[str], buckets: int = BUCKETS,
    before_publishing: Callable[[], object] = lambda: None,
) -> DataFrame:
    """Insert new keys and replace every attribute of known keys; raises when ``incoming`` doubles a key.

    ``buckets`` must be the same in all merges of a table. Missing columns of either side become NULL.
    ``before_publishing`` runs when all rows are written and none is visible.
    """
    with Scratch(spark) as scratch:
        dealt = scratch.staged(incoming.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "incoming")
        doubled = dealt.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(1).collect()
        if doubled:
            raise ValueError(f"{root}: key {tuple(doubled[0])[:-1]} arrives more than once")
        touched = [row[0] for row in dealt.select("bucket").distinct().collect()]  # at most ``buckets``
        leaves = _leaves(spark, root)
        known = [leaves[bucket][-1][1] for bucket in sorted(touched) if bucket in leaves]
        rows = dealt.drop("bucket")
        if known:
            current = _read(spark, known)
            rows = upsert(evolve(current, rows.schema), evolve(rows, current.schema).select(*evolve(current, rows.schema).columns), keys)
        taken = [int(path.rsplit("=", 1)[1]) for path in _listed(spark, f"{root}/rows/version=*")]
        version = max(taken, default=0) + 1
        target = f"{root}/rows/version={version:012d}"
        placed = rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        try:
            if touched:
                placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(target)
                before_publishing()
        except BaseException:
            remove(spark, target)
            raise
        if touched:
            marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/merges/{version:012d}")
            marker.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(marker)
        for bucket in touched:
            for _, old in leaves.get(bucket, [])[:-1]:
                remove(spark, old)
    return read_buckets(spark, root)
