"""What several corpus operators share: row numbers, running sums, components, word hashes.

Every helper keeps the work of one task bounded by the size of an input split: hot keys are first
reduced per part (the task that wrote a row), so a key that holds a third of all rows reaches a
shuffle as one row per part.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctua.sources.storage import staged

# Fixed pattern: a word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_rows(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, with two more columns: ``uid``, unique per
    row, and ``part``, the task that wrote it. Both are stable, because they are stored."""
    return staged(
        df.withColumns({"uid": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), label
    )


def join_on(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named columns in which null meets null; keeps the left names."""
    renamed = right.select(
        *(F.col(c).alias(f"_right_{c}") if c in names else F.col(c) for c in right.columns))
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"_right_{name}"))
    return left.join(renamed, condition, how).drop(*(f"_right_{name}" for name in names))


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``facts`` (one row per key) onto ``rows``, of which one key may hold a third.

    The facts first meet one row per key and part; the rows then join on keys *and* part, so that
    a hot key is spread over as many partitions as it has parts. ``rows`` has a stored ``part``.
    """
    places = rows.select(*keys, "part").distinct()
    return join_on(rows, join_on(places, facts, keys), [*keys, "part"], how)


def running_sum(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` in every group, by ``order`` (ascending, nulls last).

    Rows are range-partitioned, so a hot group spans many tasks; each range adds up its own rows
    and is offset by the totals of the ranges before it.
    """
    ascending = [F.col(c).asc_nulls_last() for c in order]
    ranged = staged(
        df.repartitionByRange(F.col(group).asc_nulls_last(), *ascending)
        .withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(group, "_range").agg(F.sum(value).alias("_total"))
        .select(group, "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    local = Window.partitionBy(group, "_range").orderBy(*ascending).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("_sum", F.sum(value).over(local))
    return (
        join_on(summed, offsets, [group, "_range"])
        .withColumn(name, F.col("_sum") + F.col("_offset")).drop("_range", "_sum", "_offset")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``, the least node of each.

    ``edges`` has long columns ``a`` and ``b``. Alternating star contraction: all larger, then all
    smaller neighbours of a node are linked to its least neighbour, until only stars are left; the
    number of rounds grows with the logarithm of the longest path. Each round is a written table,
    so a lost executor costs a retry.
    """
    def toward_least(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        return join_on(pairs, least, ["a"])

    def canonical(pairs: DataFrame) -> DataFrame:
        return (
            pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )

    def only_stars(pairs: DataFrame) -> bool:
        """Every larger end has one link, and none is itself the lesser end of a link."""
        ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("links"), F.lit(0).alias("center")).union(
            pairs.select("b", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("node").agg(F.sum("links").alias("links"), F.max("center").alias("center"))
        return nodes.agg(F.count_if(F.expr("links > 1 OR links = 1 AND center = 1"))).first()[0] == 0

    current = staged(canonical(edges), "links")
    while not only_stars(current):
        both = current.union(current.select("b", "a"))
        large = toward_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = toward_least(large)
        small = stars.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            stars.select("a", F.col("least").alias("b")))
        current = staged(canonical(small), "links")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


class WordHashes(dict):
    """64-bit hashes of words given as UTF-8; keeps those seen, up to a bound."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def utf8(column) -> list[bytes]:
    """The cells of an Arrow string column as UTF-8, null as empty.

    ``bytes.split()`` then yields exactly the words of ``WORD``, as it cuts at ASCII white space only.
    """
    import pyarrow as pa

    return [cell or b"" for cell in column.cast(pa.large_binary()).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every ``length`` consecutive word hashes."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    factors = np.random.default_rng(length).integers(0, 2**63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros(count, np.uint64)
    for i in range(length):
        total += hashes[i:i + count] * factors[i]
    return mixed(total)


def whole_keys(batches, key: str):
    """Arrow tables of whole keys from batches that are sorted by ``key``; the last key is held back
    until it is complete, so memory holds one batch and one key."""
    import pyarrow as pa

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        keys = rows.column(key).to_numpy()
        start = int(np.searchsorted(keys, keys[-1]))
        if start:
            yield rows.slice(0, start)
        held = rows.slice(start)
    if held is not None:
        yield held


def key_bounds(keys: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal sorted keys begins, and the end."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


class Sets:
    """Disjoint sets of 0..n-1."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j
