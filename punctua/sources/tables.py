"""Period-partitioned Parquet tables: scan, replace, append, upsert, evolve."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from punctua.operators.geo import airport_coordinates, route_coordinates
from punctua.schemas import KPI_SCHEMAS, KPI_TABLES
from punctua.sources import releases
from punctua.sources.storage import data_files, has_data, read_if_present, remove, staged

Period = tuple[int, int]
PERIOD_COLUMNS = ["year", "month"]


def period_filter(periods: Iterable[Period]):
    """Predicate for a set of (year, month); prunes partitions."""
    condition = F.lit(False)
    for year, month in periods:
        condition = condition | ((F.col("year") == year) & (F.col("month") == month))
    return condition


def scan_period(spark: SparkSession, root: str, year: int, month: int, name: str = "table") -> DataFrame:
    """Rows of one period; raises ``FileNotFoundError`` when the table or the period is missing."""
    return require_period(spark, root, year, month, name).where(period_filter([(year, month)]))


def require_period(spark: SparkSession, root: str, year: int, month: int, name: str = "table") -> DataFrame:
    table = read_if_present(spark, root)
    if table is None:
        raise FileNotFoundError(f"{name} not found: {root}")
    if not any(has_data(spark, p) for p in _leaves(root, year, month)):
        raise FileNotFoundError(f"{name} has no files for {year}-{month:02d}: {root}")
    return table


def _leaves(root: str, year: int, month: int) -> list[str]:
    """The folder of a period, with and without a zero-padded month."""
    names = [f"{root}/year={year}/month={month}"]
    if month < 10:
        names.append(f"{root}/year={year}/month={month:02d}")
    return names


def unify_months(spark: SparkSession, root: str) -> None:
    """Give zero-padded month folders the spelling that this module writes, so that a period has one
    folder. Folders only: their number is that of the months."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(root)
    file_system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in file_system.globStatus(path(f"{root}/year=*/month=0*")) or []:
        padded = status.getPath()
        plain = path(padded.getParent(), f"month={int(padded.getName().split('=')[1])}")
        if not file_system.exists(plain):
            file_system.rename(padded, plain)
            continue
        for file in file_system.listStatus(padded):
            if not file.getPath().getName().startswith("_"):
                file_system.rename(file.getPath(), path(plain, file.getPath().getName()))
        file_system.delete(padded, True)


def write_periods(df: DataFrame, root: str, one: bool = False, dealt: bool = False) -> None:
    """Overwrite exactly the periods present in ``df``; all other periods stay as they are.

    The rebalance hint lets adaptive execution cut a hot month into several files and merge the
    small ones. ``one`` says that all rows are of one period: they are then dealt out evenly instead
    of by their period, which would be a single key. ``dealt`` says that every task has rows of few
    periods as it is: they are written from where they are, without a shuffle.
    """
    unify_months(df.sparkSession, root)
    if not dealt:
        df = df.hint("rebalance", *([] if one else [F.col(c) for c in PERIOD_COLUMNS]))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PERIOD_COLUMNS)
        .parquet(root)
    )


def replace_period(df: DataFrame, root: str, year: int, month: int, dealt: bool = False) -> None:
    """Replace one period by the rows of ``df`` for it, also when there are none.

    A dynamic overwrite leaves a period untouched when no row arrives. Spark's file names are new
    in every write, so an unchanged listing means exactly that, and the period is then emptied.
    """
    spark = df.sparkSession
    unify_months(spark, root)
    leaf = f"{root}/year={year}/month={month}"
    before = data_files(spark, leaf)
    write_periods(df.where(period_filter([(year, month)])), root, one=True, dealt=dealt)
    if before and data_files(spark, leaf) == before:
        spark.createDataFrame([], df.drop(*PERIOD_COLUMNS).schema).write.mode("overwrite").parquet(leaf)


def append_rows(df: DataFrame, root: str, partitioned: bool = True) -> None:
    writer = df.write.mode("append")
    if partitioned:
        writer = writer.partitionBy(*PERIOD_COLUMNS)
    writer.parquet(root)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Append to a database table from the executors; the caller bounds the partition count."""
    df.write.mode("append").option("batchsize", batch_size).jdbc(url=url, table=table, properties=properties)


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys and replace every attribute of known keys.

    ``incoming`` must hold each key once. Returns the merged rows; write them to a new snapshot,
    as a table cannot be overwritten while it is read.
    """
    return incoming.unionByName(target.join(incoming.select(*keys), keys, "left_anti"))


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of the table at ``path``, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    file_system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop(f"{path}/version-*/_SUCCESS")) or []
    return sorted(status.getPath().getParent().toString() for status in found)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of the table at ``path``, or None when there is none."""
    versions = _versions(spark, path)
    return spark.read.parquet(versions[-1]) if versions else None


def merge_snapshot(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert into the unpartitioned table at ``path``; raises when ``incoming`` doubles a key.

    The merged rows are a new version in a folder of its own, which counts once Spark has marked
    its write as complete. A write that fails leaves the version before it in force. The last
    version but one is kept for those who are reading it.
    """
    incoming = staged(incoming, "incoming")
    doubled = incoming.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).limit(1).collect()
    if doubled:
        raise ValueError(f"{path}: key {tuple(doubled[0])[:-1]} arrives more than once")
    versions = _versions(spark, path)
    current = spark.read.parquet(versions[-1]) if versions else None
    merged = incoming if current is None else upsert(evolve(current, incoming.schema), incoming, keys)
    number = int(versions[-1].rsplit("-", 1)[1]) + 1 if versions else 1
    target = f"{path}/version-{number:012d}"
    remove(spark, target)  # an incomplete write of that number
    merged.write.parquet(target)
    for old in versions[:-1]:
        remove(spark, old)
    return spark.read.parquet(target)


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape rows to a table schema by name: missing columns become typed NULLs, the order is the
    table's, columns the table does not know are kept at the end."""
    present = {c.lower() for c in df.columns}
    known = {f.name.lower() for f in schema.fields}
    shaped = [
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name.lower() in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*shaped, *[F.col(c) for c in df.columns if c.lower() not in known])


def ensure_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Create an empty table with this schema unless there already is one; rows are never lost."""
    if not has_data(spark, root):
        spark.createDataFrame([], schema).write.mode("append").parquet(root)
    partitioned = [c for c in PERIOD_COLUMNS if c in schema.names]
    ordered = T.StructType(
        [f for f in schema.fields if f.name not in partitioned]
        + [schema[c] for c in partitioned]
    )
    return spark.read.schema(ordered).parquet(root).select(*schema.names)


def load_gold(
    spark: SparkSession, root: str, dataset: str, periods: Iterable[Period], dim_airport: DataFrame | None = None,
) -> DataFrame:
    """KPI rows of a named dataset (airlines, airports, routes, flights) for a set of periods.

    With ``dim_airport``, airports come with ``latitude`` and ``longitude`` and routes with those of
    both ends, NULL where unknown.
    """
    if dataset not in KPI_TABLES:
        raise ValueError(f"no KPI dataset is called {dataset!r}; there are {sorted(KPI_TABLES)}")
    table = KPI_TABLES[dataset]
    rows = releases.read_months(spark, root, {table: KPI_SCHEMAS[dataset]}, periods)[table]
    if dim_airport is None or dataset not in ("airports", "routes"):
        return rows
    return (airport_coordinates if dataset == "airports" else route_coordinates)(rows, dim_airport)


def with_period_key(df: DataFrame, name: str) -> DataFrame:
    """Unique 63-bit keys from ``year``, ``month`` and the place of a row in the write: no scan of
    older rows, no shuffle, no second copy. Keys of different periods never meet, so that months
    can be written at the same time; a month that is written again gets keys anew.

    Bits: 16 for the month, 20 for the task, 27 for the row in the task.
    """
    place = F.monotonically_increasing_id()  # task above, row below 33 bits
    row, task = place.bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright(place, 33)
    month = (F.col("year") * 12 + F.col("month")).cast("long")
    fits = (row < 1 << 27) & (task < 1 << 20) & (month < 1 << 16)
    key = F.shiftleft(month, 47) + F.shiftleft(task, 27) + row
    return df.select(F.when(fits, key).otherwise(F.raise_error(F.lit("no key left for a task"))).alias(name), *df.columns)


def with_positions(df: DataFrame, group: str, order: list, name: str, start: int = 1) -> DataFrame:
    """``start, start + 1, …`` in the given order within every group, without one sort task per group.

    Rows are range-partitioned by group and order, written once and numbered in their partition;
    the sizes of the parts of a group give the offsets. The order must tell the rows of a group apart.
    """
    ranged = staged(df.repartitionByRange(F.asc_nulls_last(group), *order).withColumn("_part", F.spark_partition_id()), "numbered")
    local = Window.partitionBy(group, "_part").orderBy(*order)
    earlier = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_at")).agg(F.count("*").alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    )
    numbered = ranged.withColumn("_row", F.row_number().over(local))
    return (
        numbered.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at")))
        .select(*df.columns, (F.col("_offset") + F.col("_row") + F.lit(start - 1)).alias(name))
    )


def with_surrogate_key(df: DataFrame, order: list, name: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive keys ``start, start + 1, …`` over all rows in the given order, which must tell
    rows apart (a unique key)."""
    keyed = with_positions(df.withColumn("_all", F.lit(0)), "_all", order, name, start)
    return keyed.select(name, *df.columns)
