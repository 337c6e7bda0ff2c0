"""Writing tables by grain: append, replace, clear, rewrite.

A table is parquet below a path, partitioned by the columns of its grain. There is no UPDATE or DELETE, so a
change is a new version of the partitions it touches. Rows are rebalanced on the partition columns before a
write: small partitions become one file each and a very large one is split over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions import decoded_path
from tidemark.operators.joins import BROADCAST_BYTES, among_values, measured_bytes, settled
from tidemark.sources.tables import NULL_PARTITION, list_files, partition_folder, path_exists, read_or_empty, remove_folder

#: Size of a file that compaction aims at.
TARGET_BYTES = 256 << 20
MOST_TASKS = 20_000
#: Folder, hidden from readers, of the partitions that a swap has emptied.
EMPTIED = "_emptied"


def _writer(df: DataFrame, schema: T.StructType, partition_by: Sequence[str], mode: str, balance: bool = True):
    rows = df.select(*[F.col(field.name).cast(field.dataType) for field in schema.fields])
    if balance:
        rows = rows.hint("rebalance", *partition_by)
    return rows.write.mode(mode).partitionBy(*partition_by)


def insert(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str], balance: bool = True) -> None:
    """Append rows; columns are taken by name."""
    _writer(df, schema, partition_by, "append", balance).parquet(path)


def replace(df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str], balance: bool = True) -> None:
    """Replace the partitions that the rows belong to, in one commit; others stay."""
    writer = _writer(df, schema, partition_by, "overwrite", balance)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def insert_once(
    df: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str], *, again: Column,
    among: DataFrame | None = None, size: int | None = None, within: Mapping[str, object] | None = None, balance: bool = True,
) -> None:
    """Append a batch that may have been written before.

    Rows of an earlier attempt at the batch are those that meet the condition `again` and, where it is given, have
    their key in the small table `among`. Mostly there are none and this is a plain append. Otherwise the
    partitions that hold them are rewritten without them, then the batch is appended. `within` gives leading
    partition values beyond which no such row can be. `size` is that of `among`, where it was settled and measured.
    """
    finish_swaps(df.sparkSession, path)
    keys = None if among is None else _Keys(among, size)
    table = read_or_empty(df.sparkSession, path, schema, within)
    earlier = table.filter(again) if keys is None else table.filter(keys.among(partition_by)).filter(again)
    if keys is not None:
        earlier = keys.semi(earlier)
    if not earlier.isEmpty():
        touched = settled(earlier.select(*partition_by).distinct())
        swapped = _Keys(touched, measured_bytes(touched))
        kept = swapped.semi(table.filter(swapped.among(partition_by)))
        stale = F.coalesce(again, F.lit(False))
        kept = kept.filter(~stale) if keys is None else keys.without(kept, stale)
        _swap(kept, touched, path, schema, partition_by)
    insert(df, path, schema, partition_by, balance)


class _Keys:
    """A small table of keys, null equal to null, to select rows of a large one without shuffling it."""

    def __init__(self, keys: DataFrame, size: int | None = None):
        if size is None:
            keys = settled(keys.distinct())
            size = measured_bytes(keys)
        self.keys = keys
        table = keys.select(*[F.col(column).alias(f"__{column}") for column in keys.columns])
        self.table = F.broadcast(table) if size <= BROADCAST_BYTES else table
        self.same = reduce(Column.__and__, [F.col(column).eqNullSafe(F.col(f"__{column}")) for column in keys.columns])

    def among(self, partition_by: Sequence[str]) -> Column:
        """The partitions that the keys can be in, as literals: a join by itself prunes none."""
        return among_values(self.keys, [column for column in partition_by if column in self.keys.columns])

    def semi(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.table, self.same, "left_semi")

    def without(self, rows: DataFrame, condition: Column) -> DataFrame:
        """Rows but for those that meet a condition and are in the keys."""
        return rows.join(self.table, self.same & condition, "left_anti")


def rewrite(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str],
    partitions: Mapping[str, object] | DataFrame, change: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace partitions by a changed version: one, given by its values, or those of a small table."""
    if isinstance(partitions, DataFrame):
        touched = settled(partitions.select(*partition_by).distinct())
        own = _Keys(touched, measured_bytes(touched))
        rows = own.semi(read_or_empty(spark, path, schema).filter(own.among(partition_by)))
    else:
        touched = spark.range(1).select(*[F.lit(partitions[column]).alias(column) for column in partition_by])
        rows = read_or_empty(spark, path, schema, partitions)
    _swap(change(rows), touched, path, schema, partition_by)


def remove_rows(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], *, stale: Column, among: DataFrame,
    within: Mapping[str, object] | None = None,
) -> None:
    """Remove the rows that meet a condition and have their key in a small table; only partitions that hold some change."""
    keys = _Keys(among)
    table = read_or_empty(spark, path, schema, within)
    found = keys.semi(table.filter(keys.among(partition_by)).filter(stale))
    touched = settled(found.select(*partition_by).distinct())
    if touched.isEmpty():
        return
    own = _Keys(touched, measured_bytes(touched))
    kept = keys.without(own.semi(table.filter(own.among(partition_by))), F.coalesce(stale, F.lit(False)))
    _swap(kept, touched, path, schema, partition_by)


def small_file_plan(files: DataFrame, partition_by: Sequence[str], *, target_bytes: int = TARGET_BYTES, least_gain: int = 2) -> DataFrame:
    """Partitions that should be compacted, from a listing of a table's files (`path`, `length`).

    A partition's files fit into `bins` of a target size; it is chosen where it has at least `least_gain` times as many.
    One row for each: the partition's values, `files`, `bytes`, `bins`.
    """
    folder = lambda column: decoded_path(F.regexp_extract("path", f"/{column}=([^/]*)/", 1))
    values = [F.nullif(folder(column), F.lit(NULL_PARTITION)).alias(column) for column in partition_by]
    data = files.filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
    sizes = data.select(*values, "length").groupBy(*partition_by).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    planned = sizes.withColumn("bins", F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1)))
    return planned.filter((F.col("files") > 1) & (F.col("files") >= least_gain * F.col("bins")))


def compact_small_files(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], *, target_bytes: int = TARGET_BYTES, least_gain: int = 2,
) -> DataFrame:
    """Rewrite the partitions that many small appends have left in many small files, and return what was planned.

    Only these are read; which they are is known from the listing. A partition becomes as many files as it has bins.
    """
    types = {field.name: field.dataType for field in schema.fields}
    plan = small_file_plan(list_files(spark, path), partition_by, target_bytes=target_bytes, least_gain=least_gain)
    plan = settled(plan.select(*[F.col(column).cast(types[column]).alias(column) for column in partition_by], "files", "bytes", "bins"))
    if plan.isEmpty():
        return plan
    own = _Keys(plan.select(*partition_by), measured_bytes(plan))
    rows = own.semi(read_or_empty(spark, path, schema).filter(own.among(partition_by)))
    # rows of a partition are dealt to its bins by a number of their own; with the number of tasks given, none are merged
    tasks = min(2 * plan.agg(F.sum("bins")).first()[0] + 1, MOST_TASKS)
    bins = plan.select(*[F.col(column).alias(f"__{column}") for column in partition_by], "bins")
    same = reduce(Column.__and__, [F.col(column).eqNullSafe(F.col(f"__{column}")) for column in partition_by])
    dealt = rows.join(F.broadcast(bins) if measured_bytes(bins) <= BROADCAST_BYTES else bins, same)
    dealt = dealt.withColumn("__bin", F.pmod(F.monotonically_increasing_id(), F.col("bins")))
    _swap(dealt.repartition(tasks, *partition_by, "__bin").select(*types), plan.select(*partition_by), path, schema, partition_by, balance=False)
    return plan


def compact(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str],
    partitions: Mapping[str, object] | DataFrame,
) -> None:
    """Rewrite partitions that many small appends have left in many small files."""
    rewrite(spark, path, schema, partition_by, partitions, lambda rows: rows)


def _swap(
    rows: DataFrame, touched: DataFrame, path: str, schema, partition_by: Sequence[str], balance: bool = True,
) -> None:
    """Write new versions of the touched partitions, from a copy in reliable storage; emptied ones are cleared.

    The folders of emptied partitions are noted beside the table first: where the swap breaks off after the new versions
    are there, the next one clears them.
    """
    spark = rows.sparkSession
    finish_swaps(spark, path)
    staged = settled(rows)
    left = _Keys(staged.select(*partition_by))
    emptied = [
        partition_folder(path, {column: row[column] for column in partition_by}) for row in left.without(touched, F.lit(True)).toLocalIterator()
    ]
    note = f"{path.rstrip('/')}/{EMPTIED}"
    if emptied:
        spark.createDataFrame([(folder,) for folder in emptied], "value string").coalesce(1).write.mode("overwrite").text(note)
    if not staged.isEmpty():
        replace(staged, path, schema, partition_by, balance)
    if emptied:
        finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Clear the partitions that a swap has noted as emptied, also one that broke off before it did."""
    note = f"{path.rstrip('/')}/{EMPTIED}"
    if not path_exists(spark, f"{note}/_SUCCESS"):
        remove_folder(spark, note)
        return
    for row in spark.read.text(note).toLocalIterator():
        remove_folder(spark, row["value"])
    remove_folder(spark, note)


def clear(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], within: Mapping[str, object],
    names: Iterable[str] | None = None,
) -> None:
    """Remove all rows of a grain: everything below leading partition values, or only the named last partitions.

    The folders are removed in the file system; no Spark job runs.
    """
    leading = {column: within[column] for column in partition_by if column in within}
    if names is None:
        remove_folder(spark, partition_folder(path, leading))
    for name in names or ():
        remove_folder(spark, partition_folder(path, {**leading, partition_by[-1]: name}))
