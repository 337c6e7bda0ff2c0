"""Appending batches of a stream by their id, each once, without looking at the table.

A batch is first written apart, under its stream and id. Only when it is there whole its files are moved into the table,
and then it is marked as done. A batch that broke off before it was whole is written again; one that broke off while its
files were moved has the rest moved; one that is done is passed over. The table itself is never read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sinks import grain
from tidemark.sources.tables import path_kind, remove_folder

#: Marks of so many earlier batches are kept; Spark repeats the last one only.
KEPT_MARKS = 100
MOVES_AT_A_TIME = 16


def append_batch(
    rows: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str], *, commits: str, stream: str, batch_id: int,
    balance: bool = True,
) -> bool:
    """Append the rows of a batch unless its id was appended before; whether it was appended now.

    `commits` is a folder on the file system of the table, and `stream` a name that no other stream has: ids start anew
    with a new checkpoint. One writer at a time appends for a stream.
    """
    spark = rows.sparkSession
    home = f"{commits.rstrip('/')}/{stream}/{batch_id}"
    done, whole, staged = f"{home}/done", f"{home}/whole", f"{home}/rows"
    if path_kind(spark, done) is not None:
        return False
    if path_kind(spark, whole) is None:
        remove_folder(spark, staged)
        grain.insert(rows, staged, schema, partition_by, balance)
        touch(spark, whole)
    move_files(spark, staged, path)
    touch(spark, done)
    remove_folder(spark, staged)
    if batch_id >= KEPT_MARKS:
        remove_folder(spark, f"{commits.rstrip('/')}/{stream}/{batch_id - KEPT_MARKS}")
    return True


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a mark."""
    place = _path(spark, path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True).close()


def _files(system, folder) -> Iterator[str]:
    """Paths of the data files below a folder, from that folder on."""
    if not system.exists(folder):
        return
    top = system.getFileStatus(folder).getPath().toString()
    found = system.listFiles(folder, True)
    while found.hasNext():
        inner = found.next().getPath().toString().removeprefix(top).lstrip("/")
        if not inner.rpartition("/")[2].startswith(("_", ".")):
            yield inner


def move_files(spark: SparkSession, staged: str, path: str, but: Sequence[str] = ()) -> None:
    """Move the data files below a folder into a table, but for those of some partition folders (relative to either).

    Files keep their names, which no other write has; those that were moved before are gone from the first folder.
    """
    source = _path(spark, staged)
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    hadoop, left_out = spark._jvm.org.apache.hadoop.fs.Path, tuple(f"{folder.strip('/')}/" for folder in but)

    def move(inner: str) -> None:
        if inner.startswith(left_out):
            return
        target = hadoop(f"{path.rstrip('/')}/{inner}")
        system.mkdirs(target.getParent())
        if not system.rename(hadoop(source, inner), target):
            raise OSError(f"{inner} of {staged} could not be moved to {path}")

    with ThreadPoolExecutor(MOVES_AT_A_TIME) as pool:
        for _ in pool.map(move, list(_files(system, source))):
            pass
    spark.catalog.refreshByPath(path)
