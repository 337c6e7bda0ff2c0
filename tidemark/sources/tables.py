"""Reading tables that are kept as parquet below a path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Characters that Spark escapes in the folder name of a partition value.
_ESCAPED = "\"#%'*/:=?\\{[]^\x7f"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

ANY = object()


def partition_folder(path: str, values: Mapping[str, object]) -> str:
    """Folder of leading partition values below a table's path; `ANY` stands for every value."""
    segments = [f"{column}={_segment(value)}" for column, value in values.items()]
    return "/".join([path.rstrip("/"), *segments])


def _segment(value: object) -> str:
    if value is ANY:
        return "*"
    return NULL_PARTITION if value is None else _escape(str(value))


def _escape(value: str) -> str:
    return "".join(f"%{ord(char):02X}" if char in _ESCAPED or char < " " else char for char in value)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, within: Mapping[str, object] | None = None
) -> DataFrame:
    """A table, or no rows where it does not exist.

    `within` gives values of the leading partition columns: only their folders are listed, which matters when the
    table has very many partitions. The schema is always given, so `007` stays text.
    """
    folder = partition_folder(path, within or {})
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """Path, length and time of every file below a folder; the content is not read. No folder, no rows."""
    if not path_exists(spark, directory):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    return files.select("path", "length", "modificationTime")  # this path is not percent-encoded


def path_kind(spark: SparkSession, path: str) -> str | None:
    """`file`, `folder`, or nothing where the file system has none; nothing is listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop):
        return None
    return "folder" if system.getFileStatus(hadoop).isDirectory() else "file"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder; a path with `*` segments where one fits."""
    if "*" not in path:
        return path_kind(spark, path) is not None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all below it; nothing to do where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    spark.catalog.refreshByPath(path)
