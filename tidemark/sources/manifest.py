"""Lists of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import base_name, decoded_path, directory_name
from tidemark.sources.landing import with_row_numbers
from tidemark.sources.tables import list_files

def with_match(files: DataFrame, pattern: str | None = None, path: str = "path") -> DataFrame:
    """Whether the base name of a file contains a match of the pattern; without a pattern all do."""
    matched: Column = base_name(F.col(path)).rlike(pattern) if pattern else F.lit(True)
    return files.withColumn("matched", matched)


def with_folder(files: DataFrame, root: str, path: str = "path") -> DataFrame:
    """Folder below the root, and the file name."""
    folder = directory_name(F.col(path))
    below = F.regexp_replace(folder, F.concat(F.lit("^.*?"), F.lit(_quoted(root.rstrip("/"))), F.lit("/?")), F.lit(""))
    return files.withColumns({"folder": below, "file": base_name(F.col(path))})


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def file_manifest(spark: SparkSession, directory: str, pattern: str | None = None) -> DataFrame:
    """All files below a folder, those that do not match the pattern included and marked."""
    return with_match(list_files(spark, directory), pattern)


def file_fingerprints(spark: SparkSession, *paths: str) -> DataFrame:
    """A fingerprint of the lines of every text file and their order, whatever its size and however it is cut.

    Hashes of lines with their positions are summed per file, so a file is never in one task as a whole.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start")
    )
    placed = with_row_numbers(lines).select("file_path", F.xxhash64("file_row_number", "value").alias("h"))
    parts = placed.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")
    )
    text = F.concat_ws(":", "n", "s", "x")
    return parts.select(decoded_path(F.col("file_path")).alias("path"), F.sha2(text, 256).alias("content_hash"))
