"""JSON-lines files of the landing folder as raw rows with their origin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import decoded_path, landing_lineage
from tidemark.operators.joins import join_small_side
from tidemark.schemas import RAW
from tidemark.sources.tables import list_files

#: Files that are read; `unread_files` tells the others.
LANDING_GLOB = "*.{json,jsonl,ndjson,txt,json.gz,jsonl.gz,ndjson.gz,txt.gz}"
_READ = r"\.(json|jsonl|ndjson|txt)(\.gz)?$"


def scan_landing(spark: SparkSession, *paths: str, glob: str = LANDING_GLOB) -> DataFrame:
    """Lines of all files below the paths, in one scan. Blank lines are no records."""
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(list(paths))
    )
    return _with_origin(lines)


def stream_landing(
    spark: SparkSession, path: str, glob: str = LANDING_GLOB, files_per_batch: int | None = None
) -> DataFrame:
    """The same as a stream of new files."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_origin(reader.text(path))


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ).filter(F.trim("value") != "")


def unread_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder that `scan_landing` passes over."""
    return list_files(spark, path).filter(~F.col("path").rlike(_READ))


def with_row_numbers(lines: DataFrame) -> DataFrame:
    """Position of every line in its file, from 1.

    A task reads the lines of a block of a file one after the other, so the ids that Spark gives to rows run on inside
    a block. A line's position is its id less its block's first id, moved by the lines of the blocks before: only one
    row for each block is shuffled, no text. Where a scan was cut otherwise than the one that found the blocks, the
    query stops instead of numbering wrongly. What the path tells is read once per block and kept in `origin`, so that
    `raw_envelope` need not read it for every line.
    """
    block = ["file_path", "block_start"]
    numbered = lines.withColumn("__id", F.monotonically_increasing_id())
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    found = numbered.groupBy(*block).agg(
        F.count(F.lit(1)).alias("__lines"), F.min("__id").alias("__first"), F.min_by(F.xxhash64("value"), "__id").alias("__hash")
    )
    offsets = found.withColumn("__offset", F.coalesce(F.sum("__lines").over(before), F.lit(0))).withColumn("origin", path_origin())
    inside = F.col("__id") - F.col("__first")
    wrong = (
        F.col("__offset").isNull() | (inside < 0) | (inside >= F.col("__lines"))
        | ((inside == 0) & (F.xxhash64("value") != F.col("__hash")))
    )
    stop = F.raise_error(F.lit("files changed, or were cut otherwise, while they were numbered")).cast("bigint")
    number = F.when(wrong, stop).otherwise(F.col("__offset") + inside + 1)
    joined = join_small_side(numbered, offsets, block, "left")
    return joined.withColumn("file_row_number", number).drop("__id", "__first", "__lines", "__hash", "__offset")


def path_origin() -> Column:
    """All that the path of a line's file tells."""
    path = decoded_path(F.col("file_path"))
    parts = {"filename": path, **landing_lineage(path)}
    return F.struct(*[column.alias(name) for name, column in parts.items()])


def raw_envelope(
    lines: DataFrame, *, ods_version: str | Column, data_model_version: str | Column,
    tenant_code: str | None = None, api_year: int | None = None, kind: str | None = None, name: str | None = None,
    lineage: str = "path", on_bad_line: str = "fail",
) -> DataFrame:
    """Rows of the raw table from lines of the landing folder.

    What is not given is read from the path. With `lineage="load_time"` the pull date and time are those of the
    load. A line that is no JSON stops the load, or with `on_bad_line="null"` gives a null payload. A file whose
    name is no plain word gives a null name, and so lands in the null partition, apart from all endpoints.
    """
    if lineage not in ("path", "load_time") or on_bad_line not in ("fail", "null"):
        raise ValueError(f"unknown option: lineage={lineage!r}, on_bad_line={on_bad_line!r}")
    if "origin" not in lines.columns:
        lines = lines.withColumn("origin", path_origin())
    origin = {name: F.col("origin")[name] for name in lines.schema["origin"].dataType.names}
    if lineage == "load_time":
        origin |= {"pull_date": F.current_date(), "pull_timestamp": F.current_timestamp()}
    given = {"tenant_code": tenant_code, "api_year": api_year, "kind": kind, "name": name}
    origin |= {column: F.lit(value) for column, value in given.items() if value is not None}
    parse = F.parse_json if on_bad_line == "fail" else F.try_parse_json
    number = F.col("file_row_number") if "file_row_number" in lines.columns else F.lit(None)
    columns = {
        **origin,
        "file_row_number": number,
        "ods_version": _column(ods_version),
        "data_model_version": _column(data_model_version),
        "v": parse(F.col("value")),
    }
    return lines.select(*[columns[field.name].cast(field.dataType).alias(field.name) for field in RAW.fields])


def _column(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def refuse_unread(spark: SparkSession, *paths: str, shown: int = 20) -> None:
    """Raise where there are files below the paths that `scan_landing` passes over; the message names some."""
    for path in paths:
        unread = unread_files(spark, path).filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]"))
        names = [row["path"] for row in unread.select("path").orderBy("path").limit(shown + 1).collect()]
        if names:
            more = " and more" if len(names) > shown else ""
            raise ValueError(f"files of other kinds are in {path}: {', '.join(names[:shown])}{more}")


def scan_variant(spark: SparkSession, *paths: str, glob: str = LANDING_GLOB) -> DataFrame:
    """Records as one variant column, parsed by the JSON reader, with the file they came from."""
    records = (
        spark.read.option("singleVariantColumn", "v").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).json(list(paths))
    )
    return records.select("v", F.col("_metadata.file_path").alias("file_path"))
