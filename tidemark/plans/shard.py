"""Splitting CSV files that hold several tenants and years into parquet by tenant and year."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from os import PathLike
from posixpath import basename

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import decoded_path
from tidemark.operators.joins import join_small_side
from tidemark.sources.csvs import MALFORMED, first_lines, read_text_columns, well_formed
from tidemark.sources.tables import NULL_PARTITION, partition_folder, path_kind, remove_folder

TENANT, YEAR = "tenant_code", "api_year"
#: Column of the base name of a row's file, while it is sharded.
FILE = "__csv"
LITERAL_ENTRIES = 50


def partition_on_tenant_and_year(
    spark: SparkSession, csv_paths: str | PathLike | list, output_dir: str | PathLike, tenant_col: str = TENANT,
    tenant_map: Mapping[str, str] | None = None, year_col: str = YEAR, year_map: Mapping[str, str] | None = None,
    multiline: bool = False, quoted_breaks: bool = False,
) -> list[str]:
    """Write every CSV to a parquet folder of its base name, partitioned by tenant and year.

    Files of one header are one scan and one write, so the Spark jobs grow with the headers, not with the files. All
    columns stay text. Rows whose tenant or year is blank or not in its map are in the null partition; see
    `rejected_rows`. Records with more or fewer fields than the header, or a line break inside quotes without
    `quoted_breaks` or `multiline`, are no rows: they are kept as text in `_malformed/` and their base name, below the
    output. Returns the folders written.
    """
    paths = [str(path) for path in (csv_paths if isinstance(csv_paths, (list, tuple)) else [csv_paths])]
    for path in paths:
        if not path.endswith(".csv"):
            raise ValueError(f"expected a name in .csv, got {path!r}")
    stems = {path: basename(path).removesuffix(".csv") for path in paths}
    if len(set(stems.values())) < len(paths):
        raise ValueError("two inputs have the same base name and would overwrite each other")
    for path in paths:
        if path_kind(spark, path) != "file":
            raise ValueError(f"there is no file {path!r}")
    by_header: dict[str | None, list[str]] = {}
    for path, header in first_lines(spark, paths).items():
        by_header.setdefault(header, []).append(path)
    records = [read_text_columns(spark, own, multiline=multiline, quoted_breaks=quoted_breaks, file_column=FILE) for own in by_header.values()]
    rows = [shard_rows(well_formed(own), tenant_col, None, year_col, None) for own in records]  # names are checked before anything is written
    output = str(output_dir).rstrip("/")
    for own, found in zip(by_header.values(), records):
        # the name as a text of the plan's own: a path may hold what a folder's name may not
        stem = F.regexp_extract(decoded_path(F.col(FILE)), r"([^/]*)\.csv$", 1)
        named = found.withColumn(FILE, stem)
        rows = shard_rows(well_formed(named), tenant_col, tenant_map, year_col, year_map)
        # nothing of the first column is added; the reader gives the malformed text only together with another column
        text = F.concat(F.col(MALFORMED), F.left(F.coalesce(F.col(f"`{found.columns[0]}`"), F.lit("")), F.lit(0)))
        # a second look at the files: metrics observed during the write are lost where adaptive execution finds no rows
        texts = named.where(F.col(MALFORMED).isNotNull()).select(text.alias("value"), FILE)
        staged, torn = f"{output}/_staged-{uuid.uuid4().hex}", f"{output}/_torn-{uuid.uuid4().hex}"
        rows.hint("rebalance", FILE, TENANT, YEAR).write.partitionBy(FILE, TENANT, YEAR).parquet(staged)
        texts.write.partitionBy(FILE).text(torn)
        for path in own:
            _publish(spark, partition_folder(staged, {FILE: stems[path]}), f"{output}/{stems[path]}", keep_empty=True)
            _publish(spark, partition_folder(torn, {FILE: stems[path]}), f"{output}/_malformed/{stems[path]}", keep_empty=False)
        remove_folder(spark, staged)
        remove_folder(spark, torn)
    return [f"{output}/{stems[path]}" for path in paths]


def _publish(spark: SparkSession, staged: str, target: str, *, keep_empty: bool) -> None:
    """Put a staged folder in the place of an earlier one; a file without rows has an empty folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source, place = hadoop(staged), hadoop(target)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    there = system.exists(source)
    if not there and not keep_empty:
        remove_folder(spark, target)
        return
    remove_folder(spark, target)
    system.mkdirs(place.getParent() if there else place)
    if there and not system.rename(source, place):
        raise OSError(f"{staged} could not be moved to {target}")
    spark.catalog.refreshByPath(target)


def shard_rows(
    rows: DataFrame, tenant_col: str = TENANT, tenant_map: Mapping[str, str] | None = None, year_col: str = YEAR,
    year_map: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows with `tenant_code` and `api_year`, taken from other columns and through maps where given."""
    for column, role in ((tenant_col, TENANT), (year_col, YEAR)):
        if column not in rows.columns:
            raise KeyError(f"{role} column {column!r} is not in the data")
    sources = rows.withColumns({"__tenant": F.col(tenant_col), "__year": F.col(year_col)})
    mapped = _mapped(_mapped(sources, "__tenant", tenant_map), "__year", year_map)
    others = [column for column in rows.columns if column not in (TENANT, YEAR)]
    blank_to_null = {
        TENANT: F.nullif(F.col("__tenant"), F.lit("")), YEAR: F.nullif(F.col("__year"), F.lit("")),
    }
    return mapped.withColumns(blank_to_null).select(*others, TENANT, YEAR)


def _mapped(rows: DataFrame, column: str, mapping: Mapping[str, str] | None) -> DataFrame:
    """Values replaced through a map, null where it has none.

    A short map is part of the plan. A long one is joined, as a lookup in it would be a search for every row.
    """
    if mapping is None:
        return rows
    texts: dict[str, str] = {}
    for key, value in mapping.items():
        if texts.setdefault(str(key), str(value)) != str(value):
            raise ValueError(f"a map has two values for {str(key)!r}")
    if len(texts) <= LITERAL_ENTRIES:
        literal = F.create_map(*[F.lit(part) for pair in texts.items() for part in pair]) if texts else F.lit(None)
        return rows.withColumn(column, literal[F.col(column)] if texts else literal.cast("string"))
    pairs = list(texts.items())
    table = rows.sparkSession.createDataFrame(pairs, f"{column} string, __mapped string")
    size = sum(len(key) + len(value) for key, value in pairs)
    joined = join_small_side(rows, table, [column], "left", size=size)
    return joined.withColumn(column, F.col("__mapped")).drop("__mapped")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Sharded rows with tenant and year as text, so `00` stays `00`."""
    files = spark.read.option("recursiveFileLookup", True).parquet(folder)
    schema = files.schema.add(TENANT, "string").add(YEAR, "string")
    return spark.read.schema(schema).parquet(folder)


def read_all_shards(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Rows of many sharded files in one scan, with `file`, the base name; a column that some files lack is null there."""
    files = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*folders)
    # a folder's name is escaped by itself, and the path that tells it once more
    part = lambda pattern: decoded_path(F.regexp_extract(decoded_path(F.col("_metadata.file_path")), pattern, 1))
    value = lambda pattern: F.nullif(part(pattern), F.lit(NULL_PARTITION))
    inner = f"/{TENANT}=([^/]*)/{YEAR}=[^/]*/[^/]*$", f"/{YEAR}=([^/]*)/[^/]*$"
    return files.select(
        "*", F.regexp_extract(decoded_path(F.col("_metadata.file_path")), f"([^/]*)/{TENANT}=[^/]*/{YEAR}=[^/]*/[^/]*$", 1).alias("file"),
        value(inner[0]).alias(TENANT), value(inner[1]).alias(YEAR),
    )


def rejected_rows(shards: DataFrame) -> DataFrame:
    """Rows without a tenant or a year."""
    return shards.filter(F.col(TENANT).isNull() | F.col(YEAR).isNull())
