"""CSV files."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidemark.functions import as_number
from tidemark.operators.joins import BROADCAST_BYTES, join_small_side, measured_bytes, settled
from tidemark.schemas import MATCH_RATE_FILE

# Quotes inside a quoted field are doubled.
_QUOTES = {"quote": '"', "escape": '"'}


#: Files that are opened at a time to see their headers, and bytes of a record over several blocks.
OPEN_FILES, MOST_BYTES = 16, 64 << 20

#: Column of the text of records that do not fit the header, null for rows that do.
MALFORMED = "__malformed"


def read_text_columns(
    spark: SparkSession, path: str | list[str], *, multiline: bool = False, quoted_breaks: bool = False, file_column: str | None = None,
) -> DataFrame:
    """A CSV with a header, every column as text, and the text of malformed records in `MALFORMED`.

    Blanks are empty text and `NA` stays `NA`. A record is malformed when it has more or fewer fields than the header.
    A line break ends a record, also inside quotes, and what it tears apart is malformed; unless `quoted_breaks` is set,
    which reads files in splits as well, or `multiline`, which reads a file in one task. Several files must have one
    header. `file_column` names a column for the path of a row's file.
    """
    paths = path if isinstance(path, list) else [path]
    reader = spark.read.options(**_QUOTES).option("header", True).option("multiLine", multiline or quoted_breaks)
    if len(paths) > 1 and len(set(first_lines(spark, paths).values())) > 1:
        raise ValueError("the files have different headers; read those of each header by themselves")
    names = reader.csv(paths[0]).columns
    schema = T.StructType([*(T.StructField(name, T.StringType()) for name in names), T.StructField(MALFORMED, T.StringType())])
    own = [] if file_column is None else [F.col("__file").alias(file_column)]
    if multiline:
        # all fields are read whatever is asked for, as only a whole record can be seen to be malformed
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
        rows = reader.csv(paths).na.fill("", names)
        return rows if file_column is None else rows.withColumn(file_column, F.col("_metadata.file_path"))
    if quoted_breaks:
        lines, options = _without_first(quoted_records(spark, paths)), {"multiLine": "true"}
    else:
        lines, options = _without_headers(spark.read.text(paths)).withColumn("__torn", F.lit(False)), {}
    # the reader by itself would take an open quote for a value
    record = F.from_csv("value", _ddl(schema), {**_QUOTES, **options, "columnNameOfCorruptRecord": MALFORMED})
    torn = F.col("__torn") | (F.regexp_count("value", F.lit('"')) % 2 == 1)
    rows = lines.select("value", "__file", torn.alias("__torn"), record.alias("r"))
    text = F.when(F.col("__torn"), F.col("value")).otherwise(F.col(f"r.{MALFORMED}")).alias(MALFORMED)
    return rows.select(*[F.col(f"r.`{name}`") for name in names], text, *own).na.fill("", names)


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """The first line of each file that is not blank, to where its quotes are closed; nothing for a file without any.

    The file system opens each file and reads a few kB of it; no Spark job runs.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def read(path: str) -> str | None:
        place = jvm.org.apache.hadoop.fs.Path(path)
        file = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(place.getFileSystem(conf).open(place), "UTF-8"))
        try:
            line = file.readLine()
            while line is not None and not line.strip(" "):
                line = file.readLine()
            while line is not None and line.count('"') % 2 and (more := file.readLine()) is not None:
                line = f"{line}\n{more}"
            return line
        finally:
            file.close()

    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return dict(zip(paths, pool.map(read, paths)))


def _without_headers(lines: DataFrame) -> DataFrame:
    """The lines that are not blank, without those that are the first of their file and equal the first file's.

    Later lines that equal the header stay. A file's first line is known by the id that Spark gives to its row. The only
    file of a path begins with the first row of the scan, however it is cut; of several, the ids are joined.
    """
    numbered = lines.select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    ).filter(F.trim("value") != "")
    starts = numbered.filter("__start = 0").select("__file", "__id", "value")
    first = starts.first()
    if first is None:
        return numbered
    header = F.col("value") == F.lit(first["value"])
    stop = F.raise_error(F.lit("files changed, or were cut otherwise, while their headers were found")).cast("boolean")
    if len(lines.inputFiles()) > 1:
        heads = starts.groupBy("__file").agg(F.min_by("value", "__id").alias("value"), F.min("__id").alias("__id"))
        heads = heads.filter(header).select("__file", "__id", F.lit(True).alias("__head"))
        numbered = join_small_side(numbered, heads, ["__file", "__id"], "left")
        here = F.col("__head").isNotNull()
    else:
        here = F.col("__id") == first["__id"]
    return numbered.filter(F.when(~here, True).when(header, False).otherwise(stop))


# --- records with line breaks inside quotes -----------------------------------------------------------------------

#: Blocks of up to so many bytes are read by one task, as long as there are some tasks for each core: a task that starts costs
#: more than a small block.
TASK_BYTES, TASKS_OF_CORE = 16 << 20, 4

_PIECE = "value string, __file string, __start long, __order int, __closes boolean, __first boolean"


def quoted_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of CSV files, each as one text, from files that are read in splits.

    Quotes are counted by block of a file, and whether a block begins inside of quotes is the parity of all before it: one
    small row for each block. With that a task finds the records of its blocks; what reaches over the border of a block is
    put together from its pieces. `__first` marks the first record of a file. A record of more than `MOST_BYTES` over several
    blocks, as an open quote makes of the rest of a file, stays in pieces, which are marked as torn.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    lines = _in_fewer_tasks(lines)
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("__file", "__start").agg((F.sum(F.regexp_count("value", F.lit('"'))) % 2).alias("__odd"))
    blocks = blocks.withColumn("__open", F.coalesce(F.sum("__odd").over(before), F.lit(0)) % 2)
    blocks = settled(blocks.select("__file", "__start", F.col("__open").cast("int").alias("__open"), ((F.col("__open") + F.col("__odd")) % 2 == 1).alias("__left")))
    size = measured_bytes(blocks)
    # a scan that is cut finer than the one that counted has blocks of which nothing is known
    stop = F.raise_error(F.lit("files changed, or were cut otherwise, while their records were found")).cast("int")
    known = _in_order(lines, blocks.drop("__left"), size, "left").withColumn("__open", F.when(F.col("__open").isNull(), stop).otherwise(F.col("__open")))
    whole = known.mapInArrow(lambda batches: _records(batches, pieces=False), _PIECE)
    cut = blocks.filter("__open = 1 or __left").drop("__left")
    pieces = _in_order(lines, cut, size).mapInArrow(lambda batches: _records(batches, pieces=True), _PIECE)
    done = Window.partitionBy("__file").orderBy("__start", "__order").rowsBetween(Window.unboundedPreceding, -1)
    numbered = pieces.withColumn("__record", F.coalesce(F.sum(F.col("__closes").cast("int")).over(done), F.lit(0)))
    bytes_of = F.sum(F.octet_length("value")).over(Window.partitionBy("__file", "__record"))
    numbered = numbered.withColumn("__torn", bytes_of > MOST_BYTES)
    in_order = F.array_sort(F.collect_list(F.struct("__start", "__order", "value")))
    joined = numbered.filter(~F.col("__torn")).groupBy("__file", "__record").agg(
        F.array_join(F.transform(in_order, lambda piece: piece["value"]), "\n").alias("value"), F.bool_or("__first").alias("__first"),
    )
    columns = ["value", "__file", "__first", "__torn"]
    return (
        whole.withColumn("__torn", F.lit(False)).select(*columns).unionByName(joined.withColumn("__torn", F.lit(False)).select(*columns))
        .unionByName(numbered.filter("__torn").select(*columns))
    )


def _in_fewer_tasks(lines: DataFrame) -> DataFrame:
    """The same blocks of a scan, several to a task where they are small and many; ids and places of rows stay."""
    spark = lines.sparkSession
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    blocks = lines.rdd.getNumPartitions()
    tasks = max(-(-blocks // max(1, TASK_BYTES // most)), TASKS_OF_CORE * spark.sparkContext.defaultParallelism)
    return lines.coalesce(tasks) if tasks < blocks else lines


def _without_first(records: DataFrame) -> DataFrame:
    return records.filter(~F.col("__first"))


def _in_order(lines: DataFrame, blocks: DataFrame, size: int, how: str = "inner") -> DataFrame:
    """Lines with what is known of their blocks; a block's lines stay together and in order."""
    joined = join_small_side(lines, blocks, ["__file", "__start"], how, size=size)
    if size > BROADCAST_BYTES:
        joined = joined.sortWithinPartitions("__file", "__start", "__id")
    return joined.select("value", "__file", "__start", "__open")


def _records(batches: Iterator[pa.RecordBatch], pieces: bool) -> Iterator[pa.RecordBatch]:
    """Whole records of blocks, or the pieces that reach over their borders."""
    block, held = None, _Block("", 0, 0)
    for batch in batches:
        files, starts = batch.column("__file").to_numpy(zero_copy_only=False), batch.column("__start").to_numpy()
        new = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        for a, b in pairwise([0, *new.tolist(), len(starts)]):
            if a == b:
                continue
            if block != (files[a], starts[a]):
                yield from _piece_rows(held.end(), held, pieces)
                block = (files[a], starts[a])
                held = _Block(str(files[a]), int(starts[a]), int(batch.column("__open")[a].as_py()))
            yield from _piece_rows(held.add(batch.column("value").slice(a, b - a)), held, pieces)
    yield from _piece_rows(held.end(), held, pieces)


def _piece_rows(found: Iterator[tuple], block: _Block, pieces: bool) -> Iterator[pa.RecordBatch]:
    """Of (values, order, closes, first) those asked for; order 0 is a whole record."""
    for values, order, closes, first in found:
        if (order > 0) == pieces and len(values):
            n = len(values)
            flags = np.zeros(n, dtype=bool)
            flags[0] = first
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.string()), pa.array([block.file] * n), pa.array([block.start] * n, pa.int64()), pa.array([order] * n, pa.int32()), pa.array([closes] * n), pa.array(flags)],
                ["value", "__file", "__start", "__order", "__closes", "__first"],
            )


class _Block:
    """The lines of one block of a file, as they come."""

    def __init__(self, file: str, start: int, opened: int):
        self.file, self.start, self.parity = file, start, opened
        self.lines: list[str] = []  # of the record that is open
        self.outside = bool(opened)  # whether it began in a block before
        self.seen_first = start > 0
        self.first_is_open = False

    def add(self, values: pa.Array) -> Iterator[tuple]:
        odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
        after = (self.parity + np.cumsum(odd)) % 2
        alone = (after == 0) & (odd == 0)
        at = 0
        for i in [*np.flatnonzero(~alone).tolist(), len(values)]:
            if at < i:
                yield from self._alone(values.slice(at, i - at))
            at = i + 1
            if i == len(values):
                break
            if not self.lines and not self.outside and odd[i] and not self.seen_first:
                self.seen_first = self.first_is_open = True
            self.lines.append(values[i].as_py())
            if not after[i]:
                yield from self._closed()
        self.parity = int(after[-1])

    def _alone(self, values: pa.Array) -> Iterator[tuple]:
        """Lines that are records."""
        values = values.filter(pc.not_equal(pc.utf8_trim(values, " \r"), ""))
        if len(values):
            first, self.seen_first = not self.seen_first, True
            yield pc.utf8_rtrim(values, "\r"), 0, True, first

    def _closed(self) -> Iterator[tuple]:
        text = "\n".join(self.lines).removesuffix("\r")
        yield [text], int(self.outside), True, self.first_is_open
        self.lines, self.outside, self.first_is_open = [], False, False

    def end(self) -> Iterator[tuple]:
        if self.lines:
            yield ["\n".join(self.lines)], 1 if self.outside else 2, False, self.first_is_open
            self.lines = []


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` string" for name in schema.names)


def well_formed(records: DataFrame) -> DataFrame:
    return records.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def read_positional(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """A CSV whose columns are taken by position; the header line is skipped."""
    reader = spark.read.schema(schema).options(**_QUOTES).option("header", True).option("enforceSchema", True)
    return reader.csv(path)


def read_match_rates(spark: SparkSession, path: str) -> DataFrame:
    """Computed match rates by header name. A missing file gives no rows."""
    try:
        text = spark.read.options(**_QUOTES).option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MATCH_RATE_FILE)
    numbers = {"num_matches": "bigint", "num_rows": "bigint", "match_rate": "double"}
    return text.select(
        *[
            as_number(F.col(field.name)).cast(numbers[field.name]).alias(field.name) if field.name in numbers
            else F.col(field.name)
            for field in MATCH_RATE_FILE.fields
        ]
    )
