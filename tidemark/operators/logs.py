"""Shaping the log of runs: errors rolled up per run, and rows for the run-log table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.constants import ERROR_LEVEL
from tidemark.functions import base_name
from tidemark.operators.joins import join_small_side, measured_bytes, settled

RUN = ["tenant_code", "api_year", "grain_update", "run_type", "run_date", "run_timestamp"]
ERROR_FIELDS = ["timestamp", "name", "level", "message", "pathname", "lineno"]
CHUNK_ERRORS = 1000
#: Block of the errors without a position: below all others.
_NO_BLOCK = -(1 << 63)


def is_error() -> Column:
    return (F.col("level") == ERROR_LEVEL) | F.col("message").contains(ERROR_LEVEL)


def errors_only(logs: DataFrame) -> DataFrame:
    return logs.filter(is_error())


def error_rollup(logs: DataFrame, run: Sequence[str] = RUN, chunk: int = CHUNK_ERRORS) -> DataFrame:
    """Errors of every run: the last one's arguments and time, and all of them as a list in order.

    `logs` has the run's columns, `seq` (the record's position in its run), and the fields of a log record. There is
    one row for each `chunk` errors of a run, numbered by `part`, so that no task holds all errors of a run; every
    part repeats the run's totals. Runs without errors do not appear. A null and a blank in the run's columns are two
    runs. Errors whose `seq` is null come first, in no order of theirs, and are never the last one.
    """
    run = list(run)
    block = F.coalesce(F.floor(F.col("seq") / chunk), F.lit(_NO_BLOCK))
    errors = errors_only(logs).withColumn("__run", _run_key(run)).withColumn("__block", block)
    last = F.max_by(F.struct("args", "kwargs", F.col("timestamp").alias("last_error_timestamp")), "seq")
    first = [F.first(key).alias(key) for key in run]
    totals = settled(errors.groupBy("__run").agg(*first, F.count(F.lit(1)).alias("n_errors"), last.alias("last")))
    size = measured_bytes(totals)
    fields = [field for field in ERROR_FIELDS if field in logs.columns]
    placed = _placed(errors, fields, chunk)
    ordered = F.sort_array(F.collect_list(F.struct("__position", *fields)))
    parts = placed.groupBy("__run", F.floor(F.col("__position") / chunk).cast("bigint").alias("part")).agg(ordered.alias("errors"))
    without_position = F.transform("errors", lambda error: error.dropFields("__position"))
    return join_small_side(parts, totals, ["__run"], size=size).select(
        *run, "part", "n_errors", "last.args", "last.kwargs", "last.last_error_timestamp", without_position.alias("errors")
    )


def _placed(errors: DataFrame, fields: list[str], chunk: int) -> DataFrame:
    """Errors with their position in their run.

    A position is the place in a block of `seq`, moved by the errors of the blocks before. Where many errors share a
    `seq`, or have none, their block is cut into ranges of a hash, in the order of which they then stand: no range holds
    much more than `chunk` of them.
    """
    blocks = settled(errors.groupBy("__run", "__block").agg(F.count(F.lit(1)).alias("__n")))
    crowded = blocks.filter(F.col("__n") > 4 * chunk)
    if crowded.isEmpty():
        ranged, groups = errors, ["__run", "__block"]
        sizes = blocks
    else:
        groups = ["__run", "__block", "__seq", "__range"]
        keyed = errors.withColumn("__key", F.coalesce(F.col("seq").cast("bigint"), F.lit(_NO_BLOCK)))
        own = join_small_side(keyed.select("__run", "__block", "__key"), crowded.select("__run", "__block"), ["__run", "__block"], "left_semi")
        cuts = own.groupBy("__run", "__block", "__key").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("__cuts"))
        share = F.shiftrightunsigned(F.xxhash64("seq", *fields), 32) / F.lit(float(1 << 32))
        ranged = join_small_side(keyed, cuts, ["__run", "__block", "__key"], "left").withColumns(
            {"__seq": F.when(F.col("__cuts").isNotNull(), F.col("__key")), "__range": F.coalesce(F.floor(share * F.col("__cuts")), F.lit(0))}
        )
        ranged = ranged.withColumn("__seq", F.coalesce("__seq", F.lit(0)))
        sizes = ranged.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__run").orderBy(*groups[1:]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy("seq", *fields))
    placed = ranged.select(*groups, "seq", *fields, inside.alias("__inside")).join(offsets, groups)
    return placed.withColumn("__position", F.col("__offset") + F.col("__inside") - 1)


def _run_key(run: Sequence[str]) -> Column:
    """One text that tells runs apart, null from blank too."""
    return F.to_json(F.struct(*run), {"ignoreNullFields": "false"})


def map_index_names(runs: DataFrame, files: DataFrame, run: Sequence[str]) -> DataFrame:
    """Base name of the file a mapped run worked on, null where it had none.

    `files` has the run's columns, `map_index` and `path`. Nulls in the run's columns equal nulls.
    """
    key = lambda: F.concat_ws(":", F.col("map_index").cast("string"), _run_key(run))
    names = files.select(key().alias("__run"), base_name(F.col("path")).alias("map_index_name")).dropDuplicates(["__run"])
    return runs.withColumn("__run", key()).join(names, "__run", "left").drop("__run")


def result_text(rollup: DataFrame) -> Column:
    """The rolled-up errors as the JSON document of the run log."""
    fields = ["args", "kwargs", "last_error_timestamp", "errors"]
    fields += [field for field in ("map_index", "map_index_name") if field in rollup.columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def run_log_rows(results: DataFrame, result: Column) -> DataFrame:
    """Rows of the run-log table; `result` is JSON text."""
    grain = F.col("grain_update") if "grain_update" in results.columns else F.lit(None)
    return results.select(
        F.nullif(grain.cast("string"), F.lit("")).alias("grain_update"),
        "run_type",
        F.col("run_date").cast("date").alias("run_date"),
        F.col("run_timestamp").cast("timestamp").alias("run_timestamp"),
        F.parse_json(result).alias("result"),
        "tenant_code",
        F.col("api_year").cast("int").alias("api_year"),
    )
