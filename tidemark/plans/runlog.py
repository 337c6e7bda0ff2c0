"""Writing the run log, and running work so that its errors end up there."""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.constants import ERROR_LEVEL
from tidemark.operators.logs import RUN, error_rollup, map_index_names, result_text, run_log_rows
from tidemark.plans.lake import Lake
from tidemark.schemas import LOG_RECORD, RUN_LOG, RUN_LOG_PARTITIONS
from tidemark.sinks import grain


def append_run_log(results: DataFrame, lake: Lake, result: str = "result") -> None:
    """Append rows whose `result` column is JSON text."""
    grain.insert(run_log_rows(results, F.col(result)), lake.run_log, RUN_LOG, RUN_LOG_PARTITIONS)


def append_error_rollup(logs: DataFrame, lake: Lake, file_lists: DataFrame | None = None) -> None:
    """Roll up the errors of all runs in a log and append one document per run (per part of a very long one)."""
    run = RUN + (["map_index"] if "map_index" in logs.columns else [])
    rollup = error_rollup(logs, run)
    if file_lists is not None:
        rollup = map_index_names(rollup, file_lists, RUN)
    append_run_log(rollup.withColumn("result", result_text(rollup)), lake)


def captured(spark: SparkSession, lake: Lake, run: dict, work: Callable, *args, **kwargs):
    """Run `work`; when it raises, log the error with the arguments and raise it again.

    `run` has the tenant, year, run type, date and timestamp, and may have `grain_update`, and for mapped work
    `map_index` and the `path` of the file it works on.
    """
    try:
        return work(*args, **kwargs)
    except Exception as error:
        frame = traceback.extract_tb(error.__traceback__)[-1]
        record = (
            datetime.now(timezone.utc).isoformat(), "tidemark", ERROR_LEVEL,
            f"work stopped by {type(error).__name__}: {error}", frame.filename, frame.lineno,
            {str(i): _text(value) for i, value in enumerate(args)}, {key: _text(value) for key, value in kwargs.items()},
        )
        logs = spark.createDataFrame([record], LOG_RECORD).withColumn("seq", F.lit(0).cast("bigint"))
        own = {"grain_update": None, **run}
        logs = logs.withColumns({key: F.lit(own[key]).cast("string" if own[key] is None else "int" if key == "api_year" else "string") for key in RUN})
        files = None
        if run.get("map_index") is not None:
            logs = logs.withColumn("map_index", F.lit(int(run["map_index"])))
            files = logs.select(*RUN, "map_index", F.lit(run.get("path")).cast("string").alias("path"))
        append_error_rollup(logs, lake, files)
        raise


def _text(value: object) -> str:
    try:
        return json.dumps(value)
    except TypeError:
        return str(value)
