"""Loading transformed files straight into the raw table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession, functions as F

from tidemark import constants as C
from tidemark.functions import camel_to_snake
from tidemark.operators.routing import sideload_name, sideload_table
from tidemark.operators.endpoints import snake_names
from tidemark.plans.lake import Lake
from tidemark.plans.load import resolve_versions, store_raw
from tidemark.sources.landing import raw_envelope, scan_landing, with_row_numbers


def sideload(
    spark: SparkSession, lake: Lake, directory: str, endpoints: Iterable[str], *, run_type: str, tenant_code: str,
    api_year: int, ods_version: str, data_model_version: str, full_refresh: bool = False,
) -> None:
    """Load the `{endpoint}.jsonl` files of a folder under names that carry the run type, all in one scan."""
    wanted = [str(endpoint) for endpoint in endpoints]
    if not wanted:
        raise ValueError("no endpoints are given")
    ods, model = resolve_versions(ods_version, data_model_version)
    lines = with_row_numbers(scan_landing(spark, directory))
    rows = raw_envelope(
        lines, ods_version=ods, data_model_version=model, tenant_code=tenant_code, api_year=api_year, kind=C.RESOURCES
    )
    snake = camel_to_snake(F.col("name"))
    asked = snake_names(spark, wanted).select(F.col("name").alias("__asked"))
    chosen = rows.join(F.broadcast(asked), snake == F.col("__asked"), "left_semi")  # as many rows as were asked for
    shared = sideload_table(F.col("name")) == C.DESCRIPTORS_TABLE
    named = chosen.withColumns(
        {"kind": F.when(shared, C.DESCRIPTORS).otherwise(C.RESOURCES), "name": sideload_name(F.col("name"), run_type)}
    )
    store_raw(named, lake, full_refresh)
