"""Total counts of a source, kept per run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.counts import total_counts
from tidemark.operators.endpoints import named, requested_endpoints, snake_names
from tidemark.operators.marks import in_grain
from tidemark.plans.lake import Lake
from tidemark.plans.load import run_moment
from tidemark.schemas import TOTAL_COUNTS, TOTAL_COUNTS_PARTITIONS
from tidemark.sinks import grain


def delete_total_counts(
    spark: SparkSession, lake: Lake, *, tenant_code: str, api_year: int, names: Iterable[str] | None = None
) -> None:
    """Remove the counts of a tenant-year, of some names or of all."""
    partition = {"tenant_code": tenant_code, "api_year": api_year}
    grain.rewrite(
        spark, lake.total_counts, TOTAL_COUNTS, TOTAL_COUNTS_PARTITIONS, partition, lambda rows: rows.filter(~named(names))
    )


def store_total_counts(
    spark: SparkSession, lake: Lake, feed: DataFrame, endpoints: DataFrame, *, tenant_code: str, api_year: int,
    run_at: datetime | str, newest: int | None = None, full_refresh: bool = False,
    requested: Iterable[str] | None = None, delete_all: bool = False,
) -> None:
    """Count every endpoint and keep the counts.

    A full refresh removes older counts of the endpoints asked for, or with `delete_all` of the whole tenant-year.
    """
    names = None
    if wanted := list(requested or []):
        asked = snake_names(spark, wanted)
        endpoints = requested_endpoints(endpoints, asked)
        names = [row["name"] for row in asked.collect()]
    if full_refresh:
        delete_total_counts(
            spark, lake, tenant_code=tenant_code, api_year=api_year, names=None if delete_all else names
        )
    moment = run_moment(run_at)
    mine = endpoints.filter(in_grain(tenant_code, api_year))
    if newest is not None:
        mine = mine.withColumn("newest_version", F.lit(newest).cast("bigint"))
    counts = total_counts(feed.filter(in_grain(tenant_code, api_year)), mine)
    rows = counts.withColumns({"pull_date": moment.cast("date"), "pull_timestamp": moment})
    same_run = (F.col("pull_timestamp") == moment) & named(names)
    partition = {"tenant_code": tenant_code, "api_year": api_year}
    grain.insert_once(rows, lake.total_counts, TOTAL_COUNTS, TOTAL_COUNTS_PARTITIONS, again=same_run, within=partition)
