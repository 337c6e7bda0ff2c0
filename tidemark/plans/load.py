"""Loading the landing folder into the raw table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.constants import NO_CHANGE_VERSIONS
from tidemark.plans.lake import Lake
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks import grain
from tidemark.sources.landing import raw_envelope, refuse_unread, scan_landing, with_row_numbers


def resolve_versions(
    ods_version: str | None, data_model_version: str | None, *, found: tuple[str | None, str | None] = (None, None),
    has_change_versions: bool = True,
) -> tuple[str, str]:
    """Version texts: what was given, else what the source told, else the mark of a source without change versions."""
    if not has_change_versions:
        found = (NO_CHANGE_VERSIONS, NO_CHANGE_VERSIONS)
    ods, model = ods_version or found[0], data_model_version or found[1]
    if not (ods and model):
        raise ValueError("ods_version and data_model_version were not found and must be given")
    return ods, model


def load_raw(
    spark: SparkSession, lake: Lake, *paths: str, tenant_code: str | None = None, api_year: int | None = None,
    kind: str | None = None, name: str | None = None, ods_version: str | None = None,
    data_model_version: str | None = None, has_change_versions: bool = True, full_refresh: bool = False,
    row_numbers: bool = True, lineage: str = "path", on_bad_line: str = "fail",
    transform: Callable[[DataFrame], DataFrame] | None = None, then: Callable[[str], None] | None = None,
    balance: bool = True, on_unread: str = "ignore",
) -> None:
    """Load all files below some folders, whatever their number, in one scan and one write.

    Appends, or on a full refresh replaces the tenants, years and names found in the files. A source without
    change versions is always refreshed in full. `transform` changes the rows before the write, `then` is called
    with the table's path after it. Without `balance` the rows are written as they were read or numbered: one
    shuffle less, good when every endpoint has few files. Files of other kinds than a landing file's are passed over, or
    with `on_unread="fail"` stop the load before anything is read; `unread_files` tells them.
    """
    if on_unread not in ("ignore", "fail"):
        raise ValueError(f"unknown option: on_unread={on_unread!r}")
    ods, model = resolve_versions(ods_version, data_model_version, has_change_versions=has_change_versions)
    if on_unread == "fail":
        refuse_unread(spark, *paths)
    lines = scan_landing(spark, *paths)
    if row_numbers and lineage == "path":
        lines = with_row_numbers(lines)
    rows = raw_envelope(
        lines, ods_version=ods, data_model_version=model, tenant_code=tenant_code, api_year=api_year, kind=kind,
        name=name, lineage=lineage, on_bad_line=on_bad_line,
    )
    rows = rows if transform is None else rows.transform(transform)
    store_raw(rows, lake, full_refresh or not has_change_versions, balance)
    if then is not None:
        then(lake.raw)


def store_raw(rows: DataFrame, lake: Lake, full_refresh: bool, balance: bool = True) -> None:
    write = grain.replace if full_refresh else grain.insert
    write(rows, lake.raw, RAW, RAW_PARTITIONS, balance=balance)


def store_raw_run(
    rows: DataFrame, lake: Lake, *, run_at: Column, streams: DataFrame, size: int | None = None,
    within: Mapping[str, object] | None = None, balance: bool = True,
) -> None:
    """Append the rows that a run pulled for some streams; a repeated run replaces its own rows."""
    same_run = F.col("pull_timestamp") == run_at
    grain.insert_once(rows, lake.raw, RAW, RAW_PARTITIONS, again=same_run, among=streams, size=size, within=within, balance=balance)


def run_moment(run_at: datetime | str) -> Column:
    return F.lit(run_at).cast("timestamp")
