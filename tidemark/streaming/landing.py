"""Landing files as a stream: every run takes the files that are new."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.joins import BROADCAST_BYTES, join_small_side, measured_bytes, settled
from tidemark.plans.lake import Lake
from tidemark.plans.load import resolve_versions
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks import grain
from tidemark.sources.landing import path_origin, raw_envelope, stream_landing
from tidemark.sources.tables import ANY, path_exists
from tidemark.streaming.feed import batch_appender


def ingest_landing(
    spark: SparkSession, lake: Lake, path: str, checkpoint: str, *, ods_version: str, data_model_version: str,
    tenant_code: str | None = None, api_year: int | None = None, kind: str | None = None, on_bad_line: str = "fail",
    transform: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int | None = None, batch_ids: bool = False,
) -> None:
    """Load all files that came since the last run with this checkpoint, then stop.

    Rows have no `file_row_number`. For a full refresh see `refresh_landing`. A batch that broke off and runs again is
    found by its files in the raw table, whoever wrote them, or with `batch_ids` by its id alone: the table is not read
    then, however large it is.
    """
    ods, model = resolve_versions(ods_version, data_model_version)
    lines = stream_landing(spark, path, files_per_batch=files_per_batch)

    def envelope(lines: DataFrame) -> DataFrame:
        return raw_envelope(
            lines, ods_version=ods, data_model_version=model, tenant_code=tenant_code, api_year=api_year, kind=kind,
            on_bad_line=on_bad_line,
        )

    given = tenant_code is not None and api_year is not None
    within = {"kind": kind or ANY, "tenant_code": tenant_code, "api_year": api_year} if given else None
    append = batch_appender(lake) if batch_ids else _batch_writer(lake, within)
    if transform is None:
        rows, append = lines, _by_file(append, envelope, with_files=not batch_ids)
    else:
        rows = envelope(lines).transform(transform)
    query = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(append).start()
    query.awaitTermination()


def refresh_landing(
    spark: SparkSession, lake: Lake, path: str, checkpoint: str, *, kind: str, tenant_code: str, api_year: int,
    names: Iterable[str] | None = None, **options,
) -> None:
    """Clear a grain and load the folder afresh. The checkpoint folder must be a new one."""
    if path_exists(spark, checkpoint):
        raise ValueError(f"{checkpoint!r} was used before; a full refresh needs a new checkpoint folder")
    within = {"kind": kind, "tenant_code": tenant_code, "api_year": api_year}
    grain.clear(spark, lake.raw, RAW, RAW_PARTITIONS, within, names)
    ingest_landing(
        spark, lake, path, checkpoint, kind=kind, tenant_code=tenant_code, api_year=api_year, **options
    )


def _by_file(append: Callable, envelope: Callable[[DataFrame], DataFrame], with_files: bool) -> Callable[[DataFrame, int], None]:
    """Appends batches of lines. What a path tells is read once per file, not for every line, while the files are not too many."""

    def write(lines: DataFrame, batch_id: int) -> None:
        files = settled(lines.select("file_path").distinct().withColumn("origin", path_origin()))
        size = measured_bytes(files)
        if size > BROADCAST_BYTES:
            append(envelope(lines), batch_id)
            return
        own = {"files": envelope(files.withColumn("value", F.lit("null")))} if with_files else {}
        append(envelope(join_small_side(lines, files, ["file_path"], size=size)), batch_id, **own)

    return write


def _batch_writer(lake: Lake, within: Mapping[str, object] | None) -> Callable[..., None]:
    """Append batches. Only the first batch after a start can be a repetition, so only that one is checked.

    `files` has a row for each of the batch's files, where they are known.
    """
    started = []

    def write(batch: DataFrame, _: int, files: DataFrame | None = None) -> None:
        if started:
            grain.insert(batch, lake.raw, RAW, RAW_PARTITIONS)
            return
        files = (batch if files is None else files).select("kind", "tenant_code", "api_year", "filename").distinct()
        grain.insert_once(batch, lake.raw, RAW, RAW_PARTITIONS, again=F.lit(True), among=files, within=within)
        started.append(True)

    return write
