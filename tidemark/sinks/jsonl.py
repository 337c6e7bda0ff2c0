"""JSON-lines and archive output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.constants import PATH_DATE_FORMAT, PATH_TIMESTAMP_FORMAT

LANDING_PARTITIONS = ["tenant_code", "api_year", "ds", "ts", "kind", "name"]
ARCHIVE_PARTITIONS = ["stage", "tenant_code", "run_type", "api_year", "grain_update", "ds", "ts"]


def json_line(*columns: str) -> Column:
    """One record as JSON text; null fields are written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Every row as one JSON object per line."""
    df.select(json_line(*df.columns).alias("value")).write.mode(mode).text(path)


def with_run_folders(df: DataFrame, run_at: Column) -> DataFrame:
    """Date and timestamp segments of a run."""
    return df.withColumns(
        {"ds": F.date_format(run_at, PATH_DATE_FORMAT), "ts": F.date_format(run_at, PATH_TIMESTAMP_FORMAT)}
    )


def write_landing(df: DataFrame, root: str, payload: str = "payload") -> None:
    """JSON lines below the landing folder, one folder per tenant, year, run, kind and endpoint.

    Only the folders of this run are replaced, so a repeated run leaves one copy. A payload over several lines is
    written as one; one that is no JSON stops the run.
    """
    one_line = F.to_json(F.parse_json(payload))
    lines = df.select(*LANDING_PARTITIONS, one_line.alias("value")).hint("rebalance", *LANDING_PARTITIONS)
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*LANDING_PARTITIONS).text(root)


def write_archive(
    df: DataFrame, root: str, *, stage: str, run_type: str, run_at: Column, grain_update: Column | None = None,
    format: str = "parquet",
) -> None:
    """Keep what went into or came out of a transformation, by tenant, run type, year, grain and time.

    `stage` tells the two apart; a run without a grain is in the null folder.
    """
    grain = F.lit(None).cast("string") if grain_update is None else grain_update
    rows = with_run_folders(df, run_at).withColumns(
        {"stage": F.lit(stage), "run_type": F.lit(run_type), "grain_update": grain}
    )
    writer = rows.hint("rebalance", *ARCHIVE_PARTITIONS).write.mode("overwrite").format(format)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*ARCHIVE_PARTITIONS).save(root)
