"""Row counts per endpoint and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.joins import join_small_side
from tidemark.schemas import GRAIN

MATCH, MISMATCH, UNAVAILABLE = "match", "mismatch", "unavailable"


def row_counts(rows: DataFrame, keys: list[str] = GRAIN, name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def total_counts(feed: DataFrame, endpoints: DataFrame | None = None) -> DataFrame:
    """Rows of every endpoint from version zero to the newest; endpoints without rows do not appear.

    `endpoints` restricts the count to its rows and may bring `newest_version`.
    """
    versions = feed.filter(F.col("change_version") >= 0).select(*GRAIN, "change_version")
    if endpoints is not None:
        bounds = [column for column in ("newest_version",) if column in endpoints.columns]
        wanted = endpoints.select(*GRAIN, *bounds).distinct()
        versions = join_small_side(versions, wanted, GRAIN)
        if bounds:
            versions = versions.filter(
                F.col("newest_version").isNull() | (F.col("change_version") <= F.col("newest_version"))
            )
    return row_counts(versions, name="total_count")


def reconcile(pulled: DataFrame, expected: DataFrame, keys: list[str] = GRAIN) -> DataFrame:
    """Rows pulled against rows expected. Both sides hold one row per endpoint; either may lack some.

    An endpoint without an expected count is `unavailable`; one that was expected and not pulled has zero rows.
    """
    joined = pulled.join(expected, keys, "full_outer")
    rows = F.coalesce("pulled_rows", F.lit(0))
    status = (
        F.when(F.col("expected_rows").isNull(), UNAVAILABLE).when(rows == F.col("expected_rows"), MATCH).otherwise(MISMATCH)
    )
    return joined.select(*keys, rows.alias("pulled_rows"), "expected_rows", status.alias("count_status"))
