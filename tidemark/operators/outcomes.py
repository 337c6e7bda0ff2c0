"""What became of every endpoint of a run, and verdicts on it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import GRAIN

SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"


class RunFailed(RuntimeError):
    """A run has endpoints that failed."""


def succeeded(endpoints: DataFrame, landed: DataFrame, keys: list[str] = GRAIN) -> DataFrame:
    """Endpoints that were loaded; only these are marked in the ledger."""
    return endpoints.join(landed.select(*keys).distinct(), keys, "left_semi")


def failed(attempted: DataFrame, landed: DataFrame, keys: list[str] = GRAIN) -> DataFrame:
    """Endpoints that were tried and not loaded."""
    return attempted.join(landed.select(*keys).distinct(), keys, "left_anti")


def with_outcome(attempted: DataFrame, landed: DataFrame, keys: list[str] = GRAIN) -> DataFrame:
    """Every attempted endpoint with `outcome`, in place of two lists."""
    done = landed.select(*keys).distinct().withColumn("__landed", F.lit(True))
    outcome = F.when(F.col("__landed"), SUCCESS).otherwise(FAILED)
    return attempted.join(done, keys, "left").withColumn("outcome", outcome).drop("__landed")


def any_failed(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a run has a failed part."""
    return runs.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col("outcome") == FAILED), F.lit(False)).alias("has_failed"))


def status_in(statuses: Iterable[str], column: str = "status") -> Column:
    """Rows with one of the statuses; an empty list takes none."""
    wanted = list(statuses)
    return F.col(column).isin(wanted) if wanted else F.lit(False)


def fail_when(rows: DataFrame, condition: Column, message: str, shown: int = 20) -> None:
    """Raise when rows meet a condition. The message names a few of them, the count is of all."""
    bad = rows.filter(condition)
    count = bad.count()
    if count:
        names = [str(tuple(row)) for row in bad.limit(shown).collect()]
        raise RunFailed(f"{message}: {count} rows, such as {', '.join(names)}")
