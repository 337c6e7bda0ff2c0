"""High-water marks: reading them from the ledger, resetting them, writing new ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import constants as C
from tidemark.functions import flag
from tidemark.operators.endpoints import named
from tidemark.schemas import GRAIN, LEDGER

LIVE, DELETES, KEY_CHANGES = "live", "deletes", "key_changes"


def in_grain(tenant_code: str | None = None, api_year: int | None = None, names: Iterable[str] | None = None) -> Column:
    """Rows of a tenant, a year and some names; what is not given does not restrict."""
    condition = named(names)
    if tenant_code is not None:
        condition &= F.col("tenant_code") == tenant_code
    if api_year is not None:
        condition &= F.col("api_year") == api_year
    return condition


def stream_of_kind(kind: Column) -> Column:
    return (
        F.when(kind == C.RESOURCE_DELETES, DELETES).when(kind == C.RESOURCE_KEY_CHANGES, KEY_CHANGES).otherwise(LIVE)
    )


def _flags(ledger: DataFrame) -> tuple[Column, Column]:
    """The two stream flags; an older ledger has no `is_key_changes`."""
    deletes = flag(F.col("is_deletes"))
    key_changes = flag(F.col("is_key_changes")) if "is_key_changes" in ledger.columns else F.lit(False)
    return deletes, key_changes


def stream_filter(ledger: DataFrame, stream: str) -> Column:
    deletes, key_changes = _flags(ledger)
    if stream == DELETES:
        return deletes
    if stream == KEY_CHANGES:
        return key_changes
    return ~deletes & ~key_changes


def prior_marks(ledger: DataFrame, stream: str = LIVE) -> DataFrame:
    """Highest active mark of one stream per tenant, year and name."""
    active = ledger.filter(F.col("is_active") & stream_filter(ledger, stream))
    return active.groupBy(*GRAIN).agg(F.max("max_version").alias("max_version"))


def prior_marks_by_stream(ledger: DataFrame) -> DataFrame:
    """Highest active marks of all streams in one pass."""
    deletes, key_changes = _flags(ledger)
    streams = F.array_compact(
        F.array(
            F.when(deletes, DELETES), F.when(key_changes, KEY_CHANGES), F.when(~deletes & ~key_changes, LIVE)
        )
    )
    rows = ledger.filter("is_active").select(*GRAIN, "max_version", F.explode(streams).alias("stream"))
    return rows.groupBy(*GRAIN, "stream").agg(F.max("max_version").alias("max_version"))


def with_last_version(endpoints: DataFrame, prior: DataFrame) -> DataFrame:
    """Endpoints with their last mark, zero where there is none. Both sides hold one row per endpoint."""
    keys = [column for column in (*GRAIN, "stream") if column in prior.columns]
    known = prior.select(*keys, F.col("max_version").alias("__mark"))
    return (
        endpoints.join(known, keys, "left")
        .withColumn("last_version", F.coalesce("__mark", F.lit(0)).cast("bigint"))
        .drop("__mark")
    )


def reset_marks(
    ledger: DataFrame, tenant_code: str | None = None, api_year: int | None = None, names: Iterable[str] | None = None
) -> DataFrame:
    """The ledger with the marks of a grain made inactive."""
    chosen = flag(in_grain(tenant_code, api_year, names))
    return ledger.withColumn("is_active", F.when(chosen & F.col("is_active"), False).otherwise(F.col("is_active")))


def new_marks(landed: DataFrame, *, full_refresh: bool, has_key_changes: bool = True) -> DataFrame:
    """Ledger rows for what was loaded.

    `landed` has the grain, `kind`, `max_version`, `pull_date` and `pull_timestamp`. After a full refresh the
    deletes and key changes are marked too, so that the next run does not pull all of them.
    """
    own = F.struct(
        flag(F.col("kind") == C.RESOURCE_DELETES).alias("is_deletes"),
        flag(F.col("kind") == C.RESOURCE_KEY_CHANGES).alias("is_key_changes"),
    )
    sets = [own]
    if full_refresh:
        sets.append(F.struct(F.lit(True).alias("is_deletes"), F.lit(False).alias("is_key_changes")))
        if has_key_changes:
            sets.append(F.struct(F.lit(False).alias("is_deletes"), F.lit(True).alias("is_key_changes")))
    rows = landed.withColumn("is_active", F.lit(True)).select("*", F.inline(F.array(*sets)))
    return rows.select(*[F.col(field.name).cast(field.dataType) for field in LEDGER.fields])
