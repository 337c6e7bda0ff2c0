"""Joining a large side to a side that is expected to be small.

The small side is computed once, into the shared checkpoint folder, and measured there. Up to a limit it is
broadcast, so that the large side is not shuffled. Beyond, the join is a plain one of two settled or scanned sides, of
which adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import ensure_checkpoint_dir

BROADCAST_BYTES = 64 * 1024 * 1024
#: Values of a column that are put into a plan as literals.
LITERAL_VALUES = 500


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows written as JSON text; an upper guide to their size in memory."""
    width = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def settled(df: DataFrame) -> DataFrame:
    """The rows kept in the checkpoint folder: computed once, and safe when an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def join_small_side(
    large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", *, limit: int = BROADCAST_BYTES,
    size: int | None = None,
) -> DataFrame:
    """Pass `size` for a small side that was settled and measured before, or is a part of one that was."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a join to a small side cannot be `{how}`")
    if size is None:
        small = settled(small)
        size = measured_bytes(small)
    return large.join(F.broadcast(small) if size <= limit else small, list(on), how)


def among_values(small: DataFrame, columns: Sequence[str]) -> Column:
    """What rows must meet to equal some row of a settled small table in each column, as literals that reach a scan.

    It lets more rows pass than a join does, never fewer. A column of very many values is left out.
    """
    columns = list(columns)
    if not columns:
        return F.lit(True)
    rows = few_rows(small.select(*columns))
    if rows is not None:
        return among_sets({column: {row[column] for row in rows} for column in columns})
    counts = small.agg(*[F.count_distinct(column).alias(column) for column in columns]).first()
    few = [column for column in columns if counts[column] <= LITERAL_VALUES]
    if not few:
        return F.lit(True)
    found = small.agg(*[with_null(column).alias(column) for column in few]).first()
    return among_sets({column: set(found[column]) for column in few})


def few_rows(small: DataFrame) -> list | None:
    """The rows of a settled table in one short job, or nothing where they are more than may become literals."""
    rows = small.limit(LITERAL_VALUES + 1).collect()
    return rows if len(rows) <= LITERAL_VALUES else None


def with_null(column: str, where: Column | None = None) -> Column:
    """The set of a column's values, in the rows that meet a condition; a null is one of them."""
    where = F.lit(True) if where is None else where
    value = F.when(where, F.struct(F.col(column).alias("value")))
    return F.transform(F.collect_set(value), lambda found: found["value"])


def among_sets(values: Mapping[str, set]) -> Column:
    """Rows that have, in each column, one of its values; null stands for null."""

    def one(column: str) -> Column:
        found = sorted(value for value in values[column] if value is not None)
        same = F.col(column).isin(found) if found else F.lit(False)
        return same | F.col(column).isNull() if None in values[column] else same

    return reduce(Column.__and__, [one(column) for column in values], F.lit(True))
