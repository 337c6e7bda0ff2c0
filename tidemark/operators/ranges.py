"""Where source and loaded rows differ, found by sums over ranges of versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import BROADCAST_BYTES, measured_bytes, settled
from tidemark.operators.windows import VALID, scan_condition
from tidemark.schemas import GRAIN

LEAF, FAN = 1_000, 32


def differing_ranges(
    source: DataFrame, loaded: DataFrame, keys: Sequence[str] = GRAIN, *, content: Sequence[str] = (), leaf: int = LEAF, fan: int = FAN,
) -> DataFrame:
    """Ranges of `leaf` versions in which two tables differ: keys, `range_min`, `range_max`, `source_rows`, `loaded_rows`.

    Both have the keys and `change_version`, and the columns of `content`, by which rows are compared too. Each range has a
    count and a sum of row hashes. They are compared from the widest ranges down, like a tree of hashes: `fan` narrower
    ranges at a time, and only in ranges that differ, which reach the scans as windows. Versions must not be null or
    negative; null keys equal null. The ranges are windows to be pulled again, see `windows_of`.
    """
    keys = list(keys)
    own = [_hashed(rows, keys, content) for rows in (source, loaded)]
    top = max((rows.agg(F.max("change_version")).first()[0] or 0) for rows in own)
    width = leaf
    while width <= top:
        width *= fan
    found = _differing(own, keys, width)
    while width > leaf:
        inside = [_within(rows, found, keys, width) for rows in own]
        width //= fan
        found = _differing(inside, keys, width)
    return found.select(*keys, "range_min", "range_max", "source_rows", "loaded_rows")


def windows_of(ranges: DataFrame) -> DataFrame:
    """Differing ranges as windows, for `rows_in_window` and `window_slices`."""
    return ranges.withColumns(
        {"last_version": F.col("range_min") - 1, "newest_version": F.col("range_max"), "window_status": F.lit(VALID)}
    ).drop("range_min", "range_max", "source_rows", "loaded_rows")


def _hashed(rows: DataFrame, keys: list[str], content: Sequence[str]) -> DataFrame:
    return rows.select(*keys, F.col("change_version").cast("bigint").alias("change_version"), F.xxhash64("change_version", *content).alias("__hash"))


def _number(width: int) -> Column:
    return F.floor(F.col("change_version") / width)


def _sums(rows: DataFrame, keys: list[str], width: int, name: str) -> DataFrame:
    # hashes are added up as decimals, which do not overflow
    total = F.sum(F.col("__hash").cast("decimal(38,0)")).alias(f"{name}_hash")
    sums = rows.groupBy(*keys, _number(width).alias("__number")).agg(F.count(F.lit(1)).alias(f"{name}_rows"), total)
    return sums.withColumnsRenamed({key: f"{key}__{name}" for key in [*keys, "__number"]})


def _differing(sides: list[DataFrame], keys: list[str], width: int) -> DataFrame:
    source, loaded = (_sums(rows, keys, width, name) for rows, name in zip(sides, ("source", "loaded")))
    own = [*keys, "__number"]
    both = source.join(loaded, _all_same([(f"{key}__source", f"{key}__loaded") for key in own]), "full_outer")
    same = F.col("source_rows").eqNullSafe(F.col("loaded_rows")) & F.col("source_hash").eqNullSafe(F.col("loaded_hash"))
    found = both.filter(~same).select(
        *[F.coalesce(f"{key}__source", f"{key}__loaded").alias(key) for key in own],
        *[F.coalesce(f"{name}_rows", F.lit(0)).alias(f"{name}_rows") for name in ("source", "loaded")],
    )
    low = F.col("__number") * width
    return settled(found.withColumns({"range_min": low, "range_max": low + width - 1}))


def _within(rows: DataFrame, ranges: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Rows of some ranges of one width; what the ranges have in common reaches the scan.

    A row is in one range of a width, which its number tells: it meets that one only, however many differ.
    """
    # a range from zero on has no lower bound, as a window of mark zero
    low = F.when(F.col("range_min") == 0, 0).otherwise(F.col("range_min") - 1)
    windows = ranges.select(*keys, low.alias("last_version"), F.col("range_max").alias("newest_version"))
    some = rows.filter(scan_condition(windows, keys)).withColumn("__number", _number(width))
    own = [*keys, "__number"]
    wanted = ranges.select(*[F.col(key).alias(f"{key}__range") for key in own])
    wanted = F.broadcast(wanted) if measured_bytes(wanted) <= BROADCAST_BYTES else wanted
    return some.join(wanted, _all_same([(key, f"{key}__range") for key in own]), "left_semi").select(*rows.columns)


def _all_same(pairs: Sequence[tuple[str, str]]) -> Column:
    """Null equals null."""
    return reduce(Column.__and__, [F.col(left).eqNullSafe(F.col(right)) for left, right in pairs])
