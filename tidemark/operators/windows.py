"""Change-version windows: bounds, validity, deltas and slices."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import LITERAL_VALUES, among_sets, among_values, few_rows, join_small_side, measured_bytes, settled, with_null
from tidemark.schemas import GRAIN

UNBOUNDED, UNCHANGED, OUT_OF_SEQUENCE, VALID = "unbounded", "unchanged", "out_of_sequence", "valid"


def window_status(low: Column, high: Column) -> Column:
    """State of a window; a missing bound leaves it unbounded."""
    return (
        F.when(low.isNull() | high.isNull(), UNBOUNDED)
        .when(low == high, UNCHANGED)
        .when(high < low, OUT_OF_SEQUENCE)
        .otherwise(VALID)
    )


def in_window(version: Column, low: Column, high: Column) -> Column:
    """Versions after the last mark up to the newest; mark zero, or none, takes the first version too."""
    above = F.coalesce((low == 0) | (version > low), F.lit(True))
    below = F.coalesce(version <= high, F.lit(True))
    return above & below


def newest_versions(feed: DataFrame, by: tuple[str, ...] = ("tenant_code", "api_year")) -> DataFrame:
    return feed.groupBy(*by).agg(F.max("change_version").alias("newest_version"))


def with_window_status(marks: DataFrame) -> DataFrame:
    return marks.withColumn("window_status", window_status(F.col("last_version"), F.col("newest_version")))


def rows_in_window(
    feed: DataFrame, windows: DataFrame, keys: list[str] = GRAIN, *, size: int | None = None
) -> DataFrame:
    """Feed rows inside the window of their endpoint, with the columns of the window.

    Windows that are unchanged or out of sequence take no rows. The open ones reach the feed's scan as literals, in a few
    groups of their own keys and bounds. Pass `size` for windows that were settled and measured.
    """
    open_windows = windows.filter(F.col("window_status").isin(VALID, UNBOUNDED))
    if size is None:
        open_windows = settled(open_windows)
        size = measured_bytes(open_windows)
    rows = feed.filter(scan_condition(open_windows, keys))
    joined = join_small_side(rows, open_windows, keys, size=size)
    return joined.filter(in_window(F.col("change_version"), F.col("last_version"), F.col("newest_version")))


#: Groups of windows that a scan's condition tells apart, and ranges of marks that are looked at where windows are many.
GROUPS, RANGES = 8, 1024


@dataclass
class _Group:
    """Some windows: the values of their keys (a key of very many is left out), and bounds, null where there is none."""

    values: dict[str, set]
    low: int | None
    high: int | None

    def condition(self) -> Column:
        version, rows = F.col("change_version"), among_sets(self.values)
        rows = rows if self.low is None else rows & (version > self.low)
        return rows if self.high is None else rows & (version <= self.high)


def scan_condition(windows: DataFrame, keys: list[str]) -> Column:
    """What feed rows must meet to be in some of the settled open windows, as literals.

    Windows fall into groups at the widest gaps between their marks, and those without a mark are a group by
    themselves: one new endpoint takes no lower bound away from the others. More rows may pass than are in a window,
    never fewer.
    """
    low = F.when(F.col("last_version") != 0, F.col("last_version"))
    bounds = windows.select(*keys, low.alias("__low"), F.col("newest_version").alias("__high"))
    rows = few_rows(bounds)
    if rows is not None:
        cuts = _cuts([(row["__low"], row["__low"]) for row in rows if row["__low"] is not None])
        parts: dict[int, list] = {}
        for row in rows:
            parts.setdefault(-1 if row["__low"] is None else sum(row["__low"] > cut for cut in cuts), []).append(row)
        groups = [
            _Group({key: {row[key] for row in part} for key in keys}, _least(part), _greatest([row["__high"] for row in part]))
            for part in parts.values()
        ]
        common = among_sets({key: {row[key] for row in rows} for key in keys})
    else:
        groups, common = _groups_of_many(bounds, keys), among_values(windows, keys)
    groups = _merged(groups)
    if len(groups) == 1:
        return groups[0].condition()
    # the common part prunes partitions, which a disjunction by itself may not
    return common & reduce(Column.__or__, [group.condition() for group in groups], F.lit(False))


def _least(part: list) -> int | None:
    lows = [row["__low"] for row in part]
    return None if None in lows else min(lows)


def _greatest(highs: list) -> int | None:
    return None if None in highs else max(highs)


def _cuts(ranges: list[tuple[int, int]]) -> list[int]:
    """Marks after which a new group begins: the widest gaps between ranges of marks."""
    ranges = sorted(set(ranges))
    gaps = sorted(((after[0] - before[1], before[1]) for before, after in pairwise(ranges) if after[0] > before[1]), reverse=True)
    return sorted(cut for _, cut in gaps[: GROUPS - 1])


def _merged(groups: list[_Group]) -> list[_Group]:
    """Groups of the same keys are one, with their outer bounds."""
    out: list[_Group] = []
    for group in groups:
        same = next((known for known in out if known.values == group.values), None)
        if same is None:
            out.append(group)
        else:
            same.low = None if same.low is None or group.low is None else min(same.low, group.low)
            same.high = _greatest([same.high, group.high])
    return out


def _groups_of_many(bounds: DataFrame, keys: list[str]) -> list[_Group]:
    """The groups of very many windows, in aggregates of which the driver sees one row for each range and group."""
    ends = bounds.agg(F.min("__low").alias("low"), F.max("__low").alias("high")).first()
    cuts: list[int] = []
    if ends["low"] is not None:
        width = max(1, -(-(ends["high"] - ends["low"] + 1) // RANGES))
        ranges = bounds.where("__low is not null").groupBy(F.floor((F.col("__low") - ends["low"]) / width).alias("range"))
        cuts = _cuts([(row["a"], row["b"]) for row in ranges.agg(F.min("__low").alias("a"), F.max("__low").alias("b")).collect()])
    number = reduce(Column.__add__, [(F.col("__low") > cut).cast("int") for cut in cuts], F.lit(0))
    grouped = bounds.withColumn("__group", F.when(F.col("__low").isNull(), -1).otherwise(number))
    counts = grouped.groupBy("__group").agg(
        F.min("__low").alias("__low"), F.max("__high").alias("__high"), F.bool_or(F.col("__high").isNull()).alias("__open"),
        *[F.count_distinct(key).alias(key) for key in keys],
    ).collect()
    few = {row["__group"]: [key for key in keys if row[key] <= LITERAL_VALUES] for row in counts}
    sets = [with_null(key, F.col("__group").isin([group for group, own in few.items() if key in own])).alias(key) for key in keys]
    found = {row["__group"]: row for row in grouped.groupBy("__group").agg(*sets).collect()}
    return [
        _Group({key: set(found[row["__group"]][key]) for key in few[row["__group"]]}, row["__low"], None if row["__open"] else row["__high"])
        for row in counts
    ]


def delta_counts(
    feed: DataFrame, windows: DataFrame, keys: list[str] = GRAIN, *, size: int | None = None
) -> DataFrame:
    """Endpoints with new rows and how many. Endpoints without any do not appear."""
    versions = feed.select(*keys, "change_version")
    bounds = windows.select(*keys, "last_version", "newest_version", "window_status")
    rows = rows_in_window(versions, bounds, keys, size=size)
    return rows.groupBy(*keys, "last_version", "newest_version").agg(F.count(F.lit(1)).alias("n"))


def slice_number(version: Column, low: Column, step: Column) -> Column:
    """Number of the step a version falls into, counted from the lower bound."""
    return F.floor((version - F.coalesce(low, F.lit(0))) / step).cast("bigint")


def window_slices(windows: DataFrame) -> DataFrame:
    """One row per step of a window, bounds inclusive; a window without both bounds stays whole.

    Steps are numbered from the lower bound. `last_version` itself was loaded before, so the first slice starts
    after it, but for a mark of zero.
    """
    low, high = F.col("last_version"), F.col("newest_version")
    step = F.col("change_version_step_size").cast("bigint")
    stepped = low.isNotNull() & high.isNotNull()
    first = F.when(low == 0, low).otherwise(low + 1)
    starts = F.when(stepped & (first <= high), F.sequence(first, high, step)).when(
        ~stepped, F.array(F.lit(None).cast("bigint"))
    )
    return windows.select("*", F.posexplode(starts).alias("slice", "slice_min")).withColumns(
        {
            "slice_min": F.when(stepped, F.col("slice_min")).otherwise(low),
            "slice_max": F.when(stepped, F.least(F.col("slice_min") + step - 1, high)).otherwise(high),
        }
    )
