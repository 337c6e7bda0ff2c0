"""Change feeds: tables of records with a change version."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.constants import DEFAULT_NUM_RETRIES, DEFAULT_PAGE_SIZE
from tidemark.operators.endpoints import equality_filter
from tidemark.operators.windows import window_slices

#: Pages are put together to batches of at least so many rows or characters.
GATHERED_ROWS, GATHERED_CHARS = 10_000, 4 << 20


def change_window(
    feed: DataFrame, low: int | None, high: int | None, parameters: Mapping[str, object] | None = None
) -> DataFrame:
    """Records of one window and some equality filters; all of it reaches the scan."""
    rows = equality_filter(feed, parameters or {})
    version = F.col("change_version")
    if low:
        rows = rows.filter(version > low)
    if high is not None:
        rows = rows.filter(version <= high)
    return rows


def roster_of(roster: DataFrame, tenant_code: str, api_year: int, parameters: Mapping[str, object] | None = None) -> DataFrame:
    """Roster rows of a tenant-year; `roster_tenant_code` and `roster_api_year` take another one."""
    own = parameters or {}
    tenant = own.get("roster_tenant_code", tenant_code)
    year = own.get("roster_api_year", api_year)
    return roster.filter((F.col("tenant_code") == tenant) & (F.col("api_year") == year))


def pull_slices(
    windows: DataFrame, fetch: Callable[[dict, int, int], list[str]], *, partitions: int, reverse: bool = True,
    count: Callable[[dict], int] | None = None,
) -> DataFrame:
    """Records of a paged source, one slice of a window at a time, slices spread over the executors.

    `windows` has the grain, the bounds, and the options of the endpoints. `fetch(slice, offset, page_size)` returns
    one page of JSON texts, an empty one past the end; it runs inside the tasks. A page may be shorter than asked for:
    only an empty one ends a slice. A page that fails is tried again. A window without both bounds is one slice.

    With `reverse` the last slices go first, and where `count(slice)` tells the rows of a slice, its last page goes
    first as well: a row that changes while it is read moves to the end, and what moves up was not yet read.
    """
    spread, keys = _spread_slices(windows, partitions, reverse)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, types in _pieces(batches):
            for texts in gathered(_pages(fetch, piece, count if reverse else None)):
                same = [pa.repeat(pa.scalar(piece[key], types.field(key).type), len(texts)) for key in keys]
                yield pa.RecordBatch.from_arrays([*same, pa.array(texts, pa.string())], [*keys, "payload"])

    # Spark takes the records to be as few as the slices that they come from, and would broadcast them in a join
    return spread.mapInArrow(read, f"{_key_types(spread, keys)}, payload string").hint("merge")


def count_slices(windows: DataFrame, count: Callable[[dict], int], *, partitions: int) -> DataFrame:
    """Rows that a paged source tells for every stream, slices asked in the tasks."""
    spread, keys = _spread_slices(windows, partitions, reverse=False)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, types in _pieces(batches):
            told = _attempt(lambda: count(piece), _tries(piece))
            same = [pa.array([piece[key]], types.field(key).type) for key in keys]
            yield pa.RecordBatch.from_arrays([*same, pa.array([int(told)], pa.int64())], [*keys, "n"])

    counted = spread.mapInArrow(ask, f"{_key_types(spread, keys)}, n bigint")
    return counted.groupBy(*keys).agg(F.sum("n").alias("n"))


def _spread_slices(windows: DataFrame, partitions: int, reverse: bool) -> tuple[DataFrame, list[str]]:
    keys = [column for column in ("kind", "tenant_code", "api_year", "name") if column in windows.columns]
    options = [column for column in ("namespace", "page_size", "num_retries") if column in windows.columns]
    parameters = ["query_parameters"] if "query_parameters" in windows.columns else []
    slices = window_slices(windows).select(
        *keys, *options, "slice", "slice_min", "slice_max", *[F.to_json(column).alias(column) for column in parameters]
    )
    order = F.desc("slice") if reverse else F.asc("slice")
    return slices.repartition(partitions, *keys, "slice").sortWithinPartitions(*keys, order), keys


def _key_types(rows: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema if field.name in keys)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Schema]]:
    for batch in batches:
        for start in range(0, batch.num_rows, GATHERED_ROWS):
            for piece in batch.slice(start, GATHERED_ROWS).to_pylist():
                if "query_parameters" in piece:
                    piece["query_parameters"] = json.loads(piece["query_parameters"] or "{}")
                yield piece, batch.schema


def gathered(pages: Iterator[list], text: Callable[[object], str] | None = None) -> Iterator[list]:
    """Rows of pages, put together into batches of some size: a batch costs more than its rows when these are few."""
    held, size = [], 0
    for page in pages:
        held += page
        size += sum(map(len, filter(None, page if text is None else map(text, page))))
        if len(held) >= GATHERED_ROWS or size >= GATHERED_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _tries(piece: dict) -> int:
    return int(DEFAULT_NUM_RETRIES if piece.get("num_retries") is None else piece["num_retries"])


def _pages(fetch, piece: dict, count: Callable[[dict], int] | None) -> Iterator[list[str]]:
    size, tries = int(piece.get("page_size") or DEFAULT_PAGE_SIZE), _tries(piece)

    def stretch(start: int, end: int | None) -> Iterator[list[str]]:
        """Pages from a start up to an end, or to the empty page."""
        offset = start
        while end is None or offset < end:
            page = _attempt(lambda: fetch(piece, offset, size if end is None else end - offset), tries)
            if not page:
                return
            yield page
            offset += len(page)

    if count is None:
        yield from stretch(0, None)
        return
    total = int(_attempt(lambda: count(piece), tries))
    yield from stretch(total, None)  # what came after the count
    for start in range((total - 1) // size * size if total else -1, -1, -size):
        yield from stretch(start, min(start + size, total))


def _attempt(ask: Callable[[], object], tries: int):
    while True:
        try:
            return ask()
        except Exception:
            if tries == 0:
                raise
            tries -= 1
