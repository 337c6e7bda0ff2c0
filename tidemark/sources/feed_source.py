"""A paged change feed as a Spark data source, for batches and for streams.

    register_feed(spark, client)
    spark.read.format("change_feed").options(**feed_options(windows)).load().where("change_version > 100")

A client has `fetch(piece, offset, page_size)`, one page of (change version, JSON text), empty past the end; `newest(piece)`,
the newest version of a stream, for streams only; and may have `count(piece)`. A piece is a step of a window as a dict: kind,
tenant_code, api_year, name, slice_min, slice_max, and the endpoint's options. It is pickled and runs in the tasks.

Each step of a window is a partition, or where there are very many, some that follow each other. Filters on the version and
on the columns of a stream choose windows and cut them before anything is fetched. As a stream, the offset is the version of
every stream up to which rows were read, so Spark's own checkpoint is the mark.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as D

from tidemark.constants import DEFAULT_CHANGE_VERSION_STEP
from tidemark.sources.feed import _pages, gathered

FORMAT = "change_feed"
KEYS = ("kind", "tenant_code", "api_year", "name")
SCHEMA = "kind string, tenant_code string, api_year int, name string, change_version bigint, payload string"
_ARROW = pa.schema([("kind", pa.string()), ("tenant_code", pa.string()), ("api_year", pa.int32()), ("name", pa.string()), ("change_version", pa.int64()), ("payload", pa.string())])
OPTIONS = ("namespace", "page_size", "num_retries", "change_version_step_size", "query_parameters")
#: Partitions of a read at most, besides one for each window. A partition of several steps has the size of these under `STRETCH`.
MOST_PARTITIONS, STRETCH = 1_000, "__step"


def register_feed(spark: SparkSession, client: object, name: str = FORMAT) -> None:
    """Make a client readable by a format's name, with filters given to it."""

    class ChangeFeed(D.DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> D.DataSourceReader:
            return FeedReader(client, json.loads(self.options["windows"]))

        def streamReader(self, schema) -> D.DataSourceStreamReader:
            return FeedStreamReader(client, json.loads(self.options["windows"]))

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChangeFeed)


def feed_options(windows: DataFrame | Sequence[Mapping]) -> dict[str, str]:
    """Options of the source: the windows, a row for each stream, from the configuration and so a few.

    A row has the columns of a stream, `last_version` and `newest_version`, of which a missing one leaves the window
    unbounded, and options of the endpoint.
    """
    if isinstance(windows, DataFrame):
        own = [column for column in (*KEYS, "last_version", "newest_version", *OPTIONS) if column in windows.columns]
        windows = [json.loads(row["w"]) for row in windows.select(F.to_json(F.struct(*own)).alias("w")).toLocalIterator()]
    return {"windows": json.dumps([dict(window) for window in windows])}


def steps(window: Mapping, after: int | None, upto: int | None, each: int = 1) -> list[dict]:
    """Pieces of a window of versions after one and up to another, the last first; without both bounds it is one piece.

    With more than one step in `each` piece, it has the size of a step as `STRETCH`.
    """
    piece = {**{key: window.get(key) for key in KEYS}, **{key: window[key] for key in OPTIONS if window.get(key) is not None}}
    piece["query_parameters"] = window.get("query_parameters") or {}
    if after is None or upto is None:
        return [{**piece, "slice_min": None if after is None else after + 1, "slice_max": upto}]
    step = _step(window)
    own = {} if each == 1 else {STRETCH: step}
    starts = range(after + 1, upto + 1, step * each)
    return [{**piece, "slice_min": low, "slice_max": min(low + step * each - 1, upto), **own} for low in reversed(starts)]


def stretches(bounded: Sequence[tuple[Mapping, int | None, int | None]], most: int = MOST_PARTITIONS) -> list[dict]:
    """Pieces of windows with their bounds: single steps, or where these are very many, some in each piece."""
    n_steps = sum(-((after - upto) // _step(window)) for window, after, upto in bounded if None not in (after, upto))
    each = max(1, -(-n_steps // most))
    return [piece for window, after, upto in bounded for piece in steps(window, after, upto, each)]


def _step(window: Mapping) -> int:
    return int(window.get("change_version_step_size") or DEFAULT_CHANGE_VERSION_STEP)


def _steps_of(piece: dict) -> Iterator[dict]:
    """The steps of a partition, the last first."""
    step = piece.get(STRETCH)
    if step is None:
        yield piece
        return
    piece = {key: value for key, value in piece.items() if key != STRETCH}
    for low in reversed(range(piece["slice_min"], piece["slice_max"] + 1, step)):
        yield {**piece, "slice_min": low, "slice_max": min(low + step - 1, piece["slice_max"])}


def _after(window: Mapping) -> int | None:
    """The version before the first of a window; mark zero takes version zero as well."""
    low = window.get("last_version")
    return -1 if low == 0 else low


def _batches(client: object, piece: dict | None) -> Iterator[pa.RecordBatch]:
    if piece is None:
        return

    def pages() -> Iterator[list]:
        for step in _steps_of(piece):
            low, high = step["slice_min"], step["slice_max"]
            for page in _pages(client.fetch, step, getattr(client, "count", None)):
                # a page may hold more than was asked for; filters that were taken over must hold
                yield [(v, text) for v, text in page if (low is None or v >= low) and (high is None or v <= high)]

    for rows in gathered(pages(), lambda row: row[1]):
        same = [pa.repeat(pa.scalar(piece[key], _ARROW.field(key).type), len(rows)) for key in KEYS]
        yield pa.RecordBatch.from_arrays([*same, pa.array([v for v, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], schema=_ARROW)


class FeedReader(D.DataSourceReader):
    def __init__(self, client: object, windows: list[dict]):
        self.client, self.windows = client, windows
        self.after: int | None = None
        self.upto: int | None = None

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        for found in filters:
            if not self._take(found):
                yield found

    def _take(self, found: D.Filter) -> bool:
        column = found.attribute[0] if len(getattr(found, "attribute", ())) == 1 else None
        if column in KEYS and isinstance(found, (D.EqualTo, D.In)):
            wanted = {found.value} if isinstance(found, D.EqualTo) else set(found.value)
            self.windows = [window for window in self.windows if window.get(column) is not None and window[column] in wanted]
            return True
        if column != "change_version" or isinstance(getattr(found, "value", None), (tuple, list)):
            return False
        if isinstance(found, (D.GreaterThan, D.GreaterThanOrEqual, D.EqualTo)):
            low = found.value if isinstance(found, D.GreaterThan) else found.value - 1
            self.after = low if self.after is None else max(self.after, low)
        if isinstance(found, (D.LessThan, D.LessThanOrEqual, D.EqualTo)):
            high = found.value - 1 if isinstance(found, D.LessThan) else found.value
            self.upto = high if self.upto is None else min(self.upto, high)
        # the versions of a feed are never null
        return isinstance(found, (D.GreaterThan, D.GreaterThanOrEqual, D.EqualTo, D.LessThan, D.LessThanOrEqual, D.IsNotNull))

    def partitions(self) -> Sequence[D.InputPartition]:
        bounded = []
        for window in self.windows:
            after = max((bound for bound in (_after(window), self.after) if bound is not None), default=None)
            upto = min((bound for bound in (window.get("newest_version"), self.upto) if bound is not None), default=None)
            if after is None or upto is None or after < upto:
                bounded.append((window, after, upto))
        return [D.InputPartition(piece) for piece in stretches(bounded) or [None]]

    def read(self, partition: D.InputPartition) -> Iterator[pa.RecordBatch]:
        return _batches(self.client, partition.value)


class FeedStreamReader(D.DataSourceStreamReader):
    """Versions of each stream as the offset. A source whose newest version has fallen back stops the query, as rows would
    else be read twice once it rises again."""

    def __init__(self, client: object, windows: list[dict]):
        self.client = client
        self.windows = {json.dumps([window.get(key) for key in KEYS]): window for window in windows}

    def initialOffset(self) -> dict:
        return {key: self._first(window) for key, window in self.windows.items()}

    def _first(self, window: Mapping) -> int:
        after = _after(window)
        return -1 if after is None else after

    def latestOffset(self) -> dict:
        newest = {}
        for key, window in self.windows.items():
            (piece,) = steps(window, None, None)
            found, top = self.client.newest(piece), window.get("newest_version")
            found = self._first(window) if found is None else int(found)
            newest[key] = found if top is None else min(found, top)
        return newest

    def partitions(self, start: dict, end: dict) -> Sequence[D.InputPartition]:
        bounded = []
        for key, window in self.windows.items():
            after, upto = start.get(key, self._first(window)), end.get(key)
            if upto is not None and upto < after:
                raise ValueError(f"the newest version of {key} is {upto}, but {after} was read before")
            if upto is not None:
                bounded.append((window, after, upto))
        return [D.InputPartition(piece) for piece in stretches(bounded) or [None]]

    def read(self, partition: D.InputPartition) -> Iterator[pa.RecordBatch]:
        return _batches(self.client, partition.value)
