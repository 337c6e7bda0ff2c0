"""The feed as a data source and stream, and batches appended by id."""

import json
import sys

import pytest
from checks import views as V
from conftest import rows
from pyspark import cloudpickle
from pyspark.sql import datasource as D, functions as F

from tidemark.plans.lake import Lake
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks import batches, grain
from tidemark.sources.feed_source import MOST_PARTITIONS, FeedReader, FeedStreamReader, _batches, _steps_of, feed_options, register_feed, steps, stretches
from tidemark.sources.tables import path_kind, remove_folder
from tidemark.streaming.feed import ingest_feed

WINDOW = {"kind": "resources", "tenant_code": "t", "api_year": 2024, "name": "a", "last_version": 0, "newest_version": 25, "change_version_step_size": 10, "page_size": 3}
VERSIONS = {"ods_version": "7", "data_model_version": "5"}


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # clients run in the tasks, which do not find test modules


class Client:
    """Versions up to a newest one, each a record."""

    def __init__(self, newest=25):
        self.top = newest

    def fetch(self, piece, offset, page_size):
        low = max(0, piece["slice_min"] or 0)
        high = self.top if piece["slice_max"] is None else min(self.top, piece["slice_max"])
        return [(v, json.dumps({"v": v})) for v in range(low, high + 1)][offset:offset + page_size]

    def newest(self, piece):
        return self.top


class Failing(Client):
    def fetch(self, piece, offset, page_size):
        raise OSError("gone")


class Telling(Client):
    def count(self, piece):
        return len(self.fetch(piece, 0, 10**6))


def reader(*windows):
    return FeedReader(Client(), [dict(w) for w in windows or (WINDOW,)])


def bounds(parts):
    return [p.value and (p.value["slice_min"], p.value["slice_max"]) for p in parts]


def test_steps_of_a_window():
    assert [(s["slice_min"], s["slice_max"]) for s in steps(WINDOW, -1, 25)] == [(20, 25), (10, 19), (0, 9)]
    assert [(s["slice_min"], s["slice_max"]) for s in steps(WINDOW, 7, 8)] == [(8, 8)]
    assert [(s["slice_min"], s["slice_max"]) for s in steps(WINDOW, None, 25) + steps(WINDOW, 4, None)] == [(None, 25), (5, None)]


def test_filters_choose_windows_and_cut_them():
    other = {**WINDOW, "name": "b", "last_version": 12, "newest_version": None}
    own = reader(WINDOW, other)
    kept = list(own.pushFilters([D.GreaterThan(("change_version",), 8), D.LessThanOrEqual(("change_version",), 21), D.In(("name",), ("a", "b")), D.IsNotNull(("name",)), D.StringContains(("payload",), "x")]))
    assert [type(f).__name__ for f in kept] == ["IsNotNull", "StringContains"]
    assert bounds(own.partitions()) == [(19, 21), (9, 18), (13, 21)]
    list(own.pushFilters([D.EqualTo(("name",), "b"), D.EqualTo(("change_version",), 15)]))
    assert bounds(own.partitions()) == [(15, 15)]
    list(own.pushFilters([D.LessThan(("change_version",), 3)]))
    assert bounds(own.partitions()) == [None]


def test_source_reads_windows_with_filters_of_all_kinds(spark):
    windows = [WINDOW, {**WINDOW, "name": "b", "last_version": None, "newest_version": None}, {**WINDOW, "name": "c", "last_version": 9}]
    for client in (Client(), Telling()):
        register_feed(spark, client, "test_feed")
        feed = spark.read.format("test_feed").options(**feed_options(windows)).load()
        assert rows(feed.groupBy("name").agg(F.count("*"), F.min("change_version"), F.sum("change_version"))) == [("a", 26, 0, 325), ("b", 26, 0, 325), ("c", 16, 10, 280)]
        some = feed.filter("change_version between 12 and 18 and name <> 'a' and payload like '%1%'")
        assert rows(some, "name", "change_version") == [(n, v) for n in "bc" for v in range(12, 19)]
        assert feed.filter("tenant_code = 'no'").count() == 0
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "BatchScan" in plan and "Filter" in plan


def test_windows_may_be_a_table(spark):
    table = spark.createDataFrame([("resources", "t", 2024, "a", 5, 8, 2, 3)], "kind string, tenant_code string, api_year int, name string, last_version long, newest_version long, change_version_step_size int, page_size int")
    register_feed(spark, Client(), "table_feed")
    feed = spark.read.format("table_feed").options(**feed_options(table.withColumn("query_parameters", F.create_map(F.lit("x"), F.lit("1"))))).load()
    assert rows(feed, "change_version") == [(6,), (7,), (8,)]


def test_failing_pages_end_the_read(spark):
    register_feed(spark, Failing(), "failing_feed")
    with pytest.raises(Exception, match="gone"):
        spark.read.format("failing_feed").options(**feed_options([{**WINDOW, "num_retries": 2}])).load().collect()


def test_stream_offsets():
    own = FeedStreamReader(Client(), [dict(WINDOW), {**WINDOW, "name": "b", "last_version": 12, "newest_version": None}])
    start, end = own.initialOffset(), own.latestOffset()
    assert list(start.values()) == [-1, 12] and list(end.values()) == [25, 25]
    assert bounds(own.partitions(start, end)) == [(20, 25), (10, 19), (0, 9), (23, 25), (13, 22)]
    assert bounds(own.partitions(end, end)) == [None]
    assert bounds(own.partitions({}, end)) == bounds(own.partitions(start, end))  # a stream that is new to the checkpoint
    with pytest.raises(ValueError, match="read before"):
        own.partitions(end, start)


def test_feed_stream_loads_each_version_once(spark, folder):
    lake, checkpoint = Lake(folder + "/lake"), folder + "/checkpoint"
    window = {**WINDOW, "newest_version": None}
    seen = []
    for newest in (10, 10, 25, 25):
        ingest_feed(spark, lake, Client(newest), [window], checkpoint, **VERSIONS)
        seen.append(lake.read_raw(spark).count())
    assert seen == [11, 11, 26, 26]
    # the last batch is run again when its end was not recorded
    remove_folder(spark, checkpoint + "/commits")
    ingest_feed(spark, lake, Client(25), [window], checkpoint, **VERSIONS)
    assert rows(lake.read_raw(spark), F.variant_get("v", "$.v", "int")) == sorted(((v,) for v in range(26)), key=repr)
    with pytest.raises(Exception, match="read before"):
        ingest_feed(spark, lake, Client(3), [window], checkpoint, **VERSIONS)


def raw_rows(spark, *ids):
    frame = spark.createDataFrame([(i, f"n{i % 2}") for i in ids], "id long, name string")
    values = {field.name: F.lit(None).cast(field.dataType) for field in RAW.fields} | {
        "v": F.parse_json(F.to_json(F.struct("id"))), "kind": F.lit("resources"), "tenant_code": F.lit("t"), "api_year": F.lit(2024), "name": F.col("name"),
    }
    return frame.select(*[column.alias(name) for name, column in values.items()])


@pytest.fixture
def table(spark, folder):
    options = {"path": folder + "/raw", "schema": RAW, "partition_by": RAW_PARTITIONS, "commits": folder + "/commits", "stream": "s"}

    def append(batch_id, *ids):
        return batches.append_batch(raw_rows(spark, *ids), batch_id=batch_id, **options)

    def ids():
        read = spark.read.schema(RAW).option("basePath", options["path"]).parquet(options["path"])
        return sorted(r[0] for r in read.select(F.variant_get("v", "$.id", "long")).collect())

    return append, ids


def test_batches_are_appended_once(spark, folder, table):
    append, ids = table
    assert append(0, 1, 2, 3) and append(1, 4) and not append(0, 1, 2, 3) and not append(1, 9)
    assert ids() == [1, 2, 3, 4]
    assert append(2) and ids() == [1, 2, 3, 4]  # a batch without rows
    assert path_kind(spark, folder + "/commits/s/0/rows") is None


def test_batch_broken_off_while_it_was_written(spark, folder, table):
    append, ids = table
    # rows without the mark that they are whole
    grain.insert(raw_rows(spark, 7, 8), folder + "/commits/s/0/rows", RAW, RAW_PARTITIONS)
    assert append(0, 1, 2) and ids() == [1, 2]


def test_batch_broken_off_while_it_was_moved(spark, folder, table, monkeypatch):
    append, ids = table
    moved = []
    real = batches._files

    def some(system, place):
        for inner in real(system, place):
            if moved:
                raise KeyboardInterrupt
            moved.append(inner)
            yield inner

    with monkeypatch.context() as patch:
        patch.setattr(batches, "list", lambda files: files, raising=False)
        patch.setattr(batches, "_files", some)
        with pytest.raises(KeyboardInterrupt):
            append(0, 1, 2)
    assert len(moved) == 1 and len(ids()) == 1
    assert append(0, 1, 2) and ids() == [1, 2]


def test_table_is_not_read(spark, folder, table):
    append, _ = table
    append(0, 1)
    broken = folder + "/raw/kind=resources/tenant_code=t/api_year=2024/name=n1/broken.parquet"
    with open(broken, "w") as file:
        file.write("no parquet")
    assert append(1, 3) and not append(1, 3)


def test_very_many_steps_share_partitions():
    windows = [({**WINDOW, "change_version_step_size": 10}, -1, 99), ({**WINDOW, "name": "b"}, 4, 4), ({**WINDOW, "name": "c"}, None, 7)]
    assert bounds([D.InputPartition(piece) for piece in stretches(windows, 10)]) == [(low, low + 9) for low in range(90, -1, -10)] + [(None, 7)]
    few = stretches(windows, 4)
    assert bounds([D.InputPartition(piece) for piece in few]) == [(90, 99), (60, 89), (30, 59), (0, 29), (None, 7)]
    assert [(s["slice_min"], s["slice_max"]) for piece in few[:2] for s in _steps_of(piece)] == [(90, 99), (80, 89), (70, 79), (60, 69)]
    versions = [v for piece in few[:4] for batch in _batches(Client(99), piece) for v in batch.column("change_version").to_pylist()]
    assert sorted(versions) == list(range(100))
    assert len(FeedReader(Client(), [{**WINDOW, "newest_version": 10**9}]).partitions()) <= MOST_PARTITIONS


class Counted(Client):
    """Tells how often it was asked for pages."""

    def __init__(self, newest):
        super().__init__(newest)
        self.asked = 0

    def fetch(self, piece, offset, page_size):
        self.asked += 1
        return super().fetch(piece, offset, page_size)


def test_short_pages_are_read_into_long_batches():
    client = Counted(999)
    found = list(_batches(client, steps({**WINDOW, "page_size": 3}, None, None)[0]))
    assert client.asked > 300 and [batch.num_rows for batch in found] == [1000]


def test_pages_of_the_checked_feed_read_few_rows(spark, folder):
    """A page is found by its position; the rows that are read grow with the page, not with the stream."""
    events = spark.range(200_000).select(
        F.col("id").alias("event_id"), (F.col("id") * 0).alias("user_id"), F.lit("a").alias("event_type"),
        F.to_json(F.struct(F.xxhash64("id").alias("k"))).alias("props"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    store = V.paged_feed(spark, folder)
    client, piece = V.FeedClient(store), {"tenant_code": "t0", "name": "a", "slice_min": 1000, "slice_max": None}

    def page(client, piece, offset, size):
        with pytest.raises(OSError, match="busy"):
            client.fetch(piece, offset, size)
        return [version for version, _ in client.fetch(piece, offset, size)]

    assert page(client, piece, 0, 3) == [1000, 1001, 1002] and page(client, piece, 150_000, 2) == [151_000, 151_001]
    assert page(client, piece, 198_998, 5) == [198_998 + 1000, 199_999] and page(client, piece, 199_000, 5) == []
    assert page(client, {**piece, "slice_max": 1003}, 2, 400) == [1002, 1003]
    long = page(client, piece, 100, 50_000)
    assert long == list(range(1100, 51_100))
    assert client.newest({**piece, "slice_min": None}) == 199_999 and client.newest({**piece, "name": "b"}) is None
    assert V.FeedClient(store, 77).newest({**piece, "slice_min": None}) == 77
    assert all(len(rows) < 50_000 for rows in client.groups.values()) and len(client.groups) <= 4
