"""What keeps tables right and small: sums over ranges, compaction, swaps that broke off, rows of streams that fell short."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import endpoints as E, logs as L, payloads as P
from tidemark.operators.ranges import differing_ranges, windows_of
from tidemark.operators.windows import rows_in_window, window_slices
from tidemark.plans.ingest import ingest_incremental
from tidemark.plans.lake import Lake
from tidemark.plans.load import load_raw
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks import grain
from tidemark.sinks.sent import SentLedger
from tidemark.sources.feed import count_slices, pull_slices
from tidemark.sources.tables import list_files, path_exists, read_or_empty

FEED = "tenant_code string, api_year int, name string, change_version long, payload string"


def feed(spark, *entries):
    return spark.createDataFrame([("t", 2024, *e) for e in entries], FEED)


def test_ranges_that_differ(spark):
    whole = [(name, v, f"p{v}") for name in ("a", None) for v in range(0, 5000, 3)]
    loaded = [(n, v, "changed" if (n, v) == ("a", 1500) else p) for n, v, p in whole if (n, v) not in (("a", 0), (None, 4998))] + [("b", 77, "more"), ("a", 3, "p3")]
    found = differing_ranges(feed(spark, *whole), feed(spark, *loaded), content=["payload"], leaf=10, fan=4)
    want = [(None, 4990, 4999, 3, 2), ("a", 0, 9, 4, 4), ("a", 1500, 1509, 4, 4), ("b", 70, 79, 0, 1)]
    assert rows(found, "name", "range_min", "range_max", "source_rows", "loaded_rows") == sorted(want, key=repr)
    without = differing_ranges(feed(spark, *whole), feed(spark, *loaded), leaf=10, fan=4)
    assert rows(without, "name", "range_min") == sorted([r[:2] for r in want if r[1] != 1500], key=repr)
    again = rows_in_window(feed(spark, *whole), windows_of(found.filter("name = 'a'")))
    assert rows(again, "change_version") == sorted([(v,) for v in (0, 3, 6, 9, 1500, 1503, 1506, 1509)], key=repr)
    slices = window_slices(windows_of(found).withColumn("change_version_step_size", F.lit(5)))
    assert slices.filter("name = 'b'").count() == 2


def test_equal_and_empty_tables_have_no_ranges(spark):
    some, none = feed(spark, ("a", 5, "x")), feed(spark)
    assert differing_ranges(some, some).isEmpty() and differing_ranges(none, none).isEmpty()
    assert rows(differing_ranges(some, none, leaf=10), "range_min", "source_rows", "loaded_rows") == [(0, 1, 0)]


def raw(spark, *ids, name="n", moment="2024-01-01"):
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    values = {field.name: F.lit(None).cast(field.dataType) for field in RAW.fields} | {
        "v": F.parse_json(F.to_json(F.struct("id"))), "pull_timestamp": F.lit(moment).cast("timestamp"),
        "kind": F.lit("resources"), "tenant_code": F.lit("t"), "api_year": F.lit(2024), "name": F.lit(name),
    }
    return frame.select(*[column.cast(RAW[name].dataType).alias(name) for name, column in values.items()])


def ids(spark, path):
    return sorted(((r[0], r[1]) for r in read_or_empty(spark, path, RAW).select("name", F.variant_get("v", "$.id", "long")).collect()), key=repr)


def files_of(spark, path):
    found = list_files(spark, path).select(F.regexp_extract("path", "/name=([^/]*)/", 1).alias("name")).groupBy("name").count()
    return {r["name"]: r["count"] for r in found.collect()}


def test_compaction_rewrites_only_partitions_of_many_small_files(spark, folder):
    path = f"{folder}/raw"
    for i in range(4):
        grain.insert(raw(spark, i, name="many"), path, RAW, RAW_PARTITIONS)
    grain.insert(raw(spark, 9, name=None), path, RAW, RAW_PARTITIONS)
    grain.insert(raw(spark, 8, name=None), path, RAW, RAW_PARTITIONS)
    grain.insert(raw(spark, 5, name="one/=é"), path, RAW, RAW_PARTITIONS)
    before, files = ids(spark, path), {r["path"] for r in list_files(spark, path).collect()}
    plan = grain.compact_small_files(spark, path, RAW, RAW_PARTITIONS)
    assert rows(plan, "name", "files", "bins") == sorted([("many", 4, 1), (None, 2, 1)], key=repr)
    assert ids(spark, path) == before
    assert sorted(files_of(spark, path).values()) == [1, 1, 1]
    assert len(files & {r["path"] for r in list_files(spark, path).collect()}) == 1
    assert grain.compact_small_files(spark, path, RAW, RAW_PARTITIONS).isEmpty()


def test_compaction_fills_bins(spark, folder):
    path = f"{folder}/raw"
    for i in range(6):
        grain.insert(raw(spark, *range(100 * i, 100 * i + 100)), path, RAW, RAW_PARTITIONS)
    size = list_files(spark, path).agg(F.sum("length")).first()[0]
    before = ids(spark, path)
    plan = grain.compact_small_files(spark, path, RAW, RAW_PARTITIONS, target_bytes=size // 3 + 1)
    assert rows(plan, "files", "bins") == [(6, 3)] and ids(spark, path) == before and 2 <= files_of(spark, path)["n"] <= 3


def test_swap_that_broke_off_is_finished(spark, folder, monkeypatch):
    path = f"{folder}/raw"
    grain.insert(raw(spark, 1, 2, name="a"), path, RAW, RAW_PARTITIONS)
    grain.insert(raw(spark, 3, name="b"), path, RAW, RAW_PARTITIONS)
    partitions = spark.createDataFrame([("resources", "t", 2024, "a"), ("resources", "t", 2024, "b")], "kind string, tenant_code string, api_year int, name string")
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:  # after the new versions are there
            raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        real = grain.finish_swaps
        patch.setattr(grain, "finish_swaps", lambda *args: broken(*args) or real(*args))
        with pytest.raises(KeyboardInterrupt):
            grain.rewrite(spark, path, RAW, RAW_PARTITIONS, partitions, lambda found: found.filter("variant_get(v, '$.id', 'long') = 1"))
    assert ids(spark, path) == [("a", 1), ("b", 3)] and path_exists(spark, f"{path}/{grain.EMPTIED}")
    grain.insert_once(raw(spark, 4, name="c"), path, RAW, RAW_PARTITIONS, again=F.lit(False))
    assert ids(spark, path) == [("a", 1), ("c", 4)] and not path_exists(spark, f"{path}/{grain.EMPTIED}")


def test_rows_are_removed_by_key_and_condition(spark, folder):
    path = f"{folder}/raw"
    for name in ("a", "b"):
        for day in (1, 2):
            grain.insert(raw(spark, day, name=name, moment=f"2024-01-0{day}"), path, RAW, RAW_PARTITIONS)
    keys = spark.createDataFrame([("resources", "t", 2024, "a")], "kind string, tenant_code string, api_year int, name string")
    late = F.col("pull_timestamp") == F.lit("2024-01-02").cast("timestamp")
    kept = {r["path"] for r in list_files(spark, path).filter("path like '%name=b%'").collect()}
    grain.remove_rows(spark, path, RAW, RAW_PARTITIONS, stale=late, among=keys)
    assert ids(spark, path) == [("a", 1), ("b", 1), ("b", 2)]
    assert kept == {r["path"] for r in list_files(spark, path).filter("path like '%name=b%'").collect()}
    grain.remove_rows(spark, path, RAW, RAW_PARTITIONS, stale=F.lit(True), among=keys)
    grain.remove_rows(spark, f"{folder}/none", RAW, RAW_PARTITIONS, stale=late, among=keys)
    assert ids(spark, path) == [("b", 1), ("b", 2)]


def test_a_stream_that_fell_short_leaves_nothing_behind(spark, folder):
    lake = Lake(folder)
    own = E.endpoints_from_config(spark, {"students": {}, "schools": {}}, tenant_code="t", api_year=2024)

    def run(moment, there):
        def fetch(piece, offset, size):
            return [json.dumps({"id": i}) for i in range(offset, min(offset + 2, there[piece["name"]]))]

        return ingest_incremental(
            spark, lake, None, own, run_at=moment, newest=5, pull=lambda due: pull_slices(due, fetch, partitions=2),
            pull_counts=lambda due: count_slices(due, lambda piece: 3, partitions=2), find_versions=lambda: ("7", "5"),
        )

    first = run("2024-01-01", {"students": 3, "schools": 2})
    assert rows(first, "name", "pulled_rows", "outcome") == [("schools", 2, "failed"), ("students", 3, "success")]
    assert rows(lake.read_raw(spark).groupBy("name").count()) == [("students", 3)]
    run("2024-01-02", {"students": 3, "schools": 3})
    assert rows(lake.read_raw(spark).groupBy("name").count()) == [("schools", 3), ("students", 3)]


LOG = "tenant_code string, api_year int, grain_update string, run_type string, run_date string, run_timestamp string, seq long, timestamp string, name string, level string, message string, pathname string, lineno int, args map<string,string>, kwargs map<string,string>"


def log(spark, entries):
    return spark.createDataFrame([("t", 2024, None, run, "2024-01-01", "2024-01-01 00:00:00", seq, "at", "task", "ERROR", m, "p", 1, {}, {}) for run, seq, m in entries], LOG)


def test_crowded_positions_are_spread(spark):
    entries = [("r", None, f"n{i}") for i in range(300)] + [("r", 7, f"s{i}") for i in range(200)] + [("r", i, f"o{i}") for i in range(100, 140)] + [("q", 1, "single")] + [("r", None, "copy")] * 3
    frame = log(spark, entries)
    got = L.error_rollup(frame, chunk=10).select("run_type", "part", "n_errors", F.transform("errors", lambda e: e["message"]).alias("m")).orderBy("run_type", "part").collect()
    assert [tuple(r) for r in got[:1]] == [("q", 0, 1, ["single"])]
    listed = [m for r in got[1:] for m in r["m"]]
    assert [len(r["m"]) for r in got[1:]] == [10] * 54 + [3] and {r["n_errors"] for r in got[1:]} == {543}
    assert sorted(listed[:303]) == sorted([f"n{i}" for i in range(300)] + ["copy"] * 3)
    assert sorted(listed[303:503]) == sorted(f"s{i}" for i in range(200)) and listed[503:] == [f"o{i}" for i in range(100, 140)]


def test_crowded_positions_have_ranges_of_their_own(spark, monkeypatch):
    seen = []
    real = F.row_number
    monkeypatch.setattr(L.F, "row_number", lambda: seen.append(1) or real())
    placed = L._placed(L.errors_only(log(spark, [("r", None, f"n{i}") for i in range(4000)])).withColumn("__run", F.lit("r")).withColumn("__block", F.lit(L._NO_BLOCK)), ["message"], 100)
    sizes = [r["count"] for r in placed.groupBy("__seq", "__range").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 200 and rows(placed.select("__position").distinct().agg(F.count("*"), F.max("__position"))) == [(4000, 3999)]


def test_sent_ledger_is_not_shuffled(spark, folder):
    ledger = SentLedger(spark, f"{folder}/sent", buckets=3)
    sent = spark.createDataFrame([("e", f"p{i}", 201 + i % 2) for i in range(40)], "endpoint string, p string, status_code int")
    ledger.append(sent.select("endpoint", F.sha2("p", 256).alias("payload_hash"), F.lit("2024-01-01").alias("sent_at"), "status_code"))
    again = SentLedger(spark, f"{folder}/sent")
    assert again.buckets == 3 and again.read().count() == 40
    with pytest.raises(ValueError):
        SentLedger(spark, f"{folder}/sent", buckets=4)
    payloads = spark.createDataFrame([("e", "p1"), ("e", "new"), (None, None)], "endpoint string, payload string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        want = rows(P.payloads_to_send(payloads, again.read().select("*"), resend_status_codes=[202]), "endpoint", "payload", "reason")
        hashed = payloads.select("endpoint", F.sha2("payload", 256).alias("payload_hash")).groupBy("endpoint", "payload_hash").count()
        last = again.read().groupBy("endpoint", "payload_hash").agg(F.max("sent_at").alias("at"))
        plan = hashed.repartition(3, "endpoint", "payload_hash").join(last, ["endpoint", "payload_hash"], "left")._jdf.queryExecution().executedPlan().toString()
        got = rows(P.payloads_to_send(payloads, again.read(), resend_status_codes=[202], sent_buckets=again.buckets), "endpoint", "payload", "reason")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and ("e", "new", "new") in got
    assert "Bucketed: true" in plan and "Exchange" not in plan[plan.index("sent_at"):].split("Scan parquet")[0]


def test_loads_refuse_files_of_other_kinds(spark, folder):
    from pathlib import Path

    base = Path(folder, "in/t/2024/20240101/20240101T000000/resources")
    base.mkdir(parents=True)
    (base / "students.jsonl").write_text('{"id": 1}\n')
    (base / "_SUCCESS").write_text("")
    options = {"ods_version": "7", "data_model_version": "5"}
    load_raw(spark, Lake(folder + "/a"), folder + "/in", on_unread="fail", **options)
    (base / "schools.jsonl.zst").write_text("x")
    with pytest.raises(ValueError, match="schools.jsonl.zst"):
        load_raw(spark, Lake(folder + "/b"), folder + "/in", on_unread="fail", **options)
    load_raw(spark, Lake(folder + "/b"), folder + "/in", **options)
    assert Lake(folder + "/b").read_raw(spark).count() == 1
    with pytest.raises(ValueError, match="on_unread"):
        load_raw(spark, Lake(folder + "/b"), folder + "/in", on_unread="no", **options)
