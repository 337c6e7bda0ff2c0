"""Queries on tables with keys and times that the small given tables do not have."""

import os

import pyarrow.parquet as pq
import pytest
from checks.compare import TABLES, differences, oracle
from conftest import rows
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import orgs, ranges, windows as W
from tidemark.plans import ingest
from tidemark.plans.lake import Lake
from tidemark.schemas import GRAIN
from tidemark.sources.feed import gathered, pull_slices
from tidemark.sources.landing import raw_envelope, scan_landing
from tidemark.streaming.landing import _by_file


@pytest.fixture
def altered(spark, folder, sf_dir):
    """A copy of the given tables, of which some are changed."""

    def make(**changes):
        for name in TABLES:
            if name not in changes:
                os.symlink(f"{sf_dir}/{name}.parquet", f"{folder}/{name}.parquet")
        for name, change in changes.items():
            # one file, which both engines read
            pq.write_table(change(spark.read.parquet(f"{sf_dir}/{name}.parquet")).toArrow(), f"{folder}/{name}.parquet")
        return folder

    return make


@pytest.mark.parametrize("name", ["org_fallback", "tenant_org_status", "status_histogram"])
def test_connections_that_end_in_four_digits(spark, altered, name):
    shifted = lambda column: lambda table: table.withColumn(column, F.col(column) + 1995)
    changed = altered(supplier=shifted("s_suppkey"), lineitem=shifted("l_suppkey"))
    assert differences(spark, changed, name, oracle(changed)) is None


def test_the_pattern_of_tenants_ends_before_the_year(spark):
    frame = spark.createDataFrame([(n,) for n in ("edfi_n_5_2024_1000", "edfi_n_15_2024_12345", "edfi_n_5_2024", "edfi_x_2024")], "connection_id string")
    assert rows(orgs.parse_connections(frame, tenant=r"n_\d+"), "tenant", "year") == [("n_15", "2024"), ("n_5", "2024"), ("n_5", "2024")]


def test_moments_on_a_whole_second(spark, altered):
    changed = altered(events=lambda table: table.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))))
    assert differences(spark, changed, "scalar_functions", oracle(changed)) is None
    whole = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert rows(spark.range(1).select(fn.utc_iso(whole, fraction=True))) == [("2024-01-02T03:04:05.000000+00:00",)]


def test_a_row_meets_one_range_however_many_differ(spark):
    rows_of = spark.range(4000).select(F.lit("t").alias("tenant_code"), F.lit(2024).alias("api_year"), F.lit(None).cast("string").alias("name"), F.col("id").alias("change_version"))
    hashed = ranges._hashed(rows_of, GRAIN, [])
    found = ranges._differing([hashed, hashed.filter("change_version % 20 > 0")], GRAIN, 10)
    assert found.count() == 200
    inside = ranges._within(hashed, found, GRAIN, 10)
    assert inside.count() == 2000
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join LeftSemi" in line]
    assert "__number" in join and ">" not in join.replace("<=>", "")  # no row is compared with the bounds of ranges


def test_pulled_records_are_not_broadcast(spark):
    windows = W.with_window_status(
        spark.createDataFrame([("t", 2024, "a", 0, 40_000)], "tenant_code string, api_year int, name string, last_version long, newest_version long")
    ).withColumns({"change_version_step_size": F.lit(500), "page_size": F.lit(500)})

    def fetch(piece, offset, size):
        low = piece["slice_min"] + offset
        return [f"{version:0400d}" for version in range(low, min(low + size, piece["slice_max"] + 1))]

    pulled = pull_slices(windows, fetch, partitions=4).select(*GRAIN, F.col("payload").cast("bigint").alias("change_version"))
    rows_of = spark.range(40_001).select(F.lit("t").alias("tenant_code"), F.lit(2024).alias("api_year"), F.lit("a").alias("name"), F.col("id").alias("change_version"), F.repeat(F.lit("x"), 1000).alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")  # the slices alone are smaller, their records are larger
    try:
        joined = rows_of.join(pulled, [*GRAIN, "change_version"])
        assert joined.select("change_version", "text").distinct().count() == 40_001
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_pages_become_long_batches():
    pages = [["x" * 10] * 150 for _ in range(200)]
    assert [len(batch) for batch in gathered(iter(pages))] == [10_050, 10_050, 9_900]
    assert [len(batch) for batch in gathered(iter([["x" * (1 << 21)]] * 5))] == [2, 2, 1]
    assert list(gathered(iter([[], []]))) == []


def test_only_streams_and_texts_are_shuffled_before_the_write(spark, folder):
    texts = spark.range(0, 3000, 1, 6).select(
        F.lit("resources").alias("kind"), F.lit("t").alias("tenant_code"), F.lit(2024).alias("api_year"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("name"), F.format_string('{"x": %d}', "id").alias("payload"),
    )
    plan = ingest._envelope(texts, F.lit("2024-02-01").cast("timestamp"), "7", "5")._jdf.queryExecution().optimizedPlan().toString()
    parsed, (shuffled, _) = plan.split("RebalancePartitions")[0], plan.split("RebalancePartitions")[1].split("\n", 1)
    assert "parse_json" in parsed.lower().replace("parsejson", "parse_json") and "payload" not in shuffled
    lake = Lake(folder)
    known = texts.select("kind", *GRAIN).distinct().withColumns({"fetch_deletes": F.lit(False), "enabled": F.lit(True)})
    feed = texts.withColumn("change_version", F.get_json_object("payload", "$.x").cast("bigint"))
    done = ingest.ingest_incremental(spark, lake, feed, known, run_at="2024-02-01", ods_version="7", data_model_version="5")
    assert rows(done, "name", "pulled_rows") == [("n0", 1000), ("n1", 1000), ("n2", 1000)]
    raw = lake.read_raw(spark)
    assert raw.select(F.input_file_name()).distinct().count() == 3  # a file for each stream, as it was
    assert rows(raw.groupBy("name").agg(F.sum(F.variant_get("v", "$.x", "bigint")))) == [("n0", 1498500), ("n1", 1499500), ("n2", 1500500)]


def test_texts_without_a_value_are_gathered():
    assert list(gathered(iter([["a", None], [None]]))) == [["a", None, None]]
    assert list(gathered(iter([[(1, "a"), (2, None)]]), lambda row: row[1])) == [[(1, "a"), (2, None)]]


def test_what_a_path_tells_is_read_once_per_file(spark, folder):
    for name in ("a", "b"):
        home = f"{folder}/t/2024/20240101/20240101T000000/resources"
        os.makedirs(home, exist_ok=True)
        with open(f"{home}/{name}.jsonl", "w") as file:
            file.write('{"x": 1}\n' * 3)
    envelope = lambda lines: raw_envelope(lines, ods_version="7", data_model_version="5")
    lines, seen = scan_landing(spark, folder), []
    _by_file(lambda batch, _, files: seen.append((batch, files)), envelope, with_files=True)(lines, 0)
    ((batch, files),) = seen
    same = lambda frame: rows(frame.withColumn("v", F.to_json("v")))
    assert same(batch) == same(envelope(lines)) and batch.count() == 6
    assert rows(files, "kind", "name") == [("resources", "a"), ("resources", "b")]
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" in plan(envelope(lines)) and "regexp_extract" not in plan(batch)
