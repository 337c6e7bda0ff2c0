"""What the physical plans must look like: filters and columns at the scan, and no needless shuffle."""

import contextlib
import io
import re

import pytest
from checks import views as V
from checks.queries import QUERIES
from pyspark.sql import functions as F

from tidemark.operators import joins, marks as M, matchrates as R, windows as W
from tidemark.plans.shard import shard_rows
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks import grain
from tidemark.sources.csvs import read_text_columns, well_formed
from tidemark.sources.feed import change_window
from tidemark.sources.tables import read_or_empty


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def read_columns(plan):
    return [set(re.findall(r"(\w+):", text)) for text in re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan)]


def test_window_reaches_the_scan(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "change_version")
    plan = plan_of(change_window(orders, 100, 900, {"o_orderstatus": "F"}).select("change_version"))
    for pushed in ("GreaterThan(o_orderkey,100)", "LessThanOrEqual(o_orderkey,900)", "EqualTo(o_orderstatus,F)"):
        assert pushed in plan
    assert read_columns(plan) == [{"o_orderkey", "o_orderstatus"}]


def test_deltas_shuffle_only_partial_counts(spark, sf_dir):
    plan = plan_of(QUERIES["delta_endpoints"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan and "partial_count" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert read_columns(plan) == [{"event_id", "user_id", "event_type"}]


def test_deltas_beyond_the_broadcast_limit_are_the_same(spark, sf_dir, monkeypatch):
    expected = sorted(map(tuple, QUERIES["delta_endpoints"](spark, sf_dir).collect()))
    monkeypatch.setattr(joins.join_small_side, "__kwdefaults__", {**joins.join_small_side.__kwdefaults__, "limit": 0})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = QUERIES["delta_endpoints"](spark, sf_dir)
        plan = plan_of(shuffled)
        got = sorted(map(tuple, shuffled.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert got == expected


def windows_of(spark, *bounds):
    frame = spark.createDataFrame([("t1", 2024, "click", *b) for b in bounds], "tenant_code string, api_year int, name string, last_version long, newest_version long")
    return W.with_window_status(frame)


@pytest.mark.parametrize("bounds, pushed, absent", [
    ([(10, 90), (40, 70)], ["GreaterThan(event_id,10)", "LessThanOrEqual(event_id,90)"], []),
    ([(0, 90), (40, 70)], ["LessThanOrEqual(event_id,90)"], ["GreaterThan(event_id"]),
    ([(10, 90), (40, None)], ["GreaterThan(event_id,10)"], ["LessThanOrEqual(event_id"]),
])
def test_windows_reach_the_scan(spark, sf_dir, bounds, pushed, absent):
    feed = V.feed(spark, sf_dir)
    windows = windows_of(spark, *bounds)
    plan = plan_of(W.delta_counts(feed, windows))
    (filters,) = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert all(p in filters for p in [*pushed, "EqualTo(event_type,click)"]) and not any(p in filters for p in absent)
    want = feed.filter("tenant_code = 't1' and name = 'click'").join(F.broadcast(windows), ["tenant_code", "api_year", "name"])
    want = want.filter(W.in_window(F.col("change_version"), F.col("last_version"), F.col("newest_version"))).count()
    assert sum(r["n"] for r in W.delta_counts(feed, windows).collect()) == want > 0


def mixed_windows(spark, *named):
    frame = spark.createDataFrame([("t1", 2024, *n) for n in named], "tenant_code string, api_year int, name string, last_version long, newest_version long")
    return W.with_window_status(frame)


@pytest.mark.parametrize("few", [True, False])
def test_a_new_endpoint_leaves_the_others_their_marks(spark, sf_dir, monkeypatch, few):
    if not few:
        monkeypatch.setattr(W, "few_rows", lambda windows: None)
    feed = V.feed(spark, sf_dir)
    marks = [("click", 300, 950), ("error", 300, 950), ("purchase", 300, 950), ("signup", 301, 950), ("view", 0, 950)]
    windows = mixed_windows(spark, *marks)
    plan = plan_of(W.delta_counts(feed, windows))
    (filters,) = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan)
    assert "GreaterThan(event_id,300)" in filters and "EqualTo(event_type,view)" in filters and "Or(" in filters
    want = {n: feed.filter(f"tenant_code = 't1' and name = '{n}' and change_version > {low} and change_version <= {high}" if low else f"tenant_code = 't1' and name = '{n}' and change_version <= {high}").count() for n, low, high in marks}
    assert {r["name"]: r["n"] for r in W.delta_counts(feed, windows).collect()} == {n: k for n, k in want.items() if k}


def test_groups_of_windows_are_bounded():
    lows = [(i * i * 1000, i * i * 1000) for i in range(100)]
    cuts = W._cuts(lows)
    assert len(cuts) == W.GROUPS - 1 and cuts == [i * i * 1000 for i in range(92, 99)]
    assert W._cuts([]) == [] == W._cuts([(5, 5), (5, 5)])


def test_groups_of_many_windows_are_those_of_few(spark):
    named = [(f"e{i}", low, high) for i, (low, high) in enumerate([(None, 9), (0, 90), (10, 90), (11, None), (5000, 6000), (5001, 7000), (90000, 90001)])] + [(None, 10, 95)]
    bounds = mixed_windows(spark, *named).selectExpr("tenant_code", "name", "nullif(last_version, 0) __low", "newest_version __high")
    many = {frozenset(g.values["name"]): (g.low, g.high, g.values["tenant_code"]) for g in W._groups_of_many(bounds, ["tenant_code", "name"])}
    assert many[frozenset({"e0", "e1"})] == (None, 90, {"t1"})
    assert many[frozenset({"e6"})] == (90000, 90001, {"t1"})
    assert set().union(*many) == {n for n, *_ in named} and any(None in names for names in many)
    assert all(low is None or low in (10, 11, 5000, 5001, 90000) for low, *_ in many.values())


def test_ingestion_scans_only_open_windows(spark, sf_dir, folder):
    from tidemark.plans.ingest import due_rows

    feed = V.feed(spark, sf_dir).drop("payload")
    windows = windows_of(spark, (10, 90), (90, 90)).withColumn("kind", F.lit("resources"))
    (filters,) = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(due_rows(feed, joins.settled(windows), 100, [])))
    assert "GreaterThan(event_id,10)" in filters and "LessThanOrEqual(event_id,90)" in filters


def test_repeated_batches_open_only_their_partitions(spark, sf_dir, folder):
    rows = V.feed(spark, sf_dir).select(
        F.to_date("ts").alias("pull_date"), F.col("ts").cast("timestamp").alias("pull_timestamp"), F.lit(1).alias("file_row_number"),
        F.lit("f").alias("filename"), F.lit("7").alias("ods_version"), F.lit("5").alias("data_model_version"), F.parse_json("payload").alias("v"),
        "kind", "tenant_code", "api_year", "name",
    )
    grain.insert(rows, folder, RAW, RAW_PARTITIONS)
    keys = grain._Keys(rows.filter("tenant_code = 't1' and name = 'click'").select("kind", "tenant_code", "api_year", "name"))
    earlier = keys.semi(read_or_empty(spark, folder, RAW).filter(keys.among(RAW_PARTITIONS)))
    (pruned,) = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(earlier))
    assert "tenant_code" in pruned and "t1" in pruned and "name" in pruned and "click" in pruned


def test_row_numbers_shuffle_no_text(spark, folder):
    from tidemark.sources.landing import scan_landing, with_row_numbers

    spark.range(100).select(F.to_json(F.struct("id")).alias("value")).write.text(folder + "/in")
    plan = plan_of(with_row_numbers(scan_landing(spark, folder + "/in")))
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan


def test_payload_texts_are_moved_only_where_they_are_sent(spark):
    from tidemark.operators.payloads import payloads_to_send

    payloads = spark.range(50).select(F.lit("e").alias("endpoint"), F.repeat(F.col("id").cast("string"), 9).alias("payload"))
    sent = spark.createDataFrame([], "endpoint string, payload_hash string, sent_at timestamp, status_code int")
    plan = plan_of(payloads_to_send(payloads, sent))
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_prior_marks_read_one_tenant_year(spark, folder, sf_dir):
    from tidemark.schemas import LEDGER, LEDGER_PARTITIONS

    grain.insert(V.ledger(spark, sf_dir), folder, LEDGER, LEDGER_PARTITIONS)
    ledger = read_or_empty(spark, folder, LEDGER).filter(M.in_grain("t1", 2024))
    plan = plan_of(M.prior_marks(ledger))
    assert re.search(r"PartitionFilters: \[[^\]]*tenant_code[^\]]*= t1", plan)
    assert "pull_timestamp" not in plan and "partial_max" in plan


def test_raw_reads_prune_partitions_and_columns(spark, folder, sf_dir):
    feed = V.feed(spark, sf_dir)
    rows = feed.select(
        F.to_date("ts").alias("pull_date"), F.col("ts").cast("timestamp").alias("pull_timestamp"), F.lit(1).alias("file_row_number"),
        F.lit("f").alias("filename"), F.lit("7").alias("ods_version"), F.lit("5").alias("data_model_version"), F.parse_json("payload").alias("v"),
        "kind", "tenant_code", "api_year", "name",
    )
    grain.insert(rows, folder, RAW, RAW_PARTITIONS)
    counted = read_or_empty(spark, folder, RAW).filter("kind = 'resources' and tenant_code = 't1' and name = 'click'").groupBy("name").count()
    plan = plan_of(counted)
    assert re.search(r"PartitionFilters: \[.*tenant_code.*t1.*name.*click", plan)
    assert read_columns(plan) in ([set()], [])


def test_match_rates_scan_each_side_once(spark, sf_dir):
    rates = R.match_rates(V.source_ids(spark, sf_dir), V.roster(spark, sf_dir), ["o_custkey", "o_orderkey"], ["c_custkey", "c_nationkey"], by=R.ASSESSMENT)
    plan = plan_of(rates)
    assert plan.count("FileScan") == 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("partial_count") == 1


def test_best_of_one_assessment_is_a_top_one(spark, sf_dir):
    plan = plan_of(QUERIES["best_match_of_one"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_sharding_through_maps_does_not_shuffle(spark, folder):
    with open(folder + "/a.csv", "w") as file:
        file.write("t,y\na,1\n")
    plan = plan_of(shard_rows(well_formed(read_text_columns(spark, folder + "/a.csv")), "t", {"a": "b"}, "y", {"1": "2001"}))
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("name", ["window_status", "total_counts", "sideload_routing", "param_map_ops", "path_functions", "name_casing"])
def test_scalar_work_stays_in_the_jvm(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "ArrowEval" not in plan


def test_slices_are_spread(spark):
    windows = W.with_window_status(
        spark.createDataFrame([("t", 1, "a", 0, 999)], "tenant_code string, api_year int, name string, last_version long, newest_version long")
    ).withColumns({"change_version_step_size": F.lit(10), "page_size": F.lit(10)})
    from tidemark.sources.feed import pull_slices

    tasks = pull_slices(windows, lambda piece, offset, size: ["{}"] if not offset else [], partitions=8)
    assert tasks.select(F.spark_partition_id()).distinct().count() > 4
