import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.operators import endpoints as E
from tidemark.operators.outcomes import RunFailed
from tidemark.plans.ingest import fail_if_any_failed, ingest_incremental, reset_ledger
from tidemark.plans.lake import Lake
from tidemark.plans.totals import store_total_counts
from tidemark.schemas import LEDGER, LEDGER_PARTITIONS, RAW, RAW_PARTITIONS
from tidemark.sinks import grain
from tidemark.sources.feed import count_slices, pull_slices
from tidemark.sources.tables import read_or_empty
from tidemark.operators.windows import with_window_status

FEED = "kind string, tenant_code string, api_year int, name string, change_version long, payload string"


def feed_of(spark, *records):
    data = [(kind, "t", 2024, name, version, f'{{"id": {version}}}') for kind, name, version in records]
    return spark.createDataFrame(data + [("resources", "other", 2024, "students", 999, "{}")], FEED)


def known(spark):
    return E.endpoints_from_config(
        spark, {"students": {"fetch_deletes": True}, "schools": {}, "staffs": {}}, tenant_code="t", api_year=2024
    )


def run(spark, lake, feed, at, **options):
    return ingest_incremental(
        spark, lake, feed, known(spark), tenant_code="t", api_year=2024, run_at=at, ods_version="7", data_model_version="5", **options
    )


def loaded(spark, lake):
    return rows(lake.read_raw(spark), "kind", "name", F.variant_get("v", "$.id", "int"))


def active_marks(spark, lake):
    return rows(lake.read_ledger(spark).filter("is_active"), "name", "max_version", "is_deletes", "is_key_changes")


@pytest.mark.parametrize("through_landing", [False, True])
def test_runs_follow_the_feed(spark, folder, through_landing):
    lake = Lake(folder)
    one = [(C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2), (C.RESOURCES, "schools", 3), (C.RESOURCE_DELETES, "students", 2)]
    first = run(spark, lake, feed_of(spark, *one), "2024-01-01", through_landing=through_landing)
    assert rows(first, "kind", "name", "outcome", "pulled_rows") == [
        (C.RESOURCE_DELETES, "students", "success", 1), (C.RESOURCE_KEY_CHANGES, "students", "skipped", 0),
        (C.RESOURCES, "schools", "success", 1), (C.RESOURCES, "staffs", "skipped", 0), (C.RESOURCES, "students", "success", 2),
    ]
    assert active_marks(spark, lake) == [("schools", 3, False, False), ("students", 3, False, False), ("students", 3, True, False)]
    two = one + [(C.RESOURCES, "students", 4)]
    second = run(spark, lake, feed_of(spark, *two), "2024-01-02", through_landing=through_landing)
    assert rows(second.filter("outcome = 'success'"), "name", "last_version", "newest_version", "pulled_rows") == [("students", 3, 4, 1)]
    before = loaded(spark, lake)
    assert before == [
        (C.RESOURCE_DELETES, "students", 2), (C.RESOURCES, "schools", 3),
        (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2), (C.RESOURCES, "students", 4),
    ]
    run(spark, lake, feed_of(spark, *two), "2024-01-03", through_landing=through_landing)
    assert loaded(spark, lake) == before


def test_a_repeated_run_of_some_endpoints_leaves_the_others(spark, folder):
    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "schools", 2))
    run(spark, lake, feed, "2024-01-01", requested=["students"])
    run(spark, lake, feed, "2024-01-01", requested=["schools"])
    assert loaded(spark, lake) == [(C.RESOURCES, "schools", 2), (C.RESOURCES, "students", 1)]
    assert active_marks(spark, lake) == [("schools", 2, False, False), ("students", 2, False, False)]


def test_all_tenants_in_one_run(spark, folder):
    lake = Lake(folder)
    feed = spark.createDataFrame([(C.RESOURCES, t, y, "students", v, "{}") for t, y, v in (("t", 2023, 5), ("t", 2024, 7), ("u", 2024, 9))], FEED)
    every = E.endpoints_from_config(spark, {"students": {}}, tenant_code="t", api_year=2023)
    for tenant, year in (("t", 2024), ("u", 2024), ("v", 2024)):
        every = every.unionByName(E.endpoints_from_config(spark, {"students": {}}, tenant_code=tenant, api_year=year))
    options = dict(ods_version="7", data_model_version="5")
    out = ingest_incremental(spark, lake, feed, every, run_at="2024-01-01", **options)
    assert rows(out, "tenant_code", "api_year", "newest_version", "outcome") == [
        ("t", 2023, 5, "success"), ("t", 2024, 7, "success"), ("u", 2024, 9, "success"), ("v", 2024, None, "skipped"),
    ]
    ingest_incremental(spark, lake, feed, every, run_at="2024-01-02", full_refresh=True, **options)
    assert rows(lake.read_raw(spark), "tenant_code", "api_year", F.col("pull_date").cast("string")) == [
        ("t", 2023, "2024-01-02"), ("t", 2024, "2024-01-02"), ("u", 2024, "2024-01-02"),
    ]
    assert lake.read_ledger(spark).filter("is_active").count() == 9


def test_a_run_that_broke_off_before_its_marks_is_repeated_whole(spark, folder):
    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2))
    run(spark, lake, feed, "2024-01-01")
    grain.clear(spark, lake.ledger, LEDGER, LEDGER_PARTITIONS, {"tenant_code": "t", "api_year": 2024})
    assert active_marks(spark, lake) == []
    run(spark, lake, feed, "2024-01-01")
    assert loaded(spark, lake) == [(C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)]
    assert active_marks(spark, lake) == [("students", 2, False, False)]


def test_full_refresh_replaces_clears_and_marks(spark, folder):
    lake = Lake(folder)
    run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCE_DELETES, "students", 2), (C.RESOURCES, "schools", 3)), "2024-01-01")
    again = feed_of(spark, (C.RESOURCES, "students", 5), (C.RESOURCE_DELETES, "students", 2))
    out = run(spark, lake, again, "2024-01-02", full_refresh=True, requested=["Students"])
    assert rows(out, "kind", "name", "outcome") == [(C.RESOURCES, "students", "success")]
    assert loaded(spark, lake) == [(C.RESOURCES, "schools", 3), (C.RESOURCES, "students", 5)]
    assert active_marks(spark, lake) == [
        ("schools", 3, False, False), ("students", 5, False, False), ("students", 5, False, True), ("students", 5, True, False),
    ]
    follow = run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 5), (C.RESOURCE_DELETES, "students", 2)), "2024-01-03")
    assert rows(follow.filter("name = 'students'"), "window_status") == [("unchanged",)] * 3


def test_out_of_sequence_fails_after_the_others_are_loaded(spark, folder):
    lake = Lake(folder)
    ahead = spark.createDataFrame([("students", None, None, 50, True, False, False, "t", 2024)], LEDGER)
    grain.insert(ahead, lake.ledger, LEDGER, LEDGER_PARTITIONS)
    out = run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "schools", 2)), "2024-01-01")
    assert rows(out.filter("kind = 'resources'"), "name", "window_status", "outcome") == [
        ("schools", "valid", "success"), ("staffs", "valid", "skipped"), ("students", "out_of_sequence", "failed"),
    ]
    assert loaded(spark, lake) == [(C.RESOURCES, "schools", 2)]
    with pytest.raises(RunFailed, match="students"):
        fail_if_any_failed(out)


def test_source_without_change_versions(spark, folder):
    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1)).withColumn("change_version", F.lit(None).cast("long"))
    for at in ("2024-01-01", "2024-01-02"):
        out = ingest_incremental(
            spark, lake, feed, known(spark), tenant_code="t", api_year=2024, run_at=at, has_change_versions=False, get_key_changes=False
        )
    assert rows(out.filter("pulled_rows > 0"), "name", "window_status") == [("students", "unbounded")]
    assert rows(lake.read_raw(spark), "name", "ods_version") == [("students", "ED-FI2")]
    assert active_marks(spark, lake) == []


def test_without_delta_check_unchanged_endpoints_fall_out_by_their_window(spark, folder):
    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1))
    run(spark, lake, feed, "2024-01-01", delta_check=False)
    out = run(spark, lake, feed, "2024-01-02", delta_check=False)
    assert rows(out.filter("name = 'students' and kind = 'resources'"), "window_status", "outcome") == [("unchanged", "skipped")]


def test_feed_filters_reach_one_tenant_year(spark, folder):
    lake = Lake(folder)
    run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1)), "2024-01-01")
    assert rows(lake.read_raw(spark).select("tenant_code").distinct()) == [("t",)]


def test_query_parameters_hold_per_endpoint(spark, folder):
    lake = Lake(folder)
    data = [(C.RESOURCES, "t", 2024, name, version, f'{{"id": {version}}}', year, "x") for name, version, year in
            (("students", 1, 2024), ("students", 2, 2023), ("students", 3, None), ("schools", 4, 2024), ("schools", 5, 2023), ("staffs", 6, 2023))]
    feed = spark.createDataFrame(data, FEED + ", schoolYear int, unused string")
    own = E.endpoints_from_config(spark, {"students": {}, "staffs": {}}, tenant_code="t", api_year=2024, multiyear=True)
    own = own.unionByName(E.endpoints_from_config(spark, {"schools": {}}, tenant_code="t", api_year=2024))
    out = ingest_incremental(spark, lake, feed, own, run_at="2024-01-01", ods_version="7", data_model_version="5", tenant_code="t", api_year=2024)
    assert loaded(spark, lake) == [(C.RESOURCES, "schools", 4), (C.RESOURCES, "schools", 5), (C.RESOURCES, "students", 1)]
    assert rows(out, "name", "expected_rows", "pulled_rows", "outcome") == [("schools", 2, 2, "success"), ("staffs", 0, 0, "skipped"), ("students", 1, 1, "success")]


@pytest.mark.parametrize("through_landing", [False, True])
def test_a_paged_source_in_place_of_a_feed(spark, folder, through_landing):
    lake = Lake(folder)
    own = E.endpoints_from_config(
        spark, {"students": {"page_size": 2, "change_version_step_size": 5, "query_parameters": {"a": "b"}}, "schools": {}}, tenant_code="t", api_year=2024
    )

    def fetch(piece, offset, size):
        if piece["name"] == "schools":
            return []
        assert piece["query_parameters"] == {"a": "b"} and size == 2
        low = int(piece["slice_min"]) + offset
        return [f'{{"id": {version}}}' for version in range(low, min(low + size, int(piece["slice_max"]) + 1))]

    options = dict(ods_version="7", data_model_version="5", through_landing=through_landing)
    for at, newest in (("2024-01-01", 11), ("2024-01-02", 14)):
        out = ingest_incremental(
            spark, lake, None, own, run_at=at, newest=newest, pull=lambda due: pull_slices(due, fetch, partitions=3), **options
        )
    assert rows(out, "name", "last_version", "pulled_rows", "outcome") == [("schools", 0, 0, "skipped"), ("students", 11, 3, "success")]
    assert loaded(spark, lake) == sorted([(C.RESOURCES, "students", i) for i in range(15)], key=repr)
    with pytest.raises(ValueError):
        ingest_incremental(spark, lake, None, own, run_at="2024-01-03", **options)


def test_total_counts(spark, folder):
    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2), (C.RESOURCES, "schools", 9))
    options = dict(tenant_code="t", api_year=2024)
    store_total_counts(spark, lake, feed, known(spark), run_at="2024-01-01", newest=5, **options)
    store_total_counts(spark, lake, feed, known(spark), run_at="2024-01-01", newest=5, **options)
    stored = lambda: rows(lake.read_total_counts(spark), "name", F.col("pull_date").cast("string"), "total_count")
    assert stored() == [("students", "2024-01-01", 2)]
    store_total_counts(spark, lake, feed, known(spark), run_at="2024-01-02", **options)
    store_total_counts(spark, lake, feed, known(spark), run_at="2024-01-03", full_refresh=True, requested=["schools"], **options)
    assert stored() == [("schools", "2024-01-03", 1), ("students", "2024-01-01", 2), ("students", "2024-01-02", 2)]
    store_total_counts(spark, lake, feed, known(spark), run_at="2024-01-04", full_refresh=True, requested=["schools"], delete_all=True, **options)
    assert stored() == [("schools", "2024-01-04", 1)]


def test_reset_of_a_ledger_that_does_not_exist(spark, folder):
    reset_ledger(spark, Lake(folder), {"tenant_code": "t", "api_year": 2024})
    assert Lake(folder).read_ledger(spark).isEmpty()


def test_compact_keeps_the_rows(spark, folder):
    marks = spark.createDataFrame([("a", None, None, 1, True, False, False, "t", 2024)], LEDGER)
    for _ in range(4):
        grain.insert(marks, folder, LEDGER, LEDGER_PARTITIONS)
    before = read_or_empty(spark, folder, LEDGER)
    assert len(before.inputFiles()) == 4
    grain.compact(spark, folder, LEDGER, LEDGER_PARTITIONS, before.select("tenant_code", "api_year"))
    after = read_or_empty(spark, folder, LEDGER)
    assert len(after.inputFiles()) == 1 and after.count() == 4


def test_tenant_codes_keep_their_text(spark, folder):
    frame = spark.createDataFrame([("n", "007", 2024, "a:b/c"), ("n", "x", 2024, None)], "filename string, tenant_code string, api_year int, name string")
    table = frame.withColumns({"pull_date": F.current_date(), "pull_timestamp": F.current_timestamp(), "file_row_number": F.lit(1),
                               "ods_version": F.lit("1"), "data_model_version": F.lit("1"), "v": F.parse_json(F.lit("{}")), "kind": F.lit("resources")})
    grain.insert(table, folder, RAW, RAW_PARTITIONS)
    lake = Lake(folder)
    whole = read_or_empty(spark, folder, RAW)
    assert rows(whole, "tenant_code", "name") == [("007", "a:b/c"), ("x", None)]
    within = {"kind": "resources", "tenant_code": "007", "api_year": 2024, "name": "a:b/c"}
    assert rows(read_or_empty(spark, folder, RAW, within), "name") == [("a:b/c",)]
    grain.clear(spark, folder, RAW, RAW_PARTITIONS, {"kind": "resources", "tenant_code": "007", "api_year": 2024}, ["a:b/c"])
    assert rows(read_or_empty(spark, folder, RAW), "tenant_code") == [("x",)]


def test_pull_slices_reads_every_page_once_and_tries_again(spark):
    data = [("t", 2024, "a", 0, 25), ("t", 2024, "b", 10, 12), ("t", 2024, "c", 3, 3)]
    windows = with_window_status(
        spark.createDataFrame(data, "tenant_code string, api_year int, name string, last_version long, newest_version long")
    ).withColumns({"change_version_step_size": F.lit(10), "page_size": F.lit(3)})
    failures = {}

    def fetch(piece, offset, size):
        key = (piece["name"], int(piece["slice"]), offset)
        failures[key] = failures.get(key, 0) + 1
        if failures[key] == 1:
            raise ConnectionError("try again")
        low = int(piece["slice_min"]) + offset
        return [str(version) for version in range(low, min(low + size, int(piece["slice_max"]) + 1))]

    got = rows(pull_slices(windows, fetch, partitions=3), "name", F.col("payload").cast("int"))
    assert got == sorted([("a", i) for i in range(26)] + [("b", 11), ("b", 12)], key=repr)


def moving_source(total, page_limit, moves):
    """A source of `total` records that gives short pages; on some calls a record changes and moves to the end."""
    import threading

    state, lock = {"rows": list(range(total)), "calls": 0}, threading.Lock()

    def fetch(piece, offset, size):
        with lock:
            state["calls"] += 1
            page = state["rows"][offset:offset + min(size, page_limit)]
            if state["calls"] in moves:
                state["rows"].append(state["rows"].pop(0))
            return [str(v) for v in page]

    return fetch


@pytest.mark.parametrize("total, size, limit", [(0, 3, 3), (1, 3, 3), (7, 3, 3), (12, 5, 2), (9, 3, 4), (1200, 1000, 500)])
@pytest.mark.parametrize("counted", [False, True])
def test_short_pages_end_no_slice(total, size, limit, counted):
    from tidemark.sources.feed import _pages

    got = [int(v) for page in _pages(moving_source(total, limit, ()), {"page_size": size}, (lambda piece: total) if counted else None) for v in page]
    assert sorted(got) == list(range(total))


def test_rows_that_move_while_they_are_read_are_not_lost():
    from tidemark.sources.feed import _pages

    # the two rows that change get new versions and belong to the next run; all others must be there
    got = {int(v) for page in _pages(moving_source(20, 5, {2, 3}), {"page_size": 5}, lambda piece: 20) for v in page}
    assert got >= set(range(2, 20))
    forward = {int(v) for page in _pages(moving_source(20, 5, {2, 3}), {"page_size": 5}, None) for v in page}
    assert not forward >= set(range(2, 20))  # this is why the count is asked for


def test_a_pull_that_falls_short_fails_and_is_not_marked(spark, folder):
    lake = Lake(folder)
    own = E.endpoints_from_config(spark, {"students": {"page_size": 4}, "schools": {}, "staffs": {}}, tenant_code="t", api_year=2024)
    told = {"students": 9, "schools": 3, "staffs": 0}

    def fetch(piece, offset, size):
        assert piece["name"] != "staffs"
        return [f'{{"id": {i}}}' for i in range(offset, min(offset + 2, 9 if piece["name"] == "students" else 2))]

    out = ingest_incremental(
        spark, lake, None, own, run_at="2024-01-01", newest=5, pull=lambda due: pull_slices(due, fetch, partitions=2),
        pull_counts=lambda due: count_slices(due, lambda piece: told[piece["name"]], partitions=2), find_versions=lambda: ("7", "5"),
    )
    assert rows(out, "name", "expected_rows", "pulled_rows", "count_status", "outcome") == [
        ("schools", 3, 2, "mismatch", "failed"), ("staffs", 0, 0, "match", "skipped"), ("students", 9, 9, "match", "success"),
    ]
    assert active_marks(spark, lake) == [("students", 5, False, False)]
    assert rows(lake.read_raw(spark).select("ods_version", "data_model_version").distinct()) == [("7", "5")]


def test_a_time_used_again_with_newer_rows_keeps_the_earlier_ones(spark, folder):
    lake = Lake(folder)
    run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1)), "2024-01-01")
    out = run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)), "2024-01-01")
    assert loaded(spark, lake) == [(C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)]
    assert rows(out.filter("kind = 'resources' and name = 'students'"), "expected_rows", "pulled_rows", "outcome") == [(1, 1, "success")]
    assert active_marks(spark, lake) == [("students", 2, False, False)]


@pytest.mark.parametrize("broken", ["insert", "move", "marks"])
def test_a_run_that_breaks_off_anywhere_is_repeated_whole(spark, folder, monkeypatch, broken):
    from tidemark.plans import ingest

    lake = Lake(folder)
    feed = feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2), (C.RESOURCES, "schools", 3))

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    def half(session, staged, path, but=()):
        ingest_move(session, staged, path, but=[*but, "kind=resources/tenant_code=t/api_year=2024/name=schools"])
        raise KeyboardInterrupt

    ingest_move = ingest.move_files
    with monkeypatch.context() as patch:
        if broken == "insert":
            patch.setattr(ingest.grain, "insert", stop)
        elif broken == "move":
            patch.setattr(ingest, "move_files", half)
        else:
            patch.setattr(ingest.grain, "insert_once", stop)
        with pytest.raises(KeyboardInterrupt):
            run(spark, lake, feed, "2024-01-01")
    assert len(loaded(spark, lake)) == {"insert": 0, "move": 2, "marks": 3}[broken] and active_marks(spark, lake) == []
    run(spark, lake, feed, "2024-01-01")
    assert loaded(spark, lake) == [(C.RESOURCES, "schools", 3), (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)]
    assert [name for name, *_ in active_marks(spark, lake)] == ["schools", "students"]


def test_a_new_run_does_not_read_the_raw_table(spark, folder):
    from pathlib import Path

    lake = Lake(folder)
    run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1)), "2024-01-01")
    broken = Path(lake.raw, "kind=resources/tenant_code=t/api_year=2024/name=students/broken.parquet")
    broken.write_text("no parquet")
    out = run(spark, lake, feed_of(spark, (C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)), "2024-01-02")
    assert rows(out.filter("kind = 'resources' and name = 'students'"), "pulled_rows", "outcome") == [(1, "success")]
    broken.rename(Path(folder, "broken"))
    assert loaded(spark, lake) == [(C.RESOURCES, "students", 1), (C.RESOURCES, "students", 2)]
    assert not Path(folder, "_runs").exists() or not list(Path(folder, "_runs").rglob("*.parquet"))
