"""Incremental ingestion: read marks, pull windows, load, advance the marks."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import constants as C
from tidemark.operators import endpoints as E, marks as M, outcomes as O, windows as W
from tidemark.operators.counts import reconcile, row_counts
from tidemark.operators.joins import among_values, join_small_side, measured_bytes, settled
from tidemark.plans.lake import Lake
from tidemark.plans.load import resolve_versions, run_moment, store_raw, store_raw_run
from tidemark.schemas import GRAIN, LEDGER, LEDGER_PARTITIONS, RAW, RAW_PARTITIONS, TENANT_YEAR
from tidemark.sinks import grain
from tidemark.sinks.batches import move_files, touch
from tidemark.sinks.jsonl import with_run_folders, write_landing
from tidemark.sources.landing import raw_envelope, scan_landing, with_row_numbers
from tidemark.sources.tables import ANY, partition_folder, path_exists, read_or_empty, remove_folder

STREAM = ["kind", *GRAIN]
OPTIONS = ["namespace", "page_size", "num_retries", "change_version_step_size", "query_parameters"]


def reset_ledger(spark: SparkSession, lake: Lake, tenant_years: DataFrame | dict, names: Iterable[str] | None = None) -> None:
    """Make the marks of some tenant-years inactive, of some names or of all."""
    grain.rewrite(
        spark, lake.ledger, LEDGER, LEDGER_PARTITIONS, tenant_years, lambda ledger: M.reset_marks(ledger, names=names)
    )


def clear_shared(spark: SparkSession, lake: Lake, tenant_years: DataFrame, names: list[str] | None = None) -> None:
    """Empty the deletes and key changes of some tenant-years before they are loaded afresh."""
    for row in tenant_years.select(*TENANT_YEAR).toLocalIterator():
        for kind in (C.RESOURCE_DELETES, C.RESOURCE_KEY_CHANGES):
            grain.clear(spark, lake.raw, RAW, RAW_PARTITIONS, {"kind": kind, **row.asDict()}, names)


def stream_windows(streams: DataFrame, ledger: DataFrame, newest: DataFrame) -> DataFrame:
    """Window of every stream with its status and options. `newest` has the newest version of every tenant-year."""
    with_stream = streams.withColumn("stream", M.stream_of_kind(F.col("kind")))
    marked = M.with_last_version(with_stream, M.prior_marks_by_stream(ledger))
    bounded = W.with_window_status(marked.join(newest, TENANT_YEAR, "left"))
    options = [column for column in OPTIONS if column in streams.columns]
    return bounded.select(*STREAM, "last_version", "newest_version", "window_status", *options)


def due_rows(feed: DataFrame, windows: DataFrame, size: int, keys: list[str]) -> DataFrame:
    """Feed rows in the windows of their streams that meet the streams' parameters."""
    bounds = windows.select(
        *STREAM, "last_version", "newest_version", "window_status", *(["query_parameters"] if keys else [])
    )
    return W.rows_in_window(feed, bounds, STREAM, size=size).filter(E.meets_parameters(keys))


def ingest_incremental(
    spark: SparkSession, lake: Lake, feed: DataFrame | None, endpoints: DataFrame, *, run_at: datetime | str,
    tenant_code: str | None = None, api_year: int | None = None, full_refresh: bool = False,
    requested: Iterable[str] | None = None, newest: int | None = None, has_change_versions: bool = True,
    delta_check: bool = True, get_key_changes: bool = True, ods_version: str | None = None,
    data_model_version: str | None = None, through_landing: bool = False,
    pull: Callable[[DataFrame], DataFrame] | None = None, pull_counts: Callable[[DataFrame], DataFrame] | None = None,
    find_versions: Callable[[], tuple[str | None, str | None]] | None = None,
) -> DataFrame:
    """Load what is new in a feed and return one row per stream with what became of it.

    `feed` has the grain, `kind`, `change_version`, `payload` (JSON text) and a column for each query parameter of the
    endpoints. One call takes all tenants and years of `endpoints`, or those given. The newest version of each is fixed
    at the start, so that a run is consistent.

    A source that is no table is given as `pull` in place of the feed: a function from due windows, with the options of
    their endpoints, to rows of `kind`, the grain and `payload`; `newest` must then be given. `pull_counts` tells the
    rows `n` to expect of each of these streams: streams without any are not pulled, and one that falls short of its
    count has failed. `find_versions` asks the source for the versions that are not given.

    Data are written before marks, and marks only for what was loaded whole: a run that breaks off is pulled again, a run
    repeated with the same `run_at` replaces its own rows, and the rows of a stream that fell short are removed again. `through_landing` keeps the pulled rows as JSON lines
    and loads them from there.
    """
    found = find_versions() if find_versions and has_change_versions and not (ods_version and data_model_version) else (None, None)
    ods, model = resolve_versions(ods_version, data_model_version, found=found, has_change_versions=has_change_versions)
    moment = run_moment(run_at)
    replacing = full_refresh or not has_change_versions
    scope = M.in_grain(tenant_code, api_year)
    own = endpoints.filter(scope)
    own_feed = None if feed is None else feed.filter(scope)
    if own_feed is None and (pull is None or (has_change_versions and newest is None)):
        raise ValueError("without a feed, `pull` and `newest` must be given")
    one = None if tenant_code is None or api_year is None else {"tenant_code": tenant_code, "api_year": api_year}
    raw_folder = None if one is None else {"kind": ANY, **one}

    streams = E.kinds_to_run(E.endpoint_streams(own, get_key_changes=get_key_changes), full_refresh)
    names = None
    if wanted := list(requested or []):
        asked = E.snake_names(spark, wanted)
        names = [row["name"] for row in asked.collect()]
        streams = E.requested_endpoints(streams, asked)
    if full_refresh:
        tenant_years = settled(own.select(*TENANT_YEAR).distinct())
        reset_ledger(spark, lake, tenant_years, names)
        clear_shared(spark, lake, tenant_years, names)

    versions = _newest(own_feed, own, newest, has_change_versions)
    windows = settled(stream_windows(streams, lake.read_ledger(spark, one), versions))
    size = measured_bytes(windows)
    keys = E.parameter_keys(windows)
    if not delta_check or (own_feed is None and pull_counts is None):
        windows = windows.withColumn("n", F.lit(None).cast("bigint"))
    else:
        if own_feed is None:
            counts = pull_counts(windows.filter(F.col("window_status").isin(W.VALID, W.UNBOUNDED))).select(*STREAM, "n")
        else:
            versions_only = own_feed.select(*STREAM, "change_version", *keys)
            counts = row_counts(due_rows(versions_only, windows, size, keys), STREAM)
        windows = settled(windows.join(counts, STREAM, "left").withColumn("n", F.coalesce("n", F.lit(0))))
    due = windows.filter(F.col("window_status").isin(W.VALID, W.UNBOUNDED) & F.coalesce(F.col("n") > 0, F.lit(True)))
    pulled = due_rows(own_feed, due, size, keys) if pull is None else pull(due)

    if through_landing:
        lines = _through_landing(spark, lake, pulled, one, moment, ods, model)
        rows = _of_streams(lines, due, size)
    else:
        rows = _envelope(pulled, moment, ods, model)
    run = _Run(spark, lake, moment, one)
    if replacing:
        store_raw(rows, lake, full_refresh=True, balance=through_landing)
        landed = settled(_of_streams(_loaded(spark, lake, raw_folder, moment, due), due, size))
    elif run.began_before():
        # rows of an attempt that broke off may be in the table and are replaced, but not those that were marked
        marked = settled(_marked_at(due, lake.read_ledger(spark, one), moment))
        before = settled(_of_streams(_loaded(spark, lake, raw_folder, moment, due), marked, size).withColumnRenamed("pulled_rows", "__before"))
        replaced = O.failed(due, marked, STREAM).select(*STREAM)
        store_raw_run(rows, lake, run_at=moment, streams=replaced, size=size, within=raw_folder, balance=through_landing)
        landed = _of_streams(_loaded(spark, lake, raw_folder, moment, due), due, size).join(before, STREAM, "left")
        landed = settled(landed.select(*STREAM, (F.col("pulled_rows") - F.coalesce("__before", F.lit(0))).alias("pulled_rows")))
        short = settled(O.failed(_short(due, landed), marked, STREAM))
        if not short.isEmpty():
            grain.remove_rows(spark, lake.raw, RAW, RAW_PARTITIONS, stale=F.col("pull_timestamp") == moment, among=short, within=raw_folder)
    else:
        landed = run.publish(rows, due, size, balance=through_landing)
    if has_change_versions:
        whole = due.join(landed, STREAM).filter(F.coalesce(F.col("pulled_rows") >= F.col("n"), F.lit(True)))
        marked = O.succeeded(due, whole, STREAM).select(
            *STREAM, F.col("newest_version").alias("max_version"), moment.cast("date").alias("pull_date"),
            moment.alias("pull_timestamp"),
        )
        marks = settled(M.new_marks(marked, full_refresh=full_refresh, has_key_changes=get_key_changes))
        grain.insert_once(
            marks, lake.ledger, LEDGER, LEDGER_PARTITIONS, again=F.col("pull_timestamp") == moment,
            among=marks.select(*GRAIN, "is_deletes", "is_key_changes"), within=one,
        )
    run.end()
    return _outcomes(windows, landed)


def _loaded(spark: SparkSession, lake: Lake, raw_folder: dict | None, moment: Column, due: DataFrame) -> DataFrame:
    """Rows of a run that are in the raw table, for each stream."""
    written = lake.read_raw(spark, raw_folder).filter(among_values(due, STREAM))
    return row_counts(written.filter(F.col("pull_timestamp") == moment), STREAM, "pulled_rows")


def _marked_at(due: DataFrame, ledger: DataFrame, moment: Column) -> DataFrame:
    """Due streams that a run of this time has marked before."""
    marks = M.prior_marks_by_stream(ledger.filter(F.col("pull_timestamp") == moment))
    with_stream = due.select(*STREAM).withColumn("stream", M.stream_of_kind(F.col("kind")))
    return with_stream.join(marks, [*GRAIN, "stream"], "left_semi").select(*STREAM)


def _short(due: DataFrame, landed: DataFrame) -> DataFrame:
    """Streams that fell short of their count: they are pulled again from their mark on, so what they brought must not stay."""
    return settled(due.join(landed, STREAM).filter("pulled_rows < n").select(*STREAM))


class _Run:
    """The rows of a run, first written apart under the run's time and tenant-year.

    There they are counted, without a look at the raw table, and then moved into it, but for streams that fell short. A run
    that finds the mark of an earlier attempt at its time has to look for its rows in the table.
    """

    def __init__(self, spark: SparkSession, lake: Lake, moment: Column, one: dict | None):
        time = spark.range(1).select(F.date_format(moment, "yyyyMMdd'T'HHmmss.SSSSSS")).first()[0]
        self.spark, self.lake, self.all = spark, lake, lake.path(f"_runs/{time}")
        self.home = partition_folder(self.all, one) if one else f"{self.all}/all"

    def began_before(self) -> bool:
        return path_exists(self.spark, self.home) or path_exists(self.spark, f"{self.all}/all") or (self.home.endswith("/all") and path_exists(self.spark, self.all))

    def publish(self, rows: DataFrame, due: DataFrame, size: int, balance: bool) -> DataFrame:
        """Rows of each stream (`pulled_rows`), after those of whole streams were moved into the table."""
        staged = f"{self.home}/rows"
        touch(self.spark, f"{self.home}/began")
        grain.insert(rows, staged, RAW, RAW_PARTITIONS, balance)
        landed = settled(_of_streams(row_counts(read_or_empty(self.spark, staged, RAW), STREAM, "pulled_rows"), due, size))
        short = [partition_folder("", row.asDict()) for row in _short(due, landed).select(*RAW_PARTITIONS).collect()]
        move_files(self.spark, staged, self.lake.raw, but=short)
        return landed

    def end(self) -> None:
        """The mark that the run began stays."""
        remove_folder(self.spark, f"{self.home}/rows")


def _newest(feed: DataFrame, endpoints: DataFrame, newest: int | None, has_change_versions: bool) -> DataFrame:
    if has_change_versions and newest is None:
        return W.newest_versions(feed)
    return endpoints.select(*TENANT_YEAR).distinct().withColumn("newest_version", F.lit(newest).cast("bigint"))


def _of_streams(rows: DataFrame, streams: DataFrame, size: int) -> DataFrame:
    """Rows of some streams."""
    return join_small_side(rows, streams.select(*STREAM), STREAM, "left_semi", size=size)


def _envelope(pulled: DataFrame, moment: Column, ods: str, model: str) -> DataFrame:
    """Rows of the raw table, balanced for its write: only the streams and their texts are shuffled."""
    return pulled.select(*STREAM, "payload").hint("rebalance", *RAW_PARTITIONS).select(
        moment.cast("date").alias("pull_date"), moment.alias("pull_timestamp"),
        F.lit(None).cast("bigint").alias("file_row_number"), F.lit(None).cast("string").alias("filename"),
        F.lit(ods).alias("ods_version"), F.lit(model).alias("data_model_version"),
        F.parse_json("payload").alias("v"), *STREAM,
    )


def _through_landing(
    spark, lake: Lake, pulled: DataFrame, one: dict | None, moment: Column, ods: str, model: str
) -> DataFrame:
    """Keep the pulled rows in the landing folders of the run and read them back from there."""
    write_landing(with_run_folders(pulled, moment), lake.landing)
    run = with_run_folders(spark.range(1), moment).first()
    owner = one or {"tenant_code": ANY, "api_year": ANY}
    folder = partition_folder(lake.landing, {**owner, "ds": run["ds"], "ts": run["ts"]})
    if not path_exists(spark, folder):
        return spark.createDataFrame([], RAW)
    lines = with_row_numbers(scan_landing(spark, folder))
    return raw_envelope(lines, ods_version=ods, data_model_version=model)


def _outcomes(windows: DataFrame, landed: DataFrame) -> DataFrame:
    counts = reconcile(landed, windows.select(*STREAM, F.col("n").alias("expected_rows")), STREAM)
    outcome = (
        F.when(F.col("window_status") == W.OUT_OF_SEQUENCE, O.FAILED)
        .when(F.coalesce("pulled_rows", F.lit(0)) < F.col("n"), O.FAILED)
        .when(F.coalesce("pulled_rows", F.lit(0)) > 0, O.SUCCESS)
        .when((F.col("window_status") == W.UNCHANGED) | F.coalesce(F.col("n") == 0, F.lit(True)), O.SKIPPED)
        .otherwise(O.FAILED)
    )
    return windows.join(counts, STREAM, "left").withColumn("outcome", outcome).select(
        *STREAM, "last_version", "newest_version", "window_status", "expected_rows", "pulled_rows", "count_status", "outcome"
    )


def fail_if_any_failed(outcomes: DataFrame) -> None:
    """Raise when a stream of the run failed; call it after the marks are written."""
    O.fail_when(outcomes.select("kind", "name", "window_status", "outcome"), F.col("outcome") == O.FAILED, "streams failed")
