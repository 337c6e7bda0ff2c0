"""A paged change feed as a stream into the raw table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.lake import Lake
from tidemark.plans.load import resolve_versions
from tidemark.schemas import RAW, RAW_PARTITIONS
from tidemark.sinks.batches import append_batch
from tidemark.sources.feed_source import FORMAT, KEYS, feed_options, register_feed


def ingest_feed(
    spark: SparkSession, lake: Lake, client: object, streams: DataFrame | Sequence[Mapping], checkpoint: str, *,
    ods_version: str, data_model_version: str, name: str = FORMAT,
) -> None:
    """Load what is newer than the last run with this checkpoint, then stop.

    The checkpoint holds the version of each stream up to which rows were loaded: it is the mark. `last_version` of a
    stream counts in its first run only. Batches are appended by id, so one that broke off and runs again is there once.
    """
    ods, model = resolve_versions(ods_version, data_model_version)
    register_feed(spark, client, name)
    rows = spark.readStream.format(name).options(**feed_options(streams)).load()
    moment = F.current_timestamp()
    raw = rows.select(
        moment.cast("date").alias("pull_date"), moment.alias("pull_timestamp"), F.lit(None).cast("bigint").alias("file_row_number"),
        F.lit(None).cast("string").alias("filename"), F.lit(ods).alias("ods_version"), F.lit(model).alias("data_model_version"),
        F.parse_json("payload").alias("v"), *KEYS,
    )
    writer = raw.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    writer.foreachBatch(batch_appender(lake)).start().awaitTermination()


def batch_appender(lake: Lake) -> Callable[[DataFrame, int], None]:
    """Appends the batches of a running query to the raw table, each id of the query once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # the query's id is kept in its checkpoint and survives a restart
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_batch(batch, lake.raw, RAW, RAW_PARTITIONS, commits=lake.path("_batches"), stream=query, batch_id=batch_id)

    return write
