"""The ledger of payloads that were sent, as a table bucketed by what it is looked up by."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.tables import path_kind

KEYS = ("endpoint", "payload_hash")
COLUMNS = "endpoint string, payload_hash string, sent_at timestamp, status_code int"


class SentLedger:
    """A parquet table below a shared path, in buckets of endpoint and hash.

    `buckets` is fixed when the ledger is made, by default the session's shuffle partitions; later sessions find it. Every
    session that opens the ledger names it in its own catalog.
    """

    def __init__(self, spark: SparkSession, path: str, *, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.table = "sent_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        place = f"{self.path}/buckets"
        if path_kind(spark, place) is None:
            made = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.range(1).select(F.lit(made).alias("buckets")).coalesce(1).write.parquet(place)
        self.buckets = spark.read.parquet(place).first()["buckets"]
        if buckets not in (None, self.buckets):
            raise ValueError(f"the ledger at {self.path} has {self.buckets} buckets, not {buckets}")
        keys = ", ".join(KEYS)
        spark.sql(
            f"create table if not exists {self.table} ({COLUMNS}) using parquet clustered by ({keys}) sorted by ({keys}) "
            f"into {self.buckets} buckets location '{self.path}/sent'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, sent: DataFrame) -> None:
        """Add sendings (endpoint, payload_hash, sent_at, status_code), one file for each bucket that gets some."""
        rows = sent.select(*KEYS, F.col("sent_at").cast("timestamp").alias("sent_at"), F.col("status_code").cast("int").alias("status_code"))
        rows.repartition(self.buckets, *KEYS).write.insertInto(self.table)
