"""Exact deduplication against a persistent index of digests.

The index is a parquet table, bucketed and sorted by the digest of the normalised text. New documents are reduced to one row
for each digest, anti-joined with the index by sort-merge in the index's own buckets, and what it lacks is appended. Texts
are read once and never shuffled.

Of equal texts of one call the row with the largest id stays; a text that an earlier batch brought keeps that batch's row.
Rows that tie on text and id are told apart, so that one of them stays. Null texts count as empty; a null id is less than
any other. Columns other than id and text are left out.

A batch has a name, kept with its digests: a batch that broke off and is added again gets the same answer. One batch at a
time may be added to an index.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.joins import join_small_side, settled
from tidemark.sources.tables import path_kind

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COLUMNS = "digest binary, keep_id bigint, batch string"


def normalised(text: str = "text") -> Column:
    """A-Z lower-cased, all else as it is; null as empty."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, UPPER.lower())


class DigestIndex:
    """An index below a path that all executors share. `buckets` is fixed when the index is made: some 100 MB of digests for
    each (40 bytes a text) is a good size; by default the session's shuffle partitions."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.name = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        self.buckets = self._made_with(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), asked=buckets)
        spark.sql(
            f"create table if not exists {self.name} ({COLUMNS}) using parquet clustered by (digest) sorted by (digest) "
            f"into {self.buckets} buckets location '{self.path}/digests'"
        )

    def _made_with(self, wanted: int, asked: int | None) -> int:
        place = f"{self.path}/buckets"
        if path_kind(self.spark, place) is None:
            self.spark.range(1).select(F.lit(wanted).alias("buckets")).coalesce(1).write.parquet(place)
            return wanted
        made = self.spark.read.parquet(place).first()["buckets"]
        if asked is not None and asked != made:
            raise ValueError(f"the index at {self.path} has {made} buckets, not {asked}")
        return made

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def lacking(self, digests: DataFrame) -> DataFrame:
        """Rows whose digest is not in the index: a sort-merge join in the buckets of the index, which is not shuffled."""
        return digests.repartition(self.buckets, "digest").join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, entries: DataFrame) -> None:
        """Adds entries (digest, keep_id, batch), one file for each bucket, sorted."""
        entries.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").write.insertInto(self.name)

    def compacted(self, path: str, *, buckets: int | None = None) -> DigestIndex:
        """A new index of the same entries at another path: one file for each bucket, or another number of buckets."""
        fresh = DigestIndex(self.spark, path, buckets=buckets or self.buckets)
        fresh.append(self.read())
        return fresh


def deduplicate(docs: DataFrame, index: DigestIndex, *, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds a batch to the index and returns its rows: doc_id, keep_id, group_size (rows of the batch with this text), kept,
    text_sha256.

    Copies are counted in their tasks before digests meet. Only texts of several rows, or known before, are joined back to
    the rows; that side is broadcast when it is small, else Spark may split the join where a text has very many copies.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"))
    # kept once, so that the numbers of rows stay as they are whatever is computed again
    rows = settled(rows.withColumn("row", F.monotonically_increasing_id()))
    groups = rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.coalesce(F.max_by("row", "doc_id"), F.min("row")).alias("row"),
    )
    groups = settled(groups)
    new = settled(index.lacking(groups.select("digest", "keep_id", F.lit(batch).alias("batch"))))
    index.append(new)
    entries = index.read().select("digest", F.col("keep_id").alias("stored_id"), "batch").hint("merge")
    found = groups.repartition(index.buckets, "digest").join(entries, "digest")
    # the others stand alone and are new
    special = found.where((F.col("group_size") > 1) | (F.col("batch") != batch)).select(
        "digest", "stored_id", "group_size", F.when(F.col("batch") == batch, F.col("row")).alias("kept_row"), F.lit(True).alias("special"),
    )
    out = join_small_side(rows, special, ["digest"], "left")
    alone = F.col("special").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("stored_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def oracle() -> str:
    """The contract for one batch and a new index."""
    return f"""select doc_id, max(doc_id) over same keep_id, count(*) over same group_size, doc_id = max(doc_id) over same kept, sha256(t) text_sha256
from (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') t from documents) window same as (partition by t)"""
