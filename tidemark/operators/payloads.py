"""Which payloads to send again, and which inputs have changed."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.joins import join_small_side

NEW, RESEND, FORCED = "new", "resend", "forced"


def payload_hash(payload: Column) -> Column:
    return F.sha2(payload, 256)


def payloads_to_send(
    payloads: DataFrame, sent: DataFrame, *, force: bool = False, resend_status_codes: Iterable[int] = (),
    older_than: datetime | str | None = None, newer_than: datetime | str | None = None, sent_buckets: int | None = None,
) -> DataFrame:
    """Payloads that were not sent, and sent ones that every given filter selects.

    `payloads` has `endpoint` and `payload`; `sent` has `endpoint`, `payload_hash`, `sent_at`, `status_code` with
    one row per sending, of which the last counts. Copies are one row with `copies`: the second would be skipped
    as already sent. Both sides are reduced to one row per hash before they meet, and only the texts that are to be
    sent are moved. A null endpoint or payload equals none that was sent. With `sent_buckets`, the buckets of a ledger
    (`sinks.sent.SentLedger`), the new hashes go to its buckets and the ledger itself is not shuffled.
    """
    hashed = payloads.select("endpoint", payload_hash(F.col("payload")).alias("payload_hash"), "payload")
    distinct = hashed.groupBy("endpoint", "payload_hash").agg(F.count(F.lit(1)).alias("copies"))
    last = (
        sent.groupBy("endpoint", "payload_hash")
        .agg(F.max(F.struct("sent_at", "status_code")).alias("__last"))
        .withColumn("__sent", F.lit(True))
    )
    resend = _resend(list(resend_status_codes), older_than, newer_than)
    reason = F.when(F.lit(force), FORCED).when(F.col("__sent").isNull(), NEW).when(resend, RESEND)
    if sent_buckets is not None:
        distinct = distinct.repartition(sent_buckets, "endpoint", "payload_hash")
    joined = distinct.join(last, ["endpoint", "payload_hash"], "left").withColumn("reason", reason)
    # one text that is never null, for chosen rows with a null endpoint or hash have to find their texts too
    key = F.to_json(F.struct("endpoint", "payload_hash"), {"ignoreNullFields": "false"}).alias("__key")
    chosen = joined.filter("reason is not null").select(key, "copies", "reason")
    texts = join_small_side(hashed.select("*", key), chosen, ["__key"])
    return texts.dropDuplicates(["__key"]).select("endpoint", "payload_hash", "payload", "copies", "reason")


def _resend(codes: list[int], older_than, newer_than) -> Column:
    conditions = []
    if codes:
        conditions.append(F.col("__last.status_code").isin(codes))
    if older_than is not None:
        conditions.append(F.col("__last.sent_at") < F.lit(older_than))
    if newer_than is not None:
        conditions.append(F.col("__last.sent_at") > F.lit(newer_than))
    if not conditions:
        return F.lit(False)
    chosen = conditions[0]
    for condition in conditions[1:]:
        chosen &= condition
    return chosen


def changed_inputs(current: DataFrame, state: DataFrame, *, force: bool = False, skip_hashing: bool = False) -> DataFrame:
    """Inputs whose content differs from the saved state. Both have `path` and `content_hash`, one row per path."""
    if force or skip_hashing:
        return current
    return current.join(state.select("path", "content_hash"), ["path", "content_hash"], "left_anti")
